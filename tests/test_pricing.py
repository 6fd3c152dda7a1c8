from __future__ import annotations

import random
from collections import defaultdict

import pytest
from brute import top_share as literal_top_share
from pyspark.sql import functions as F

from adflow import session
from adflow.operators import pricing, topshare
from adflow.operators.rollups import best_by_rate, status_counts, weighted_rate
from adflow.operators.topshare import top_share
from adflow.session import stored
from adflow.sources import readers, sinks

# Statistics and orders with known prices.
SIMPLE_STATS = """\
1	9223372032561204273	abc.com	1	7500	5	200	1	960*60
2	2455123	abc.com	1	2000	10	1000	1	960*60
3	9223372032560524225	abc.com	1	10000	25	1800	1	960*60
4	9223372032562425138	other.com	4	100	5	200	1	960*90
5	9223372032560524225	abc.com	1	150	0	0	1	960*60
6	9223372032560975139	google.com	5	100	5	200	1	960*60
7	9223372032560524225	abc.com	1	1	1	50	1	960*60
8	9223372032560524225	abc.com	1	60000	127	12700	1	960*60
9	9223372032560524225	abc.com	1	400	5	200	1	728*90
10	9223372032560524225	abc.com	1	400	5	200	1	960*60
11	9223372032560524225	abc.com	1	400	5	200	1	728*90
12	9223372032560524225	abc.com	1	400	5	200	1	960*60
13	9223372032560524225	abc.com	1	400	5	200	1	960*60
14	9223372032560524225	abc.com	0	608741	146	22560	1	960*60
15	9223372032560524225	abc.com	0	131324	102	10689	1	960*60
16	9223372032560524225	abc.com	0	715656	534	119498	1	960*60
"""
AUDIT_STATS = (
    "16	9223372032560524225	abc.com	1	250000	1000	750000	1	300*250\n" * 4
    + "16	9223372032560524225	abc.com	1	250000	1000	5000	1	960*60\n" * 4
    + SIMPLE_STATS
)
SIMPLE_ORDER = "1	PDBS-1447055117-2888	ABC网站	abc.com	0	257698038720	88	DSP哈哈\n"
AUDIT_ORDER = "1	PDBS-1447055117-2888	ABC网站	abc.com	0	1073741824300	88	DSP哈哈\n"

RUN_DATE = "2016-01-31"


def text_file(spark, folder, content: str) -> str:
    path = folder("fixture")
    rows = [(line,) for line in content.splitlines()]
    spark.createDataFrame(rows, "value string").coalesce(1).write.text(path)
    return path


def price_files(spark, folder, stats: str, orders: str):
    return pricing.price_orders(
        readers.read_stats(spark, text_file(spark, folder, stats)),
        readers.read_orders(spark, text_file(spark, folder, orders)),
    )


def test_simple_order_succeeds(spark, folder):
    priced = price_files(spark, folder, SIMPLE_STATS, SIMPLE_ORDER)
    row = priced.collect()
    assert len(row) == 1
    got = row[0].asDict()
    assert (got["domain"], got["size_code"], got["status"]) == ("abc.com", 257698038720, "success")
    assert (got["premium_rate"], got["original_rate"], got["best_rate"]) == (265, 110, 205)
    assert (got["best_channel_name"], got["best_impression"]) == ("NOVA", 81651)
    statement = pricing.price_statements(priced, RUN_DATE).first()["statement"]
    assert statement == (
        "update pre_order set order_price =     2.65, pre_state=6, mod_time='2016-01-31' "
        "where order_id = 'PDBS-1447055117-2888';"
    )


def test_expensive_order_needs_audit(spark, folder):
    priced = price_files(spark, folder, AUDIT_STATS, AUDIT_ORDER)
    got = priced.first().asDict()
    assert (got["domain"], got["size_code"], got["status"]) == ("abc.com", 1073741824300, "audit")
    assert (got["premium_rate"], got["original_rate"], got["best_rate"]) == (4500, 3000, 1458)
    assert (got["best_channel_name"], got["best_impression"]) == ("NOVA", 2081651)
    statement = pricing.price_statements(priced, RUN_DATE).first()["statement"]
    assert statement.endswith(
        "values(1, 'PDBS-1447055117-2888','ABC网站','abc.com',1,1073741824300,   45.00,0.0,   30.00,   14.58,"
        "1,2081651,0,'2016-01-31','2016-01-31');"
    )


def test_unknown_domain_fails_and_says_why(spark, folder):
    order = "7	X-1	Site	nowhere.com	0	257698038720	88	DSP\n8	X-2	Site	nowhere.com	0	0	88	DSP\n"
    priced = price_files(spark, folder, SIMPLE_STATS, order)
    rows = {r["order_id"]: r for r in priced.collect()}
    assert {r["status"] for r in rows.values()} == {"fail"}
    assert rows["X-1"]["msg"] == (
        "PDOrder(7,X-1,Site,nowhere.com,0,257698038720,88,DSP)\tNo size found for nowhere.com 960*60"
    )
    assert rows["X-2"]["msg"].endswith("\tNo size found for nowhere.com ")
    lines = {r["value"].split("\t")[1]: r["value"] for r in pricing.result_lines(priced).collect()}
    assert lines["X-1"].startswith("7\tX-1\tnowhere.com\t257698038720\tPDOrder(")
    statement = pricing.price_statements(priced.where("order_id = 'X-1'"), RUN_DATE).first()["statement"]
    assert statement == "update pre_order set pre_state=7, mod_time='2016-01-31' where order_id = 'X-1';"


def test_duplicate_orders_are_kept_and_counted(spark, folder):
    priced = price_files(spark, folder, SIMPLE_STATS, SIMPLE_ORDER * 3 + SIMPLE_ORDER.replace("abc.com", "z.com"))
    counts = status_counts(priced).first().asDict()
    assert counts == {"results": 4, "success": 3, "normal": 3, "below_floor": 0, "fail": 1, "audit": 0}
    headers = {r["header"] for r in pricing.result_headers(priced).collect()}
    assert headers == {"Output success results, num=3", "Output fail results, num=1"}


def test_floor_and_free_channel(spark):
    stats = spark.createDataFrame(
        [("free.com", 3, 1000, 0, 0, 0), ("cheap.com", 3, 1000, 0, 20, 0)],
        "domain string, dsp_id int, impression bigint, clk bigint, cost bigint, size_code bigint",
    )
    orders = spark.createDataFrame(
        [(1, "A", "n", "free.com", 0, 0, 1, "d"), (2, "B", "n", "cheap.com", 0, 0, 1, "d")],
        "order_key bigint, order_id string, ssp_name string, domain string, creative_styles int, "
        "size_code bigint, dsp_id int, dsp_name string",
    )
    got = {r["order_id"]: r for r in pricing.price_orders(stats, orders).collect()}
    assert (got["A"]["premium_rate"], got["A"]["best_rate"], got["A"]["status"]) == (100, 0, "audit")
    assert (got["B"]["premium_rate"], got["B"]["below_floor"], got["B"]["status"]) == (100, True, "audit")


def test_result_files_hold_headers_and_both_shapes(spark, folder):
    priced = price_files(spark, folder, SIMPLE_STATS, SIMPLE_ORDER + SIMPLE_ORDER.replace("abc.com", "z.com"))
    path = folder("results")
    sinks.write_result_headers(priced, path)
    sinks.write_results(priced, path)
    lines = {(r["status"], r["value"].count("\t")) for r in spark.read.text(path).collect()}
    assert lines == {("success", 0), ("success", 9), ("fail", 0), ("fail", 5)}


def random_rows(seed: int, keys: int) -> list[tuple[str, int, int]]:
    """Rows with ties, zero values, equal copies, tiny keys and one hot key."""
    rng = random.Random(seed)
    rows = []
    for k in range(keys):
        for _ in range(rng.choice([1, 2, 3, 10, 40])):
            weight = rng.choice([1, 2, 3, 10, 100, rng.randint(1, 10**6)])
            rows.append((f"k{k}", weight, rng.choice([0, 0, weight, weight * 2, rng.randint(0, 10**6)])))
    hot = [("hot", rng.randint(1, 50), rng.choice([0, 7])) for _ in range(len(rows) // 2)]
    return rows + hot + [("same", 4, 3)] * 101 + [("zero", w, 0) for w in range(1, 200)]


@pytest.mark.parametrize("share", [0.25, 0.1, 0.9])
def test_top_share_agrees_with_literal_loop(spark, share):
    rows = random_rows(seed=int(share * 100), keys=120)
    df = spark.createDataFrame(rows, "key string, w bigint, v bigint")
    expected = defaultdict(list)
    for key, w, v in rows:
        expected[key].append((w, v))
    got = top_share(df, ["key"], "w", "v", share=share).collect()
    assert {r["key"]: tuple(r)[1:] for r in got} == {k: literal_top_share(v, share) for k, v in expected.items()}


def test_top_share_on_an_exact_row_edge(spark):
    rows = [("k", 25, 100), ("k", 25, 50), ("k", 50, 10)]
    got = top_share(spark.createDataFrame(rows, "key string, w bigint, v bigint"), ["key"], "w", "v").first()
    assert (got["top_weight"], got["top_value"]) == (25, 100)


def test_top_share_of_less_than_one_unit(spark):
    got = top_share(spark.createDataFrame([("k", 1, 50)], "key string, w bigint, v bigint"), ["key"], "w", "v").first()
    assert (got["top_weight"], got["top_value"], got["top_rate"], got["all_rate"]) == (0, 12, 0, 50000)


def test_top_share_of_nothing(spark):
    empty = spark.createDataFrame([], "key string, w bigint, v bigint")
    assert top_share(empty, ["key"], "w", "v").count() == 0
    with pytest.raises(ValueError):
        top_share(empty, ["key"], "w", "v", share=1.5)


def test_top_share_keeps_the_key_null_and_adds_up_coarser_keys(spark):
    rng = random.Random(11)
    rows = [(rng.choice(["a", "b", None]), rng.choice([0, 1, 2, None]), rng.randint(1, 50), rng.randint(0, 99)) for _ in range(900)]
    df = spark.createDataFrame(rows, "d string, s int, w bigint, v bigint")
    got = top_share(df, ["d", "s"], "w", "v", coarser={"s": F.lit(0)}).collect()
    expected = defaultdict(list)
    for d, s, w, v in rows:
        for key in {(d, s), (d, 0)}:
            expected[key].append((w, v))
    assert {(r["d"], r["s"]): tuple(r)[2:] for r in got} == {k: literal_top_share(v) for k, v in expected.items()}
    assert len(got) == len(expected) == 12


def test_top_share_of_wanted_keys(spark):
    df = spark.createDataFrame(random_rows(seed=4, keys=30), "key string, w bigint, v bigint")
    wanted = spark.createDataFrame([("k3",), ("hot",), ("hot",), ("nowhere",)], "key string")
    got = {tuple(r) for r in top_share(df, ["key"], "w", "v", wanted=wanted).collect()}
    every = top_share(df, ["key"], "w", "v")
    assert got == {tuple(r) for r in every.where("key in ('k3', 'hot')").collect()} and len(got) == 2


def test_bands_are_shuffled_once_for_join_and_windows(spark, monkeypatch):
    """One shuffle serves the join with the wanted keys and the windows; step 2 is computed once."""
    plans = {}

    def noted(df, label, *args):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return session.stored(df, label, *args)

    monkeypatch.setattr(topshare, "stored", noted)
    rows = [(None if k == "k1" else k, i % 3 or None, w, v) for i, (k, w, v) in enumerate(random_rows(seed=5, keys=30))]
    df = spark.createDataFrame(rows, "d string, s int, w bigint, v bigint")
    wanted = df.where("d is null or d <> 'k2'").select("d", "s").distinct().union(spark.sql("select 'hot', 0"))
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        got = top_share(df, ["d", "s"], "w", "v", wanted=stored(wanted, "wanted"), coarser={"s": F.lit(0)})
        got = {(r["d"], r["s"]): tuple(r)[2:] for r in got.collect()}
    finally:
        spark.conf.set(limit, before)
    groups = defaultdict(list)
    for d, s, w, v in rows:
        if d != "k2":
            groups[d, s].append((w, v))
        if d == "hot":
            groups[d, 0].append((w, v))
    assert got == {k: literal_top_share(v) for k, v in groups.items()}
    assert list(plans) == ["bands", "close"]
    window = plans["bands"].rindex("Window [")
    join = plans["bands"].index("Join", window)
    assert "Exchange" not in plans["bands"][window:join]


def test_best_channel_ties_go_to_the_lowest(spark):
    rows = [("d", 5, 1000, 10), ("d", 2, 1000, 10), ("d", 9, 1000, 1)]
    got = best_by_rate(spark.createDataFrame(rows, "domain string, dsp int, w bigint, v bigint"), ["domain"], "dsp", "w", "v")
    assert got.first().asDict() == {"domain": "d", "best_dsp": 2, "best_rate": 10, "best_w": 1000}


def test_weighted_rate_without_weight_is_zero(spark):
    got = weighted_rate(spark.createDataFrame([(0, 5)], "w bigint, v bigint"), [], "w", "v").first()
    assert got["rate"] == 0


def test_raw_rows_meet_no_window(spark):
    """Windows see bands and distinct values, which come out of an aggregate."""
    df = spark.range(1000).select((F.col("id") % 3).alias("key"), (F.col("id") + 1).alias("w"), F.col("id").alias("v"))
    plan = top_share(df, ["key"], "w", "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan.split("Window")[-1]
