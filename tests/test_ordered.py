from __future__ import annotations

import random
from collections import defaultdict

import pytest
from brute import walk
from pyspark.sql import functions as F

from adflow.operators import ordering
from adflow.operators.scans import previous_value, running_sums, with_position, zip_tables
from adflow.operators.sequences import PHASE_CHANGES, contiguous_prefix, running_valid, validate_transitions


def entries(n: int = 600) -> list[tuple]:
    """Entries of a few keys, one of them hot and one NULL, in random order."""
    rng = random.Random(5)
    keys = ["hot"] * 6 + ["a", "b", "c", None]
    rows = [(rng.choice(keys), i // 3, i, rng.randint(-5, 20)) for i in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("parts", [1, 2, 7, 50, None])
def test_running_sums(spark, parts):
    rows = entries()
    df = spark.createDataFrame(rows, "key string, day int, id int, amount int").repartition(5)
    got = running_sums(df, ["key"], ["day", "id"], {"total": F.col("amount"), "n": F.lit(1)}, parts).collect()
    totals, counts, expected = defaultdict(int), defaultdict(int), {}
    for key, _, i, amount in sorted(rows, key=lambda r: r[2]):
        totals[key] += amount
        counts[key] += 1
        expected[i] = (totals[key], counts[key])
    assert {r["id"]: (r["total"], r["n"]) for r in got} == expected
    assert len(got) == len(rows)


@pytest.mark.parametrize("parts", [1, 2, 9, None])
def test_previous_value(spark, parts):
    rows = entries()
    df = spark.createDataFrame(rows, "key string, day int, id int, amount int")
    got = previous_value(df, ["key"], ["day", "id"], "amount", "before", parts).collect()
    last, expected = {}, {}
    for key, _, i, amount in sorted(rows, key=lambda r: r[2]):
        expected[i] = last.get(key)
        last[key] = amount
    assert {r["id"]: r["before"] for r in got} == expected


def test_scans_of_nothing_and_of_one_value(spark):
    empty = spark.createDataFrame([], "key string, day int, id int, amount int")
    for parts in (None, 4):
        assert running_sums(empty, ["key"], ["day", "id"], {"total": F.col("amount")}, parts).count() == 0
    assert with_position(empty, ["day", "id"]).count() == 0
    same = spark.createDataFrame([("k", 1, i, 1) for i in range(10)], "key string, day int, id int, amount int")
    for parts in (None, 4):
        got = running_sums(same, ["key"], ["day", "id"], {"total": F.col("amount")}, parts)
        assert sorted(r["total"] for r in got.collect()) == list(range(1, 11))


def test_ties_in_the_first_order_column_are_spread(spark):
    """Nine rows in ten have one day; no range holds more than twice the mean."""
    from adflow.operators import scans

    df = spark.range(20_000).select(F.lit("hot").alias("key"), F.when(F.col("id") % 10 > 0, 5).otherwise(F.col("id") % 9).alias("day"), "id")
    rows = scans._ranged(df, ["key"], ["day", "id"], 10)
    sizes = [r["count"] for r in rows.groupBy("_part").count().collect()]
    assert max(sizes) <= 2 * sum(sizes) / len(sizes) and len(sizes) >= 9
    got = running_sums(df, ["key"], ["day", "id"], {"n": F.lit(1)}, 10).select("day", "id", "n").collect()
    assert [r["n"] for r in sorted(got, key=lambda r: (r["day"], r["id"]))] == list(range(1, 20_001))


@pytest.mark.parametrize("kind", ["string", "double"])
def test_orders_of_text_and_with_nan_and_null(spark, kind):
    values = ["b", None, "a", "c", "é"] if kind == "string" else [2.5, None, float("nan"), -1.0, 0.0]
    rows = [(v, i) for i, v in enumerate(values * 20)]
    df = spark.createDataFrame(rows, f"at {kind}, id int")
    expected = {r["id"]: n for n, r in enumerate(df.coalesce(1).orderBy("at", "id").collect(), 1)}
    for parts in (1, 3, 8):
        assert {r["id"]: r["n"] for r in running_sums(df, [], ["at", "id"], {"n": F.lit(1)}, parts).collect()} == expected
    before = {r["id"]: r["before"] for r in previous_value(df, [], ["at", "id"], "id", "before", 6).collect()}
    by_place = {n: i for i, n in expected.items()}
    assert before == {i: by_place.get(n - 1) for i, n in expected.items()}


def test_positions_and_zip(spark):
    left = spark.createDataFrame([(i * 3,) for i in range(50)], "l int")
    right = spark.createDataFrame([(100 - i, f"r{i}") for i in range(70)], "r int, name string")
    assert {(r["l"], r["position"]) for r in with_position(left, ["l"]).collect()} == {(i * 3, i + 1) for i in range(50)}
    got = zip_tables(left, right, ["l"], ["r"]).collect()
    assert {(r["l"], r["r"]) for r in got} == {(i * 3, 31 + i) for i in range(50)}


def test_running_valid(spark):
    people = [(1, "John", "Quincy", "Adams"), (2, "Mike", None, "Linn"), (3, None, None, None)]
    df = spark.createDataFrame(people, "seq int, first string, middle string, last string").withColumn("g", F.lit(1))
    one = running_valid(df, ["g"], ["seq"], F.col("first").isNotNull()).orderBy("seq").collect()
    assert [r["valid_so_far"] for r in one] == [1, 2, 2]
    full = F.col("first").isNotNull() & F.col("middle").isNotNull() & F.col("last").isNotNull()
    assert [r["valid_so_far"] for r in running_valid(df, ["g"], ["seq"], full).orderBy("seq").collect()] == [1, 1, 1]


def walk_table(spark, walks: dict[str, list[str]]):
    rows = [(name, i, event) for name, events in walks.items() for i, event in enumerate(events)]
    return spark.createDataFrame(rows, "entity string, seq int, event string")


def test_phase_changes(spark):
    walks = {
        "good": ["Melting", "Vaporization", "Ionization", "Deionization"],
        "bad": ["Vaporization", "Freezing"],
        "odd": ["Melting", None, "Freezing"],
    }
    got = validate_transitions(walk_table(spark, walks), "entity", ["seq"], "event", "solid").collect()
    result = {r["entity"]: (r["valid"], r["first_bad"] and r["first_bad"]["seq"]) for r in got}
    assert result == {"good": (True, None), "bad": (False, 0), "odd": (False, 1)}


def test_random_walks_agree_with_literal_machine(spark):
    rng = random.Random(3)
    after = defaultdict(list)
    for name, (source, _) in PHASE_CHANGES.items():
        after[source].append(name)
    walks = {}
    for w in range(300):
        state, events = "solid", []
        for _ in range(rng.randint(1, 25)):
            event = rng.choice(after[state]) if rng.random() < 0.95 else rng.choice([*PHASE_CHANGES, "Unknown"])
            events.append(event)
            state = PHASE_CHANGES.get(event, (None, state))[1]
        walks[f"w{w}"] = events
    got = validate_transitions(walk_table(spark, walks), "entity", ["seq"], "event", "solid").collect()
    result = {r["entity"]: r["first_bad"] and r["first_bad"]["seq"] for r in got}
    assert result == {name: walk(events, PHASE_CHANGES, "solid") for name, events in walks.items()}
    assert all(r["valid"] == (r["first_bad"] is None) for r in got)


def test_contiguous_prefix(spark):
    pages = {"a": [1, 2, 3, 5], "b": [2, 3], "c": [1], "d": [0, 1, 2, 2, 4], "e": [1, 3]}
    rows = [(k, p, f"Page{p}") for k, ps in pages.items() for p in ps]
    rows += [(None, 1, "x"), (None, 2, "x"), (None, 4, "x")]
    df = spark.createDataFrame(rows, "k string, page int, text string")
    got = contiguous_prefix(df, "k", "page").collect()
    found = defaultdict(list)
    for r in got:
        found[r["k"]].append(r["page"])
    assert {k: sorted(v) for k, v in found.items()} == {"a": [1, 2, 3], "c": [1], "d": [1, 2, 2], "e": [1], None: [1, 2]}
    first = contiguous_prefix(df, "k", "page", pages=2).collect()
    assert sorted(r["page"] for r in first if r["k"] == "a") == [1, 2]


def test_take_drop_first(spark):
    df = spark.createDataFrame([(i,) for i in [3, 9, 1, 7, 10, 2, 8, 4, 6, 5]], "n int")
    assert [r["n"] for r in ordering.take_n(df, 5, "n").collect()] == [1, 2, 3, 4, 5]
    assert sorted(r["n"] for r in ordering.drop_n(df, 5, "n").collect()) == [6, 7, 8, 9, 10]
    assert ordering.drop_n(df, 10, "n").count() == 0
    assert ordering.drop_n(df, 11, "n").count() == 0
    assert ordering.drop_n(df, 0, "n").count() == 10
    assert ordering.first_match(df, F.col("n") > 5, "n").first()["n"] == 6


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "double", "decimal(9,3)", "string"])
def test_order_columns_of_any_kind_and_time_zone(spark, kind):
    from test_skew import settings

    with settings(spark, {"spark.sql.session.timeZone": "America/Los_Angeles"}):
        # Half hours around the spring change of clocks, or numbers.
        clock = F.make_timestamp_ntz(
            F.lit(2024), F.lit(3), F.lit(9) + F.floor(F.col("id") / 48), F.floor(F.col("id") / 2) % 24,
            (F.col("id") % 2) * 30, F.lit(0.25),
        )
        value = {"double": F.col("id") / 7, "decimal(9,3)": F.col("id") / 8, "string": F.lpad(F.col("id").cast("string"), 4, "0")}
        place = value.get(kind, clock).cast(kind)
        df = spark.range(100).select("id", place.alias("at"))
        df = df if kind == "timestamp_ntz" else df.dropDuplicates(["at"])
        # In a zone that changes its clocks, rows of one instant are no sequence.
        rows = sorted((r["at"], r["id"]) for r in df.collect())
        kept = {r["id"] for r in ordering.drop_n(df, 7, "at", "id").collect()}
        assert kept == {i for _, i in rows[7:]}
        got = running_sums(df, [], ["at", "id"], {"n": F.lit(1)}, parts=6).collect()
        assert {r["id"]: r["n"] for r in got} == {i: n + 1 for n, (_, i) in enumerate(rows)}


def test_drop_across_the_hour_that_comes_twice(spark):
    from test_skew import settings

    with settings(spark, {"spark.sql.session.timeZone": "America/New_York"}):
        # 1:30 twice, then 2:30: the clocks go back at 6:00 UTC.
        instants = [1730611800, 1730615400, 1730619000]
        df = spark.createDataFrame([(s,) for s in instants], "s bigint").select(F.timestamp_seconds("s").alias("at"), "s")
        assert [r["s"] for r in ordering.drop_n(df, 2, "at").collect()] == instants[2:]


def test_sorting(spark):
    people = [("Aaron", "Jeffrey", "Smith"), ("Aaron", "Bailey", "Zanthar"), ("Brian", "Adams", "Smith")]
    df = spark.createDataFrame(people, "first string, middle string, last string")
    assert [r["middle"] for r in ordering.sort_rows(df, "first", "last", "middle").collect()] == ["Jeffrey", "Bailey", "Adams"]
    numbers = spark.createDataFrame([(i,) for i in [5, 7, 2, 3, 0, 8, 7]], "n int")
    assert [r["n"] for r in ordering.sort_distinct(numbers, "n").collect()] == [0, 2, 3, 5, 7, 8]


def test_shuffle_is_reproducible(spark):
    df = spark.range(200).withColumnRenamed("id", "k")
    once = [r["k"] for r in ordering.shuffle_rows(df, "k", 1).collect()]
    again = [r["k"] for r in ordering.shuffle_rows(df.repartition(7), "k", 1).collect()]
    assert once == again and sorted(once) == list(range(200)) and once != list(range(200))


def test_shards(spark):
    df = spark.createDataFrame([(i,) for i in range(-20, 40)], "g int")
    assert all(r["shard"] == r["g"] % 10 for r in ordering.shard_by_modulo(df, "g", 10).collect())


def test_a_large_shard_is_written_by_several_tasks(spark, folder):
    from test_skew import settings

    from adflow.sources import sinks

    df = spark.range(40_000).select(F.when(F.col("id") < 39_000, 7).otherwise(F.col("id") % 10).alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    path = folder("shards")
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k"}):
        sinks.write_tsv_shards(ordering.shard_by_modulo(df, "g", 10), path, "shard")
    back = spark.read.text(path).select("shard", F.split("value", "\t")[0].cast("int").alias("g"), F.input_file_name().alias("file"))
    assert back.where("shard <> g % 10").count() == 0 and back.count() == 40_000
    files = {r["shard"]: r["n"] for r in back.groupBy("shard").agg(F.count_distinct("file").alias("n")).collect()}
    assert files[7] > 1


def test_set_operations(spark):
    a = spark.createDataFrame([("apples",), ("pears",), ("pears",)], "name string")
    b = spark.createDataFrame([("apples",), ("banana",)], "name string")
    assert sorted(r["name"] for r in ordering.union_all(a, b).collect()) == ["apples", "apples", "banana", "pears", "pears"]
    assert [r["name"] for r in ordering.set_difference(a, b, "name").collect()] == ["pears", "pears"]
