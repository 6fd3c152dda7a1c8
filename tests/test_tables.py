from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from adflow.operators import filters, lookups, rollups
from adflow.sources import generators


def test_word_count(spark):
    lines = spark.createDataFrame([("To be or not to be.",), ("That is the question.",), ("",), (" . ..",)], "line string")
    expected = [("be", 2), ("is", 1), ("not", 1), ("or", 1), ("question", 1), ("that", 1), ("to", 2)]
    assert sorted(tuple(r) for r in rollups.clean_word_count(lines, "line", ["the"]).collect()) == expected
    stop = spark.createDataFrame([("the",)], "word string")
    assert sorted(tuple(r) for r in rollups.clean_word_count(lines, "line", stop).collect()) == expected


def test_grade_histogram(spark):
    grades = spark.createDataFrame([(g,) for g in (5.0, 4.0, 4.4, 2.2, 3.3, 3.5)], "g double")
    got = [tuple(r) for r in rollups.grade_histogram(grades, "g", width=3).collect()]
    assert got == [("A", 2, "**"), ("B", 3, "***"), ("C", 1, "*")]
    wide = [r["bar"] for r in rollups.grade_histogram(grades, "g", width=6).collect()]
    assert wide == ["****", "******", "**"]


def test_rollups(spark):
    rng = random.Random(1)
    rows = [(rng.randint(1, 3), rng.randint(1, 3), 2_000_000_000, rng.randint(0, 9)) for _ in range(300)]
    df = spark.createDataFrame(rows, "u int, g int, show int, clk int")
    shows, clicks = defaultdict(int), defaultdict(int)
    for u, g, show, clk in rows:
        shows[u, g] += show
        clicks[u, g] += clk
    got = {(r["u"], r["g"]): (r["show"], r["clk"]) for r in rollups.rollup(df, ["u", "g"], ["show", "clk"]).collect()}
    assert got == {k: (shows[k], clicks[k]) for k in shows}
    by_group = rollups.rollup_by_group(df, "g", ["clk"], ["u"]).collect()
    assert {r["g"]: (r["u"], r["clk"]) for r in by_group} == {
        g: (1, sum(c for (_, h), c in clicks.items() if h == g)) for g in (1, 2, 3)
    }


def test_exact_sum_has_no_order_and_no_overflow(spark):
    big = 9_000_000_000_000_000_000
    values = [big, big, -big, 7, -1, 10**12]
    df = spark.createDataFrame([(v,) for v in values], "x bigint")
    assert int(df.agg(rollups.exact_sum(F.col("x"))).first()[0]) == sum(values)
    assert str(df.agg(rollups.exact_sum(F.col("x"), 2)).first()[0]) == f"{sum(values) // 100}.{sum(values) % 100:02d}"


def test_sums_of_nothing(spark):
    none = spark.createDataFrame([], "x bigint, price decimal(12,2)")
    assert rollups.sum_or_zero(none, "x").first()["total"] == 0
    assert rollups.maximum(none, "x").first()["maximum"] is None
    assert rollups.discount_total(none, F.col("price")).first()["discount"] is None


def test_prices(spark):
    prices = spark.createDataFrame([("20.2",), ("3.4",), ("50.6",)], "p string").select(F.col("p").cast("decimal(12,2)"))
    assert float(rollups.discount_total(prices, F.col("p")).first()["discount"]) == pytest.approx(7.08)
    videos = spark.createDataFrame([("cat", 300), ("home-improvement", 600), ("cat", 200)], "kind string, length int")
    assert rollups.filtered_sum(videos, F.col("kind") == "cat", F.col("length")).first()["total"] == 500


def test_chunks_hold_every_row_and_stay_small(spark):
    rows = [(0 if i % 3 else i % 7, i, i * 2) for i in range(1000)]
    df = spark.createDataFrame(rows, "store int, id int, item int")
    lists = rollups.collect_chunks(df, "store", "id", {"item": F.col("item")}, width=50).collect()
    assert max(len(r["rows"]) for r in lists) <= 50
    whole = defaultdict(list)
    for r in sorted(lists, key=lambda r: (r["store"], -r["chunk"])):
        whole[r["store"]] += [(x["id"], x["item"]) for x in r["rows"]]
    expected = defaultdict(list)
    for store, i, item in reversed(rows):
        expected[store].append((i, item))
    assert whole == expected


def test_pi(spark):
    points = generators.sample_points(spark.range(20_000), F.col("id"), per_id=10)
    got = rollups.estimate_pi(points, F.col("x"), F.col("y")).first()
    assert got["points"] == 200_000 and abs(got["pi"] - 3.14159) < 0.02


def test_generators(spark):
    log = generators.report_log(spark.range(1, 1001), "id", batches=3)
    got = log.collect()
    assert len(got) == 3000
    assert all((r["user_id"], r["plan_id"]) == (r["group_id"] // 100 + 1, r["group_id"] // 10 + 1) for r in got)
    assert all(100 <= r["show"] < 1100 and 0 <= r["clk"] < 100 and 0 <= r["cost"] < 100 for r in got)
    again = generators.report_log(spark.range(1, 1001).repartition(7), "id", batches=3)
    assert Counter(map(tuple, got)) == Counter(map(tuple, again.collect()))
    bought = generators.purchases(spark.range(1000), "id").agg(
        F.max("store_number"), F.max("customer_number"), F.max("item_number")
    )
    assert [a < b for a, b in zip(bought.first(), (100, 1000, 500))] == [True] * 3
    assert [r["id"] for r in generators.integers(spark, 1, 6, 2).collect()] == [1, 3, 5]


def test_lookup_keeps_rows_and_fills_defaults(spark):
    sites = spark.createDataFrame([(1, "abc"), (2, "uuu"), (3, "yyy"), (4, "ppp")], "k int, v string")
    items = spark.createDataFrame([(1,), (2,), (3,), (5,), (5,), (None,)], "k int")
    got = Counter((r["k"], r["v"]) for r in lookups.lookup(items, sites, "k", "v", F.lit("-")).collect())
    assert got == Counter([(1, "abc"), (2, "uuu"), (3, "yyy"), (5, "-"), (5, "-"), (None, "-")])
    with pytest.raises(Exception, match="repeated dictionary key 1"):
        lookups.lookup(items, sites.union(sites.limit(1)), "k", "v").collect()


def test_lookup_record_and_distinct(spark):
    people = spark.createDataFrame([(1, "Joe", "Smith"), (2, "Jack", "Brown")], "id int, first string, last string")
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    got = lookups.lookup_record(ids, people, "id", {"first": "John", "last": "Doe"}).collect()
    assert {r["id"]: tuple(r["record"]) for r in got} == {1: ("Joe", "Smith"), 2: ("Jack", "Brown"), 3: ("John", "Doe")}
    known = F.create_map(*[F.lit(x) for x in (42, "foo", 12, "bar", 1, "baz")])
    asked = spark.createDataFrame([(42,), (42,), (12,), (99999,), (None,)], "id int")
    found = lookups.lookup_distinct(asked, "id", "v", F.try_element_at(known, F.col("id"))).collect()
    assert Counter((r["id"], r["v"]) for r in found) == Counter(
        [(42, "foo"), (42, "foo"), (12, "bar"), (99999, None), (None, None)]
    )


def test_movie_chains(spark):
    users = spark.createDataFrame([("1", "Mike"), ("42", "Nobody")], "user_id string, name string")
    favorites = spark.createDataFrame([("1", "101")], "user_id string, movie_id string")
    parts = [("101", "Interview With Cast", 480), ("101", "Gigli", 7260)]
    videos = spark.createDataFrame(parts, "movie_id string, title string, length int")
    found = lookups.favorite_videos(users, favorites, videos).collect()
    assert {r["title"] for r in found} == {"Interview With Cast", "Gigli"}
    movies = spark.createDataFrame([("100", "A Movie"), ("200", "B Movie")], "movie_id string, title string")
    liked = spark.createDataFrame([("1", "100"), ("1", "200")], "user_id string, movie_id string")
    got = lookups.favorite_movies(liked, movies).collect()
    assert {(r["movie"]["title"], r["video"]["movie_id"]) for r in got} == {("A Movie", "100"), ("B Movie", "200")}


def test_filters(spark):
    words = [("habitual", 6), ("and", 56), ("consuetudinary", 2), ("additionally", 27), ("homely", 5), ("society", 13)]
    df = spark.createDataFrame(words, "word string, freq int")
    assert [r[0] for r in filters.filter_open_range(df, "word", "freq").collect()] == ["habitual", "homely", "society"]
    scores = spark.createDataFrame([("Daniel", 3500), ("Melissa", 13000), ("John", 7000)], "name string, score int")
    assert [r[0] for r in filters.filter_score(scores, "name", "score").collect()] == ["Melissa", "John"]
    people = spark.createDataFrame([("jack", (123,)), ("neo", (19123,)), ("raj", (19103,))], "name string, address struct<zip: int>")
    got = [r["greeting"] for r in filters.greet_neighbours(people).collect()]
    assert got == [f"Hello, {n}, and welcome to the Lambda Bar And Grille!" for n in ("neo", "raj")]
    numbers = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, None)], "n int")
    even, rest = filters.split_by_predicate(numbers, F.col("n") % 2 == 0)
    assert [r["n"] for r in even.collect()] == [2, 4] and [r["n"] for r in rest.collect()] == [1, 3, None]


def test_mail_and_requests(spark):
    mail = spark.createDataFrame(
        [("", "hello, my friend, your, dynamic typing", "a", "b"), ("s", "t", "a", "b")],
        "subject string, text string, sender string, recipient string",
    )
    got = [tuple(r)[:2] for r in filters.clean_mail(mail).collect()]
    assert got == [
        ("No subject", "hello, my friend, you're, **CENSORED**\nThis mail sent via Super Awesome Free Mail"),
        ("s", "t\nThis mail sent via Super Awesome Free Mail"),
    ]
    requests = spark.createDataFrame(
        [({"Authorization": "Auth", "X-RequestFingerprint": "fp"}, "x"), ({"Accept": "any"}, "old")],
        "headers map<string, string>, principal string",
    )
    done = requests.transform(filters.check_authorization).transform(filters.add_fingerprint).collect()
    assert [(r["principal"], r["fingerprint"]) for r in done] == [("AUser", "fp"), (None, "")]
