"""A memo that outlives calls, and counts that a write observes."""

from __future__ import annotations

from pyspark.sql import functions as F

from adflow.operators.lookups import memoized
from adflow.operators.pricing import counted_headers, counted_messages, outcome_messages, result_headers
from adflow.operators.rollups import status_counts
from adflow.plans.pricing import stored_prices
from adflow.sources import sinks
from adflow.streaming import batches

SF_DIR = "/root/testdata/sf0.001"


def test_each_key_is_evaluated_once_over_batches(spark, folder):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def slow(key):
        calls.add(1)
        return None if key == 4 else f"v{key}"

    memo, seen = folder("memo"), set()
    for ids in ([1, 2, 2, 3, None], [2, 3, 4, 4, 5], [4, 1, 5, 6, None, 6]):
        df = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "id int, n int")
        got = memoized(df, "id", "found", slow("id"), memo)
        rows = sorted((r["n"], r["id"], r["found"]) for r in got.collect())
        assert rows == [(n, i, None if i in (None, 4) else f"v{i}") for n, i in enumerate(ids)]
        got.count()
        seen |= set(ids) - {None}
        assert calls.value == len(seen)


def test_a_memo_in_a_stream(spark, folder):
    memo, source, out = folder("memo"), folder("in"), folder("out")
    for ids in ([1, 2, 2], [2, 3]):
        spark.createDataFrame([(i,) for i in ids], "id int").coalesce(1).write.mode("append").parquet(source)
        stream = batches.parquet_stream(spark, source, "id int")
        run = batches.start_per_batch(
            stream, lambda b: memoized(b, "id", "square", F.col("id") * F.col("id"), memo), out, f"{out}-checkpoint"
        )
        run.awaitTermination()
    assert sorted((r["id"], r["square"]) for r in spark.read.parquet(out).collect()) == [(1, 1), (2, 4), (2, 4), (2, 4), (3, 9)]
    assert spark.read.parquet(memo).count() == 3


def test_nothing_asked(spark, folder):
    memo = folder("memo")
    empty = spark.createDataFrame([], "id int")
    assert memoized(empty, "id", "v", F.col("id") + 1, memo).count() == 0
    assert [r["v"] for r in memoized(spark.createDataFrame([(1,)], "id int"), "id", "v", F.col("id") + 1, memo).collect()] == [2]


def test_counts_come_from_the_write(spark, folder):
    results, path = stored_prices(spark, SF_DIR), folder("counted")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "write and count")
    try:
        counts = sinks.write_counted(results, path)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("counted")) == 1
    assert counts.collect() == status_counts(spark.read.parquet(path)).collect()
    assert counts.columns == status_counts(results).columns
    assert {tuple(r) for r in counted_headers(counts).collect()} == {tuple(r) for r in result_headers(results).collect()}
    assert {tuple(r) for r in counted_messages(counts).collect()} == {tuple(r) for r in outcome_messages(results).collect()}


def test_counts_of_nothing(spark, folder):
    none = stored_prices(spark, SF_DIR).where("order_key < 0")
    counts = sinks.write_counted(none, folder("counted"))
    assert set(counts.first()) == {0}
    assert counted_headers(counts).count() == 0 and counted_messages(counts).count() == 3
