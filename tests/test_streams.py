from __future__ import annotations


import pytest

from adflow import jobs
from adflow.streaming import batches


def arrive(spark, path, *lines):
    """One more text file in a folder."""
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def test_words_are_counted_per_batch_without_state(spark, folder):
    source, out = folder("in"), folder("out")
    arrive(spark, source, "a b a", "")
    arrive(spark, source, "a  c ")
    stream = batches.text_stream(spark, source, max_files=1)
    batches.start_word_count(stream, "value", out, folder("checkpoint")).awaitTermination()
    rows = spark.read.parquet(out).collect()
    by_batch = {}
    for r in rows:
        by_batch.setdefault(r["batch_id"], {})[r["word"]] = r["count"]
    assert sorted(by_batch.values(), key=len) == [{"a": 2, "b": 1, "": 1}, {"a": 1, "": 1, "c": 1}] or sorted(
        map(str, by_batch.values())
    ) == sorted(map(str, [{"a": 2, "b": 1, "": 1}, {"a": 1, "": 1, "c": 1}]))
    assert sum(c for counts in by_batch.values() for w, c in counts.items() if w == "a") == 3


def test_a_batch_that_runs_again_replaces_its_output(spark, folder):
    out = folder("out")
    df = spark.createDataFrame([("a",)], "value string")
    for _ in range(2):
        batches.count_words(df, "value").write.mode("overwrite").parquet(f"{out}/batch_id=0")
    assert spark.read.parquet(out).count() == 1


def test_stream_picks_up_where_it_stopped(spark, folder):
    source, out, checkpoint = folder("in"), folder("out"), folder("checkpoint")
    for lines in (["t1 ann"], ["t2 bob", "t3 ann"]):
        arrive(spark, source, *lines)
        batches.start_append(batches.text_stream(spark, source), out, checkpoint).awaitTermination()
    assert sorted(r["value"] for r in spark.read.parquet(out).collect()) == ["t1 ann", "t2 bob", "t3 ann"]


def test_blacklist_on_a_batch(spark):
    clicks = spark.createDataFrame([("1 hadoop",), ("2 spark",), ("3 mahout",), ("4 flink x",), ("5 both",)], "value string")
    listed = [("hadoop", True), ("hadoop", True), ("mahout", True), ("flink", False), ("both", True), ("both", False)]
    blacklist = spark.createDataFrame(listed, "name string, blocked boolean")
    assert sorted(r["value"] for r in batches.valid_click_lines(clicks, blacklist).collect()) == ["2 spark", "4 flink x"]
    with pytest.raises(Exception, match="no name in click"):
        batches.valid_click_lines(spark.createDataFrame([("alone",)], "value string"), blacklist).collect()


def test_blacklist_job(spark, folder):
    source, blacklist, out = folder("in"), folder("blacklist"), folder("out")
    arrive(spark, source, "1 hadoop", "2 spark")
    arrive(spark, source, "3 mahout", "4 storm")
    arrive(spark, blacklist, "hadoop\ttrue", "mahout\ttrue", "storm\tfalse")
    jobs.stream_clicks(spark, source, blacklist, out, folder("checkpoint"), None).awaitTermination()
    assert sorted(r["value"] for r in spark.read.parquet(out).collect()) == ["2 spark", "4 storm"]


def test_batches_by_the_clock(spark, folder):
    source, out = folder("in"), folder("out")
    arrive(spark, source, "a b")
    run = jobs.stream_words(spark, source, out, folder("checkpoint"), seconds=1)
    try:
        run.processAllAvailable()
    finally:
        run.stop()
    assert sorted((r["word"], r["count"]) for r in spark.read.parquet(out).collect()) == [("a", 1), ("b", 1)]
    assert batches.micro_batch(10) == {"processingTime": "10 seconds"}


def test_shared_folder_must_be_named_on_a_cluster(monkeypatch):
    from adflow import session

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, *_):
            return self.value

    class Cluster:
        def __init__(self, named):
            self.conf = Conf(named)
            self.sparkContext = type("Context", (), {"master": "yarn", "applicationId": "x"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster(None))
    assert session.fresh_folder(Cluster("hdfs://shared/"), "t").startswith("hdfs://shared/adflow/x/t-")
