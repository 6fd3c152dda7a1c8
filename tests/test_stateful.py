"""Streams that keep state over batches and restarts."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from test_machines import literal_walk

from adflow import jobs
from adflow.operators.machines import run_machine
from adflow.streaming import batches, stateful

MACHINE = {"go": {"a": "b", "b": "c", "c": "c"}, "back": {"c": "a", "b": "a"}, "stay": {"a": "a", "b": "b"}}
WALK = "who int, seq int, event string"


def put_lines(spark, path, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def totals(spark, out):
    schema = batches.count_words(spark.createDataFrame([], "value string"), "value").schema
    return {r["word"]: r["count"] for r in stateful.newest(spark, out, schema, ["word"]).collect()}


def test_running_words_go_on_after_a_restart(spark, folder):
    source, out, checkpoint = folder("in"), folder("out"), folder("checkpoint")
    said = [["a b a", ""], ["a  c "], ["b", "d d d"]]
    expected = Counter()
    for lines in said:
        put_lines(spark, source, *lines)
        jobs.stream_totals(spark, source, out, checkpoint, None).awaitTermination()
        words = batches.count_words(spark.createDataFrame([(x,) for x in lines], "value string"), "value")
        expected += Counter({r["word"]: r["count"] for r in words.collect()})
        assert totals(spark, out) == dict(expected)
    # Nothing new: a start changes nothing.
    jobs.stream_totals(spark, source, out, checkpoint, None).awaitTermination()
    assert totals(spark, out) == dict(expected)


def test_running_words_stopped_in_mid_stream(spark, folder):
    source, out, checkpoint = folder("in"), folder("out"), folder("checkpoint")
    for i in range(6):
        put_lines(spark, source, f"x y{i % 2}")
    stream = batches.text_stream(spark, source, max_files=1)
    run = stateful.start_running_words(stream, "value", out, checkpoint, seconds=0)
    while run.lastProgress is None or run.lastProgress["batchId"] < 1:
        assert run.exception() is None
    run.stop()
    run.awaitTermination()
    stateful.start_running_words(stream, "value", out, checkpoint).awaitTermination()
    assert totals(spark, out) == {"x": 6, "y0": 3, "y1": 3}


@pytest.mark.parametrize("cuts", [1, 2, 5])
def test_walks_agree_with_the_batch_operator_for_any_cut(spark, folder, cuts):
    rng = random.Random(cuts)
    rows = []
    for who in [None, *range(12)]:
        for seq in range(rng.choice([1, 2, 6, 40])):
            rows.append((who, seq, rng.choice(["go", "go", "stay", "back", None if rng.random() < 0.1 else "go"])))
    source, out, checkpoint = folder("in"), folder("out"), folder("checkpoint")
    edges = [40 * i // cuts for i in range(cuts + 1)]
    for low, high in zip(edges, edges[1:]):
        part = [r for r in rows if low <= r[1] < high]
        rng.shuffle(part)
        spark.createDataFrame(part, WALK).repartition(2).write.mode("append").parquet(source)
        stream = batches.parquet_stream(spark, source, WALK)
        stateful.start_walks(stream, "who", ["seq"], "event", MACHINE, "a", out, checkpoint).awaitTermination()
    schema = stateful.walk_schema(stream, "who", ["seq"])
    got = {r["who"]: (r["valid"], r["end_state"], r["bad_seq"]) for r in stateful.newest(spark, out, schema, ["who"]).collect()}
    people = {r[0] for r in rows}
    assert got == {p: literal_walk(MACHINE, sorted((s, e) for w, s, e in rows if w == p), "a") for p in people}
    batch = run_machine(spark.createDataFrame(rows, WALK), "who", ["seq"], "event", MACHINE, "a").collect()
    assert got == {r["who"]: (r["valid"], r["end_state"], r["first_bad"] and r["first_bad"]["seq"]) for r in batch}
