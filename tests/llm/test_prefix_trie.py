"""The prefix trie against rebuilt conversations held as lists."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from adflow.llm import prefix_trie
from adflow.llm.prefix_trie import power

TURNS = "conv_id long, turn long, role string, text string"


def literal_trie(spark, rows, base=20, heads=4):
    """Rows of the trie from (conv_id, turn, role, text); turns that tie go by Spark's hash of role and text."""
    said = spark.createDataFrame([(r[2] or "", r[3] or "") for r in rows] or [("", "")], "role string, text string").distinct()
    digests = {(r[0], r[1]): r[2] for r in said.select("role", "text", F.xxhash64("role", "text")).collect()}
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            content = (role or "", text or "")
            own[conv].append((turn is not None, turn or 0, digests[content], content))
    own = {c: [x[-1] for x in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        first = c - (abs(c) % base) * (1 if c >= 0 else -1)
        rebuilt[c] = own.get(first, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, convs in members.items():
        words = len(path[-1][1].encode().split()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(convs) - 1) * words
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(path), parent, len(convs), len(children[path]) if path in children else 0, leaves[path], saved[path], digest))
    return sorted(out, key=repr)


def trie(df, **options):
    return sorted(map(tuple, prefix_trie.prefix_trie(df, **options).collect()), key=repr)


def some_rows(seed):
    rng = random.Random(seed)
    texts = ["hi", "hello there", "", "  two\twords ", None, "a b c d", "ok"]
    rows = []
    for c in [*range(-5, 75), 100, 119, 10**15]:
        for t in range(rng.choice([0, 1, 1, 2, 3, 4, 6])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["u", "u", "u", None]), rng.choice(texts)))
    rows += [(None, 1, "u", "lost"), (None, None, None, None)]
    rows += rows[:6]  # repeated rows
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_agrees_with_lists(spark, seed):
    rows = some_rows(seed)
    df = spark.createDataFrame(rows, TURNS)
    expected = literal_trie(spark, rows)
    assert any(r[5] > 1 for r in expected) and any(r[6] for r in expected)
    assert trie(df) == expected
    assert trie(df, partitions=9) == expected


def test_fingerprints_that_collide_are_taken_again(spark):
    rows = some_rows(3)
    df = spark.createDataFrame(rows, TURNS)
    assert trie(df, first_prime=13) == literal_trie(spark, rows)


def test_verification_reads_the_stored_turns(spark):
    rows = [(1, 0, "u", "x"), (2, 0, "u", "x"), (3, 0, "u", "y")]
    turns = prefix_trie.ordered_turns(spark.createDataFrame(rows, TURNS), "conv_id", "turn", "role", "text")
    ids = {r["text"] + str(r["conv_id"]): r["rid"] for r in turns.collect()}
    groups = spark.createDataFrame([((1, 1), (1, 1))], "low_parent struct<a: int, b: int>, high_parent struct<a: int, b: int>")
    same = spark.createDataFrame([(ids["x2"], ids["x1"]), (ids["x1"], ids["x1"])], "rid long, first_rid long")
    other = spark.createDataFrame([(ids["y3"], ids["x1"])], "rid long, first_rid long")
    assert not prefix_trie._differ(groups, same, turns)
    assert prefix_trie._differ(groups, other, turns)
    parents = spark.createDataFrame([((1, 1), (1, 2))], groups.schema)
    assert prefix_trie._differ(parents, same, turns)


def test_one_long_conversation_over_many_ranges(spark):
    rows = [(40, t, "u", f"w{t % 11} and more") for t in range(1500)] + [(c, t, "u", f"w{t % 11} and more") for c in (41, 47) for t in range(40)]
    df = spark.createDataFrame(rows, TURNS)
    assert trie(df, partitions=13) == literal_trie(spark, rows)


def test_many_copies(spark):
    # All rebuilt as the same turn, or as nothing: ids of one node in many pieces, sorted as numbers.
    copies = spark.range(9000).selectExpr("id * 20 AS conv_id", "0L AS turn", "'u' AS role", "'hello you' AS text")
    got = trie(copies)
    rows = [(i * 20, 0, "u", "hello you") for i in range(9000)]
    assert got == literal_trie(spark, rows) and len(got) == 2


def test_odd_tables(spark):
    assert trie(spark.createDataFrame([], TURNS)) == []
    assert trie(spark.createDataFrame([(None, 1, "u", "x")], TURNS)) == []
    # Extra columns with names used inside.
    extra = ["rid", "part", "w", "s0", "near", "depth", "owner", "ahead", "length", "place"]
    rows = some_rows(5)[:60]
    df = spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], TURNS + "".join(f", {c} string" for c in extra))
    assert trie(df) == literal_trie(spark, rows)
    long = [(c, 0, "u", "word " * 200_000) for c in (20, 40)] + [(20, 1, "u", "x")]
    assert trie(spark.createDataFrame(long, TURNS)) == literal_trie(spark, long)


def test_powers(spark):
    exponents = [0, 1, 5, 63, 64, 1000, 2**31, 2**41 + 17]
    df = spark.createDataFrame([(e,) for e in exponents], "e long")
    got = [r[0] for r in df.select(power(F.col("e"), 48271, prefix_trie.PRIME)).collect()]
    assert got == [pow(48271, e, prefix_trie.PRIME) for e in exponents]
