from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from cases import empty_table, odd_table, prose

from adflow.llm import simhash


def literal_print(text: str | None, n: int = 3) -> int:
    """The fingerprint bit by bit."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\v\f\r":
            words, word = [*words, word] if word else words, ""
        else:
            word += c
    if not words:
        return 0
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def literal_classes(prints: list[int], distance: int) -> list[int]:
    """For each fingerprint the index of the first that it reaches."""
    parent = list(range(len(prints)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return [find(i) for i in range(len(prints))]


def clustered(rng: random.Random, clusters: int, distance: int) -> list[int]:
    """Random fingerprints, chains of close ones, and a dense ball."""
    prints = []
    for _ in range(clusters):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            prints.append(x)
            for b in rng.sample(range(64), rng.randint(1, distance + 1)):
                x ^= 1 << b
    ball = rng.getrandbits(64)
    return prints + [ball] + [ball ^ 1 << a ^ 1 << b for a, b in (rng.sample(range(64), 2) for _ in range(150))]


def test_fingerprint_by_bits():
    texts = ["", None, "A", "Two words", "One two THREE", "É é x\ny\tz\v w", prose(200), "a b c a b c a b c"]
    assert [simhash.simhash(t) for t in texts] == [literal_print(t) for t in texts]


@pytest.mark.parametrize("paired", [1, 64])
@pytest.mark.parametrize("distance, segments", [(1, 3), (2, 5), (3, 8)])
def test_links_connect_what_all_pairs_connect(spark, distance, segments, paired):
    prints = sorted(set(clustered(random.Random(distance), 40, distance)))
    df = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "f long")
    edges = simhash.links(df, distance, segments, paired)
    rows = edges.collect()
    unsigned = [(r["a"] % 2**64, r["b"] % 2**64) for r in rows]
    assert all((a ^ b).bit_count() <= distance for a, b in unsigned)
    roots = {r["f"] % 2**64: r["root"] for r in simhash.components(edges).collect()}
    expected = literal_classes(prints, distance)
    got = [roots.get(p, p) for p in prints]
    pairs = {(g, e) for g, e in zip(got, expected)}
    assert len(pairs) == len(set(got)) == len(set(expected))


def test_chains_prune_but_lose_no_pair(spark):
    """Of pairs within the distance some chain holds; the filter drops others."""
    from pyspark.sql import functions as F

    rng = random.Random(3)
    rows = []
    for _ in range(400):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 5)):
            b ^= 1 << bit
        rows.append((int(np.uint64(a).astype(np.int64)), int(np.uint64(b).astype(np.int64))))
    df = spark.createDataFrame(rows, "a long, b long")
    holds = [simhash.chain_holds(F.col("a"), F.col("b"), s, 2, 5) for s in range(5)]
    got = df.select(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).alias("d"), F.greatest(*holds).alias("holds")).collect()
    assert all(r["holds"] for r in got if r["d"] <= 2)
    assert sum(not r["holds"] for r in got if r["d"] > 2) > 50


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 80)] + [(180, 60), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    roots = {r["f"]: r["root"] for r in simhash.components(df).collect()}
    assert {v for k, v in roots.items() if k <= 60 or k == 180} == {1}
    assert {v for k, v in roots.items() if 100 <= k < 180} == {100}
    assert simhash.components(df.limit(0)).count() == 0


def test_odd_rows(spark):
    df = odd_table(spark)
    got = simhash.near_duplicates(df).collect()
    rows = df.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    assert sorted((str(r["doc_id"]), r["fingerprint"]) for r in got) == sorted(
        (str(r["doc_id"]), f"{literal_print(r['text']):016x}") for r in rows
    )
    by_id = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in got}
    zero = "0" * 16
    assert by_id[(3, zero)] == by_id[(4, zero)] == by_id[(5, zero)] == by_id[(None, zero)] == 3
    assert {c for (i, _), c in by_id.items() if i in (1, 2)} == {1}
    kept = simhash.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "None", "3", "6", "7", "8", "9"])
    assert simhash.near_duplicates(empty_table(spark)).count() == simhash.deduplicated(empty_table(spark)).count() == 0
