"""The Jaccard join against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from cases import CLASHES, WORDS, empty_table, odd_rows, odd_table, prose
from pyspark.sql import functions as F

from adflow.llm import jaccard
from adflow.llm.jaccard import jaccard_classes, prefix_length, shingle_digests
from adflow.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def literal_set(text, shingle=3):
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
    if 0 < len(words) < shingle:
        return frozenset([tuple(words)])
    return frozenset(zip(*(words[i:] for i in range(shingle)))) if words else frozenset()


def literal_classes(rows, percent=90, shingle=3):
    """(id, size, smallest id that links reach) of each (id, text) row."""
    sets = [literal_set(t, shingle) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (own, _) in enumerate(rows):
        known = [x for x in (least.get(find(i)), own) if x is not None]
        least[find(i)] = min(known) if known else None
    return sorted(((own, len(s), least[find(i)]) for i, ((own, _), s) in enumerate(zip(rows, sets))), key=repr)


def classes(df, **options):
    return sorted(map(tuple, jaccard_classes(df, **options).collect()), key=repr)


def families(seed, shared=True):
    """Copies with random edits of some texts, short and long, and texts that share a passage."""
    rng = random.Random(seed)
    passage = prose(60, 99).split()
    rows = []
    for family in range(6):
        base = prose(rng.choice([5, 12, 40, 150, 300]), family).split()
        for _ in range(rng.choice([1, 4, 25])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, len(base) // 12])):
                words[rng.randrange(len(words))] = rng.choice(WORDS) + str(rng.randrange(1000))
            if shared and rng.random() < 0.3:
                words += passage
            rows.append(" ".join(words))
    rows += [" ".join(passage), " ".join(passage[:-2]), "a b", "A  b", "a", ""]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, cell, percent", [(1, 2048, 90), (2, 4, 90), (3, 4, 80)])
def test_agrees_with_all_pairs(spark, monkeypatch, seed, cell, percent):
    rows = families(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = literal_classes(rows, percent)
    assert 6 < len({r[2] for r in expected}) < len(rows)
    assert classes(df, cell=cell, percent=percent) == expected


def test_pairs_that_leaders_leave_are_all_compared(spark, monkeypatch):
    rows = families(7)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # Leaders that find nothing: all links come from the cells of the remaining pairs.
    none = spark.createDataFrame([], "a long, b long")
    monkeypatch.setattr(jaccard, "leader_pairs", lambda *_: none)
    assert classes(df, cell=3) == literal_classes(rows)


def test_a_chain_of_links(spark):
    base = prose(100, 4).split()
    chain = [" ".join(f"n{k}" if k < i * 2 else w for k, w in enumerate(base)) for i in range(12)]
    rows = [(50 - i, t) for i, t in enumerate(chain)]
    got = classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == literal_classes(rows) and {r[2] for r in got} == {39}


def test_many_edited_copies(spark):
    """Most copies differ from each other by more than the limit: the pairs made stay far fewer than all of them."""
    rng, base, rows = random.Random(5), prose(150, 8).split(), []
    for i in range(300):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 8, 15])):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert classes(df) == literal_classes(rows)


def test_odd_and_empty_tables(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert classes(odd_table(spark)) == literal_classes(rows)
    assert classes(empty_table(spark)) == []
    extra = [*CLASHES, "token", "sid", "n", "own", "root", "set_key", "tokens", "quarter", "text_digest2", "members"]
    df = spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], "doc_id long, text string" + "".join(f", `{c}` string" for c in extra))
    assert classes(df) == literal_classes(rows)
    nobody = [(None, prose(30, 1)), (None, prose(30, 1)), (4, prose(30, 2)), (None, prose(30, 2))]
    assert classes(spark.createDataFrame(nobody, "doc_id long, text string")) == literal_classes(nobody)


def test_the_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op13_jaccard"](spark, SF_DIR).collect()), key=repr) == literal_classes(rows)


def test_prefix_length_and_digests(spark):
    sizes = [1, 2, 9, 10, 11, 99, 100, 101, 12345]
    got = spark.createDataFrame([(n,) for n in sizes], "n long").select(prefix_length(F.col("n"))).collect()
    assert [r[0] for r in got] == [n - -(-9 * n // 10) + 1 for n in sizes] == [prefix_length(n) for n in sizes]
    text = prose(2000, 1) + " " + prose(2000, 1).upper()
    tokens = shingle_digests(text.encode())
    assert len(tokens) == len(literal_set(text)) and (np.diff(tokens.astype(object)) > 0).all()
    assert len(shingle_digests(b"a b")) == 1 and len(shingle_digests(b" \n")) == 0
    assert shingle_digests(b"a b c d e f", 6).shape == (1,)
