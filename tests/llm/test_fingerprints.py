from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from cases import PLAIN, empty_table, odd_table, prose

from adflow.llm import fingerprints


def literal_lexicon(texts: list[str]) -> np.ndarray:
    seen = Counter(x for t in texts for x in set((fingerprints.terms_of(t) & np.uint64(0xFFFFFFFF)).tolist()))
    low, high = len(texts) * math.exp(-fingerprints.IDF_MOST), len(texts) * math.exp(-fingerprints.IDF_LEAST)
    return np.array(sorted(t for t, n in seen.items() if low <= n <= max(1, high)), np.uint32)


@pytest.mark.parametrize("parts", ["1", "5", "40"])
def test_edits_by_brute_force(spark, parts):
    from test_skew import settings

    texts = [prose(20 + i * 7 % 90, i) + f" only{i} and{i} here{i}" for i in range(60)] + ["", "é", "One two"]
    rows = [(i * 5 % 67, t, None, None, 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, PLAIN)
    terms = fingerprints.lexicon(df)
    known = literal_lexicon(texts)
    assert fingerprints.known_terms(terms).tolist() == known.tolist()
    with settings(spark, {"spark.sql.shuffle.partitions": parts}):
        got = {r["doc_id"]: r for r in fingerprints.compare_edits(df, terms).collect()}
    maker = fingerprints.Fingerprinter(known)
    order = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    for (i, text, *_), (_, following, *_) in zip(order, order[1:] + order[:1]):
        third = len(text) // 3
        changed = text[: len(text) - third] + following[:third]
        mine, other, after = maker.of(text), maker.of(changed), maker.of(following)
        near = (fingerprints.likeness(mine, other), fingerprints.likeness(mine, after))
        assert tuple(got[i]) == (i, len(text), changed, mine, other, *near)


def test_likeness_tells_edits_from_others():
    texts = [" ".join(f"w{i * 37 % 1999}x{j * j % 97}" for j in range(120)) for i in range(80)]
    maker = fingerprints.Fingerprinter(literal_lexicon(texts))
    prints = [maker.of(t) for t in texts]
    edits = [fingerprints.likeness(p, maker.of(t[: len(t) * 2 // 3] + texts[i - 1][: len(t) // 3])) for i, (t, p) in enumerate(zip(texts, prints))]
    others = [fingerprints.likeness(p, prints[i - 1]) for i, p in enumerate(prints)]
    assert np.mean(edits) > 0.3 and np.mean(others) < 0.05
    assert all(0 <= x <= 1 for x in edits + others)
    assert fingerprints.likeness(prints[0], maker.of(texts[0])) == 1


def test_odd_rows(spark):
    df = odd_table(spark)
    terms = fingerprints.lexicon(df)
    made = df.select("text", fingerprints.fingerprint(df, terms).alias("fingerprint_")).collect()
    by_text: dict = {}
    for r in made:
        assert by_text.setdefault(r["text"] or "", r["fingerprint_"]) == r["fingerprint_"]
    assert len(set(by_text.values())) == len(by_text)
    got = fingerprints.compare_edits(df, terms).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in df.select("doc_id").collect())
    assert all(r["fingerprint"] in by_text.values() for r in got)
    one = spark.createDataFrame([(None, "abcdef", None, None, None)], PLAIN)
    [r] = fingerprints.compare_edits(one, fingerprints.lexicon(one)).collect()
    assert (r["doc_id"], r["edited"], r["near_next"]) == (None, "abcdab", 1.0)
    assert fingerprints.compare_edits(empty_table(spark), terms).count() == 0
    assert fingerprints.lexicon(empty_table(spark)).count() == 0
