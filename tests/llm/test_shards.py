from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from cases import empty_table, odd_table

from adflow.llm import shards


@pytest.mark.parametrize("rows", [1, 2, 3, 24, 25, 1000, 4097])
def test_permutation_and_back(rows):
    numbers = np.arange(rows)
    places = shards.permuted(numbers, rows)
    assert sorted(places.tolist()) == list(range(rows))
    assert (shards.permuted(places, rows, back=True) == numbers).all()
    if rows >= 1000:
        assert (places != numbers).mean() > 0.9 and abs(np.corrcoef(numbers, places)[0, 1]) < 0.1
        assert (shards.permuted(numbers, rows, key=7) != places).mean() > 0.9


def test_shards_and_slots(spark):
    rows = [(i * 3 % 1009, f"text {i}", "x") for i in range(1009)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(7)
    got = shards.assign_shards(df, shards=24).collect()
    again = shards.assign_shards(df.repartition(3), shards=24).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    counts = Counter(r["shard"] for r in got)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    assert {(r["shard"], r["slot"]) for r in got} == {(s, i) for s, n in counts.items() for i in range(n)}
    order = sorted(r[0] for r in rows)
    for r in got[:50]:
        assert r["row"] == order.index(r["doc_id"]) == shards.row_of(r["shard"], r["slot"], 1009)
    with pytest.raises(IndexError):
        shards.row_of(0, 43, 1009)


def test_odd_rows(spark):
    df = odd_table(spark)
    got = shards.assign_shards(df, shards=5).collect()
    texts = Counter((r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in df.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == texts
    assert sorted(r["row"] for r in got) == list(range(len(got)))
    assert {r["row"] for r in got if r["doc_id"] is None} == {0, 1}
    assert shards.assign_shards(empty_table(spark)).count() == 0
