"""Shards by a keyed permutation of global row numbers.

Rows are numbered in the order of their id; a balanced Feistel network with a
key permutes the numbers. The network works on the least power of four that
holds all numbers; a result beyond the last number is put through it again
(cycle walking) until it falls within, which takes under four rounds on average.
Shard and slot are the remainder and the quotient of the permuted number by the
number of shards. So shards differ by one row at most, slots have no gaps, and
the place of any row can be computed from its number, and back, without a table.

Defined cases. Null ids come first. Rows with the same id are ordered by text
checksum and size; rows that agree in these too are interchangeable. Null texts
have no bytes and the checksum of none. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adflow.llm.tables import column, global_order, text_of
from adflow.session import stored

SHARDS = 24
ROUNDS = 6
KEY = 0x5EED
OVERHEAD = 8
"""Bytes that a row takes besides its text."""


def _mixed(half: np.ndarray, key: int, turn: int, mask: np.uint64) -> np.ndarray:
    """The round function: a keyed hash of half a number."""
    x = half + np.uint64((key * 0x9E3779B97F4A7C15 + turn * 0xD1B54A32D192ED03 + 1) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) & mask


def _half_bits(rows: int) -> int:
    return max(1, ((max(1, rows) - 1).bit_length() + 1) // 2)


def _network(numbers: np.ndarray, rows: int, key: int, back: bool) -> np.ndarray:
    bits = np.uint64(_half_bits(rows))
    mask = np.uint64((1 << int(bits)) - 1)
    left, right = numbers >> bits, numbers & mask
    for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
        if back:
            left, right = right ^ _mixed(left, key, turn, mask), left
        else:
            left, right = right, left ^ _mixed(right, key, turn, mask)
    return left << bits | right


def permuted(numbers: np.ndarray, rows: int, key: int = KEY, back: bool = False) -> np.ndarray:
    """The place of each row number under the permutation of ``rows`` numbers, or back."""
    found = _network(numbers.astype(np.uint64), rows, key, back)
    beyond = np.flatnonzero(found >= rows)
    while len(beyond):
        found[beyond] = _network(found[beyond], rows, key, back)
        beyond = beyond[found[beyond] >= rows]
    return found.astype(np.int64)


def row_of(shard: int, slot: int, rows: int, shards: int = SHARDS, key: int = KEY) -> int:
    """The number of the row at a slot of a shard."""
    place = slot * shards + shard
    if not (0 <= shard < shards and 0 <= slot and place < rows):
        raise IndexError("no such slot")
    return int(permuted(np.array([place]), rows, key, back=True)[0])


def assign_shards(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", shards: int = SHARDS, key: int = KEY
) -> DataFrame:
    """(id, size, text_crc32, row, shard, slot) of every row."""
    whole = text_of(docs, text)
    facts = docs.select(
        column(docs, id_column).alias(id_column),
        (F.octet_length(whole) + OVERHEAD).cast("long").alias("size"),
        F.crc32(whole).alias("text_crc32"),
    ).withColumn("arrival", F.monotonically_increasing_id())
    order = [column(facts, id_column).asc_nulls_first(), F.col("text_crc32"), F.col("size"), F.col("arrival")]
    keep = [column(facts, id_column), F.col("size"), F.col("text_crc32")]
    numbered = global_order(facts, order, keep, "rows")
    rows = stored(numbered, "numbered")
    total = rows.count()

    @F.pandas_udf("long")
    def place(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for numbers in parts:
            yield pd.Series(permuted(numbers.to_numpy(np.int64), total, key))

    placed = rows.withColumn("at", place("position"))
    return placed.select(
        id_column,
        "size",
        "text_crc32",
        F.col("position").alias("row"),
        (F.col("at") % shards).cast("int").alias("shard"),
        F.expr(f"at div {shards}").alias("slot"),
    )
