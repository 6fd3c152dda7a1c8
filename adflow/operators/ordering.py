"""Sorting, limits, set operations and physical layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.functions.numbers import draw
from adflow.operators.scans import with_position


def sort_rows(df: DataFrame, *order: str | Column) -> DataFrame:
    """Global sort by range partitions; end the order with an id so hot values can be split."""
    return df.orderBy(*order)


def sort_distinct(df: DataFrame, column: str) -> DataFrame:
    """Sorted values, each once."""
    return df.select(column).distinct().orderBy(column)


def take_n(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first n rows in an order; each task keeps n rows and no more."""
    return df.orderBy(*order).limit(n)


def drop_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    """All rows but the first n in ascending order of some columns.

    The columns must tell all rows apart. Rows are numbered range by range, so
    neither the dropped rows nor the rest pass through one task, as they would
    with an offset.
    """
    if n <= 0:
        return df
    return with_position(df, order, "_position").where(F.col("_position") > n).drop("_position")


def first_match(df: DataFrame, predicate: Column, *order: str | Column) -> DataFrame:
    return df.where(predicate).orderBy(*order).limit(1)


def shuffle_rows(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Rows in a reproducible random order."""
    return df.orderBy(draw(F.col(key), seed), key)


def union_all(*frames: DataFrame) -> DataFrame:
    """Concatenate tables by column name; duplicates stay."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def set_difference(df: DataFrame, other: DataFrame, on: str) -> DataFrame:
    """Rows whose key is not in another table."""
    return df.join(other.select(on), on, "left_anti")


def shard_by_modulo(df: DataFrame, column: str, shards: int = 10) -> DataFrame:
    """Mark each row with its shard: its id modulo the number of shards.

    ``sinks.write_tsv_shards`` writes one folder per shard.
    """
    return df.withColumn("shard", F.pmod(F.col(column), F.lit(shards)).cast("int"))


def deal_shards(df: DataFrame, shard: str, rows_per_part: int = 1_000_000, most_shards: int = 10_000) -> DataFrame:
    """Rows in partitions that hold one shard each, several for a shard with more than ``rows_per_part`` rows.

    Each shard has partition numbers of its own, as many as its rows ask for;
    rows go to them by number, so that no two shards meet in a partition as
    hashed ones do. Within a shard a hash of the whole row deals rows out, which a
    task that runs again repeats. The shards, not their rows, are counted on the
    driver; more than ``most_shards`` are an error. Rows without a shard are one
    more shard.
    """
    counts = df.groupBy(shard).count().limit(most_shards + 1).collect()
    if len(counts) > most_shards:
        raise ValueError(f"more than {most_shards} shards")
    first, places = 0, []
    for key, rows in sorted(((r[0], r[1]) for r in counts), key=lambda r: (r[0] is not None, r[0])):
        parts = -(-rows // rows_per_part)
        places.append((key, first, parts))
        first += parts
    if not places:
        return df
    known = [(key, F.struct(F.lit(at).alias("at"), F.lit(parts).alias("parts"))) for key, at, parts in places]
    listed = F.create_map(*[x for key, place in known if key is not None for x in (F.lit(key), place)])
    place = F.try_element_at(listed, F.col(shard)) if any(key is not None for key, _ in known) else F.lit(None)
    if known[0][0] is None:
        place = F.when(F.col(shard).isNull(), known[0][1]).otherwise(place)
    number = place["at"] + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), place["parts"])
    return df.repartitionById(first, number.cast("int"))


def spread(df: DataFrame, partitions: int = 8) -> DataFrame:
    """Deal rows out evenly over a number of partitions."""
    return df.repartition(partitions)
