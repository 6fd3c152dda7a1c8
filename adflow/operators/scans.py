"""Ordered scans that stay parallel inside one hot key.

Rows are range-partitioned and sorted by the keys and all order columns, and
written with the number of their partition. A key that spans partitions hands
on, per partition, one small row with what the later ones need: its sums, or its
last value. That row enters the window of the next partition in front of the
real ones, so no task sees more of a key than one partition holds. The same path
serves every size and every type that Spark can sort.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adflow.session import stored


def _ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: int | None) -> DataFrame:
    """The rows with ``_part``, the number of their range of the keys and the order."""
    count = [] if parts is None else [parts]
    ranged = df.repartitionByRange(*count, *keys, *order)
    return stored(ranged.withColumn("_part", F.spark_partition_id()), "ranged")


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column],
    parts: int | None = None,
) -> DataFrame:
    """Add running sums, this row included, along an order within each key.

    ``order`` must tell the rows of a key apart, else rows that tie are summed
    in any order. With no keys the whole table is one sequence. ``parts`` sets
    the number of ranges; without it Spark's shuffle settings do.
    """
    rows = _ranged(df, keys, order, parts).withColumns(dict(sums)).withColumn("_real", F.lit(1))
    totals = rows.groupBy(*keys, "_part").agg(*[F.sum(name).alias(name) for name in sums])
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    handed = totals.select(
        *keys, "_part", *[F.sum(name).over(earlier).alias(name) for name in sums], F.lit(0).alias("_real")
    )
    along = (
        Window.partitionBy(*keys, "_part")
        .orderBy("_real", *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    scanned = rows.unionByName(handed, allowMissingColumns=True)
    scanned = scanned.withColumns({name: F.sum(name).over(along) for name in sums})
    return scanned.where("_real = 1").drop("_real", "_part")


def previous_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, parts: int | None = None
) -> DataFrame:
    """Add the value of the row before, along an order within each key; NULL for the first row.

    ``order`` and ``parts`` are as in ``running_sums``.
    """
    rows = _ranged(df, keys, order, parts).withColumn("_real", F.lit(1))
    newest = F.max_by(F.struct(value), F.struct(*order)).alias("_last")
    lasts = rows.groupBy(*keys, "_part").agg(newest)
    by_part = Window.partitionBy(*keys).orderBy("_part")
    handed = lasts.select(
        *keys, "_part", F.lag(f"_last.{value}").over(by_part).alias(value), F.lit(0).alias("_real")
    )
    along = Window.partitionBy(*keys, "_part").orderBy("_real", *order)
    scanned = rows.unionByName(handed, allowMissingColumns=True).withColumn(out, F.lag(value).over(along))
    return scanned.where("_real = 1").drop("_real", "_part")


def with_position(df: DataFrame, order: Sequence[str], out: str = "position", parts: int | None = None) -> DataFrame:
    """Number all rows from 1 along an order."""
    return running_sums(df, [], order, {out: F.lit(1).cast("bigint")}, parts)


def zip_tables(left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str]) -> DataFrame:
    """Pair the rows of two tables by position, cut to the shorter one."""
    return with_position(left, left_order).join(with_position(right, right_order), "position")
