"""Synthetic tables, grown from a column of ids.

Random columns depend on the id alone (see ``draw``), so lost tasks redo the
same rows on any machine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adflow.functions.numbers import draw, draw_below, draw_unit, int_divide


def integers(spark: SparkSession, start: int, stop: int, step: int = 1) -> DataFrame:
    """Integers from a start up to, and without, a stop."""
    return spark.range(start, stop, step)


def random_integers(ids: DataFrame, key: str, seed: int) -> DataFrame:
    """A random integer for each id; reading again gives the same numbers."""
    return ids.select(key, draw(F.col(key), seed).alias("random"))


def report_log(ids: DataFrame, key: str, batches: int = 1, seed: int = 1) -> DataFrame:
    """A synthetic ad log: for each id i and each batch one row of plan i/10+1 of user i/100+1."""
    i, batch = F.col(key).cast("bigint"), F.col("batch").cast("bigint")
    place = i * F.lit(batches) + batch
    rows = ids.select(key, F.explode(F.sequence(F.lit(0), F.lit(batches - 1))).alias("batch"))
    return rows.select(
        "batch",
        (int_divide(i, F.lit(100)) + 1).alias("user_id"),
        (int_divide(i, F.lit(10)) + 1).alias("plan_id"),
        i.alias("group_id"),
        draw_below(place, seed, 1000, 100).alias("show"),
        draw_below(place, seed + 1, 100).alias("clk"),
        draw_below(place, seed + 2, 100).alias("cost"),
    )


def purchases(ids: DataFrame, key: str, seed: int = 1) -> DataFrame:
    """A random purchase for each id: 100 stores, 1000 customers, 500 items."""
    i = F.col(key)
    return ids.select(
        key,
        draw_below(i, seed, 100).alias("store_number"),
        draw_below(i, seed + 1, 1000).alias("customer_number"),
        draw_below(i, seed + 2, 500).alias("item_number"),
    )


def sample_points(ids: DataFrame, key: Column, per_id: int = 1, seed: int = 1) -> DataFrame:
    """Random points of the square [-1, 1) x [-1, 1), some for each id."""
    place = key * F.lit(per_id) + F.col("_copy")
    spread = ids.select("*", F.explode(F.sequence(F.lit(0), F.lit(per_id - 1))).alias("_copy"))
    return spread.select(
        (draw_unit(place, seed) * 2 - 1).alias("x"),
        (draw_unit(place, seed + 1) * 2 - 1).alias("y"),
    )
