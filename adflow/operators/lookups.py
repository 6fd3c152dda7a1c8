"""Lookups against dictionaries and chains of joins.

No broadcast is forced here: the planner broadcasts a side whose size it knows
to be small and shuffles otherwise, and adaptive execution splits hot keys of
the fact side, which is safe because the dictionary holds each key once. It
does so only where a side of the join is a plain shuffle; sides that come out
of an aggregate are written to the shared folder first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.session import folder_exists, stored


def require_unique(dim: DataFrame, key: str) -> None:
    """Raise an error if a dictionary holds a key twice; NULL keys match nothing and may repeat.

    The check is a job of its own. The join then reads the dictionary itself,
    not the outcome of an aggregate: its size is known, and adaptive execution
    can split hot keys on the other side.
    """
    repeated = dim.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").first()
    if repeated is not None:
        raise ValueError(f"repeated dictionary key {repeated[key]}")


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same names, where NULL equals NULL; the left ones are kept."""
    names = {c: f"_right_{c}" for c in on}
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    return left.join(right.withColumnsRenamed(names), same, how).drop(*names.values())


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    value: str,
    default: Column | None = None,
) -> DataFrame:
    """Add a dictionary value to each row; unknown keys get the default.

    Every row is kept, duplicates too. A dictionary that repeats a key is an
    error.
    """
    require_unique(dim, on)
    joined = df.join(dim.select(on, value), on, "left")
    return joined if default is None else joined.withColumn(value, F.coalesce(value, default))


def lookup_record(df: DataFrame, dim: DataFrame, on: str, default: Mapping[str, str]) -> DataFrame:
    """Add a whole dictionary record as a struct; unknown keys get the default record."""
    require_unique(dim, on)
    dictionary = dim.select(on, F.struct(*default).alias("record"))
    fallback = F.struct(*[F.lit(v).alias(k) for k, v in default.items()])
    return df.join(dictionary, on, "left").withColumn("record", F.coalesce("record", fallback))


def lookup_distinct(df: DataFrame, on: str, value: str, expensive: Column) -> DataFrame:
    """Evaluate an expensive expression once per distinct key, then join it back.

    The values found are written to the shared folder, so no later step asks
    for them again. A NULL key finds no value.
    """
    once = df.select(on).distinct().withColumn(value, expensive)
    return df.join(stored(once, "lookups"), on, "left")


def memoized(df: DataFrame, on: str, value: str, expensive: Column, memo: str) -> DataFrame:
    """Add the value of an expensive expression, evaluated once for each key that the memo does not hold.

    The memo is a folder that outlives the call: a table of keys and values that
    calls, batches and applications share. Keys without a value there are
    evaluated and appended; all values are then read from it. A call that fails
    half-way leaves whole rows or none of a task, so the next one evaluates what
    is missing. Two writers at once may evaluate a key twice; one value counts.
    A NULL key finds no value and is not evaluated.
    """
    spark = df.sparkSession
    asked = stored(df.select(on).where(F.col(on).isNotNull()).distinct(), "asked")
    schema = asked.withColumn(value, expensive).schema
    fresh = asked
    if folder_exists(spark, memo):
        fresh = asked.join(spark.read.schema(schema).parquet(memo), on, "left_anti")
    fresh.withColumn(value, expensive).write.mode("append").parquet(memo)
    known = spark.read.schema(schema).parquet(memo).join(asked, on, "left_semi")
    return df.join(stored(known.dropDuplicates([on]), "lookups"), on, "left")


def partner_salts(df: DataFrame, partners: DataFrame) -> DataFrame:
    """Add the hash salt of each row's namespace; an unknown namespace has none."""
    return lookup(df, partners, "ns", "hash_salt")


def favorite_movies(favorites: DataFrame, movies: DataFrame) -> DataFrame:
    """Each favourite video with its movie as a struct."""
    by_id = movies.select("movie_id", F.struct("movie_id", "title").alias("movie"))
    videos = favorites.select("user_id", "movie_id", F.struct("movie_id").alias("video"))
    return videos.join(by_id, "movie_id").select("user_id", "movie", "video")


def favorite_videos(users: DataFrame, favorites: DataFrame, videos: DataFrame) -> DataFrame:
    """User to favourite movie to the movie's videos; a miss at any step gives no row.

    One row per video, so a movie with many videos stays spread over tasks.
    """
    return users.join(favorites, "user_id").join(videos, "movie_id")
