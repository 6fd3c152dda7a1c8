"""Aggregations. Every one has a map-side partial step, so hot groups shrink before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adflow.functions.numbers import grade_letter, rate
from adflow.functions.text import WHITESPACE


def rollup(df: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Sum measures per key, widened to bigint."""
    return df.groupBy(*keys).agg(*[F.sum(F.col(c).cast("bigint")).alias(c) for c in sums])


def rollup_by_group(df: DataFrame, key: str, sums: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Sum measures per key and keep one value of other id columns, the lowest."""
    kept = [F.min(c).alias(c) for c in keep]
    return df.groupBy(key).agg(*kept, *[F.sum(F.col(c).cast("bigint")).alias(c) for c in sums])


def avg_by_group(df: DataFrame, key: str, measure: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(measure).alias(f"avg_{measure}"))


def exact_sum(units: Column, digits: int = 0) -> Column:
    """Sum of a bigint column as a decimal, ``units`` being 10**-digits each.

    The high and the low bits are summed apart as bigints, so no step can
    overflow or round, and the aggregate stays as cheap as a sum of doubles.
    """
    high = F.sum(F.shiftright(units, 20)).cast("decimal(28,0)")
    low = F.sum(units.bitwiseAND(F.lit(1048575).cast("bigint"))).cast("decimal(20,0)")
    total = high * F.lit(1048576).cast("decimal(7,0)") + low
    if digits == 0:
        return total
    return total * F.lit(f"1e-{digits}").cast(f"decimal({digits + 1},{digits})")


def pricing_summary(lineitem: DataFrame, until: str = "1998-09-16") -> DataFrame:
    """Sums, averages and counts per return flag and line status.

    Quantities, prices and shares have two decimals; they are summed exactly,
    so the result does not depend on the order in which tasks add up.
    """
    shipped = lineitem.where(F.col("l_shipdate") <= F.lit(until).cast("timestamp_ntz"))

    def hundredths(name: str) -> Column:
        return F.rint(F.col(name) * 100).cast("bigint")

    quantity, price = hundredths("l_quantity"), hundredths("l_extendedprice")
    discount, tax = hundredths("l_discount"), hundredths("l_tax")
    disc_price = price * (100 - discount)
    n = F.count(F.lit(1))

    def total(units: Column, digits: int = 2) -> Column:
        return exact_sum(units, digits).cast("double")

    per_flag = shipped.groupBy("l_returnflag", "l_linestatus").agg(
        total(quantity).alias("sum_qty"),
        total(price).alias("sum_base_price"),
        total(disc_price, 4).alias("sum_disc_price"),
        total(disc_price * (100 + tax), 6).alias("sum_charge"),
        (total(quantity) / n).alias("avg_qty"),
        (total(price) / n).alias("avg_price"),
        (total(discount) / n).alias("avg_disc"),
        n.alias("count_order"),
    )
    return per_flag.orderBy("l_returnflag", "l_linestatus")


def clean_word_count(
    df: DataFrame,
    text: str,
    stop_words: Sequence[str] | DataFrame = (),
    pattern: str = WHITESPACE,
    strip: str = ".",
) -> DataFrame:
    """Count words: lower-case, split, strip, drop stop words and empty words.

    A list of stop words becomes a filter, a table of them (column ``word``)
    an anti join.
    """
    words = df.select(F.explode(F.split(F.lower(F.col(text)), pattern)).alias("_raw"))
    counted = words.select(F.btrim("_raw", F.lit(strip)).alias("word")).where("word <> ''")
    if isinstance(stop_words, DataFrame):
        # Count first: the join then sees each word once, however often it occurs.
        counted = counted.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
        return counted.join(stop_words.select("word"), "word", "left_anti")
    if stop_words:
        counted = counted.where(~F.col("word").isin(*stop_words))
    return counted.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def grade_histogram(df: DataFrame, grade: str, width: int = 60) -> DataFrame:
    """Count and bar of stars per letter, sorted by letter; the longest bar has ``width`` stars.

    Bars are in proportion, so that no text grows with the rows. With the
    largest count as the width there is one star per row.
    """
    letter = grade_letter(F.col(grade)).alias("letter")
    counts = df.groupBy(letter).agg(F.count(F.lit(1)).alias("count"))
    # A window over the few letters, not over rows.
    longest = F.max("count").over(Window.partitionBy())
    stars = F.ceil(F.col("count") * width / longest)
    return counts.withColumn("bar", F.repeat(F.lit("*"), stars.cast("int"))).orderBy("letter")


def discount_total(df: DataFrame, price: Column, at_least: float = 20.0, share: Column | None = None) -> DataFrame:
    """Sum of a share (10 % by default) of all prices from a bound on; NULL if there is none."""
    share = F.lit("0.10").cast("decimal(3,2)") if share is None else share
    return df.where(price >= at_least).agg(F.sum(price * share).alias("discount"))


def sum_or_zero(df: DataFrame, measure: str) -> DataFrame:
    return df.agg(F.coalesce(F.sum(measure), F.lit(0).cast("bigint")).alias("total"))


def maximum(df: DataFrame, measure: str) -> DataFrame:
    """Largest value; NULL on empty input."""
    return df.agg(F.max(measure).alias("maximum"))


def filtered_sum(df: DataFrame, condition: Column, measure: Column) -> DataFrame:
    """Sum of a measure over the rows that meet a condition, 0 if none does."""
    return df.where(condition).agg(F.coalesce(F.sum(measure), F.lit(0).cast("bigint")).alias("total"))


def weighted_rate(df: DataFrame, keys: Sequence[str], weight: str, value: str, scale: float = 1000.0) -> DataFrame:
    """Sums of weight and value per key and the rate of the merged rows; no keys give one row."""
    sums = rollup(df, keys, [weight, value])
    return sums.withColumn("rate", rate(F.col(value), F.col(weight), scale))


def best_by_rate(
    df: DataFrame, keys: Sequence[str], channel: str, weight: str, value: str, scale: float = 1000.0
) -> DataFrame:
    """Per key the channel with the highest merged rate, with its rate and weight.

    On a tie the lowest channel wins.
    """
    merged = weighted_rate(df, [*keys, channel], weight, value, scale)
    order = F.struct(F.col("rate"), -F.col(channel).cast("bigint"))
    best = F.max_by(F.struct("rate", channel, weight), order).alias("_best")
    return merged.groupBy(*keys).agg(best).select(
        *keys,
        F.col(f"_best.{channel}").alias(f"best_{channel}"),
        F.col("_best.rate").alias("best_rate"),
        F.col(f"_best.{weight}").alias(f"best_{weight}"),
    )


def collect_chunks(
    df: DataFrame, key: str, sequence: str, fields: Mapping[str, Column], width: int = 100_000
) -> DataFrame:
    """Rows of each key as lists, newest first, cut into chunks.

    ``sequence`` numbers the rows uniquely. A chunk covers ``width`` sequence
    numbers, so no list holds more than ``width`` rows however hot its key is.
    The chunks of a key in descending order, one after the other, are its list.
    """
    chunk = F.floor(F.col(sequence) / F.lit(width)).alias("chunk")
    row = F.struct(F.col(sequence), *[c.alias(name) for name, c in fields.items()])
    lists = df.groupBy(key, chunk).agg(F.collect_list(row).alias("rows"))
    return lists.withColumn("rows", F.sort_array("rows", asc=False))


def discounted_total(df: DataFrame, discounted: Column) -> DataFrame:
    return df.agg(F.sum(discounted).alias("total"))


def outcome_counts() -> list[Column]:
    """Counts by outcome: success, normal, below the floor, fail, audit."""
    status = F.col("status")
    return [
        F.count(F.lit(1)).alias("results"),
        F.count_if(status == "success").alias("success"),
        F.count_if((status == "success") & ~F.col("below_floor")).alias("normal"),
        F.count_if((status == "success") & F.col("below_floor")).alias("below_floor"),
        F.count_if(status == "fail").alias("fail"),
        F.count_if(status == "audit").alias("audit"),
    ]


def status_counts(priced: DataFrame) -> DataFrame:
    """One row of counts by outcome."""
    return priced.agg(*outcome_counts())


def estimate_pi(points: DataFrame, x: Column, y: Column) -> DataFrame:
    """Four times the share of points of the unit square that lie in the unit circle.

    ``x`` and ``y`` run over [-1, 1).
    """
    inside = F.count_if(x * x + y * y < 1)
    total = F.count(F.lit(1))
    return points.agg(inside.alias("inside"), total.alias("points"), (inside * 4.0 / total).alias("pi"))
