"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adflow.session import stored


def fresh_name(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that the table does not have yet (case aside)."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        found.append(name)
    return found


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, whatever characters the name has."""
    return F.col(f"`{name.replace('`', '``')}`")


def text_of(df: DataFrame, name: str) -> Column:
    """A text column with the empty text for null."""
    return F.coalesce(column(df, name).cast("string"), F.lit(""))


_BLANKS = bytes(b if chr(b).isalnum() or b >= 0x80 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words in lower case: runs of anything but ASCII white space and punctuation."""
    return (text or "").lower().encode("utf-8", "replace").translate(_BLANKS).split()


def flat(value: str | None) -> str:
    """A text as a Python string; null and NaN are the empty text."""
    return value if isinstance(value, str) else ""


def global_order(df: DataFrame, order: list[Column], keep: list[Column], label: str, partitions: int | None = None) -> DataFrame:
    """Rows numbered from 0 in a total order, in the column ``position``.

    Rows are range-partitioned and sorted, and written with their place in their
    partition; the only table seen by one task has a row per partition. Rows
    that tie in all order columns are numbered in any order.
    """
    count = (partitions,) if partitions else ()
    dealt = df.repartitionByRange(*count, *order).sortWithinPartitions(*order)
    placed = stored(dealt.select(*keep, F.monotonically_increasing_id().alias("place")), label)
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    running = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    starts = sizes.select("part", (running - F.col("rows")).alias("start"))
    within = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    names = [c for c in placed.columns if c != "place"]
    return (
        placed.withColumn("part", part)
        .join(starts, "part")
        .select(*names, (F.col("start") + within).alias("position"))
    )
