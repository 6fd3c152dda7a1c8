"""Rate of the best share of volume per key.

Rows of a key are ordered by rate, best first; rows count until a share of the
key's weight is used up, and the row on the boundary counts in part.

A window over the rows would put a hot key into one task. The boundary is
found in three steps instead, each over aggregates that shrink before the
shuffle:

1. sums per coarse rate band place the boundary in one band of each key;
2. sums per exact rate and coarse weight band place the boundary in one such
   cell of the band;
3. within the cell, equal rows are counted, and the boundary row is found.

Windows run over bands and distinct values only, never over raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adflow.functions.numbers import int_divide, rate
from adflow.operators.lookups import null_safe_join
from adflow.session import stored

def _band(n: Column, bits: int) -> Column:
    """Coarse band of a non-negative number: its leading bits and its size.

    Bands grow with the number; one of 63 binary digits falls into one of
    fewer than ``64 * 2**bits`` bands.
    """
    shift = F.greatest(F.floor(F.log2(n)) - (bits - 1), F.lit(0).cast("bigint"))
    band = F.shiftleft(shift, 52).bitwiseOR(F.call_function("shiftright", n, shift.cast("int")))
    return F.coalesce(band, F.lit(0).cast("bigint"))


def _running(cells: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add the sums of weight and value up to each cell, best cells first."""
    along = (
        Window.partitionBy(*keys)
        .orderBy(*[F.desc(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return cells.withColumns({"_cum_w": F.sum("_w").over(along), "_cum_v": F.sum("_v").over(along)})


def _boundary(running: DataFrame) -> DataFrame:
    """Per key the cell in which the target weight is reached.

    ``_w0`` and ``_v0`` hold what lies in front of all cells of this step; in
    the result they also hold the cells in front of the boundary.
    """
    before_w = F.col("_w0") + F.col("_cum_w") - F.col("_w")
    before_v = F.col("_v0") + F.col("_cum_v") - F.col("_v")
    reached = (before_w <= F.col("_target")) & (F.col("_target") < F.col("_w0") + F.col("_cum_w"))
    return running.where(reached).withColumns({"_w0": before_w, "_v0": before_v}).drop("_cum_w", "_cum_v")


def top_share(
    df: DataFrame,
    keys: Sequence[str],
    weight: str,
    value: str,
    share: float = 0.25,
    scale: float = 1000.0,
    wanted: DataFrame | None = None,
    coarser: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Per key: weight, value and rate of its best share, and the rate of all its rows.

    ``weight`` is a positive integer per row and ``value`` a non-negative one;
    rows without weight have no share and are left out. Equal rates are
    ordered by weight, then value, largest first. NULL is a key like others.

    ``wanted`` restricts the result to the keys it holds. With ``coarser``
    (values for some key columns) each row also counts for the key that has
    these values in place of its own. Steps 1 and 2 run at once and write their
    results to the shared folder.
    """
    if not 0.0 < share < 1.0:
        raise ValueError("share must lie between 0 and 1")
    coarser = dict(coarser or {})
    w, v = F.col(weight).cast("bigint"), F.col(value).cast("bigint")
    of_row = rate(F.col("_value"), F.col("_weight"), scale)
    rows = (
        df.select(*keys, w.alias("_weight"), v.alias("_value"))
        .where(F.col("_weight") > 0)
        .withColumn("_rate", of_row)
        .withColumn("_band", _band(F.col("_rate"), 5))
    )

    # Step 1: rate bands, and the totals of each key from the same sums. Each level of keys is summed
    # from the rows by itself, and combined before its shuffle: a row of a coarser key goes through one.
    sums = [F.sum("_weight").alias("_w"), F.sum("_value").alias("_v")]
    if coarser:
        finer = reduce(or_, [~F.col(k).eqNullSafe(c) for k, c in coarser.items()])
        own_level = rows.where(finer).groupBy(*keys, "_band").agg(*sums)
        bands = own_level.unionByName(rows.withColumns(coarser).groupBy(*keys, "_band").agg(*sums))
    else:
        bands = rows.groupBy(*keys, "_band").agg(*sums)
    # The key as one struct, in which NULL equals NULL: the join and the windows share a shuffle.
    bands = bands.select(F.struct(*keys).alias("_key"), "_band", "_w", "_v")
    if wanted is not None:
        bands = bands.join(wanted.select(F.struct(*keys).alias("_key")), "_key", "left_semi")
    # The running sums come first: their sort also serves the totals.
    whole = Window.partitionBy("_key")
    all_w, all_v = F.sum("_w").over(whole), F.sum("_v").over(whole)
    zero = F.lit(0).cast("bigint")
    bands = _running(bands, ["_key"], ["_band"]).withColumns({"_all_w": all_w, "_all_v": all_v})
    target = F.lit(share) * F.col("_all_w").cast("double")
    bands = bands.withColumns({"_target": target, "_w0": zero, "_v0": zero})
    state = ["_target", "_all_w", "_all_v", "_w0", "_v0"]
    # One row per key, written out: the planner then knows whether it can broadcast it, and the
    # rows of step 2 are shuffled before the join only if it cannot.
    in_band = stored(_boundary(bands).select("_key.*", "_band", *state), "bands")

    # Step 2: only rows of the boundary band go on, equal rows as one row and a count, and of
    # these only the cell of exact rate and coarse weight that the boundary lies in.
    own = {c: f"_own_{c}" for c in [*keys, "_band"]}
    renamed = rows.drop("_rate").withColumnsRenamed(own)
    same = F.col("_own__band") == F.col("_band")
    for k in keys:
        alike = F.col(own[k]).eqNullSafe(F.col(k))
        same = same & (alike | F.col(k).eqNullSafe(coarser[k]) if k in coarser else alike)
    close = renamed.join(in_band, same).groupBy(*keys, "_weight", "_value", *state).agg(F.count(F.lit(1)).alias("_n"))
    close = close.withColumns({"_rate": of_row, "_weight_band": _band(F.col("_weight"), 9)})
    # Written out, as the cells and their rows are both taken from it.
    close = _within_cell(stored(close, "close"), keys, state)

    # Step 3: the boundary row, and the equal rows in front of it.
    sums = {"_w": F.col("_weight") * F.col("_n"), "_v": F.col("_value") * F.col("_n")}
    last = _boundary(_running(close.withColumns(sums), keys, ["_rate", "_weight", "_value"]))
    left_over = F.col("_target") - F.col("_w0")
    last = last.withColumn("_full", int_divide(F.floor(left_over), F.col("_weight")))
    rest = left_over - F.col("_full") * F.col("_weight")
    part = rest / F.col("_weight")
    top_w = F.col("_w0") + F.col("_full") * F.col("_weight") + rest.cast("bigint")
    top_v = F.col("_v0") + F.col("_full") * F.col("_value") + (F.col("_value") * part).cast("bigint")
    return (
        last.withColumns({"top_weight": top_w, "top_value": top_v})
        .withColumn("top_rate", rate(F.col("top_value"), F.col("top_weight"), scale))
        .withColumn("all_rate", rate(F.col("_all_v"), F.col("_all_w"), scale))
        .select(*keys, "top_weight", "top_value", "top_rate", "all_rate")
    )


def _within_cell(close: DataFrame, keys: Sequence[str], state: Sequence[str]) -> DataFrame:
    """Rows of the one cell of exact rate and weight band that the boundary lies in."""
    sums = [F.sum(F.col("_weight") * F.col("_n")).alias("_w"), F.sum(F.col("_value") * F.col("_n")).alias("_v")]
    cells = close.groupBy(*keys, "_rate", "_weight_band", *state).agg(*sums)
    in_cell = _boundary(_running(cells, keys, ["_rate", "_weight_band"]))
    in_cell = in_cell.select(*keys, "_rate", "_weight_band", "_w0", "_v0")
    return null_safe_join(close.drop("_w0", "_v0"), in_cell, [*keys, "_rate", "_weight_band"])
