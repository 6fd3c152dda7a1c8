"""Operators on event sequences: running totals, state checks, contiguous prefixes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.operators.lookups import null_safe_join
from adflow.operators.scans import previous_value, running_sums
from adflow.session import stored

# Phase changes as event -> (state before, state after).
PHASE_CHANGES = {
    "Melting": ("solid", "liquid"),
    "Sublimation": ("solid", "vapor"),
    "Vaporization": ("liquid", "vapor"),
    "Freezing": ("liquid", "solid"),
    "Condensation": ("vapor", "liquid"),
    "Deposition": ("vapor", "solid"),
    "Ionization": ("vapor", "plasma"),
    "Deionization": ("plasma", "vapor"),
}


def ledger_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: Column) -> DataFrame:
    """The ledger with the running total after each entry."""
    return running_sums(df, keys, order, {"running_total": amount})


def running_valid(df: DataFrame, keys: Sequence[str], order: Sequence[str], valid: Column) -> DataFrame:
    """How many valid rows each sequence holds up to each row.

    A valid row's count is its position among the valid ones, so the list
    collected up to a row is the valid rows with a position up to its count.
    """
    is_valid = F.coalesce(valid, F.lit(False))
    counted = running_sums(df, keys, order, {"valid_so_far": is_valid.cast("bigint")})
    return counted.withColumn("valid", is_valid)


def validate_transitions(
    df: DataFrame,
    entity: str,
    order: Sequence[str],
    event: str,
    start: str,
    table: Mapping[str, tuple[str, str]] = PHASE_CHANGES,
) -> DataFrame:
    """Whether each entity's events are a legal walk, and the first event that is not.

    Each event has one source state, so a walk is legal exactly if every event
    starts where the one before ended. Unknown events are illegal.
    """
    source = F.create_map(*[F.lit(x) for name, (before, _) in table.items() for x in (name, before)])
    target = F.create_map(*[F.lit(x) for name, (_, after) in table.items() for x in (name, after)])
    steps = df.select(entity, *order, F.coalesce(event, F.lit("")).alias(event))
    steps = previous_value(steps, [entity], order, event, "_before")
    came_from = F.when(F.col("_before").isNull(), F.lit(start)).otherwise(
        F.try_element_at(target, F.col("_before"))
    )
    legal = F.coalesce(F.try_element_at(source, F.col(event)) == came_from, F.lit(False))
    first_bad = F.min(F.when(~legal, F.struct(*order)))
    return steps.groupBy(entity).agg(F.bool_and(legal).alias("valid"), first_bad.alias("first_bad"))


def contiguous_prefix(df: DataFrame, key: str, page: str, start: int = 1, pages: int | None = None) -> DataFrame:
    """Pages of each key from the start up to the first missing one, or the first ``pages`` of these.

    Rows without a key are one more key.

    A page ends a run if its successor is missing; the first such page at or
    after the start ends the prefix. Both joins are on values, not on a sorted
    group, so a key with very many pages stays spread.
    """
    wanted = F.col(page) >= start
    if pages is not None:
        wanted = wanted & (F.col(page) < start + pages)
    there = df.select(key, page).where(wanted).distinct()
    successors = there.select(key, (F.col(page) - 1).alias(page))
    gaps = null_safe_join(there, successors, [key, page], "left_anti")
    ends = gaps.groupBy(key).agg(F.min(page).alias("_end"))
    opened = there.where(F.col(page) == start).select(key)
    ends = stored(null_safe_join(ends, opened, [key], "left_semi"), "prefix-ends")
    return null_safe_join(df.where(wanted), ends, [key]).where(F.col(page) <= F.col("_end")).drop("_end")
