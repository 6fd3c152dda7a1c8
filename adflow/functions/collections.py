"""Array, map and nested functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def add_to_all(a: Column, b: Column) -> Column:
    """Every element of one list plus every element of another, in nested-loop order.

    Both lists live in the same row, so the output grows with the rows only.
    """
    return F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: x + y)))


def even_times(a: Column, k: int) -> Column:
    """Keep even elements and multiply them."""
    return F.transform(F.filter(a, lambda x: x % 2 == 0), lambda x: x * k)


def next_codes(text: Column) -> Column:
    """Character code plus one for each ASCII character of a text."""
    return F.transform(F.split(text, ""), lambda c: F.ascii(c) + 1)


def array_head(a: Column) -> Column:
    """First element; NULL where the list is empty."""
    return F.get(a, 0)


def array_tail(a: Column) -> Column:
    return F.slice(a, 2, F.greatest(F.size(a), F.lit(1)))


def array_is_empty(a: Column) -> Column:
    return F.size(a) == 0


def array_sum(a: Column) -> Column:
    """Sum of a list, 0 when empty."""
    return F.aggregate(a, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def array_concat(a: Column, b: Column) -> Column:
    """The elements of one list, then those of another."""
    return F.concat(a, b)


def array_drop(a: Column, n: int) -> Column:
    """All elements but the first n."""
    return F.slice(a, n + 1, F.greatest(F.size(a), F.lit(1)))


def array_find(a: Column, meets: Callable[[Column], Column]) -> Column:
    """The first element that meets a condition; NULL if none does."""
    return F.get(F.filter(a, meets), 0)


def array_partition(a: Column, meets: Callable[[Column], Column]) -> Column:
    """A struct of the elements that meet a condition (``yes``) and those that do not (``no``)."""
    known = lambda x: F.coalesce(meets(x), F.lit(False))
    return F.struct(F.filter(a, known).alias("yes"), F.filter(a, lambda x: ~known(x)).alias("no"))


def zip_short(a: Column, b: Column) -> Column:
    """Zip two lists by position, cut to the shorter one."""
    n = F.least(F.size(a), F.size(b))
    return F.arrays_zip(F.slice(a, 1, n).alias("left"), F.slice(b, 1, n).alias("right"))


def sort_distinct_array(a: Column) -> Column:
    return F.array_sort(F.array_distinct(a))


def keep_values_below(m: Column, limit: int) -> Column:
    return F.map_filter(m, lambda k, v: v < limit)


def keep_keys_above(m: Column, limit: int) -> Column:
    return F.map_filter(m, lambda k, v: k > limit)


def scale_keys(m: Column, factor: int) -> Column:
    return F.transform_keys(m, lambda k, v: k * factor)


def path_select(json_text: Column, *path: str) -> Column:
    """Value at a path of keys in nested JSON; a missing step gives NULL."""
    if not path:
        raise ValueError("path must not be empty")
    return F.get_json_object(json_text, "$" + "".join(f"['{step}']" for step in path))


def path_select_map(nested: Column, *path: str) -> Column:
    """Value at a path of keys in nested maps; a missing step gives NULL."""
    if not path:
        raise ValueError("path must not be empty")
    for step in path:
        nested = F.try_element_at(nested, F.lit(step))
    return nested
