"""Text functions."""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that Java's \s matches, spelled out.
WHITESPACE = "[ \\t\\n\\x0B\\f\\r]"

COMPARATORS: dict[str, Callable[[Column, int], Column]] = {
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
    "==": operator.eq,
}


def concat_key(*parts: Column) -> Column:
    """Parts joined with ``_``; for display only, joins use the columns."""
    return F.concat_ws("_", *[p.cast("string") for p in parts])


def prefix_text(name: Column, prefix: str = "Hello, ") -> Column:
    return F.concat(F.lit(prefix), name)


def initials(name: Column) -> Column:
    """First letter of each space-separated word, in upper case.

    Repeated spaces make empty words, which add nothing.
    """
    letters = F.transform(F.split(F.upper(name), " "), lambda w: F.substring(w, 1, 1))
    return F.array_join(letters, "")


def vowels_in_word(word: Column) -> Column:
    """Sorted distinct lower-case vowels of a word."""
    return F.sort_array(F.array_distinct(F.regexp_extract_all(word, F.lit("([aeiou])"), F.lit(1))))


def append_chain(text: Column, suffixes: Iterable[str], compose: bool = False) -> Column:
    """Append suffixes one after the other; ``compose`` applies the last one first."""
    ordered = list(suffixes)
    if compose:
        ordered.reverse()
    return reduce(lambda acc, s: F.concat(acc, F.lit(s)), ordered, text)


def reverse_text(text: Column) -> Column:
    return F.reverse(text)


def full_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)


def full_address(house_number: Column, street: Column) -> Column:
    return F.concat(house_number.cast("string"), F.lit(" "), street)


def length_check(text: Column, comparator: str, n: int) -> Column:
    """Compare the text length with ``n`` by one of ``> >= < <= ==``."""
    return COMPARATORS[comparator](F.length(text), n)


def minimum_size(text: Column, n: int) -> Column:
    return length_check(text, ">=", n)


def maximum_size(text: Column, n: int) -> Column:
    return length_check(text, "<=", n)


def words(text: Column, separator: str = " ") -> Column:
    """The text split at a character, without trailing empty words.

    An empty text still gives one empty word.
    """
    trimmed = F.rtrim(text, F.lit(separator))
    none = F.array().cast("array<string>")
    return F.when((F.length(trimmed) == 0) & (F.length(text) > 0), none).otherwise(F.split(trimmed, separator))
