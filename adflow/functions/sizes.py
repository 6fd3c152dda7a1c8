"""Ad-slot sizes packed into one bigint: height in the high 32 bits, width in the low."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTH_MASK = 4294967295


def _dimension(text: Column, index: int) -> Column:
    part = F.split_part(text, F.lit("*"), F.lit(index))
    return F.when(F.trim(part) == part, part.try_cast("bigint"))


def size_encode(text: Column) -> Column:
    """``"W*H"`` to its code; ``"0"``, malformed text and NULL give 0."""
    width, height = _dimension(text, 1), _dimension(text, 2)
    return F.coalesce(F.shiftleft(height, 32).bitwiseOR(width), F.lit(0).cast("bigint"))


def size_decode(code: Column) -> Column:
    """A code back to ``"W*H"``; 0 gives an empty text."""
    width = code.bitwiseAND(F.lit(WIDTH_MASK).cast("bigint"))
    height = F.shiftright(code, 32)
    literal = F.concat(width.cast("string"), F.lit("*"), height.cast("string"))
    return F.when(code == 0, F.lit("")).otherwise(literal)
