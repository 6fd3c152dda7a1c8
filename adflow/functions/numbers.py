"""Arithmetic, prices, grades, shapes and reproducible random numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grade steps as (above, up to and including, letter).
FULL_GRADES = [(4.0, 5.0, "A"), (3.0, 4.0, "B"), (2.0, 3.0, "C"), (0.0, 2.0, "D")]
PLUS_MINUS_GRADES = [
    (4.7, 5.0, "A"),
    (4.3, 4.7, "A-"),
    (4.0, 4.3, "B+"),
    (3.7, 4.0, "B"),
    (3.3, 3.7, "B-"),
    (3.0, 3.3, "C+"),
    (2.7, 3.0, "C"),
    (2.3, 2.7, "C-"),
    (0.0, 2.3, "D"),
]

# Sales tax by state.
STATE_TAX = {"NY": 0.0645, "PA": 0.045}


def rate(value: Column, weight: Column, scale: float = 1000.0) -> Column:
    """``value`` per ``scale`` units of ``weight``, truncated; 0 where the weight is 0."""
    weight = weight.cast("double")
    per_scale = value.cast("double") / F.when(weight != 0, weight / F.lit(scale))
    return F.coalesce(per_scale.cast("bigint"), F.lit(0).cast("bigint"))


def grade_letter(grade: Column, steps: Sequence[tuple[float, float, str]] = FULL_GRADES) -> Column:
    """Letter of a grade by half-open steps; 0 is F, anything else N/A."""
    letter = F.when(grade == 0.0, "F")
    for low, high, name in steps:
        letter = letter.when((grade > low) & (grade <= high), name)
    return letter.otherwise("N/A")


def percent_discount(price: Column, percent: float | Column) -> Column:
    """Price less ``percent`` per cent; a percentage outside 0..100 is an error."""
    message = "Discounts must be between 0.0 and 100.0."
    if not isinstance(percent, Column):
        if not 0.0 <= percent <= 100.0:
            raise ValueError(message)
        return price - price * F.lit(float(percent)) * F.lit(0.01)
    reduced = price - price * percent * F.lit(0.01)
    return F.when(percent.between(0.0, 100.0), reduced).otherwise(F.raise_error(F.lit(message)))


def state_tax(amount: Column, state: Column, rates: Mapping[str, float] = STATE_TAX) -> Column:
    """Tax on an amount; a state without a rate is an error."""
    branches = None
    for name, share in rates.items():
        condition, taxed = state == name, amount * F.lit(share)
        branches = F.when(condition, taxed) if branches is None else branches.when(condition, taxed)
    return branches.otherwise(F.raise_error(F.concat(F.lit("no tax rate for "), state)))


def int_divide(a: Column, b: Column) -> Column:
    """Integer division that truncates towards zero; dividing by 0 is an error."""
    return F.call_function("div", a, b)


def is_even(n: Column) -> Column:
    return n % 2 == 0


def factorial(n: Column) -> Column:
    """n! as bigint; NULL above 20, where a bigint ends."""
    return F.factorial(n)


def perimeter(kind: Column, a: Column, b: Column) -> Column:
    """Perimeter of a circle (radius a), rectangle (a by b) or square (side a)."""
    return (
        F.when(kind == "circle", 2 * F.pi() * a)
        .when(kind == "rectangle", 2 * a + 2 * b)
        .when(kind == "square", 4 * a)
    )


def area(kind: Column, a: Column, b: Column) -> Column:
    """Area of a circle (radius a), rectangle (a by b) or square (side a)."""
    return (
        F.when(kind == "circle", F.pi() * a * a)
        .when(kind == "rectangle", a * b)
        .when(kind == "square", a * a)
    )


def draw(key: Column, seed: int) -> Column:
    """A reproducible random integer in [0, 2**31) for each key and seed.

    It depends on the key alone, so a task that runs again on another machine
    draws the same number, whatever the partitioning. The bits of the key are
    mixed by two rounds of shift, multiply and cut, in plain bigint arithmetic
    that no step can overflow.
    """
    low_bits = F.lit(2147483647).cast("bigint")
    key = key.cast("bigint")
    x = (key.bitwiseAND(low_bits) + (seed * 1013904223) % 2147483647).bitwiseAND(low_bits)
    x = (x.bitwiseXOR(F.shiftright(x, 16)) * 2146121005).bitwiseAND(low_bits)
    x = x.bitwiseXOR(F.shiftright(key, 31).bitwiseAND(low_bits))
    x = (x.bitwiseXOR(F.shiftright(x, 15)) * 2221713035).bitwiseAND(low_bits)
    return x.bitwiseXOR(F.shiftright(x, 16))


def draw_below(key: Column, seed: int, span: int, offset: int = 0) -> Column:
    """A reproducible random integer in [offset, offset + span)."""
    return F.lit(offset) + F.pmod(draw(key, seed), F.lit(span))


def draw_unit(key: Column, seed: int) -> Column:
    """A reproducible random double in [0, 1)."""
    return draw(key, seed) / F.lit(2147483648.0)
