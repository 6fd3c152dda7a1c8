"""Columns that hold values of several types: numbers, texts, records and lists in one VARIANT column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fields of an email record.
EMAIL_FIELDS = ("subject", "text", "sender", "recipient")

_INT = 1 << 31


def kind_of(value: Column) -> Column:
    """What a value is: ``int``, ``number``, ``text``, ``boolean``, ``record``, ``list``, ``null`` or ``other``; NULL for NULL."""
    name = F.schema_of_variant(value)
    return (
        F.when(name == "BIGINT", "int")
        .when(name.startswith("DECIMAL") | name.isin("DOUBLE", "FLOAT"), "number")
        .when(name == "STRING", "text")
        .when(name == "BOOLEAN", "boolean")
        .when(name.startswith("OBJECT"), "record")
        .when(name.startswith("ARRAY"), "list")
        .when(name == "VOID", "null")
        .when(name.isNotNull(), "other")
    )


def _step(key: str) -> str:
    if "'" not in key:
        return f"['{key}']"
    if '"' not in key:
        return f'["{key}"]'
    raise ValueError(f"a key with both kinds of quotes: {key}")


def variant_path(value: Column, *path: str, kind: str = "variant") -> Column:
    """The value at a path of keys in nested records; NULL if a key is missing or a step is no record.

    The value keeps its own type, or is read as ``kind``, and is NULL if it cannot be.
    """
    if not path:
        raise ValueError("path must not be empty")
    return F.try_variant_get(value, "$" + "".join(map(_step, path)), kind)


def whole_number(value: Column) -> Column:
    """The value as a 32-bit integer if that is what it is, else NULL; texts and fractions are not converted."""
    number = F.try_variant_get(value, "$", "bigint")
    return F.when((kind_of(value) == "int") & number.between(-_INT, _INT - 1), number.cast("int"))


def text_value(value: Column) -> Column:
    """The value as a text if that is what it is, else NULL."""
    return F.when(kind_of(value) == "text", F.try_variant_get(value, "$", "string"))


def is_record_of(value: Column, *fields: str) -> Column:
    """Whether the value is a record with all these fields as texts."""
    has = kind_of(value) == "record"
    for name in fields:
        has = has & F.coalesce(kind_of(variant_path(value, name)) == "text", F.lit(False))
    return F.coalesce(has, F.lit(False))


def any_case(value: Column) -> Column:
    """Answer by the kind and value of what one column holds; answers are of several types too.

    The number 1 gives a text, the text ``two`` a number, other 32-bit numbers
    and emails what they are, and all else, NULL included, ``many``.
    """

    # The answers.
    def said(text: Column) -> Column:
        return F.to_json(F.struct(text.alias("a")))

    subject = F.format_string("Email: subject = %s", variant_path(value, "subject", kind="string"))
    answer = (
        F.when(whole_number(value) == 1, said(F.lit("one")))
        .when(text_value(value) == "two", F.to_json(F.struct(F.lit(2).alias("a"))))
        .when(whole_number(value).isNotNull(), said(F.lit("scala.Int")))
        .when(is_record_of(value, *EMAIL_FIELDS), said(subject))
        .otherwise(said(F.lit("many")))
    )
    return variant_path(F.parse_json(answer), "a")
