"""Record-level rules: choices, defaults, code names, partner ids."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code names.
CHANNELS = {0: "3rd-DSP", 1: "NOVA", 4: "LU", 5: "PC-DSP", 6: "MDSP"}
RESOURCE_TYPES = {0: "未知", 1: "PC", 2: "WAP", 3: "APP", 4: "PC贴片", 5: "APP贴片"}
TRAFFIC_TYPES = {1: "WEB", 2: "APP"}
ORDER_NEW, ORDER_TO_CONFIRM, ORDER_NOT_FOR_BUYING = 0, 6, 7

# Partner user-id formats as (text before, text after); {salt} is the partner's salt.
PARTNER_FORMATS = {"Acxiom": ("", "ll"), "Bluekai": ("{salt}", "kk"), "Dummy": ("", "_{salt}jj")}
PARTNER_NAMESPACES = {"Acxiom": "AC", "Bluekai": "CMP", "Dummy": ""}


def code_to_literal(code: Column, names: Mapping[int, str], unknown: str = "-") -> Column:
    """Name of a code from a fixed dictionary; unknown codes give ``-``."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), F.lit(unknown))


def in_open_range(freq: Column, low: int = 3, high: int = 25) -> Column:
    return (freq > low) & (freq < high)


def case_or_default(word: Column, freq: Column, default: str = "not valid") -> Column:
    """The word where its frequency is in range, else the default; no row is lost."""
    return F.when(in_open_range(freq), word).otherwise(default)


def strict_case(word: Column, freq: Column, low: int = 3, high: int = 25) -> Column:
    """The word where its frequency is in range; any other row is an error."""
    shown = F.concat_ws(",", word, freq.cast("string"))
    failure = F.raise_error(F.concat(F.lit("no case for ("), shown, F.lit(")")))
    return F.when(in_open_range(freq, low, high), word).otherwise(failure)


def choose_by_number(num: Column, first: Column, second: Column, third: Column) -> Column:
    """First, second or third for 1, 2, 3; NULL for any other number."""
    return F.when(num == 1, first).when(num == 2, second).when(num == 3, third)


def typed_case(number: Column, text: Column, email: Column) -> Column:
    """Answer by the kind of value a row holds: a number, a text or an email struct."""
    # The answers.
    return (
        F.when(number == 1, "one")
        .when(text == "two", "2")
        .when(number.isNotNull(), "scala.Int")
        .when(email.isNotNull(), F.format_string("Email: subject = %s", email["subject"]))
        .otherwise("many")
    )


def default_if_any_null(default: Mapping[str, str], **parts: Column) -> Column:
    """A struct of the parts, or the whole default struct if any part is missing."""
    complete = F.lit(True)
    for part in parts.values():
        complete = complete & part.isNotNull()
    given = F.struct(*[part.alias(name) for name, part in parts.items()])
    fallback = F.struct(*[F.lit(default[name]).alias(name) for name in parts])
    return F.when(complete, given).otherwise(fallback)


def partner_hash(user_id: Column, partner: Column, salt: Column) -> Column:
    """A partner's encoding of a user id; a partner that needs a salt and has none is an error."""
    needed = F.coalesce(salt, F.raise_error(F.concat(F.lit("no salt for "), partner)).cast("string"))
    result = None
    for name, formats in PARTNER_FORMATS.items():
        before, after = [_salted(text, needed) for text in formats]
        encoded = F.concat(before, user_id.cast("string"), after)
        result = F.when(partner == name, encoded) if result is None else result.when(partner == name, encoded)
    return result.otherwise(F.raise_error(F.concat(F.lit("unknown partner "), partner)))


def _salted(text: str, salt: Column) -> Column:
    before, mark, after = text.partition("{salt}")
    return F.concat(F.lit(before), salt, F.lit(after)) if mark else F.lit(text)


def partner_sha(user_id: Column, salt: Column) -> Column:
    """A one-way encoding for real use: SHA-256 of salt and id."""
    return F.sha2(F.concat(salt, user_id.cast("string")), 256)


def hash_table_name(partner: Column) -> Column:
    """Name of the table a partner's ids are loaded into."""
    return F.concat(F.lit("Ingest_Hash_Table_"), partner)


def struct_update(record: Column, **changes: Column) -> Column:
    """A copy of a struct with some fields changed."""
    for name, value in changes.items():
        record = record.withField(name, value)
    return record
