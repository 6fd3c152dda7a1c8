"""Readers of headerless text, with strict parsing or rejected rows kept apart."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adflow.functions.sizes import size_encode
from adflow.operators.filters import filter_valid_stats


@dataclass(frozen=True)
class Field:
    """A named field of a line: its position and type."""

    name: str
    position: int
    type: str


def _in_order(columns: str) -> list[Field]:
    """Fields from ``"name type, name type"``, numbered from 0."""
    pairs = [c.split() for c in columns.split(",")]
    return [Field(name, i, kind) for i, (name, kind) in enumerate(pairs)]


SALARY = _in_order("team string, name string, salary int, position string")
REPORT_LOG = _in_order("user_id int, plan_id int, group_id int, show int, clk int, cost int")
ORDERS = _in_order(
    "order_key bigint, order_id string, ssp_name string, domain string, "
    "creative_styles int, size_code bigint, dsp_id int, dsp_name string"
)
STATS = [
    Field("domain", 2, "string"),
    Field("dsp_id", 3, "int"),
    Field("impression", 4, "bigint"),
    Field("clk", 5, "bigint"),
    Field("cost", 6, "bigint"),
    Field("res_type", 7, "int"),
    Field("size", 8, "string"),
]
SSP = [
    Field("tu", 0, "bigint"),
    Field("domain", 3, "string"),
    Field("spv", 5, "int"),
    Field("clk", 6, "int"),
    Field("price", 7, "double"),
]


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view of the catalog."""
    return spark.table(name)


@contextmanager
def java_charsets(spark: SparkSession) -> Iterator[None]:
    """Let expressions that are built inside use any charset of the JVM, such as GBK."""
    setting = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def read_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Text files as one row per line, column ``value``.

    The text source keeps the bytes of a line as they are, so other encodings
    are decoded from them. This fits all encodings that write a line feed as
    one byte and use that byte for nothing else, as GBK does.
    """
    lines = spark.read.text(path)
    if encoding.upper() in ("UTF-8", "UTF8"):
        return lines
    with java_charsets(spark):
        return lines.select(F.decode(F.col("value").cast("binary"), encoding).alias("value"))


def parse_lines(
    lines: DataFrame,
    fields: Sequence[Field],
    sep: str = "\t",
    count: int | None = None,
    strict: bool = False,
    trim_end: bool = False,
) -> DataFrame:
    """Lines cut into typed fields, with ``_line`` and ``_ok`` added.

    A row is fine if every field is present and has its type, and, with
    ``count``, if the line has exactly that many fields; further fields are
    ignored otherwise. ``strict`` makes a bad row an error. ``trim_end`` leaves
    out white space at the end of a line before it is cut.
    """
    text = F.regexp_replace("value", r"\s+$", "") if trim_end else F.col("value")
    cut = lines.select(F.col("value").alias("_line"), F.split(text, sep).alias("_cut"))
    # One struct, taken apart by a generator: a filter on its fields stays above it, so that a line
    # is cut once and not again for each field that the filter names. A line with another number of
    # fields is bad whatever these hold; they stay NULL, as a cast that fails takes far longer.
    whole = F.lit(True) if count is None else F.size("_cut") == count
    values = [F.when(whole, F.get("_cut", f.position).try_cast(f.type)).alias(f.name) for f in fields]
    parsed = cut.select("_line", F.inline(F.array(F.struct(whole.alias("_whole"), *values))))
    ok = F.col("_whole")
    for f in fields:
        ok = ok & F.col(f.name).isNotNull()
    if strict:
        ok = ok | F.raise_error(F.concat(F.lit("bad line: "), F.col("_line"))).cast("boolean")
    return parsed.withColumn("_ok", ok).drop("_whole")


def read_delimited(
    spark: SparkSession,
    path: str,
    fields: Sequence[Field],
    sep: str = "\t",
    encoding: str = "UTF-8",
    count: int | None = None,
    trim_end: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected lines with nothing lost."""
    parsed = parse_lines(read_lines(spark, path, encoding), fields, sep, count, trim_end=trim_end)
    good = parsed.where("_ok").drop("_ok", "_line")
    return good, parsed.where("not _ok").select("_line")


def read_strict(
    spark: SparkSession, path: str, fields: Sequence[Field], sep: str = "\t", encoding: str = "UTF-8"
) -> DataFrame:
    """Typed rows; one bad line fails the job."""
    parsed = parse_lines(read_lines(spark, path, encoding), fields, sep, strict=True)
    return parsed.where("_ok").drop("_ok", "_line")


def read_stats(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Ad statistics with encoded sizes; rows without impressions, or more clicks than that, are left out."""
    stats = read_strict(spark, path, STATS, encoding=encoding)
    return filter_valid_stats(stats.withColumn("size_code", size_encode(F.col("size"))).drop("size"))


def read_orders(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    return read_strict(spark, path, ORDERS, encoding=encoding)


def read_ssp(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Supply-side rows of exactly 8 fields, cost in truncated cents, and rejected lines.

    White space at the end of a line is no field. Costs beyond the range of an
    int are cut to its ends; a price that is no number costs 0.
    """
    good, rejected = read_delimited(spark, path, SSP, sep=r"\s+", count=8, trim_end=True)
    cents = F.least(F.greatest(F.col("price") * 100, F.lit(-2147483648.0)), F.lit(2147483647.0))
    cost = F.when(F.isnan("price"), 0).otherwise(cents.cast("int"))
    return good.withColumn("cost", cost).drop("price"), rejected


def read_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Size texts with their codes."""
    return read_lines(spark, path).select(
        F.col("value").alias("size"), size_encode(F.col("value")).alias("size_code")
    )


def tokens_to_ints(lines: DataFrame) -> DataFrame:
    """All white-space separated tokens as ints; a token that is none fails the job, a blank line has none."""
    token = F.explode(F.filter(F.split("value", r"\s+"), lambda t: t != "")).alias("token")
    number = F.col("token").try_cast("int")
    failure = F.raise_error(F.concat(F.lit("not a number: "), F.col("token"))).cast("int")
    return lines.select(token).select(F.coalesce(number, failure).alias("number"))


def count_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).agg(F.count(F.lit(1)).alias("lines"))


def file_prefix(spark: SparkSession, path: str, n: int = 10, unreadable: str = "raise") -> DataFrame:
    """Path, length and first bytes of each file below a path; no more than these bytes are read.

    A file shorter than ``n`` gives all it has. Files without any bytes are left
    out by Spark's listing, and a folder without files gives no rows. A file that cannot be opened, or is gone when
    its turn comes, is an error that names it; with ``unreadable="null"`` one that
    cannot be opened has a NULL prefix, and one that is gone no row.

    Spark's own binary source reads whole files, so each file is opened in the
    task instead, by the file system that its address names.
    """
    if unreadable not in ("raise", "null"):
        raise ValueError(f"unreadable is raise or null, not {unreadable}")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = listed.option("ignoreMissingFiles", str(unreadable == "null").lower()).load(path)

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        def head(path: str) -> bytes | None:
            scheme, _, rest = path.partition(":")
            rest = rest if rest.startswith("//") else f"//{rest}"
            scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
            try:
                system, name = fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@=')}")
                with system.open_input_file(name) as stream:
                    return stream.read(n)
            except OSError as error:
                if unreadable == "raise":
                    raise OSError(f"cannot read {path}: {error}") from error
                return None

        for batch in batches:
            yield batch.assign(prefix=[head(path) for path in batch["path"]])

    return files.select("path", "length").mapInPandas(heads, "path string, length bigint, prefix binary")


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table from rows in the program."""
    return spark.createDataFrame(list(rows), schema)


def line_of(*columns: Column, sep: str = "\t") -> Column:
    """Columns joined to one line of text; NULL becomes an empty field."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
