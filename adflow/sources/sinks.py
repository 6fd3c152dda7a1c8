"""Sinks. Each writes one file per task; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from adflow.operators.pricing import (
    counted_headers,
    counted_messages,
    outcome_messages,
    price_statements,
    result_headers,
    result_lines,
)
from adflow.operators.rollups import outcome_counts
from adflow.sources.readers import java_charsets, line_of


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """All columns as tab-separated text without quoting."""
    df.select(line_of(*[F.col(c) for c in df.columns]).alias("value")).write.mode(mode).text(path)


def write_tsv_shards(df: DataFrame, path: str, shard: str) -> None:
    """A folder of tab-separated text for each value of a column, which is not written itself.

    A rebalancing exchange brings a shard's rows together and cuts a large shard
    into partitions of the advised size, so several tasks write it.
    """
    line = line_of(*[F.col(c) for c in df.columns if c != shard]).alias("value")
    df.select(line, shard).hint("rebalance", F.col(shard)).write.partitionBy(shard).text(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    df.write.mode(mode).csv(path, sep=sep)


def write_lines(
    df: DataFrame, line: Column, path: str, mode: str = "errorifexists", encoding: str = "UTF-8"
) -> None:
    """One line of text per row; any encoding that writes a line feed as one byte, such as GBK."""
    value = line.cast("string")
    if encoding.upper() in ("UTF-8", "UTF8"):
        lines = df.select(value.alias("value"))
    else:
        with java_charsets(df.sparkSession):
            lines = df.select(F.encode(value, encoding).cast("string").alias("value"))
    lines.write.mode(mode).text(path)


def write_counted(priced: DataFrame, path: str) -> DataFrame:
    """Write results as a table and give their counts by outcome, which the write itself has observed.

    One job writes and counts; nothing is read again. The counts are a table of
    one row, as ``status_counts`` gives them.
    """
    seen = Observation()
    priced.observe(seen, *outcome_counts()).write.mode("errorifexists").parquet(path)
    counts = seen.get
    return priced.sparkSession.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))


def write_results(priced: DataFrame, path: str) -> None:
    """Pricing results as text, added to a folder per status."""
    result_lines(priced).write.mode("append").partitionBy("status").text(path)


def write_result_headers(priced: DataFrame, path: str, counts: DataFrame | None = None) -> None:
    """Section headings with counts, added next to the results; from given counts if there are any."""
    headers = result_headers(priced) if counts is None else counted_headers(counts)
    headers = headers.select("status", F.col("header").alias("value"))
    headers.write.mode("append").partitionBy("status").text(path)


def write_outcome_messages(priced: DataFrame, path: str, counts: DataFrame | None = None) -> None:
    """The summary of outcomes as text, one line each; from given counts if there are any."""
    messages = outcome_messages(priced) if counts is None else counted_messages(counts)
    messages.select(F.col("message").alias("value")).write.mode("errorifexists").text(path)


def write_statements(priced: DataFrame, run_date: str, path: str, **tables: str) -> None:
    """One SQL statement per result as text."""
    statements = price_statements(priced, run_date, **tables)
    statements.select(F.col("statement").alias("value")).write.mode("errorifexists").text(path)


def preview(df: DataFrame, n: int = 20, *order: str | Column) -> DataFrame:
    """The first rows for a look at a result."""
    return (df.orderBy(*order) if order else df).limit(n)
