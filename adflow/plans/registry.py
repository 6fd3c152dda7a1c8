"""The registry of queries and the inputs they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adflow.functions.sizes import WIDTH_MASK, size_encode

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a key, with the SQL that gives the same rows where there is one."""

    def add(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a folder; its schema is read from the files once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def cents(column: str) -> Column:
    """Money as integer cents."""
    return F.rint(F.col(column) * 100).cast("bigint")


def text(*parts: str | Column) -> Column:
    """Parts joined to one text; a string is a literal."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def joined(array: Column) -> Column:
    """An array as comma-separated text."""
    return F.array_join(F.transform(array, lambda x: x.cast("string")), ",")


def draw_sql(key: str, seed: int) -> str:
    """SQL for ``functions.numbers.draw`` on non-negative keys."""
    m = 2147483647
    key = f"({key})::BIGINT"
    x = f"((({key} & {m}) + {(seed * 1013904223) % m}) & {m})"
    x = f"((xor({x}, {x} >> 16) * 2146121005) & {m})"
    x = f"xor({x}, ({key} >> 31) & {m})"
    x = f"((xor({x}, {x} >> 15) * 2221713035) & {m})"
    return f"xor({x}, {x} >> 16)"


# Ad statistics: line items as traffic of a supplier's domain, sized by part.
STATS_SQL = """stats AS (
  SELECT 's' || l_suppkey AS domain, l_linenumber AS dsp_id,
         CAST(l_quantity AS BIGINT) * 100 AS impression, CAST(l_quantity AS BIGINT) AS clk,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cost,
         (CAST(p_size AS BIGINT) * 2 << 32) | CAST(p_size AS BIGINT) AS size_code
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    size = text(F.col("p_size"), "*", F.col("p_size") * 2)
    sized = part.select("p_partkey", size_encode(size).alias("size_code"))
    return lineitem.join(sized, lineitem.l_partkey == sized.p_partkey).select(
        text("s", F.col("l_suppkey")).alias("domain"),
        F.col("l_linenumber").alias("dsp_id"),
        (F.col("l_quantity").cast("bigint") * 100).alias("impression"),
        F.col("l_quantity").cast("bigint").alias("clk"),
        cents("l_extendedprice").alias("cost"),
        "size_code",
    )


# Orders: each domain as a whole, each domain and size, and domains without traffic.
ORDERS_SQL = """asked AS (
  SELECT s_suppkey AS order_key, 'S-' || s_suppkey AS order_id, s_name AS ssp_name,
         's' || s_suppkey AS domain, CAST(0 AS BIGINT) AS size_code
  FROM supplier
  UNION ALL
  SELECT s_suppkey * 1000 + p_size, 'Z-' || s_suppkey || '-' || p_size, s_name,
         's' || s_suppkey, (CAST(p_size AS BIGINT) * 2 << 32) | CAST(p_size AS BIGINT)
  FROM supplier
  JOIN (SELECT DISTINCT l_suppkey, p_size FROM lineitem JOIN part ON l_partkey = p_partkey)
    ON s_suppkey = l_suppkey
  UNION ALL
  SELECT n_nationkey, 'N-' || n_nationkey, n_name, 'n' || n_nationkey,
         ((CAST(n_nationkey AS BIGINT) + 1) << 32) | 7
  FROM nation),
orders_in AS (
  SELECT *, 0 AS creative_styles, 88 AS dsp_id, 'DSP' AS dsp_name FROM asked)"""


def orders(spark: SparkSession, sf_dir: str, stats: DataFrame) -> DataFrame:
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    key = F.col("s_suppkey")
    sites = supplier.select("s_suppkey", F.col("s_name").alias("ssp_name"), text("s", key).alias("domain"))
    whole = sites.select(
        key.alias("order_key"),
        text("S-", key).alias("order_id"),
        "ssp_name",
        "domain",
        F.lit(0).cast("bigint").alias("size_code"),
    )
    size = F.col("size_code").bitwiseAND(F.lit(WIDTH_MASK).cast("bigint"))
    sized = sites.join(stats.select("domain", "size_code").distinct(), "domain").select(
        (key * 1000 + size).alias("order_key"),
        text("Z-", key, "-", size).alias("order_id"),
        "ssp_name",
        "domain",
        "size_code",
    )
    n = F.col("n_nationkey")
    unknown = nation.select(
        n.cast("bigint").alias("order_key"),
        text("N-", n).alias("order_id"),
        F.col("n_name").alias("ssp_name"),
        text("n", n).alias("domain"),
        size_encode(text("7*", n + 1)).alias("size_code"),
    )
    return (
        whole.unionByName(sized)
        .unionByName(unknown)
        .withColumns({"creative_styles": F.lit(0), "dsp_id": F.lit(88), "dsp_name": F.lit("DSP")})
    )


# Words of a text as ``clean_word_count`` cuts them: one row per word, counted.
def words_sql(source: str) -> str:
    return f"""raw_words AS (
  SELECT lower(trim(unnest(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]')), '.')) AS word FROM {source}),
word_counts AS (
  SELECT word, count(*) AS "count" FROM raw_words WHERE word <> '' GROUP BY word)"""
