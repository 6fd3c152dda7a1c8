"""Sorting, limits and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adflow.operators import ordering
from adflow.operators.rollups import clean_word_count
from adflow.plans.registry import draw_sql, query, table, words_sql


@query("sort_asc", "SELECT p_name, p_partkey FROM part ORDER BY p_name, p_partkey")
def sort_asc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.sort_rows(table(spark, sf_dir, "part").select("p_name", "p_partkey"), "p_name", "p_partkey")


@query(
    "sort_multi",
    "SELECT c_mktsegment, c_nationkey, c_name FROM customer ORDER BY c_mktsegment, c_nationkey, c_name",
)
def sort_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["c_mktsegment", "c_nationkey", "c_name"]
    return ordering.sort_rows(table(spark, sf_dir, "customer").select(*names), *names)


@query("sort_desc", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ordering.sort_rows(orders, F.desc("o_totalprice"), "o_orderkey")


@query("sort_distinct", "SELECT DISTINCT l_quantity FROM lineitem ORDER BY l_quantity")
def sort_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.sort_distinct(table(spark, sf_dir, "lineitem"), "l_quantity")


@query("take_n", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5")
def take_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.take_n(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), 5, "o_orderkey")


@query("drop_n", "SELECT event_id, user_id FROM events ORDER BY ts, event_id OFFSET 5")
def drop_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("ts", "event_id", "user_id")
    return ordering.drop_n(events, 5, "ts", "event_id").drop("ts")


@query(
    "first_match",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000 ORDER BY o_orderkey LIMIT 1",
)
def first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ordering.first_match(orders, F.col("o_totalprice") > 300000, "o_orderkey")


@query(
    "shuffle_rows",
    f"SELECT o_orderkey, o_custkey FROM orders ORDER BY {draw_sql('o_orderkey', 3)}, o_orderkey",
)
def shuffle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.shuffle_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 3)


@query(
    "union_all",
    """SELECT s_name AS "name", s_nationkey AS nation FROM supplier
UNION ALL SELECT c_name, c_nationkey FROM customer UNION ALL SELECT n_name, n_nationkey FROM nation""",
)
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [("supplier", "s"), ("customer", "c"), ("nation", "n")]
    return ordering.union_all(
        *[
            table(spark, sf_dir, name).select(
                F.col(f"{p}_name").alias("name"), F.col(f"{p}_nationkey").alias("nation")
            )
            for name, p in parts
        ]
    )


@query(
    "set_difference",
    f"""WITH {words_sql('conversations')},
stop AS (SELECT lower(trim(unnest(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]')), '.')) AS word FROM benchmark)
SELECT word, "count" FROM word_counts WHERE word NOT IN (SELECT word FROM stop)""",
)
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    stop = clean_word_count(table(spark, sf_dir, "benchmark"), "text")
    counts = clean_word_count(table(spark, sf_dir, "conversations"), "text")
    return ordering.set_difference(counts, stop, "word")


@query("set_of_keys", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def set_of_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
