"""Lookups and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adflow.functions.collections import add_to_all, zip_short
from adflow.functions.records import (
    CHANNELS,
    PARTNER_NAMESPACES,
    RESOURCE_TYPES,
    TRAFFIC_TYPES,
    code_to_literal,
    default_if_any_null,
    hash_table_name,
    partner_hash,
    partner_sha,
)
from adflow.operators import lookups
from adflow.operators.scans import zip_tables
from adflow.plans.filters import PEOPLE_SQL, people
from adflow.plans.registry import joined, query, table, text
from adflow.session import fresh_folder


@query(
    "lookup_default",
    """SELECT c_custkey, c_nationkey, coalesce(n_name, '-') AS n_name
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 1) ON c_nationkey = n_nationkey""",
)
def lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").where("n_regionkey <> 1")
    nations = nations.withColumnRenamed("n_nationkey", "c_nationkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return lookups.lookup(customers, nations, "c_nationkey", "n_name", F.lit("-"))


@query(
    "lookup_default_record",
    """SELECT s_suppkey, coalesce(n_name, 'John') AS "first", coalesce(r_name, 'Doe') AS "last"
FROM supplier LEFT JOIN (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA')
  ON s_nationkey = n_nationkey""",
)
def lookup_default_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    known = nation.join(region, nation.n_regionkey == region.r_regionkey).where("r_name <> 'ASIA'")
    names = [F.col("n_name").alias("first"), F.col("r_name").alias("last")]
    known = known.select(F.col("n_nationkey").alias("s_nationkey"), *names)
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    found = lookups.lookup_record(suppliers, known, "s_nationkey", {"first": "John", "last": "Doe"})
    return found.select("s_suppkey", "record.*")


@query(
    "default_if_any_null",
    f"""WITH {PEOPLE_SQL}
SELECT c_custkey, CASE WHEN "first" IS NULL OR "last" IS NULL THEN 'John' ELSE "first" END AS "first",
  CASE WHEN "first" IS NULL OR "last" IS NULL THEN 'Doe' ELSE "last" END AS "last" FROM people""",
)
def person_or_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    default = {"first": "John", "last": "Doe"}
    person = default_if_any_null(default, first=F.col("first"), last=F.col("last"))
    return people(spark, sf_dir).select("c_custkey", person.alias("person")).select("c_custkey", "person.*")


@query(
    "code_to_literal",
    """SELECT l_orderkey, l_linenumber,
  CASE l_linenumber WHEN 1 THEN 'NOVA' WHEN 4 THEN 'LU' WHEN 5 THEN 'PC-DSP' WHEN 6 THEN 'MDSP' WHEN 0 THEN '3rd-DSP'
    ELSE '-' END AS channel,
  CASE l_linenumber WHEN 1 THEN 'PC' WHEN 2 THEN 'WAP' WHEN 3 THEN 'APP' WHEN 4 THEN 'PC贴片' WHEN 5 THEN 'APP贴片'
    WHEN 0 THEN '未知' ELSE '-' END AS resource,
  CASE l_linenumber WHEN 1 THEN 'WEB' WHEN 2 THEN 'APP' ELSE '-' END AS traffic
FROM lineitem""",
)
def line_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        code_to_literal(code, CHANNELS).alias("channel"),
        code_to_literal(code, RESOURCE_TYPES).alias("resource"),
        code_to_literal(code, TRAFFIC_TYPES).alias("traffic"),
    )


@query(
    "lookup_distinct_keys",
    """SELECT o_orderkey, o_custkey, CASE o_custkey WHEN 42 THEN 'foo' WHEN 12 THEN 'bar' WHEN 1 THEN 'baz' END AS found
FROM orders""",
)
def lookup_distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.create_map(*[F.lit(x) for x in (42, "foo", 12, "bar", 1, "baz")])
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lookups.lookup_distinct(orders, "o_custkey", "found", F.try_element_at(known, F.col("o_custkey").cast("int")))


@query(
    "lookup_memo",
    """SELECT o_orderkey % 3 AS batch, o_orderkey, o_custkey, sha256(CAST(o_custkey AS VARCHAR)) AS found FROM orders""",
)
def lookup_memo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches with one memo: each finds the customers of the ones before in it."""
    memo = fresh_folder(spark, "memo")
    orders = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 3).alias("batch"), "o_orderkey", "o_custkey")
    expensive = F.sha2(F.col("o_custkey").cast("string"), 256)
    done = [lookups.memoized(orders.where(F.col("batch") == b), "o_custkey", "found", expensive, memo) for b in range(3)]
    return done[0].unionByName(done[1]).unionByName(done[2]).select("batch", "o_orderkey", "o_custkey", "found")


SALTED_SQL = """salted AS (
  SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Acxiom' WHEN 1 THEN 'Bluekai' ELSE 'Dummy' END AS partner,
         CASE c_custkey % 3 WHEN 0 THEN 'AC' WHEN 1 THEN 'CMP' ELSE '' END AS ns
  FROM customer),
with_salt AS (
  SELECT *, CASE ns WHEN 'AC' THEN 'NATION_0' WHEN 'CMP' THEN 'NATION_1' END AS hash_salt FROM salted)"""


def salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers dealt out to partners, with salts that are nation names."""
    turn = F.col("c_custkey") % 3
    partner = F.when(turn == 0, "Acxiom").when(turn == 1, "Bluekai").otherwise("Dummy")
    customers = table(spark, sf_dir, "customer").select("c_custkey", partner.alias("partner"))
    names = F.create_map(*[F.lit(x) for pair in PARTNER_NAMESPACES.items() for x in pair])
    customers = customers.withColumn("ns", F.try_element_at(names, F.col("partner")))
    key = F.col("n_nationkey")
    partners = table(spark, sf_dir, "nation").select(
        F.when(key == 0, "AC").when(key == 1, "CMP").otherwise(text("N", key)).alias("ns"),
        F.col("n_name").alias("hash_salt"),
    )
    return lookups.partner_salts(customers, partners)


@query("partner_config", f"WITH {SALTED_SQL} SELECT c_custkey, partner, ns, hash_salt FROM with_salt")
def partner_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return salted(spark, sf_dir)


@query(
    "partner_hash",
    f"""WITH {SALTED_SQL}, given AS (SELECT *, coalesce(hash_salt, 'nnnnn') AS salt FROM with_salt)
SELECT c_custkey, CASE partner WHEN 'Acxiom' THEN c_custkey || 'll' WHEN 'Bluekai' THEN salt || c_custkey || 'kk'
    ELSE c_custkey || '_' || salt || 'jj' END AS encoded,
  'Ingest_Hash_Table_' || partner AS table_name, sha256(salt || c_custkey) AS sha FROM given""",
)
def customer_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    salt = F.coalesce("hash_salt", F.lit("nnnnn"))
    return salted(spark, sf_dir).select(
        "c_custkey",
        partner_hash(F.col("c_custkey"), F.col("partner"), salt).alias("encoded"),
        hash_table_name(F.col("partner")).alias("table_name"),
        partner_sha(F.col("c_custkey"), salt).alias("sha"),
    )


@query(
    "favorite_movies",
    """SELECT o_custkey AS user_id, p_partkey AS movie_id, p_name AS title, p_partkey AS video_id
FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey""",
)
def favorite_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    favorites = orders.join(lines, orders.o_orderkey == lines.l_orderkey)
    favorites = favorites.select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("movie_id"))
    movies = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("movie_id"), F.col("p_name").alias("title"))
    found = lookups.favorite_movies(favorites, movies)
    return found.select("user_id", "movie.*", F.col("video.movie_id").alias("video_id"))


@query(
    "chained_lookup",
    """SELECT c_custkey AS user_id, o_orderkey AS movie_id, l_linenumber, l_quantity
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey""",
)
def chained_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    users, favorites, videos = (table(spark, sf_dir, name) for name in ("customer", "orders", "lineitem"))
    return lookups.favorite_videos(
        users.select(F.col("c_custkey").alias("user_id")),
        favorites.select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("movie_id")),
        videos.select(F.col("l_orderkey").alias("movie_id"), "l_linenumber", "l_quantity"),
    )


@query(
    "cross_sum",
    """SELECT l_orderkey, concat_ws(',', l_linenumber + l_partkey, l_linenumber + l_suppkey,
  CAST(l_quantity AS BIGINT) + l_partkey, CAST(l_quantity AS BIGINT) + l_suppkey) AS sums FROM lineitem""",
)
def cross_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = F.array(F.col("l_linenumber").cast("bigint"), F.col("l_quantity").cast("bigint"))
    sums = joined(add_to_all(left, F.array("l_partkey", "l_suppkey")))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", sums.alias("sums"))


@query(
    "null_propagating_sum",
    """SELECT c_custkey, CAST(c_custkey + CASE WHEN c_nationkey > 5 THEN c_nationkey END AS VARCHAR) AS total
FROM customer""",
)
def null_propagating_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(F.col("c_nationkey") > 5, F.col("c_nationkey"))
    total = (F.col("c_custkey") + part).cast("string")
    return table(spark, sf_dir, "customer").select("c_custkey", total.alias("total"))


@query(
    "zip_positional",
    """WITH a AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS "position", o_orderkey FROM orders),
b AS (SELECT row_number() OVER (ORDER BY ts, event_id) AS "position", event_id FROM events)
SELECT "position", o_orderkey, event_id FROM a JOIN b USING ("position")""",
)
def zip_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    events = table(spark, sf_dir, "events").select("ts", "event_id")
    return zip_tables(orders, events, ["o_orderkey"], ["ts", "event_id"]).drop("ts")


@query(
    "zip_arrays",
    """SELECT l_orderkey, l_linenumber || ':' || l_returnflag || ',' || l_suppkey || ':' || l_linestatus AS pairs
FROM lineitem""",
)
def zip_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = F.array(F.col("l_linenumber").cast("bigint"), "l_suppkey", "l_partkey")
    pairs = zip_short(numbers, F.array("l_returnflag", "l_linestatus"))
    shown = F.transform(pairs, lambda p: text(p["left"], ":", p["right"]))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", F.array_join(shown, ",").alias("pairs"))
