"""Aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adflow.functions.numbers import percent_discount
from adflow.operators import rollups
from adflow.operators.machines import run_machine
from adflow.operators.ordering import deal_shards, shard_by_modulo, sort_rows
from adflow.operators.sequences import ledger_total, running_valid, validate_transitions
from adflow.plans.files import LOG_SQL, report_log

from adflow.plans.registry import STATS_SQL, cents, query, stats, table, text, words_sql


@query(
    "tpch_q1",
    """WITH l AS (
  SELECT l_returnflag, l_linestatus, CAST(l_quantity AS DECIMAL(12,2)) AS q, CAST(l_extendedprice AS DECIMAL(12,2)) AS p,
         CAST(l_discount AS DECIMAL(4,2)) AS d, CAST(l_tax AS DECIMAL(4,2)) AS t
  FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-16')
SELECT l_returnflag, l_linestatus,
  CAST(sum(q) AS DOUBLE) AS sum_qty,
  CAST(sum(p) AS DOUBLE) AS sum_base_price,
  CAST(sum(p * (1 - d)) AS DOUBLE) AS sum_disc_price,
  CAST(sum(p * (1 - d) * (1 + t)) AS DOUBLE) AS sum_charge,
  CAST(sum(q) AS DOUBLE) / count(*) AS avg_qty,
  CAST(sum(p) AS DOUBLE) / count(*) AS avg_price,
  CAST(sum(d) AS DOUBLE) / count(*) AS avg_disc,
  count(*) AS count_order
FROM l GROUP BY ALL ORDER BY ALL""",
)
def tpch_q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.pricing_summary(table(spark, sf_dir, "lineitem"))


@query(
    "avg_by_group",
    """SELECT c_nationkey AS team, round(CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) / count(*), 4) AS avg_salary
FROM customer GROUP BY ALL""",
)
def avg_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    salaries = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("team"), F.col("c_acctbal").cast("decimal(12,2)").alias("salary")
    )
    means = rollups.avg_by_group(salaries, "team", "salary")
    return means.select("team", F.round(F.col("avg_salary").cast("double"), 4).alias("avg_salary"))


@query(
    "report_log_rollup",
    f"""WITH log AS ({LOG_SQL})
SELECT user_id, plan_id, group_id, CAST(sum("show") AS BIGINT) AS "show", CAST(sum(clk) AS BIGINT) AS clk,
  CAST(sum(cost) AS BIGINT) AS cost FROM log GROUP BY ALL""",
)
def report_log_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = report_log(spark, sf_dir).withColumns(
        {"user_id": F.col("user_id").cast("int"), "group_id": F.col("group_id").cast("int")}
    )
    return rollups.rollup(log, ["user_id", "plan_id", "group_id"], ["show", "clk", "cost"])


@query(
    "shard_by_modulo",
    f"""WITH log AS ({LOG_SQL})
SELECT user_id, plan_id, group_id, CAST(sum("show") AS BIGINT) AS "show", CAST(sum(clk) AS BIGINT) AS clk,
  CAST(sum(cost) AS BIGINT) AS cost, group_id % 10 AS shard FROM log GROUP BY ALL""",
)
def log_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_modulo(report_log_rollup(spark, sf_dir), "group_id", 10)


@query(
    "shard_partitions",
    f"""WITH log AS ({LOG_SQL}), sums AS (SELECT DISTINCT user_id, plan_id, group_id FROM log),
sizes AS (SELECT group_id % 10 AS shard, count(*) AS "rows" FROM sums GROUP BY ALL)
SELECT shard, "rows", CAST(1 AS BIGINT) AS shards_met, CAST(ceil("rows" / 400.0) AS BIGINT) AS parts FROM sizes""",
)
def log_shard_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many partitions each shard is dealt to, and how many shards its partitions hold."""
    dealt = deal_shards(log_shards(spark, sf_dir), "shard", rows_per_part=400)
    # The partitions are as many as the rows ask for; a task counts many of them, each under its own
    # number, as every task sends its metrics to the driver.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = dealt.select("shard", F.spark_partition_id().alias("part")).coalesce(tasks)
    held = parts.groupBy("part", "shard").agg(F.count(F.lit(1)).alias("rows"))
    met = held.withColumn("shards_met", F.count(F.lit(1)).over(Window.partitionBy("part")))
    return met.groupBy("shard").agg(
        F.sum("rows").alias("rows"), F.max("shards_met").alias("shards_met"), F.count_distinct("part").alias("parts")
    )


@query(
    "rollup_by_group",
    f"""WITH log AS ({LOG_SQL})
SELECT group_id, min(user_id) AS user_id, min(plan_id) AS plan_id, CAST(sum("show") AS BIGINT) AS "show",
  CAST(sum(clk) AS BIGINT) AS clk, CAST(sum(cost) AS BIGINT) AS cost FROM log GROUP BY ALL""",
)
def rollup_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = report_log(spark, sf_dir).withColumns(
        {"user_id": F.col("user_id").cast("int"), "group_id": F.col("group_id").cast("int")}
    )
    return rollups.rollup_by_group(log, "group_id", ["show", "clk", "cost"], ["user_id", "plan_id"])


@query("word_count_clean", f"""WITH {words_sql('documents')} SELECT word, "count" FROM word_counts WHERE word <> 'the'""")
def word_count_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sort_rows(rollups.clean_word_count(table(spark, sf_dir, "documents"), "text", ["the"]), "word")


GRADED_SQL = "(l_quantity / 10) AS grade"


@query(
    "grade_histogram",
    f"""WITH g AS (SELECT {GRADED_SQL} FROM lineitem),
l AS (SELECT CASE WHEN grade > 4 AND grade <= 5 THEN 'A' WHEN grade > 3 AND grade <= 4 THEN 'B'
  WHEN grade > 2 AND grade <= 3 THEN 'C' WHEN grade > 0 AND grade <= 2 THEN 'D' WHEN grade = 0 THEN 'F'
  ELSE 'N/A' END AS letter FROM g)
SELECT letter, count(*) AS "count",
  repeat('*', CAST(ceil(count(*) * 60::DOUBLE / max(count(*)) OVER ()) AS INTEGER)) AS bar FROM l GROUP BY letter""",
)
def grade_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    grades = table(spark, sf_dir, "lineitem").select((F.col("l_quantity") / 10).alias("grade"))
    return rollups.grade_histogram(grades, "grade", width=60)


@query(
    "filter_map_reduce",
    """SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.10 AS DECIMAL(3,2))) AS DOUBLE) AS discount
FROM lineitem WHERE l_extendedprice >= 20000""",
)
def filter_map_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    total = rollups.discount_total(table(spark, sf_dir, "lineitem"), price, 20000)
    return total.select(F.col("discount").cast("double").alias("discount"))


@query(
    "sum_or_zero",
    """SELECT 'all' AS "rows", CAST(coalesce(sum(l_linenumber), 0) AS BIGINT) AS total FROM lineitem
UNION ALL SELECT 'none', CAST(coalesce(sum(l_linenumber), 0) AS BIGINT) FROM lineitem WHERE l_quantity < 0""",
)
def sum_or_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    every = rollups.sum_or_zero(lines, "l_linenumber").withColumn("rows", F.lit("all"))
    none = rollups.sum_or_zero(lines.where("l_quantity < 0"), "l_linenumber")
    return every.unionByName(none.withColumn("rows", F.lit("none")))


@query("max_strict", "SELECT max(o_totalprice) AS maximum FROM orders")
def max_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.maximum(table(spark, sf_dir, "orders"), "o_totalprice")


@query(
    "filtered_sum",
    "SELECT CAST(sum(length(text)) AS BIGINT) AS total FROM conversations WHERE role = 'assistant'",
)
def filtered_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return rollups.filtered_sum(turns, F.col("role") == "assistant", F.length("text"))


@query(
    "collect_by_store",
    """SELECT o_custkey AS store, o_orderkey // 5000 AS chunk,
  string_agg(o_orderkey || ':' || o_orderstatus, ',' ORDER BY o_orderkey DESC) AS purchases
FROM orders GROUP BY ALL""",
)
def collect_by_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "store")
    lists = rollups.collect_chunks(orders, "store", "o_orderkey", {"status": F.col("o_orderstatus")}, width=5000)
    shown = F.transform("rows", lambda r: text(r["o_orderkey"], ":", r["status"]))
    return lists.select("store", "chunk", F.array_join(shown, ",").alias("purchases"))


@query(
    "ledger_total",
    """SELECT event_id, user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (
    PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_total FROM events""",
)
def event_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", cents("value").alias("amount"))
    ledger = ledger_total(events, ["user_id"], ["ts", "event_id"], F.col("amount"))
    return ledger.select("event_id", "user_id", "running_total")


@query(
    "running_valid",
    """SELECT event_id, event_type = 'purchase' AS valid, CAST(count(*) FILTER (event_type = 'purchase') OVER (
    PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS valid_so_far FROM events""",
)
def valid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    valid = F.col("event_type") == "purchase"
    return running_valid(events, ["user_id"], ["ts", "event_id"], valid).select("event_id", "valid", "valid_so_far")


# Event types as phase changes; a user's events are judged as one walk from solid.
WALK = {"view": "Melting", "click": "Vaporization", "purchase": "Freezing", "signup": "Condensation"}


@query(
    "validate_transitions",
    """WITH steps AS (
  SELECT user_id, event_id, ts,
    CASE event_type WHEN 'view' THEN 'solid' WHEN 'click' THEN 'liquid' WHEN 'purchase' THEN 'liquid'
      WHEN 'signup' THEN 'vapor' ELSE 'solid' END AS source,
    CASE event_type WHEN 'view' THEN 'liquid' WHEN 'click' THEN 'vapor' WHEN 'purchase' THEN 'solid'
      WHEN 'signup' THEN 'liquid' ELSE 'vapor' END AS target
  FROM events),
judged AS (
  SELECT user_id, event_id, ts,
    source = coalesce(lag(target) OVER (PARTITION BY user_id ORDER BY ts, event_id), 'solid') AS legal FROM steps)
SELECT user_id, bool_and(legal) AS valid,
  CAST(coalesce(arg_min(event_id, ts) FILTER (NOT legal), -1) AS BIGINT) AS first_bad_event
FROM judged GROUP BY user_id""",
)
def event_walks(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in WALK.items() for x in pair])
    phase = F.coalesce(F.try_element_at(names, F.col("event_type")), F.lit("Sublimation"))
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", phase.alias("phase"))
    checked = validate_transitions(events, "user_id", ["ts", "event_id"], "phase", start="solid")
    first_bad = F.coalesce("first_bad.event_id", F.lit(-1)).alias("first_bad_event")
    return checked.select("user_id", "valid", first_bad)


@query("distinct_rows", f"WITH {STATS_SQL} SELECT DISTINCT domain, size_code FROM stats")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats(spark, sf_dir).select("domain", "size_code").distinct()


def exact(amount: Column) -> Column:
    return amount.cast("decimal(18,4)")


@query(
    "discounted_total",
    """SELECT CAST(sum(CAST(l_extendedprice - l_extendedprice * 25::DOUBLE * 0.01::DOUBLE AS DECIMAL(18,4))) AS DOUBLE)
  AS total FROM lineitem""",
)
def discounted_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    reduced = exact(percent_discount(F.col("l_extendedprice"), 25))
    total = rollups.discounted_total(table(spark, sf_dir, "lineitem"), reduced)
    return total.select(F.col("total").cast("double").alias("total"))


# A visitor's session as a machine; most events are allowed from several states.
SESSION = {
    "signup": {"new": "member", "browsing": "member"},
    "view": {"new": "browsing", "browsing": "browsing", "member": "browsing", "engaged": "browsing", "bought": "browsing"},
    "click": {"browsing": "engaged", "engaged": "engaged", "member": "engaged", "bought": "engaged"},
    "purchase": {"engaged": "bought", "member": "bought", "browsing": "bought"},
    "error": {"new": "new", "browsing": "new", "engaged": "browsing", "member": "member"},
}
_MOVES_SQL = ", ".join(f"('{e}', '{a}', '{b}')" for e, moves in SESSION.items() for a, b in moves.items())


@query(
    "machine_walks",
    f"""WITH RECURSIVE moves AS (SELECT * FROM (VALUES {_MOVES_SQL}) AS m(event_type, before, after)),
steps AS (
  SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place,
         count(*) OVER (PARTITION BY user_id) AS n FROM events),
walk AS (
  SELECT user_id, CAST(0 AS BIGINT) AS place, 'new' AS state, n, CAST(-1 AS BIGINT) AS bad FROM steps WHERE place = 1
  UNION ALL
  SELECT w.user_id, s.place, m.after, w.n, CASE WHEN m.after IS NULL THEN s.event_id ELSE -1 END
  FROM walk w JOIN steps s ON s.user_id = w.user_id AND s.place = w.place + 1
  LEFT JOIN moves m ON m.event_type = s.event_type AND m.before = w.state
  WHERE w.state IS NOT NULL)
SELECT user_id, state IS NOT NULL AS valid, coalesce(state, '-') AS end_state, bad AS first_bad_event
FROM walk WHERE state IS NULL OR place = n""",
)
def machine_walks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    walked = run_machine(events, "user_id", ["ts", "event_id"], "event_type", SESSION, start="new")
    return walked.select(
        "user_id",
        "valid",
        F.coalesce("end_state", F.lit("-")).alias("end_state"),
        F.coalesce("first_bad.event_id", F.lit(-1)).alias("first_bad_event"),
    )
