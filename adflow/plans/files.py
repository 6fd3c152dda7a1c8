"""Scans, parsers, generators and sinks. Text inputs are written from the tables and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adflow.functions.records import RESOURCE_TYPES, code_to_literal
from adflow.operators.ordering import spread
from adflow.operators.rollups import rollup
from adflow.operators.sequences import contiguous_prefix
from adflow.plans.registry import cents, draw_sql, query, table, text
from adflow.session import fresh_folder
from adflow.sources import generators, readers, sinks


def written(spark: SparkSession, df: DataFrame, label: str) -> str:
    """Write a table as tab-separated text to a fresh folder."""
    path = fresh_folder(spark, label)
    sinks.write_tsv(df, path)
    return path


@query(
    "scan_table",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag FROM lineitem",
)
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = "l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_returnflag".split()
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("scanned_lineitem")
    return readers.scan_table(spark, "scanned_lineitem").select(*columns)


def salaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        text("team ", F.col("c_nationkey")).alias("team"),
        F.col("c_name").alias("name"),
        cents("c_acctbal").cast("int").alias("salary"),
        F.col("c_mktsegment").alias("position"),
    )


@query(
    "scan_delimited",
    """SELECT 'team ' || c_nationkey AS team, c_name AS "name", CAST(round(c_acctbal * 100) AS INTEGER) AS salary,
         c_mktsegment AS "position" FROM customer""",
)
def scan_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = written(spark, salaries(spark, sf_dir), "salary")
    return readers.read_strict(spark, path, readers.SALARY)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = text(F.col("o_orderkey"), " ", F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select(line.alias("value"))


ORDER_LINE = "o_orderkey || ' ' || o_orderpriority"


@query("scan_text", f'SELECT {ORDER_LINE} AS "value" FROM orders')
def scan_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "lines")
    sinks.write_lines(order_lines(spark, sf_dir), F.col("value"), path)
    return readers.read_lines(spark, path)


@query("sink_text_lines", f'SELECT count(*) AS "lines", count(DISTINCT {ORDER_LINE}) AS distinct_lines FROM orders')
def sink_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "lines")
    sinks.write_lines(order_lines(spark, sf_dir), F.col("value"), path)
    count = F.count(F.lit(1)).alias("lines")
    return readers.read_lines(spark, path).agg(count, F.count_distinct("value").alias("distinct_lines"))


def report_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as an ad log, with a seventh field that the parser ignores."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("user_id"),
        F.col("l_linenumber").alias("plan_id"),
        F.col("l_partkey").alias("group_id"),
        F.col("l_quantity").cast("int").alias("show"),
        F.lit(1).alias("clk"),
        cents("l_extendedprice").alias("cost"),
        "l_returnflag",
    )


LOG_SQL = """SELECT CAST(l_suppkey AS INTEGER) AS user_id, l_linenumber AS plan_id,
  CAST(l_partkey AS INTEGER) AS group_id, CAST(l_quantity AS INTEGER) AS "show", 1 AS clk,
  CAST(round(l_extendedprice * 100) AS INTEGER) AS cost FROM lineitem"""


@query("parse_report_log", LOG_SQL)
def parse_report_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = written(spark, report_log(spark, sf_dir), "report-log")
    return readers.read_strict(spark, path, readers.REPORT_LOG)


@query(
    "sink_tsv",
    f"""WITH log AS ({LOG_SQL})
SELECT user_id, plan_id, group_id, CAST(sum("show") AS BIGINT) AS "show", CAST(sum(clk) AS BIGINT) AS clk,
  CAST(sum(cost) AS BIGINT) AS cost FROM log GROUP BY ALL""",
)
def sink_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "rollup")
    keys, sums = ["user_id", "plan_id", "group_id"], ["show", "clk", "cost"]
    sinks.write_csv(rollup(report_log(spark, sf_dir), keys, sums), path, sep="\t")
    schema = "user_id int, plan_id int, group_id int, show bigint, clk bigint, cost bigint"
    return spark.read.csv(path, schema=schema, sep="\t", mode="FAILFAST")


@query(
    "parse_tu_stat",
    """SELECT 's' || l_suppkey || '.com' AS "domain", l_linenumber AS dsp_id,
  (CAST(l_quantity AS BIGINT) - 5) * 100 AS impression, CAST(l_quantity AS BIGINT) * 10 AS clk,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS cost, 1 AS res_type,
  CASE WHEN l_returnflag = 'N' THEN 0 ELSE (CAST(l_linenumber AS BIGINT) * 10 << 32) | l_suppkey END AS size_code
FROM lineitem
WHERE (CAST(l_quantity AS BIGINT) - 5) * 100 > 0
  AND (CAST(l_quantity AS BIGINT) - 5) * 100 >= CAST(l_quantity AS BIGINT) * 10""",
)
def parse_tu_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("bigint")
    size = text(F.col("l_suppkey"), "*", F.col("l_linenumber") * 10)
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.lit("9223372036854775807").alias("tu"),
        text("s", F.col("l_suppkey"), ".com").alias("domain"),
        "l_linenumber",
        (quantity - 5) * 100,
        quantity * 10,
        cents("l_extendedprice"),
        F.lit(1),
        F.when(F.col("l_returnflag") == "N", "0").otherwise(size).alias("size"),
    )
    return readers.read_stats(spark, written(spark, lines, "stats"))


@query(
    "parse_orders",
    """SELECT o_orderkey AS order_key, 'PDBS-' || o_orderkey AS order_id, o_orderpriority AS ssp_name,
  'c' || o_custkey || '.com' AS "domain", 0 AS creative_styles, o_custkey AS size_code, 88 AS dsp_id,
  o_orderstatus AS dsp_name FROM orders""",
)
def parse_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text("PDBS-", F.col("o_orderkey")).alias("id"),
        "o_orderpriority",
        text("c", F.col("o_custkey"), ".com").alias("domain"),
        F.lit(0).alias("styles"),
        "o_custkey",
        F.lit(88).alias("dsp"),
        "o_orderstatus",
    )
    return readers.read_orders(spark, written(spark, lines, "orders"))


def ssp_folder(spark: SparkSession, sf_dir: str) -> str:
    """Supply-side lines with blanks of any kind, also at their end; open lines lack a field and must be rejected.

    Returned goods cost more than an int can hold in cents.
    """
    fields = [
        F.col("l_suppkey"),
        F.lit("  x\t"),
        F.lit("y "),
        text("s", F.col("l_partkey")),
        F.lit("\tz"),
        F.col("l_linenumber"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity").cast("int").cast("string")).otherwise(""),
        F.when(F.col("l_returnflag") == "R", "30000000.5").otherwise(F.col("l_extendedprice").cast("string")),
    ]
    line = F.concat(F.concat_ws(" ", *[f.cast("string") for f in fields]), F.lit(" \t"))
    path = fresh_folder(spark, "ssp")
    sinks.write_lines(table(spark, sf_dir, "lineitem"), line, path)
    return path


SSP_SQL = """ssp AS (
  SELECT l_suppkey AS tu, 's' || l_partkey AS "domain", l_linenumber AS spv, CAST(l_quantity AS INTEGER) AS clk,
         CASE WHEN l_returnflag = 'R' THEN 2147483647 ELSE CAST(trunc(l_extendedprice * 100) AS INTEGER) END AS cost
  FROM lineitem WHERE l_linestatus = 'F')"""


@query(
    "parse_ssp",
    f"""WITH {SSP_SQL}
SELECT false AS rejected, concat_ws('|', tu, "domain", spv, clk, cost) AS "row" FROM ssp
UNION ALL
SELECT true, l_suppkey || '   x' || chr(9) || ' y  s' || l_partkey || ' ' || chr(9) || 'z ' || l_linenumber
  || '  ' || CASE WHEN l_returnflag = 'R' THEN '30000000.5' ELSE CAST(l_extendedprice AS VARCHAR) END
  || ' ' || chr(9) FROM lineitem WHERE l_linestatus <> 'F'""",
)
def parse_ssp(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, rejected = readers.read_ssp(spark, ssp_folder(spark, sf_dir))
    row = F.concat_ws("|", *[F.col(c).cast("string") for c in ("tu", "domain", "spv", "clk", "cost")])
    good = good.select(F.lit(False).alias("rejected"), row.alias("row"))
    return good.unionByName(rejected.select(F.lit(True).alias("rejected"), F.col("_line").alias("row")))


@query(
    "ssp_rollup",
    f"""WITH {SSP_SQL}
SELECT tu, "domain", CAST(sum(spv) AS BIGINT) AS spv, CAST(sum(clk) AS BIGINT) AS clk,
  CAST(sum(cost) AS BIGINT) AS cost FROM ssp GROUP BY ALL""",
)
def ssp_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = readers.read_ssp(spark, ssp_folder(spark, sf_dir))
    return rollup(good, ["tu", "domain"], ["spv", "clk", "cost"])


@query(
    "scan_encoded",
    """SELECT l_orderkey || ' ' || CASE l_linenumber WHEN 1 THEN 'PC' WHEN 2 THEN 'WAP' WHEN 3 THEN 'APP'
  WHEN 4 THEN 'PC贴片' WHEN 5 THEN 'APP贴片' ELSE '-' END AS "value" FROM lineitem WHERE l_quantity > 25""",
)
def scan_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = code_to_literal(F.col("l_linenumber"), RESOURCE_TYPES)
    line = text(F.col("l_orderkey"), " ", name, "\t", F.col("l_quantity").cast("int"))
    path = fresh_folder(spark, "gbk")
    sinks.write_lines(table(spark, sf_dir, "lineitem"), line, path, encoding="GBK")
    fields = [readers.Field("value", 0, "string"), readers.Field("quantity", 1, "int")]
    kept = readers.read_strict(spark, path, fields, encoding="GBK").where("quantity > 25")
    return kept.select("value")


@query(
    "tokens_to_ints",
    """SELECT CAST(unnest([l_partkey, l_suppkey, l_linenumber]) AS INTEGER) AS "number" FROM lineitem""",
)
def tokens_to_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "tokens")
    # Lines with blanks at either end, and a blank line after each.
    line = text("\t", F.col("l_partkey"), " \t ", F.col("l_suppkey"), " ", F.col("l_linenumber"), " \n \t")
    sinks.write_lines(table(spark, sf_dir, "lineitem"), line, path)
    return readers.tokens_to_ints(readers.read_lines(spark, path))


@query("count_lines", 'SELECT count(*) AS "lines" FROM orders')
def count_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "lines")
    sinks.write_lines(order_lines(spark, sf_dir), F.col("value"), path)
    return readers.count_lines(spark, path)


@query(
    "file_prefix_bytes",
    "SELECT DISTINCT o_orderpriority AS kind, rpad(o_orderpriority, 10, '.')[1:10] AS prefix FROM orders",
)
def file_prefix_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    line = text(F.rpad(priority, 10, "."), " ", F.col("o_orderkey"))
    path = fresh_folder(spark, "prefixes")
    lines = table(spark, sf_dir, "orders").select(priority.alias("kind"), line.alias("value"))
    # One file for each kind, so that a file that is lost or read twice shows.
    lines.repartition("kind").write.partitionBy("kind").text(path)
    heads = readers.file_prefix(spark, path, 10)
    kind = F.regexp_replace(F.regexp_extract("path", "kind=([^/]*)/", 1), "%20", " ")
    return heads.select(kind.alias("kind"), F.decode("prefix", "UTF-8").alias("prefix"))


PRIORITIES = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5)]


@query(
    "literal_table",
    """SELECT o_orderkey, "rank" FROM orders JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3),
  ('4-NOT SPECIFIED', 4), ('5-LOW', 5)) AS p(o_orderpriority, "rank") USING (o_orderpriority)""",
)
def literal_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = readers.literal_table(spark, PRIORITIES, "o_orderpriority string, rank int")
    return table(spark, sf_dir, "orders").join(ranks, "o_orderpriority").select("o_orderkey", "rank")


@query("parallelize", "SELECT c_custkey, c_name FROM customer")
def parallelize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), 8)


@query(
    "range_source",
    "SELECT unnest(range(lo, hi + 1, 2)) AS id FROM (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders)",
)
def range_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = table(spark, sf_dir, "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return generators.integers(spark, ends[0], ends[1] + 1, 2)


@query("random_source", f"SELECT o_orderkey, {draw_sql('o_orderkey', 7)} AS random FROM orders")
def random_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generators.random_integers(table(spark, sf_dir, "orders"), "o_orderkey", 7)


@query(
    "gen_report_log",
    f"""WITH ids AS (SELECT o_orderkey + 1 AS i, unnest(range(10))::INTEGER AS batch FROM orders)
SELECT batch, i // 100 + 1 AS user_id, i // 10 + 1 AS plan_id, i AS group_id,
  100 + {draw_sql('i * 10 + batch', 1)} % 1000 AS "show", {draw_sql('i * 10 + batch', 2)} % 100 AS clk,
  {draw_sql('i * 10 + batch', 3)} % 100 AS cost FROM ids""",
)
def gen_report_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("i"))
    return generators.report_log(ids, "i", batches=10)


@query(
    "gen_purchases",
    f"""SELECT event_id, {draw_sql('event_id', 1)} % 100 AS store_number,
  {draw_sql('event_id', 2)} % 1000 AS customer_number, {draw_sql('event_id', 3)} % 500 AS item_number FROM events""",
)
def gen_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generators.purchases(table(spark, sf_dir, "events"), "event_id")


# Line items as pages of their supplier's book; parts leave gaps, one book has no name.
PAGES_SQL = """pages AS (
  SELECT l_orderkey, l_linenumber, nullif('b' || l_suppkey, 'b1') AS book, l_partkey % 200 + 1 AS page FROM lineitem),
there AS (SELECT DISTINCT book, page FROM pages),
runs AS (SELECT book, page, page - row_number() OVER (PARTITION BY book ORDER BY page) AS gap FROM there),
prefix AS (
  SELECT p.* FROM pages p JOIN runs r ON p.book IS NOT DISTINCT FROM r.book AND p.page = r.page WHERE gap = 0)"""


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = F.nullif(text("b", F.col("l_suppkey")), F.lit("b1")).alias("book")
    page = (F.col("l_partkey") % 200 + 1).alias("page")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", book, page)


@query(
    "contiguous_pages",
    f"WITH {PAGES_SQL} SELECT l_orderkey, l_linenumber, book, page FROM prefix",
)
def contiguous_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contiguous_prefix(pages(spark, sf_dir), "book", "page")


@query("contiguous_first_pages", f"WITH {PAGES_SQL} SELECT l_orderkey, l_linenumber, book, page FROM prefix WHERE page <= 5")
def contiguous_first_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contiguous_prefix(pages(spark, sf_dir), "book", "page", pages=5)


@query(
    "size_table",
    """SELECT DISTINCT p_size || '*' || (p_size * 2) AS size,
  (CAST(p_size AS BIGINT) * 2 << 32) | CAST(p_size AS BIGINT) AS size_code FROM part""",
)
def size_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "part").select("p_size").distinct()
    path = fresh_folder(spark, "sizes")
    sinks.write_lines(sizes, text(F.col("p_size"), "*", F.col("p_size") * 2), path)
    return readers.read_sizes(spark, path)


@query(
    "sink_preview",
    "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def sink_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    return sinks.preview(rows, 20, F.desc("o_totalprice"), "o_orderkey").select("o_orderkey", "o_custkey")


def point_key() -> Column:
    """A number for a line item, equal for none but equal order, line, part and supplier numbers in practice."""
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


@query(
    "monte_carlo_pi",
    f"""WITH k AS (
  SELECT l_orderkey * 8 + l_linenumber AS k, unnest(range(16)) AS c FROM lineitem),
p AS (SELECT {draw_sql('k * 16 + c', 1)} / 2147483648.0::DOUBLE * 2 - 1 AS x,
             {draw_sql('k * 16 + c', 2)} / 2147483648.0::DOUBLE * 2 - 1 AS y FROM k)
SELECT count(*) FILTER (x * x + y * y < 1) AS inside, count(*) AS points,
  count(*) FILTER (x * x + y * y < 1) * 4.0::DOUBLE / count(*) AS pi FROM p""",
)
def monte_carlo_pi(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adflow.operators.rollups import estimate_pi

    points = generators.sample_points(table(spark, sf_dir, "lineitem"), point_key(), per_id=16)
    return estimate_pi(points, F.col("x"), F.col("y"))
