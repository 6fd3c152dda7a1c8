"""Projections, filters, splits and row-wise rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adflow.functions.collections import even_times
from adflow.functions.records import case_or_default, choose_by_number, strict_case, struct_update, typed_case
from adflow.functions.text import COMPARATORS, length_check
from adflow.operators import filters
from adflow.operators.rollups import clean_word_count
from adflow.plans.registry import joined, query, table, text, words_sql


@query("project_columns", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]
    return filters.project_columns(table(spark, sf_dir, "supplier"), *names)


@query(
    "filter_date",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-16'",
)
def filter_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    until = F.lit("1998-09-16").cast("timestamp_ntz")
    shipped = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= until)
    return shipped.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "filter_open_range",
    f"""WITH {words_sql('conversations')} SELECT word FROM word_counts WHERE "count" > 3 AND "count" < 25""",
)
def filter_open_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = clean_word_count(table(spark, sf_dir, "conversations"), "text")
    return filters.filter_open_range(counts, "word", "count")


@query(
    "case_or_default",
    """SELECT p_partkey, CASE WHEN p_size > 3 AND p_size < 25 THEN p_name ELSE 'not valid' END AS word FROM part""",
)
def part_case_or_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = case_or_default(F.col("p_name"), F.col("p_size"))
    return table(spark, sf_dir, "part").select("p_partkey", word.alias("word"))


@query("strict_case", "SELECT p_partkey, p_name AS word FROM part")
def part_strict_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = strict_case(F.col("p_name"), F.col("p_size"), low=0, high=1000)
    return table(spark, sf_dir, "part").select("p_partkey", word.alias("word"))


@query("filter_score", "SELECT c_name FROM customer WHERE c_acctbal > 5000")
def filter_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_score(table(spark, sf_dir, "customer"), "c_name", "c_acctbal", 5000)


@query(
    "filter_valid_stats",
    """SELECT l_orderkey, CAST(l_quantity AS BIGINT) - 5 AS impression, l_linenumber AS clk FROM lineitem
WHERE l_quantity - 5 > 0 AND l_quantity - 5 >= l_linenumber""",
)
def filter_valid_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        (F.col("l_quantity").cast("bigint") - 5).alias("impression"),
        F.col("l_linenumber").alias("clk"),
    )
    return filters.filter_valid_stats(stats)


@query(
    "filter_nested_in",
    """SELECT c_custkey, 'Hello, ' || c_name || ', and welcome to the Lambda Bar And Grille!' AS greeting
FROM customer WHERE 19100 + c_nationkey IN (19123, 19103)""",
)
def filter_nested_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    address = F.struct((F.lit(19100) + F.col("c_nationkey")).alias("zip")).alias("address")
    people = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"), address)
    return filters.greet_neighbours(people).select("c_custkey", "greeting")


@query(
    "filter_even_map",
    """SELECT l_orderkey, l_linenumber,
  array_to_string(list_transform(list_filter([l_partkey, l_suppkey, l_linenumber], lambda x: x % 2 = 0),
                                 lambda x: x * 10), ',') AS evens FROM lineitem""",
)
def filter_even_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = F.array("l_partkey", "l_suppkey", F.col("l_linenumber").cast("bigint"))
    evens = joined(even_times(numbers, 10)).alias("evens")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", evens)


@query(
    "split_by_predicate",
    """SELECT o_orderkey, CASE WHEN o_totalprice >= 250000 THEN 'large' ELSE 'small' END AS side FROM orders""",
)
def split_by_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    large, small = filters.split_by_predicate(orders, F.col("o_totalprice") >= 250000)
    large = large.select("o_orderkey", F.lit("large").alias("side"))
    return large.unionByName(small.select("o_orderkey", F.lit("small").alias("side")))


PEOPLE_SQL = """people AS (
  SELECT c_custkey, CASE WHEN c_nationkey <> 3 THEN c_name END AS "first",
         CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS "middle",
         CASE WHEN c_acctbal > 0 THEN 'L' || c_nationkey END AS "last"
  FROM customer)"""


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as people with missing name parts."""
    segment = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_nationkey") != 3, F.col("c_name")).alias("first"),
        F.when(segment != "BUILDING", segment).alias("middle"),
        F.when(F.col("c_acctbal") > 0, text("L", F.col("c_nationkey"))).alias("last"),
    )


@query(
    "filter_not_null",
    f"""WITH {PEOPLE_SQL}
SELECT c_custkey, 'first' AS rule FROM people WHERE "first" IS NOT NULL
UNION ALL
SELECT c_custkey, 'full' FROM people WHERE "first" IS NOT NULL AND "middle" IS NOT NULL AND "last" IS NOT NULL""",
)
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    everyone = people(spark, sf_dir)
    first = filters.filter_not_null(everyone, "first").select("c_custkey", F.lit("first").alias("rule"))
    full = filters.filter_not_null(everyone, "first", "middle", "last")
    return first.unionByName(full.select("c_custkey", F.lit("full").alias("rule")))


@query(
    "filter_text_length",
    """SELECT conv_id, turn, length(text) > 200 AS gt, length(text) >= 200 AS ge, length(text) < 200 AS lt,
  length(text) <= 200 AS le, length(text) = 200 AS eq FROM conversations WHERE length(text) >= 20""",
)
def filter_text_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {">": "gt", ">=": "ge", "<": "lt", "<=": "le", "==": "eq"}
    mail = table(spark, sf_dir, "conversations").where(length_check(F.col("text"), ">=", 20))
    checks = [length_check(F.col("text"), c, 200).alias(names[c]) for c in COMPARATORS]
    return mail.select("conv_id", "turn", *checks)


@query(
    "filter_contains",
    """SELECT count(*) FILTER (contains(text, 'a')) AS with_a, count(*) FILTER (contains(text, 'b')) AS with_b
FROM documents""",
)
def filter_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = F.col("text").contains("a"), F.col("text").contains("b")
    return table(spark, sf_dir, "documents").agg(
        F.count_if(counted[0]).alias("with_a"), F.count_if(counted[1]).alias("with_b")
    )


@query(
    "filter_stopwords",
    f"""WITH {words_sql('conversations')}
SELECT word, "count" FROM word_counts WHERE word NOT IN ('the', 'la', 'de', 'und')""",
)
def filter_stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_word_count(table(spark, sf_dir, "conversations"), "text", ["the", "la", "de", "und"])


@query(
    "clean_chain",
    """SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'No subject' ELSE role END AS subject,
  replace(replace(text, 'your', 'you''re'), 'dynamic typing', '**CENSORED**') || chr(10) ||
  'This mail sent via Super Awesome Free Mail' AS text
FROM (SELECT * REPLACE (text || ' your' AS text) FROM conversations)""",
)
def clean_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.col("role")
    mail = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(role == "user", "").otherwise(role).alias("subject"),
        text(F.col("text"), " your").alias("text"),
    )
    return filters.clean_mail(mail)


@query(
    "request_enrich",
    """SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'AUser' END AS principal,
  CASE WHEN event_type IN ('purchase', 'click') THEN props ELSE '' END AS fingerprint FROM events""",
)
def request_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    mark = [F.lit("X-RequestFingerprint"), F.col("props")]
    headers = (
        F.when(kind == "purchase", F.create_map(F.lit("Authorization"), F.lit("token"), *mark))
        .when(kind == "click", F.create_map(*mark))
        .otherwise(F.create_map(F.lit("Accept"), F.lit("any")))
    )
    requests = table(spark, sf_dir, "events").select("event_id", headers.alias("headers"))
    enriched = requests.transform(filters.check_authorization).transform(filters.add_fingerprint)
    return enriched.select("event_id", "principal", "fingerprint")


@query(
    "struct_update",
    """SELECT o_orderkey, 'haha' AS subject, 'hello' AS text, o_orderpriority AS sender FROM orders""",
)
def order_struct_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = F.struct(F.lit("subject").alias("subject"), F.lit("").alias("text"), F.col("o_orderpriority").alias("sender"))
    changed = struct_update(mail, subject=F.lit("haha"), text=F.lit("hello"))
    return table(spark, sf_dir, "orders").select("o_orderkey", changed.alias("mail")).select("o_orderkey", "mail.*")


@query(
    "choose_by_number",
    """SELECT l_orderkey, CASE l_linenumber WHEN 1 THEN 'first' WHEN 2 THEN 'second' WHEN 3 THEN 'third' END AS choice
FROM lineitem""",
)
def line_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    choice = choose_by_number(F.col("l_linenumber"), F.lit("first"), F.lit("second"), F.lit("third"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", choice.alias("choice"))


@query(
    "typed_case",
    """SELECT p_partkey, CASE WHEN p_size = 1 THEN 'one' WHEN p_size > 30 AND p_type = 'SMALL' THEN '2'
  WHEN p_size <= 30 THEN 'scala.Int' WHEN p_brand = 'Brand#1' THEN 'Email: subject = ' || p_name
  ELSE 'many' END AS answer FROM part""",
)
def part_typed_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    number = F.when(size <= 30, size)
    word = F.when((size > 30) & (F.col("p_type") == "SMALL"), "two")
    email = F.when(F.col("p_brand") == "Brand#1", F.struct(F.col("p_name").alias("subject")))
    return table(spark, sf_dir, "part").select("p_partkey", typed_case(number, word, email).alias("answer"))
