"""Scalar, array and map functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adflow.functions import collections as arrays
from adflow.functions import numbers, text as texts, variants
from adflow.functions.sizes import size_decode, size_encode
from adflow.plans.registry import joined, query, table, text


@query(
    "size_encode",
    """SELECT p_partkey, (CAST(p_size AS BIGINT) * 2 << 32) | CAST(p_size AS BIGINT) AS code, 0::BIGINT AS malformed
FROM part""",
)
def part_size_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = text(F.col("p_size"), "*", F.col("p_size") * 2)
    malformed = size_encode(text(F.col("p_size"), "x2"))
    return table(spark, sf_dir, "part").select("p_partkey", size_encode(size).alias("code"), malformed.alias("malformed"))


@query("size_decode", "SELECT p_partkey, p_size || '*' || (p_size * 2) AS size, '' AS empty FROM part")
def part_size_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = size_encode(text(F.col("p_size"), "*", F.col("p_size") * 2))
    return table(spark, sf_dir, "part").select(
        "p_partkey", size_decode(code).alias("size"), size_decode(code - code).alias("empty")
    )


@query(
    "concat_key",
    """SELECT l_suppkey || '_' || l_linenumber || '_' || l_partkey AS "key", count(*) AS "count"
FROM lineitem GROUP BY ALL""",
)
def line_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["l_suppkey", "l_linenumber", "l_partkey"]
    counts = table(spark, sf_dir, "lineitem").groupBy(*names).agg(F.count(F.lit(1)).alias("count"))
    return counts.select(texts.concat_key(*[F.col(n) for n in names]).alias("key"), "count")


@query(
    "initials",
    """SELECT p_partkey, upper(array_to_string(list_transform(string_split(p_name, ' '), lambda w: w[1:1]), ''))
  AS initials FROM part""",
)
def part_initials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", texts.initials(F.col("p_name")).alias("initials"))


@query("prefix_text", "SELECT c_custkey, 'Hello, ' || c_name AS greeting FROM customer")
def customer_greeting(spark: SparkSession, sf_dir: str) -> DataFrame:
    greeting = texts.prefix_text(F.col("c_name")).alias("greeting")
    return table(spark, sf_dir, "customer").select("c_custkey", greeting)


@query(
    "vowels_in_word",
    """SELECT doc_id, concat_ws(',', CASE WHEN contains(text, 'a') THEN 'a' END, CASE WHEN contains(text, 'e') THEN 'e' END,
  CASE WHEN contains(text, 'i') THEN 'i' END, CASE WHEN contains(text, 'o') THEN 'o' END,
  CASE WHEN contains(text, 'u') THEN 'u' END) AS vowels FROM documents""",
)
def document_vowels(spark: SparkSession, sf_dir: str) -> DataFrame:
    vowels = joined(texts.vowels_in_word(F.col("text")))
    return table(spark, sf_dir, "documents").select("doc_id", vowels.alias("vowels"))


@query("append_chain", "SELECT p_partkey, p_name || 'cba' AS composed, p_name || 'abc' AS chained FROM part")
def part_append_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        texts.append_chain(name, "abc", compose=True).alias("composed"),
        texts.append_chain(name, "abc").alias("chained"),
    )


@query("reverse_text", "SELECT doc_id, reverse(text) AS reversed FROM documents")
def document_reverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", texts.reverse_text(F.col("text")).alias("reversed"))


@query(
    "full_name_address",
    "SELECT c_custkey, c_name || ' ' || c_mktsegment AS full_name, c_nationkey || ' ' || c_name AS address FROM customer",
)
def customer_name_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.struct(F.col("c_name").alias("first"), F.col("c_mktsegment").alias("last"))
    address = F.struct(F.col("c_nationkey").alias("house"), F.col("c_name").alias("street"))
    people = table(spark, sf_dir, "customer").select("c_custkey", name.alias("name"), address.alias("address"))
    return people.select(
        "c_custkey",
        texts.full_name(F.col("name.first"), F.col("name.last")).alias("full_name"),
        texts.full_address(F.col("address.house"), F.col("address.street")).alias("address"),
    )


@query(
    "grade_letter",
    """WITH g AS (SELECT l_orderkey, l_linenumber, l_quantity / 10 - 0.1::DOUBLE AS g FROM lineitem)
SELECT l_orderkey, l_linenumber,
  CASE WHEN g > 4 AND g <= 5 THEN 'A' WHEN g > 3 AND g <= 4 THEN 'B' WHEN g > 2 AND g <= 3 THEN 'C'
    WHEN g > 0 AND g <= 2 THEN 'D' WHEN g = 0 THEN 'F' ELSE 'N/A' END AS full_letter,
  CASE WHEN g > 4.7::DOUBLE AND g <= 5 THEN 'A' WHEN g > 4.3::DOUBLE AND g <= 4.7::DOUBLE THEN 'A-'
    WHEN g > 4 AND g <= 4.3::DOUBLE THEN 'B+' WHEN g > 3.7::DOUBLE AND g <= 4 THEN 'B'
    WHEN g > 3.3::DOUBLE AND g <= 3.7::DOUBLE THEN 'B-' WHEN g > 3 AND g <= 3.3::DOUBLE THEN 'C+'
    WHEN g > 2.7::DOUBLE AND g <= 3 THEN 'C' WHEN g > 2.3::DOUBLE AND g <= 2.7::DOUBLE THEN 'C-'
    WHEN g > 0 AND g <= 2.3::DOUBLE THEN 'D' WHEN g = 0 THEN 'F' ELSE 'N/A' END AS fine_letter
FROM g""",
)
def line_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    grade = F.col("l_quantity") / 10 - 0.1
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.grade_letter(grade).alias("full_letter"),
        numbers.grade_letter(grade, numbers.PLUS_MINUS_GRADES).alias("fine_letter"),
    )


@query(
    "percent_discount",
    """SELECT l_orderkey, l_linenumber,
  l_extendedprice - l_extendedprice * (l_discount * 100) * 0.01::DOUBLE AS price,
  l_extendedprice - l_extendedprice * 25::DOUBLE * 0.01::DOUBLE AS quarter_off FROM lineitem""",
)
def line_discount(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.percent_discount(price, F.col("l_discount") * 100).alias("price"),
        numbers.percent_discount(price, 25).alias("quarter_off"),
    )


@query(
    "state_tax",
    """SELECT o_orderkey, o_totalprice * CASE WHEN o_orderstatus = 'F' THEN 0.0645::DOUBLE ELSE 0.045::DOUBLE END AS tax
FROM orders""",
)
def order_tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.when(F.col("o_orderstatus") == "F", "NY").otherwise("PA")
    return table(spark, sf_dir, "orders").select("o_orderkey", numbers.state_tax(F.col("o_totalprice"), state).alias("tax"))


@query(
    "int_arith",
    """SELECT l_orderkey, l_partkey + l_suppkey AS added, l_partkey - l_suppkey AS subtracted,
  l_partkey * l_suppkey AS multiplied, (l_linenumber - l_suppkey) // (l_partkey + 1) AS divided,
  l_partkey * l_partkey AS squared, l_partkey + 1 AS successor, 2 * l_partkey AS doubled, 42 + l_partkey AS plus_42
FROM lineitem""",
)
def line_arith(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("l_partkey"), F.col("l_suppkey")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        (a + b).alias("added"),
        (a - b).alias("subtracted"),
        (a * b).alias("multiplied"),
        numbers.int_divide(F.col("l_linenumber") - b, a + 1).alias("divided"),
        (a * a).alias("squared"),
        (a + 1).alias("successor"),
        (2 * a).alias("doubled"),
        (42 + a).alias("plus_42"),
    )


@query("factorial", "SELECT l_orderkey, l_linenumber, CAST(factorial(l_linenumber) AS BIGINT) AS product FROM lineitem")
def line_factorial(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = numbers.factorial(F.col("l_linenumber")).alias("product")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", product)


@query("parity", "SELECT o_orderkey, o_custkey % 2 = 0 AS even, o_custkey % 2 <> 0 AS odd FROM orders")
def customer_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = numbers.is_even(F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", even.alias("even"), (~even).alias("odd"))


SHAPE_SQL = """shapes AS (
  SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'circle' WHEN 'R' THEN 'rectangle' ELSE 'square' END AS kind,
         l_quantity AS a, CAST(l_linenumber AS DOUBLE) AS b FROM lineitem)"""


@query(
    "shape_measures",
    f"""WITH {SHAPE_SQL}
SELECT l_orderkey, kind,
  CASE kind WHEN 'circle' THEN 2 * pi() * a WHEN 'rectangle' THEN 2 * a + 2 * b ELSE 4 * a END AS perimeter,
  CASE kind WHEN 'circle' THEN pi() * a * a WHEN 'rectangle' THEN a * b ELSE a * a END AS area FROM shapes""",
)
def shape_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    kind = F.when(flag == "A", "circle").when(flag == "R", "rectangle").otherwise("square")
    shapes = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        kind.alias("kind"),
        F.col("l_quantity").alias("a"),
        F.col("l_linenumber").cast("double").alias("b"),
    )
    sides = F.col("kind"), F.col("a"), F.col("b")
    return shapes.select(
        "l_orderkey", "kind", numbers.perimeter(*sides).alias("perimeter"), numbers.area(*sides).alias("area")
    )


# A list of four numbers per line item.
LIST_SQL = "[l_linenumber::BIGINT, l_suppkey, l_quantity::BIGINT, l_linenumber::BIGINT]"


def line_list() -> Column:
    line = F.col("l_linenumber").cast("bigint")
    return F.array(line, "l_suppkey", F.col("l_quantity").cast("bigint"), line)


@query(
    "array_map",
    f"""SELECT l_orderkey, array_to_string(list_transform({LIST_SQL}, lambda x: x * 2), ',') AS doubled,
  CASE l_returnflag WHEN 'A' THEN '66' WHEN 'R' THEN '83' ELSE '79' END || ',' ||
  CASE l_linestatus WHEN 'F' THEN '71' ELSE '80' END AS next_codes FROM lineitem""",
)
def array_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = text(F.col("l_returnflag"), F.col("l_linestatus"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        joined(F.transform(line_list(), lambda x: x * 2)).alias("doubled"),
        joined(arrays.next_codes(flags)).alias("next_codes"),
    )


@query(
    "array_flatten",
    """SELECT l_orderkey, concat_ws(',', l_linenumber, l_suppkey, l_partkey) AS flat,
  concat_ws(',', l_linenumber * 2, l_suppkey * 2, l_partkey * 2) AS flat_doubled FROM lineitem""",
)
def array_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = F.array(F.array(F.col("l_linenumber").cast("bigint"), "l_suppkey"), F.array("l_partkey"))
    doubled = F.transform(nested, lambda inner: F.transform(inner, lambda x: x * 2))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", joined(F.flatten(nested)).alias("flat"), joined(F.flatten(doubled)).alias("flat_doubled")
    )


@query(
    "array_remove",
    f"""SELECT l_orderkey, array_to_string(list_filter({LIST_SQL}, lambda x: x <> l_linenumber), ',') AS kept
FROM lineitem""",
)
def array_remove(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = F.array_remove(line_list(), F.col("l_linenumber").cast("bigint"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", joined(kept).alias("kept"))


@query(
    "array_empty_head_tail",
    f"""WITH a AS (SELECT l_orderkey, list_filter({LIST_SQL}, lambda x: x > 5) AS a FROM lineitem)
SELECT l_orderkey, len(a) = 0 AS is_empty, coalesce(a[1], -1) AS head, array_to_string(a[2:], ',') AS tail FROM a""",
)
def array_empty_head_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = table(spark, sf_dir, "lineitem").select("l_orderkey", F.filter(line_list(), lambda x: x > 5).alias("a"))
    a = F.col("a")
    return lists.select(
        "l_orderkey",
        arrays.array_is_empty(a).alias("is_empty"),
        F.coalesce(arrays.array_head(a), F.lit(-1)).alias("head"),
        joined(arrays.array_tail(a)).alias("tail"),
    )


@query(
    "array_sum_sort",
    f"""SELECT l_orderkey, CAST(list_sum({LIST_SQL}) AS BIGINT) AS total, list_max({LIST_SQL}) AS largest,
  array_to_string(list_sort(list_distinct({LIST_SQL})), ',') AS sorted_distinct FROM lineitem""",
)
def array_sum_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = line_list()
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        arrays.array_sum(a).alias("total"),
        F.array_max(a).alias("largest"),
        joined(arrays.sort_distinct_array(a)).alias("sorted_distinct"),
    )


def line_map() -> Column:
    pairs = [F.lit(1), F.col("l_suppkey"), F.lit(2), F.col("l_partkey"), F.lit(3), F.col("l_quantity").cast("bigint")]
    return F.create_map(*pairs)


def entries(m: Column) -> Column:
    return F.array_join(F.transform(F.map_entries(m), lambda e: text(e["key"], ":", e["value"])), ",")


@query(
    "map_filter",
    """SELECT l_orderkey, concat_ws(',', CASE WHEN l_suppkey < 50 THEN '1:' || l_suppkey END,
    CASE WHEN l_partkey < 50 THEN '2:' || l_partkey END,
    CASE WHEN l_quantity < 50 THEN '3:' || l_quantity::BIGINT END) AS by_value,
  concat_ws(',', '2:' || l_partkey, '3:' || l_quantity::BIGINT) AS by_key FROM lineitem""",
)
def map_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        entries(arrays.keep_values_below(line_map(), 50)).alias("by_value"),
        entries(arrays.keep_keys_above(line_map(), 1)).alias("by_key"),
    )


@query(
    "map_transform",
    """SELECT l_orderkey, '10:' || l_suppkey || ',20:' || l_partkey || ',30:' || l_quantity::BIGINT AS scaled,
  concat_ws(',', l_suppkey, l_partkey, l_quantity::BIGINT) AS "values" FROM lineitem""",
)
def map_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        entries(arrays.scale_keys(line_map(), 10)).alias("scaled"),
        joined(F.map_values(line_map())).alias("values"),
    )


@query(
    "path_select",
    """SELECT event_id, json_extract_string(props, '$.k') AS k,
  coalesce(json_extract_string(props, '$.k.x'), 'none') AS missing, 'u' || user_id AS nested FROM events""",
)
def path_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    inner = F.create_map(F.lit("last"), text("u", F.col("user_id")))
    nested = F.create_map(F.lit("name"), inner)
    return table(spark, sf_dir, "events").select(
        "event_id",
        arrays.path_select(F.col("props"), "k").alias("k"),
        F.coalesce(arrays.path_select(F.col("props"), "k", "x"), F.lit("none")).alias("missing"),
        arrays.path_select_map(nested, "name", "last").alias("nested"),
    )


def mixed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with a value of several types: small sizes, words, emails, lists, fractions and nothing."""
    size, name = F.col("p_size"), F.col("p_name")
    email = F.struct(
        name.alias("subject"), F.col("p_type").alias("text"), F.col("p_brand").alias("sender"), F.lit("shop").alias("recipient")
    )
    nested = F.struct(F.struct(name.alias("first"), size.alias("size")).alias("name"))
    kind = F.col("p_partkey") % 6
    told = (
        F.when(kind == 0, size.cast("string"))
        .when(kind == 1, F.when(size > 25, F.lit('"two"')).otherwise(F.lit('"three"')))
        .when(kind == 2, F.to_json(email))
        .when(kind == 3, F.to_json(nested))
        .when(kind == 4, text("[", size, "]"))
        .when(size > 25, text(size, ".5"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", F.parse_json(told).alias("value"))


@query(
    "variant_case",
    """SELECT p_partkey, CASE
  WHEN p_partkey % 6 = 0 THEN CASE WHEN p_size = 1 THEN '"one"' ELSE '"scala.Int"' END
  WHEN p_partkey % 6 = 1 AND p_size > 25 THEN '2'
  WHEN p_partkey % 6 = 2 THEN '"Email: subject = ' || p_name || '"'
  ELSE '"many"' END AS answer,
  CASE p_partkey % 6 WHEN 0 THEN 'int' WHEN 1 THEN 'text' WHEN 2 THEN 'record' WHEN 3 THEN 'record' WHEN 4 THEN 'list'
    ELSE CASE WHEN p_size > 25 THEN 'number' END END AS kind
FROM part""",
)
def variant_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    return mixed_parts(spark, sf_dir).select(
        "p_partkey", F.to_json(variants.any_case(value)).alias("answer"), variants.kind_of(value).alias("kind")
    )


@query(
    "variant_path",
    """SELECT p_partkey, CASE p_partkey % 6 WHEN 3 THEN p_name END AS first, CASE p_partkey % 6 WHEN 3 THEN p_size ELSE -1 END AS size,
  CASE p_partkey % 6 WHEN 2 THEN p_brand END AS sender FROM part""",
)
def variant_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    return mixed_parts(spark, sf_dir).select(
        "p_partkey",
        variants.text_value(variants.variant_path(value, "name", "first")).alias("first"),
        F.coalesce(variants.whole_number(variants.variant_path(value, "name", "size")), F.lit(-1)).alias("size"),
        variants.variant_path(value, "sender", kind="string").alias("sender"),
    )
