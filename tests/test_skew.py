"""Hot keys: joins are split, and no cross join or whole-table window appears in any plan."""

from __future__ import annotations

import os
import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from adflow.operators import lookups
from adflow.operators.pricing import price_orders
from adflow.operators.sequences import contiguous_prefix
from adflow.plans.catalog import QUERIES
from adflow.streaming.batches import drop_blacklisted

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.shuffle.partitions": "16",
}


@contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hot_facts(spark, n=20_000):
    """Rows of which a third has one key; the payload does not compress."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900).cast("int")
    return spark.range(0, n, 1, 8).select(key.alias("k"), F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("p"))


def splits(df) -> bool:
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_are_split_in_joins(spark):
    with settings(spark, SMALL_SKEW):
        facts = hot_facts(spark)
        dim = spark.range(900).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
        found = lookups.lookup(facts, dim, "k", "v", F.lit("-"))
        assert splits(found) and found.count() == 20_000
        once = lookups.lookup_distinct(facts, "k", "twice", F.col("k") * 2)
        assert splits(once) and once.count() == 20_000
        hot = F.col("id") < 10_000
        pages = spark.range(0, 20_000, 1, 8).select(
            F.when(hot, 7).otherwise(F.col("id") % 900 + 10).alias("k"),
            F.when(hot, F.col("id")).otherwise(F.floor(F.col("id") / 900) - 11).alias("page"),
            F.sha2(F.col("id").cast("string"), 256).alias("p"),
        )
        prefix = contiguous_prefix(pages, "k", "page", start=0)
        assert splits(prefix) and prefix.where("k = 7").count() == 10_000
        blacklist = spark.createDataFrame([(i, i % 2 == 0) for i in range(300)], "k int, blocked boolean")
        kept = drop_blacklisted(facts, blacklist, "k")
        assert splits(kept) and kept.where("k < 300 and k % 2 = 0").count() == 0


def test_a_domain_with_very_many_orders_is_split(spark):
    with settings(spark, SMALL_SKEW):
        key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900)
        domain = F.concat(F.lit("d"), key)
        none = F.lit(0).cast("bigint")
        stats = spark.range(5000).select(
            F.concat(F.lit("d"), F.col("id") % 800).alias("domain"), (F.col("id") % 7).cast("int").alias("dsp_id"),
            (F.col("id") + 1000).alias("impression"), none.alias("clk"), F.col("id").alias("cost"), none.alias("size_code"),
        )
        orders = spark.range(0, 20_000, 1, 8).select(
            F.col("id").alias("order_key"), F.sha2(F.col("id").cast("string"), 256).alias("order_id"),
            F.lit("n").alias("ssp_name"), domain.alias("domain"), F.lit(0).alias("creative_styles"),
            none.alias("size_code"), F.lit(1).alias("dsp_id"), F.lit("d").alias("dsp_name"),
        )
        priced = price_orders(stats, orders)
        assert splits(priced) and priced.count() == 20_000


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize(
    "key", ["price_orders", "top_share_rate", "tpch_q1", "chained_lookup", "ledger_total", "validate_transitions",
            "zip_positional", "contiguous_pages", "set_difference", "collect_by_store", "cross_sum", "drop_n"],
)
def test_plans_have_no_cross_join_and_no_narrow_spot(spark, key):
    with settings(spark, {k: v for k, v in SMALL_SKEW.items() if "roadcast" in k}):
        plan = QUERIES[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    for below in re.findall(r"Exchange SinglePartition[^\n]*\n[ :|+-]*([^\n]*)", plan):
        assert "HashAggregate" in below


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["tpch_q1"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(l_shipdate" in plan
    scanned = re.search(r"ReadSchema: struct<([^>]*)", plan).group(1)
    assert "l_orderkey" not in scanned and "l_comment" not in scanned
