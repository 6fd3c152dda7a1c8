"""Pricing results applied to an order table: the effect of their SQL statements, run in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adflow.functions.records import ORDER_NEW, ORDER_NOT_FOR_BUYING, ORDER_TO_CONFIRM
from adflow.session import stored
from adflow.sources import versions
from adflow.sources.versions import Version, VersionTaken

ORDERS, AUDITS = "pre_order", "pre_order_audit"
ATTEMPTS = 5

MONEY = "decimal(18,2)"
ORDER_COLUMNS = f"order_id string, order_price {MONEY}, pre_state int, mod_time string"


def money(cents: str):
    """Cents as a decimal amount."""
    return (F.col(cents).cast("decimal(20,0)") / F.lit(100)).cast(MONEY)


def new_orders(ids: DataFrame, order_id: str, at: str) -> DataFrame:
    """Orders without a price yet, one for each id."""
    return ids.select(
        F.col(order_id).cast("string").alias("order_id"),
        F.lit(0).cast(MONEY).alias("order_price"),
        F.lit(ORDER_NEW).alias("pre_state"),
        F.lit(at).alias("mod_time"),
    ).distinct()


def order_changes(priced: DataFrame) -> DataFrame:
    """One row for each order that results update: (order_id, new_price, new_state).

    Prices are set before failures are, and results of one status in the order
    of their keys: the last price counts, and an order that also failed has a
    price and the state of a failure.
    """
    status = F.col("status")
    last = F.struct("order_key", "premium_rate")
    price = F.max_by("premium_rate", F.when(status == "success", last))
    failed = F.bool_or(status == "fail")
    changes = priced.where(status.isin("success", "fail")).groupBy("order_id").agg(price.alias("cents"), failed.alias("failed"))
    state = F.when(F.col("failed"), ORDER_NOT_FOR_BUYING).otherwise(ORDER_TO_CONFIRM)
    return changes.select("order_id", money("cents").alias("new_price"), state.alias("new_state"))


def audit_rows(priced: DataFrame, run_date: str) -> DataFrame:
    """The audit entry of each order that needs one; of several results the one with the lowest key."""
    needed = priced.where("status = 'audit'")
    columns = [c for c in priced.columns if c != "order_id"]
    first = needed.groupBy("order_id").agg(F.min(F.struct("order_key", *[c for c in columns if c != "order_key"])).alias("r"))
    r = first.select("order_id", "r.*")
    return r.select(
        F.col("order_key").alias("pre_order_id"),
        "order_id",
        "ssp_name",
        F.col("domain").alias("ssp_url"),
        "traffic_type",
        F.col("size_code").alias("ad_size"),
        money("premium_rate").alias("advice_price"),
        F.lit(0).cast(MONEY).alias("adjusted_price"),
        money("original_rate").alias("average_price"),
        money("best_rate").alias("channel_highest_price"),
        F.col("best_channel").alias("highest_price_channel"),
        F.col("best_impression").alias("highest_price_pv"),
        F.lit(0).alias("audit_status"),
        F.lit(run_date).alias("add_time"),
        F.lit(run_date).alias("mod_time"),
    )


def updated(orders: DataFrame, changes: DataFrame, run_date: str) -> DataFrame:
    """Orders with the changes that name them; others as they are. Changes to unknown orders have no effect."""
    known = F.col("new_state").isNotNull()
    joined = orders.join(changes, "order_id", "left")
    return joined.select(
        "order_id",
        F.coalesce("new_price", "order_price").alias("order_price"),
        F.coalesce("new_state", "pre_state").alias("pre_state"),
        F.when(known, F.lit(run_date)).otherwise(F.col("mod_time")).alias("mod_time"),
    )


def apply_results(spark: SparkSession, root: str, priced: DataFrame, run_date: str, run: str) -> Version:
    """Apply results to the tables below a folder and give the version that holds them.

    Orders with a price or a failure are updated where they are found; audit
    entries are inserted unless the order has one. Both tables change in one
    version. A run that a version already holds has no effect, and neither do
    results that have been applied before. ``priced`` should be a written table:
    it is read more than once, and again if another writer came first.
    """
    for _ in range(ATTEMPTS):
        base = versions.current(spark, root)
        if base is None:
            raise ValueError(f"no order table below {root}")
        if run in base.runs:
            return base
        orders, audits = base.tables[ORDERS], base.tables[AUDITS]
        changes = stored(order_changes(priced), "order-changes")
        touched = versions.touched_buckets(changes, "order_id", orders.buckets)
        before = versions.read_table(spark, root, base, ORDERS, touched)

        asked = stored(audit_rows(priced, run_date), "audit-rows")
        old = versions.read_table(spark, root, base, AUDITS, versions.touched_buckets(asked, "order_id", audits.buckets))
        added = stored(asked.join(old.select("order_id"), "order_id", "left_anti").select(*old.columns), "audit-rows")
        grown = versions.touched_buckets(added, "order_id", audits.buckets)
        kept = versions.read_table(spark, root, base, AUDITS, grown)
        try:
            return versions.commit(
                spark,
                root,
                base,
                {ORDERS: (updated(before, changes, run_date), touched), AUDITS: (kept.unionByName(added), grown)},
                run,
            )
        except VersionTaken:
            continue
    raise VersionTaken(f"{ATTEMPTS} attempts below {root}")
