"""Order pricing: a premium on the rate of the best share of volume, with audit and failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.functions.records import CHANNELS, ORDER_NOT_FOR_BUYING, ORDER_TO_CONFIRM, code_to_literal
from adflow.functions.sizes import size_decode
from adflow.operators.rollups import best_by_rate, status_counts
from adflow.operators.topshare import top_share
from adflow.session import stored

TRAFFIC_WEB = 1
STATUSES = ("success", "fail", "audit")

ORDER_FIELDS = (
    "order_key",
    "order_id",
    "ssp_name",
    "domain",
    "creative_styles",
    "size_code",
    "dsp_id",
    "dsp_name",
)


def audit_flag(premium: Column, best_rate: Column, high: float = 3.0, low: float = 1.0) -> Column:
    """Whether a price is out of range against the best channel's rate; always if that rate is 0."""
    ratio = premium.cast("double") / F.when(best_rate != 0, best_rate).cast("double")
    return F.when(best_rate == 0, F.lit(True)).otherwise((ratio > high) | (ratio < low))


def best_shares(stats: DataFrame, share: float = 0.25, wanted: DataFrame | None = None) -> DataFrame:
    """The best share of each domain as a whole (size 0) and of each of its sizes."""
    whole = {"size_code": F.lit(0).cast("bigint")}
    return top_share(stats, ["domain", "size_code"], "impression", "cost", share, wanted=wanted, coarser=whole)


def price_orders(
    stats: DataFrame,
    orders: DataFrame,
    share: float = 0.25,
    premium: float = 1.5,
    floor: int = 100,
    audit: tuple[float, float] = (3.0, 1.0),
) -> DataFrame:
    """Price each order from the statistics of its domain, or domain and size.

    Each key is priced once, however many orders ask for it. ``status`` is
    success, audit or fail; an order without statistics fails and says why.
    The rates of keys and domains are computed at once.
    """
    asked = orders.select("domain", "size_code").distinct()
    priced = best_shares(stats, share, asked).select(
        "domain", "size_code", "top_rate", F.col("all_rate").alias("original_rate")
    )
    channels = best_by_rate(stats, ["domain"], "dsp_id", "impression", "cost").withColumnRenamed(
        "best_dsp_id", "best_channel"
    )
    # One row per key, written out: of known size, so broadcast if small, and a plain side of the
    # one join that orders go through if not, so that a domain with very many orders can be split.
    rates = stored(priced.join(channels, "domain"), "rates")

    raw = (F.col("top_rate") * F.lit(premium)).cast("bigint")
    price = F.greatest(raw, F.lit(floor).cast("bigint"))
    failed = F.col("top_rate").isNull()
    known = ~failed
    reason = F.concat(
        F.lit("No size found for "), F.col("domain"), F.lit(" "), size_decode(F.col("size_code"))
    )
    shown = F.concat(
        F.lit("PDOrder("), F.concat_ws(",", *[F.col(c).cast("string") for c in ORDER_FIELDS]), F.lit(")")
    )
    status = (
        F.when(failed, "fail")
        .when(audit_flag(F.col("premium_rate"), F.col("best_rate"), *audit), "audit")
        .otherwise("success")
    )

    def or_zero(name: str) -> Column:
        return F.when(known, F.col(name)).otherwise(F.lit(0)).cast("bigint")

    return (
        orders.join(rates, ["domain", "size_code"], "left")
        .withColumn("premium_rate", price)
        .select(
            "order_key",
            "order_id",
            "ssp_name",
            "domain",
            F.lit(TRAFFIC_WEB).alias("traffic_type"),
            "size_code",
            F.when(known, F.col("premium_rate")).otherwise(F.lit(0)).cast("bigint").alias("premium_rate"),
            or_zero("original_rate").alias("original_rate"),
            or_zero("best_rate").alias("best_rate"),
            F.when(known, F.col("best_channel")).otherwise(F.lit(0)).cast("int").alias("best_channel"),
            F.when(known, code_to_literal(F.col("best_channel"), CHANNELS))
            .otherwise(F.lit("-"))
            .alias("best_channel_name"),
            or_zero("best_impression").alias("best_impression"),
            F.coalesce(raw < floor, F.lit(False)).alias("below_floor"),
            status.alias("status"),
            F.when(failed, F.concat(shown, F.lit("\t"), reason)).otherwise(F.lit("")).alias("msg"),
        )
    )


def split_results(priced: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Successful, failed and audit orders."""
    status = F.col("status")
    return priced.where(status == "success"), priced.where(status == "fail"), priced.where(status == "audit")


def result_lines(priced: DataFrame) -> DataFrame:
    """One tab-separated line per result: 5 fields for a failure, 10 otherwise."""
    head = ["order_key", "order_id", "domain", "size_code"]
    rates = ["premium_rate", "original_rate", "best_rate", "best_channel", "best_channel_name", "best_impression"]

    def joined(*names: str) -> Column:
        return F.concat_ws("\t", *[F.col(n).cast("string") for n in names])

    line = F.when(F.col("status") == "fail", joined(*head, "msg")).otherwise(joined(*head, *rates))
    return priced.select("status", line.alias("value"))


def result_headers(priced: DataFrame) -> DataFrame:
    """The heading of each section of results with its number of rows."""
    text = F.format_string("Output %s results, num=%d", F.col("status"), F.col("count"))
    return priced.groupBy("status").count().select("status", text.alias("header"))


def counted_headers(counts: DataFrame) -> DataFrame:
    """The same headings from a row of ``status_counts``; sections without rows have none."""
    each = [F.struct(F.lit(s).alias("status"), F.col(s).alias("count")) for s in STATUSES]
    rows = counts.select(F.inline(F.array(*each))).where("count > 0")
    return rows.select("status", F.format_string("Output %s results, num=%d", "status", "count").alias("header"))


def outcome_messages(priced: DataFrame) -> DataFrame:
    """One message per outcome with its number of orders, for outcomes without any too."""
    return counted_messages(status_counts(priced))


def counted_messages(counts: DataFrame) -> DataFrame:
    """The same messages from a row of ``status_counts``."""
    # The messages of the summary.
    said = [
        ("success", "Successful PD order num is %d"),
        ("audit", "Auditable PD order num is %d"),
        ("fail", "Failed to cacludate PD order num is %d"),
    ]
    rows = [F.struct(F.lit(s).alias("status"), F.format_string(m, F.col(s)).alias("message")) for s, m in said]
    return counts.select(F.inline(F.array(*rows)))


def price_statements(
    priced: DataFrame,
    run_date: str,
    order_table: str = "pre_order",
    audit_table: str = "pre_order_audit",
) -> DataFrame:
    """One SQL statement per result: the new price, an audit entry, or the failed state."""

    def money(name: str) -> Column:
        return F.format_string("%8.2f", F.col(name) / F.lit(100.0))

    order_id = F.col("order_id")
    success = F.concat(
        F.lit(f"update {order_table} set order_price = "),
        money("premium_rate"),
        F.lit(f", pre_state={ORDER_TO_CONFIRM}, mod_time='{run_date}' where order_id = '"),
        order_id,
        F.lit("';"),
    )
    # Fixed value: column order of the audit table.
    columns = (
        "pre_order_id,order_id,ssp_name,ssp_url,traffic_type,"
        "ad_size,advice_price,adjusted_price,average_price,channel_highest_price,highest_price_channel,"
        "highest_price_pv,audit_status,add_time,mod_time"
    )
    review = F.concat(
        F.lit(f"insert ignore into {audit_table}({columns}) values("),
        F.format_string(
            "%d, '%s','%s','%s',%d,%d,",
            *[F.col(c) for c in ("order_key", "order_id", "ssp_name", "domain", "traffic_type", "size_code")],
        ),
        F.concat_ws(",", money("premium_rate"), F.lit("0.0"), money("original_rate"), money("best_rate")),
        F.format_string(",%d,%d,0,", F.col("best_channel"), F.col("best_impression")),
        F.lit(f"'{run_date}','{run_date}');"),
    )
    failure = F.concat(
        F.lit(f"update {order_table} set pre_state={ORDER_NOT_FOR_BUYING}, mod_time='{run_date}' where order_id = '"),
        order_id,
        F.lit("';"),
    )
    status = F.col("status")
    statement = F.when(status == "success", success).when(status == "audit", review).otherwise(failure)
    return priced.select("status", statement.alias("statement"))


def mock_orders(stats: DataFrame) -> DataFrame:
    """One order for each domain that has statistics."""
    return stats.select(
        F.lit(1).cast("bigint").alias("order_key"),
        F.lit("PD").alias("order_id"),
        F.lit("xxx.com").alias("ssp_name"),
        "domain",
        F.lit(0).alias("creative_styles"),
        F.lit(0).cast("bigint").alias("size_code"),
        F.lit(0).alias("dsp_id"),
        F.lit("DSP").alias("dsp_name"),
    ).distinct()
