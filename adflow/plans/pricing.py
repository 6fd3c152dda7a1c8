"""Order pricing and its parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adflow.operators import order_table, pricing
from adflow.operators.rollups import best_by_rate, status_counts, weighted_rate
from adflow.plans.registry import ORACLES, ORDERS_SQL, STATS_SQL, orders, query, stats
from adflow.session import SMALL_GROUPS, fresh_folder, stored
from adflow.sources import readers, sinks, versions

RATE = "CAST(trunc({v} / ({w} / 1000.0::DOUBLE)) AS BIGINT)"

TOP_SQL = f"""grained AS (
  SELECT domain, unnest([0::BIGINT, size_code]) AS size_code, impression, cost FROM stats),
rated AS (
  SELECT *, {RATE.format(v='cost', w='impression')} AS rate FROM grained),
running AS (
  SELECT *, sum(impression) OVER best AS cum,
         sum(impression) OVER (PARTITION BY domain, size_code) * 0.25::DOUBLE AS target
  FROM rated
  WINDOW best AS (PARTITION BY domain, size_code ORDER BY rate DESC, impression DESC, cost DESC
                  ROWS UNBOUNDED PRECEDING)),
cut AS (
  SELECT *,
    CASE WHEN cum <= target THEN impression
         WHEN cum - impression <= target THEN CAST(trunc(target - (cum - impression)) AS BIGINT)
         ELSE 0 END AS top_imp,
    CASE WHEN cum <= target THEN cost
         WHEN cum - impression <= target
         THEN CAST(trunc(cost * ((target - (cum - impression)) / impression)) AS BIGINT)
         ELSE 0 END AS top_cost
  FROM running),
summed AS (
  SELECT domain, size_code, CAST(sum(top_imp) AS BIGINT) AS top_weight, CAST(sum(top_cost) AS BIGINT) AS top_value,
         CAST(sum(impression) AS BIGINT) AS w, CAST(sum(cost) AS BIGINT) AS v
  FROM cut GROUP BY domain, size_code),
top AS (
  SELECT domain, size_code, top_weight, top_value,
         CASE WHEN top_weight = 0 THEN 0 ELSE {RATE.format(v='top_value', w='top_weight')} END AS top_rate,
         {RATE.format(v='v', w='w')} AS all_rate
  FROM summed)"""

CHANNEL_SQL = f"""merged AS (
  SELECT domain, dsp_id, CAST(sum(impression) AS BIGINT) AS impression, CAST(sum(cost) AS BIGINT) AS cost
  FROM stats GROUP BY domain, dsp_id),
channel_rates AS (
  SELECT *, {RATE.format(v='cost', w='impression')} AS rate FROM merged),
channels AS (
  SELECT domain, dsp_id AS best_channel, rate AS best_rate, impression AS best_impression FROM channel_rates
  QUALIFY row_number() OVER (PARTITION BY domain ORDER BY rate DESC, dsp_id) = 1)"""

PRICED_SQL = f"""{STATS_SQL}, {ORDERS_SQL}, {TOP_SQL}, {CHANNEL_SQL},
matched AS (
  SELECT o.*, top_rate, all_rate, c.best_channel, c.best_rate, c.best_impression,
         CAST(trunc(top_rate * 1.5::DOUBLE) AS BIGINT) AS raw
  FROM orders_in o
  LEFT JOIN top t ON o.domain = t.domain AND o.size_code = t.size_code
  LEFT JOIN channels c ON o.domain = c.domain),
premium AS (
  SELECT *, greatest(raw, 100) AS p, top_rate IS NULL AS failed FROM matched),
priced AS (
  SELECT order_key, order_id, ssp_name, domain, 1 AS traffic_type, size_code,
    CASE WHEN failed THEN 0 ELSE p END::BIGINT AS premium_rate,
    CASE WHEN failed THEN 0 ELSE all_rate END::BIGINT AS original_rate,
    CASE WHEN failed THEN 0 ELSE best_rate END::BIGINT AS best_rate,
    CASE WHEN failed THEN 0 ELSE best_channel END::INTEGER AS best_channel,
    CASE WHEN failed THEN '-' WHEN best_channel = 0 THEN '3rd-DSP' WHEN best_channel = 1 THEN 'NOVA'
         WHEN best_channel = 4 THEN 'LU' WHEN best_channel = 5 THEN 'PC-DSP' WHEN best_channel = 6 THEN 'MDSP'
         ELSE '-' END AS best_channel_name,
    CASE WHEN failed THEN 0 ELSE best_impression END::BIGINT AS best_impression,
    coalesce(raw < 100, false) AS below_floor,
    CASE WHEN failed THEN 'fail'
         WHEN best_rate = 0 OR p::DOUBLE / best_rate > 3.0 OR p::DOUBLE / best_rate < 1.0 THEN 'audit'
         ELSE 'success' END AS status,
    CASE WHEN failed THEN
      'PDOrder(' || concat_ws(',', order_key, order_id, ssp_name, domain, creative_styles, size_code,
                              dsp_id, dsp_name) || ')' || chr(9) || 'No size found for ' || domain || ' ' ||
      CASE WHEN size_code = 0 THEN '' ELSE (size_code & 4294967295) || '*' || (size_code >> 32) END
      ELSE '' END AS msg
  FROM premium)"""


def stored_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics as a table of their own: pricing reads them more than once, the join runs once."""
    return stored(stats(spark, sf_dir), "stats", SMALL_GROUPS)


def priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = stored_stats(spark, sf_dir)
    return pricing.price_orders(given, stored(orders(spark, sf_dir, given), "orders"))


def stored_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices computed once and kept as a table, for sinks that read them more than once."""
    return stored(priced(spark, sf_dir), "priced")


query("price_orders", f"WITH {PRICED_SQL} SELECT * FROM priced")(priced)


NAMELESS_SQL = STATS_SQL.replace("'s' || l_suppkey AS domain", "nullif('s' || l_suppkey, 's1') AS domain")


@query("top_share_rate", f"WITH {NAMELESS_SQL}, {TOP_SQL} SELECT * FROM top")
def top_share_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One domain has no name, and must not be lost."""
    nameless = stats(spark, sf_dir).withColumn("domain", F.nullif("domain", F.lit("s1")))
    return pricing.best_shares(stored(nameless, "stats", SMALL_GROUPS))


@query(
    "weighted_rate",
    f"""WITH {STATS_SQL}, m AS (
  SELECT domain, CAST(sum(impression) AS BIGINT) AS impression, CAST(sum(cost) AS BIGINT) AS cost
  FROM stats GROUP BY domain)
SELECT *, {RATE.format(v='cost', w='impression')} AS rate FROM m""",
)
def domain_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_rate(stats(spark, sf_dir), ["domain"], "impression", "cost")


@query(
    "global_totals",
    f"""WITH {STATS_SQL}, m AS (
  SELECT CAST(sum(impression) AS BIGINT) AS impression, CAST(sum(cost) AS BIGINT) AS cost FROM stats)
SELECT *, {RATE.format(v='cost', w='impression')} AS rate FROM m""",
)
def global_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_rate(stats(spark, sf_dir), [], "impression", "cost")


@query(
    "argmax_channel",
    f"""WITH {STATS_SQL}, {CHANNEL_SQL}
SELECT domain, best_channel AS best_dsp_id, best_rate, best_impression FROM channels""",
)
def argmax_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_by_rate(stats(spark, sf_dir), ["domain"], "dsp_id", "impression", "cost")


@query(
    "audit_flag",
    f"""WITH {PRICED_SQL}
SELECT order_id, status = 'audit' AS need_audit FROM priced""",
)
def audit_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = pricing.audit_flag(F.col("premium_rate"), F.col("best_rate"))
    need = (F.col("status") != "fail") & flag
    return priced(spark, sf_dir).select("order_id", need.alias("need_audit"))


@query(
    "lookup_miss_to_failure",
    f"WITH {PRICED_SQL} SELECT order_key, order_id, msg FROM priced WHERE status = 'fail'",
)
def lookup_miss_to_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, failed, _ = pricing.split_results(priced(spark, sf_dir))
    return failed.select("order_key", "order_id", "msg")


@query(
    "split_results",
    f"WITH {PRICED_SQL} SELECT order_id, status, premium_rate FROM priced WHERE status IN ('success', 'audit')",
)
def split_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    success, _, audit = pricing.split_results(priced(spark, sf_dir))
    return success.unionByName(audit).select("order_id", "status", "premium_rate")


@query(
    "status_counts",
    f"""WITH {PRICED_SQL}
SELECT count(*) AS results,
       count(*) FILTER (status = 'success') AS success,
       count(*) FILTER (status = 'success' AND NOT below_floor) AS normal,
       count(*) FILTER (status = 'success' AND below_floor) AS below_floor,
       count(*) FILTER (status = 'fail') AS fail,
       count(*) FILTER (status = 'audit') AS audit
FROM priced""",
)
def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_counts(priced(spark, sf_dir))


@query(
    "sink_result_tsv",
    f"""WITH {PRICED_SQL}
SELECT status, CASE WHEN status = 'fail'
  THEN concat_ws(chr(9), order_key, order_id, domain, size_code, msg)
  ELSE concat_ws(chr(9), order_key, order_id, domain, size_code, premium_rate, original_rate, best_rate,
                 best_channel, best_channel_name, best_impression) END AS "value"
FROM priced
UNION ALL
SELECT status, 'Output ' || status || ' results, num=' || count(*) FROM priced GROUP BY status""",
)
def sink_result_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = stored_prices(spark, sf_dir)
    path = fresh_folder(spark, "results")
    sinks.write_result_headers(results, path)
    sinks.write_results(results, path)
    return spark.read.text(path).select("status", "value")


@query(
    "sink_sql_statements",
    f"""WITH {PRICED_SQL}
SELECT CASE
  WHEN status = 'success' THEN 'update pre_order set order_price = ' || printf('%8.2f', premium_rate / 100.0::DOUBLE)
    || ', pre_state=6, mod_time=''2016-01-31'' where order_id = ''' || order_id || ''';'
  WHEN status = 'audit' THEN 'insert ignore into pre_order_audit(pre_order_id,order_id,ssp_name,ssp_url,traffic_type,'
    || 'ad_size,advice_price,adjusted_price,average_price,channel_highest_price,highest_price_channel,'
    || 'highest_price_pv,audit_status,add_time,mod_time) values('
    || order_key || ', ''' || order_id || ''',''' || ssp_name || ''',''' || domain || ''',' || traffic_type || ','
    || size_code || ',' || printf('%8.2f', premium_rate / 100.0::DOUBLE) || ',0.0,'
    || printf('%8.2f', original_rate / 100.0::DOUBLE) || ',' || printf('%8.2f', best_rate / 100.0::DOUBLE) || ','
    || best_channel || ',' || best_impression || ',0,''2016-01-31'',''2016-01-31'');'
  ELSE 'update pre_order set pre_state=7, mod_time=''2016-01-31'' where order_id = ''' || order_id || ''';'
  END AS "value"
FROM priced""",
)
def sink_sql_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "statements")
    sinks.write_statements(priced(spark, sf_dir), "2016-01-31", path)
    return spark.read.text(path)


@query(
    "mock_orders",
    f"""WITH {STATS_SQL}
SELECT DISTINCT CAST(1 AS BIGINT) AS order_key, 'PD' AS order_id, 'xxx.com' AS ssp_name, domain,
  0 AS creative_styles, CAST(0 AS BIGINT) AS size_code, 0 AS dsp_id, 'DSP' AS dsp_name
FROM stats""",
)
def mock_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "mock-orders")
    sinks.write_tsv(pricing.mock_orders(stats(spark, sf_dir)), path)
    return readers.read_orders(spark, path)


@query(
    "apply_order_results",
    f"""WITH {PRICED_SQL}
SELECT 'order' AS entry, order_id, CASE WHEN status = 'success' THEN premium_rate / 100.0::DOUBLE ELSE 0 END AS price,
       CASE status WHEN 'success' THEN 6 WHEN 'fail' THEN 7 ELSE 0 END AS state,
       CASE WHEN status = 'audit' THEN '2015-12-01' ELSE '2016-01-31' END AS mod_time
FROM priced WHERE order_key % 7 <> 0
UNION ALL
SELECT 'audit', order_id, CASE WHEN order_key % 5 = 0 THEN 1.0 ELSE premium_rate / 100.0::DOUBLE END,
       CASE WHEN order_key % 5 = 0 THEN 2 ELSE 0 END,
       CASE WHEN order_key % 5 = 0 THEN '2015-12-01' ELSE '2016-01-31' END
FROM priced WHERE status = 'audit'""",
)
def apply_order_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results applied to an order table that lacks some orders and an audit table that has some entries.

    They are applied twice under one name and once more under another, which must change nothing.
    """
    results = stored_prices(spark, sf_dir)
    root = fresh_folder(spark, "order-table")
    known = order_table.new_orders(results.where("order_key % 7 <> 0"), "order_id", "2015-12-01")
    seen = order_table.audit_rows(results.where("order_key % 5 = 0"), "2015-12-01")
    seen = seen.withColumns({"advice_price": F.lit(1).cast(order_table.MONEY), "audit_status": F.lit(2)})
    tables = {order_table.ORDERS: (known, "order_id"), order_table.AUDITS: (seen, "order_id")}
    versions.create(spark, root, tables, buckets=8)
    for run in ("january", "january", "january again"):
        version = order_table.apply_results(spark, root, results, "2016-01-31", run)
    orders_now = versions.read_table(spark, root, version, order_table.ORDERS)
    audits_now = versions.read_table(spark, root, version, order_table.AUDITS)

    def shown(entry: str, df: DataFrame, price: str, state: str) -> DataFrame:
        return df.select(
            F.lit(entry).alias("entry"), "order_id", F.col(price).cast("double").alias("price"), F.col(state).alias("state"), "mod_time"
        )

    return shown("order", orders_now, "order_price", "pre_state").unionByName(shown("audit", audits_now, "advice_price", "audit_status"))


@query("observed_counts", ORACLES["status_counts"])
def observed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by outcome from the job that writes the results."""
    return sinks.write_counted(priced(spark, sf_dir), fresh_folder(spark, "priced"))
