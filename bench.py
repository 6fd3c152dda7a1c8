"""Time headline queries: prints one JSON line.

Each query runs once to warm up and twice more; the better time counts. All
rows are computed and none are kept (``noop`` sink); a query that writes or
streams does its work when it is built, and that time counts too.
"""

from __future__ import annotations

import contextlib
import io
import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adflow.functions.numbers import draw_unit  # noqa: E402
from adflow.operators.rollups import estimate_pi  # noqa: E402
from adflow.plans.catalog import QUERIES  # noqa: E402
from adflow.session import local_session, remove_written  # noqa: E402

HEADLINES = [
    "tpch_q1",
    "avg_by_group",
    "report_log_rollup",
    "shard_by_modulo",
    "price_orders",
    "top_share_rate",
    "argmax_channel",
    "word_count_clean",
    "set_difference",
    "ledger_total",
    "validate_transitions",
    "contiguous_pages",
    "collect_by_store",
    "favorite_movies",
    "lookup_default",
    "sort_desc",
    "parse_report_log",
    "gen_report_log",
    "monte_carlo_pi",
    "stream_word_count",
    "stream_blacklist",
    "ml_fit_logistic",
]


def hundred_million_points(spark: SparkSession, _: str) -> DataFrame:
    """The Monte Carlo estimate at the size of the baseline, without an input table."""
    points = spark.range(100_000_000)
    x, y = [draw_unit(F.col("id"), seed) * 2 - 1 for seed in (1, 2)]
    return estimate_pi(points, x, y)


def seconds(run: Callable[[SparkSession, str], DataFrame], spark: SparkSession, sf_dir: str) -> float:
    began = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "adflow-bench", spark__sql__shuffle__partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    runs = {key: QUERIES[key] for key in HEADLINES}
    runs["monte_carlo_pi_1e8"] = hundred_million_points
    times = {}
    for key, run in runs.items():
        with contextlib.redirect_stdout(io.StringIO()):
            seconds(run, spark, sf_dir)
            times[key] = round(min(seconds(run, spark, sf_dir) for _ in range(2)), 3)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus),
    }
    remove_written(spark)
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
