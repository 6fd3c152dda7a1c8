"""Whole jobs, from input paths to output paths: ``spark-submit adflow/jobs.py JOB ARG ...``."""

from __future__ import annotations

import argparse
import os
import sys

if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.streaming import StreamingQuery  # noqa: E402

from adflow.operators import model, order_table, pricing, rollups  # noqa: E402
from adflow.operators.ordering import shard_by_modulo  # noqa: E402
from adflow.session import remove_written, stored  # noqa: E402
from adflow.sources import generators, readers, sinks  # noqa: E402
from adflow.streaming import batches, stateful  # noqa: E402


def report_log(spark: SparkSession, source: str, target: str, shards: int = 10) -> None:
    """Roll up an ad log by user, plan and group, and write it in shards by group."""
    log = readers.read_strict(spark, source, readers.REPORT_LOG)
    sums = rollups.rollup(log, ["user_id", "plan_id", "group_id"], ["show", "clk", "cost"])
    sinks.write_tsv_shards(shard_by_modulo(sums, "group_id", shards), target, "shard")


def make_log(spark: SparkSession, target: str, groups: int = 1_000_000, batch_count: int = 100) -> None:
    """Write a synthetic ad log of so many groups in each of so many batches."""
    ids = spark.range(1, groups + 1)
    sinks.write_tsv(generators.report_log(ids, "id", batch_count).drop("batch"), target)


def price(
    spark: SparkSession,
    stats_path: str,
    orders_path: str,
    target: str,
    run_date: str,
    encoding: str = "GBK",
) -> DataFrame:
    """Price orders; write prices, result lines with headings, and SQL statements below a folder."""
    stats = readers.read_stats(spark, stats_path, encoding)
    orders = readers.read_orders(spark, orders_path, encoding)
    counts = sinks.write_counted(pricing.price_orders(stats, orders), f"{target}/priced")
    priced = spark.read.parquet(f"{target}/priced")
    sinks.write_result_headers(priced, f"{target}/results", counts)
    sinks.write_results(priced, f"{target}/results")
    sinks.write_outcome_messages(priced, f"{target}/messages", counts)
    sinks.write_statements(priced, run_date, f"{target}/statements")
    return priced


def apply_prices(spark: SparkSession, priced_path: str, orders: str, run_date: str, run: str) -> None:
    """Apply priced results to the versioned order table below a folder; a run that it holds has no effect."""
    order_table.apply_results(spark, orders, spark.read.parquet(priced_path), run_date, run)


def supply_side(spark: SparkSession, source: str, target: str) -> None:
    """Roll up supply-side rows by slot and domain; rejected lines are kept next to the result."""
    good, rejected = readers.read_ssp(spark, source)
    sinks.write_tsv(rollups.rollup(good, ["tu", "domain"], ["spv", "clk", "cost"]), f"{target}/sums")
    sinks.write_lines(rejected, F.col("_line"), f"{target}/rejected")


def salaries(spark: SparkSession, source: str, target: str) -> None:
    """Average salary per team, as tab-separated text."""
    teams = readers.read_strict(spark, source, readers.SALARY)
    sinks.write_tsv(rollups.avg_by_group(teams, "team", "salary"), target)


def stream_words(spark: SparkSession, source: str, target: str, checkpoint: str, seconds: int | None) -> StreamingQuery:
    """Count the words of each micro-batch of text files."""
    lines = batches.text_stream(spark, source)
    return batches.start_word_count(lines, "value", target, checkpoint, seconds)


def stream_totals(spark: SparkSession, source: str, target: str, checkpoint: str, seconds: int | None) -> StreamingQuery:
    """Count the words of all text files so far; a restart goes on from the checkpoint."""
    lines = batches.text_stream(spark, source)
    return stateful.start_running_words(lines, "value", target, checkpoint, seconds)


def stream_clicks(
    spark: SparkSession, source: str, blacklist: str, target: str, checkpoint: str, seconds: int | None
) -> StreamingQuery:
    """Pass on click lines whose name is not on the blacklist, a tab-separated ``name, true/false``."""
    fields = [readers.Field("name", 0, "string"), readers.Field("blocked", 1, "boolean")]
    listed = readers.read_strict(spark, blacklist, fields)
    valid = batches.valid_click_lines(batches.text_stream(spark, source), listed)
    return batches.start_append(valid, target, checkpoint, seconds)


SURVEY = (
    "affairs double, gender string, age double, yearsmarried double, children string, "
    "religiousness double, education double, occupation double, rating double"
)


def survey(spark: SparkSession, source: str, target: str, seed: int = 12345) -> None:
    """Fit a logistic regression on survey answers; write coefficients, loss and scored test rows."""
    answers = spark.read.csv(source, schema=SURVEY, sep="\t", mode="FAILFAST")
    features = model.assemble(model.encode(answers)).select("affairs", "features")
    train, test = model.random_split(stored(features, "survey"), seed)
    fitted = model.fit_logistic(train)
    model.coefficients(spark, fitted).write.parquet(f"{target}/coefficients")
    model.model_params(spark, fitted).write.parquet(f"{target}/params")
    model.objective_history(spark, fitted).write.parquet(f"{target}/loss")
    model.predict(fitted, test).write.parquet(f"{target}/scored")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    arguments = {
        "report-log": ["source", "target"],
        "make-log": ["target"],
        "price": ["stats", "orders", "target", "run_date"],
        "apply-prices": ["priced", "orders", "run_date", "run"],
        "supply-side": ["source", "target"],
        "salaries": ["source", "target"],
        "stream-words": ["source", "target", "checkpoint", "seconds"],
        "stream-totals": ["source", "target", "checkpoint", "seconds"],
        "stream-clicks": ["source", "blacklist", "target", "checkpoint", "seconds"],
        "survey": ["source", "target"],
    }
    for name, positions in arguments.items():
        job = jobs.add_parser(name)
        for position in positions:
            job.add_argument(position, type=int if position == "seconds" else str)
    given = vars(parser.parse_args())
    name = given.pop("job")
    values = [given[position] for position in arguments[name]]
    spark = SparkSession.builder.appName(f"adflow {name}").getOrCreate()
    runs = {
        "report-log": report_log,
        "make-log": make_log,
        "price": price,
        "apply-prices": apply_prices,
        "supply-side": supply_side,
        "salaries": salaries,
        "stream-words": lambda *a: stream_words(*a).awaitTermination(),
        "stream-totals": lambda *a: stream_totals(*a).awaitTermination(),
        "stream-clicks": lambda *a: stream_clicks(*a).awaitTermination(),
        "survey": survey,
    }
    try:
        runs[name](spark, *values)
    finally:
        remove_written(spark)
        spark.stop()


if __name__ == "__main__":
    main()
