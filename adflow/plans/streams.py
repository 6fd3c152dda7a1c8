"""Streaming queries. Each reads what there is, ends by itself and reads its output back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adflow.plans.registry import ORACLES, query, table, text
from adflow.plans.rollups import SESSION
from adflow.session import fresh_folder
from adflow.sources import sinks
from adflow.streaming import batches, stateful


def finish(run: StreamingQuery) -> None:
    """Wait for a stream that ends by itself, and pass on its failure."""
    run.awaitTermination()


def arriving(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    """A table as a stream of files.

    The path is a pattern that only this table matches: a stream takes a plain
    path for a folder, and a table may be a single file.
    """
    return batches.parquet_stream(spark, f"{sf_dir}/[{name[0]}]{name[1:]}.parquet", schema)


def event_folder(spark: SparkSession, sf_dir: str) -> str:
    """Events as click lines ``"event_id user"`` in text files."""
    path = fresh_folder(spark, "clicks")
    line = text(F.col("event_id"), " u", F.col("user_id"))
    sinks.write_lines(table(spark, sf_dir, "events"), line, path)
    return path


def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with large errors are blocked; entries of large sign-ups carry a false flag."""
    kind = F.col("event_type")
    listed = table(spark, sf_dir, "events").where("value > 100").where(kind.isin("error", "signup"))
    return listed.select(text("u", F.col("user_id")).alias("name"), (kind == "error").alias("blocked"))


VALID_SQL = """SELECT event_id || ' u' || user_id AS "value" FROM events WHERE user_id NOT IN (
  SELECT user_id FROM events WHERE event_type = 'error' AND value > 100)"""


@query(
    "stream_text_source",
    """SELECT event_id || ' u' || user_id AS "value" FROM events""",
)
def stream_text_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = batches.text_stream(spark, event_folder(spark, sf_dir))
    out = fresh_folder(spark, "stream-lines")
    finish(batches.start_append(lines, out, fresh_folder(spark, "checkpoint")))
    return spark.read.schema("value string").parquet(out)


@query("stream_blacklist", VALID_SQL)
def stream_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = batches.text_stream(spark, event_folder(spark, sf_dir))
    valid = batches.valid_click_lines(lines, blacklist(spark, sf_dir))
    out = fresh_folder(spark, "valid-clicks")
    finish(batches.start_append(valid, out, fresh_folder(spark, "checkpoint")))
    return spark.read.schema("value string").parquet(out)


@query(
    "sink_valid_clicks",
    """SELECT event_id, user_id, event_type FROM events WHERE user_id NOT IN (
  SELECT user_id FROM events WHERE event_type = 'error' AND value > 100)""",
)
def sink_valid_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "event_id bigint, user_id bigint, event_type string"
    events = arriving(spark, sf_dir, "events", schema)
    named = events.withColumn("name", text("u", F.col("user_id")))
    valid = batches.drop_blacklisted(named, blacklist(spark, sf_dir), "name").drop("name")
    out = fresh_folder(spark, "billing")
    finish(batches.start_append(valid, out, fresh_folder(spark, "checkpoint")))
    return spark.read.schema(schema).parquet(out)


COUNTED = "word string, count bigint, batch_id bigint"


@query(
    "stream_word_count",
    """WITH w AS (
  SELECT CASE WHEN text = '' THEN [''] WHEN trim(text, ' ') = '' THEN []
              ELSE string_split(rtrim(text, ' '), ' ') END AS words FROM documents)
SELECT CAST(0 AS BIGINT) AS batch_id, word, count(*) AS "count" FROM (SELECT unnest(words) AS word FROM w) GROUP BY word""",
)
def stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = arriving(spark, sf_dir, "documents", "doc_id bigint, text string")
    out = fresh_folder(spark, "words")
    finish(batches.start_word_count(documents, "text", out, fresh_folder(spark, "checkpoint")))
    return spark.read.schema(COUNTED).parquet(out).select("batch_id", "word", "count")


@query("micro_batch_interval", 'SELECT event_type, count(*) AS "count" FROM events GROUP BY ALL')
def micro_batch_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches by the clock: the stream runs until its input is used up and is then stopped."""
    events = arriving(spark, sf_dir, "events", "event_id bigint, event_type string")
    out = fresh_folder(spark, "by-clock")

    def count(batch: DataFrame) -> DataFrame:
        return batch.groupBy("event_type").agg(F.count(F.lit(1)).alias("count"))

    run = batches.start_per_batch(events, count, out, fresh_folder(spark, "checkpoint"), seconds=1)
    try:
        run.processAllAvailable()
    finally:
        run.stop()
    counted = spark.read.schema("event_type string, count bigint, batch_id bigint").parquet(out)
    return counted.groupBy("event_type").agg(F.sum("count").alias("count"))


@query(
    "stream_running_count",
    """WITH w AS (
  SELECT CASE WHEN text = '' THEN [''] WHEN trim(text, ' ') = '' THEN []
              ELSE string_split(rtrim(text, ' '), ' ') END AS words FROM documents)
SELECT word, count(*) AS "count" FROM (SELECT unnest(words) AS word FROM w) GROUP BY word""",
)
def stream_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over documents that arrive in three parts; the stream stops and starts again before each."""
    source, out, checkpoint = [fresh_folder(spark, x) for x in ("arriving", "totals", "checkpoint")]
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    for part in range(3):
        documents.where(F.pmod("doc_id", F.lit(3)) == part).write.mode("append").parquet(source)
        stream = batches.parquet_stream(spark, source, "doc_id bigint, text string")
        finish(stateful.start_running_words(stream, "text", out, checkpoint))
    totals = stateful.count_words(documents, "text").schema
    return stateful.newest(spark, out, totals, ["word"]).select("word", "count")


@query("stream_machine", ORACLES["machine_walks"])
def stream_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions judged as events arrive: three spans of time, with a restart before each."""
    source, out, checkpoint = [fresh_folder(spark, x) for x in ("arriving", "walks", "checkpoint")]
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(seconds), F.max(seconds)).first()
    width = ((last or 0) - (first or 0)) // 3 + 1
    for part in range(3):
        span = F.floor((seconds - F.lit(first)) / F.lit(width)) == part
        events.where(span).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        run = stateful.start_walks(stream, "user_id", ["ts", "event_id"], "event_type", SESSION, "new", out, checkpoint)
        finish(run)
    walks = stateful.newest(spark, out, stateful.walk_schema(events, "user_id", ["ts", "event_id"]), ["user_id"])
    return walks.select(
        "user_id",
        "valid",
        F.coalesce("end_state", F.lit("-")).alias("end_state"),
        F.coalesce("bad_event_id", F.lit(-1)).alias("first_bad_event"),
    )


@query("stream_ids", "SELECT c_custkey, c_name FROM customer")
def stream_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers met by ids from a source without end: three batches, a restart, and as many as the ids ask for."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    most = customers.agg(F.max("c_custkey")).first()[0] or 0
    out, checkpoint = fresh_folder(spark, "ids"), fresh_folder(spark, "checkpoint")
    per_batch = most // 5 + 1
    for until in (3, 6):
        ids = batches.id_stream(spark, per_batch)
        batches.run_until(batches.start_append(ids, out, checkpoint, seconds=0), until)
    ids = spark.read.schema("id bigint").parquet(out)
    return customers.join(ids, customers["c_custkey"] == ids["id"]).select("c_custkey", "c_name")
