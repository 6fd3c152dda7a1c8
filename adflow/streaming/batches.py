"""Stream sources, triggers and per-batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adflow.functions.text import words
from adflow.session import stored


def text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of the text files that arrive in a folder."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def parquet_stream(spark: SparkSession, path: str, schema: str, max_files: int | None = None) -> DataFrame:
    """Rows of the Parquet files that arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def id_stream(spark: SparkSession, rows_per_batch: int, start: int = 0, partitions: int | None = None) -> DataFrame:
    """Ids without end, ``start`` first, so many in each micro-batch; a restart goes on where the checkpoint ends."""
    reader = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch)
    if partitions is not None:
        reader = reader.option("numPartitions", partitions)
    return reader.load().select((F.col("value") + start).alias("id"))


def run_until(query: StreamingQuery, batches: int) -> None:
    """Stop a stream without end once so many micro-batches are written."""
    try:
        while query.isActive and (query.lastProgress is None or query.lastProgress["batchId"] + 1 < batches):
            query.awaitTermination(0.05)
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()


def micro_batch(seconds: int | None) -> dict:
    """Trigger arguments: a batch every so many seconds, or all there is and then stop."""
    return {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}


def drop_blacklisted(clicks: DataFrame, blacklist: DataFrame, key: str, flag: str = "blocked") -> DataFrame:
    """Rows whose key is not blocked; works on batches and streams.

    A key that the list names more than once is blocked if any entry says so.
    Entries whose flag is false block nothing. The list is reduced to blocked
    keys once, in the shared folder; every batch reads those.
    """
    blocked = blacklist.groupBy(key).agg(F.bool_or(flag).alias("_blocked")).where("_blocked").select(key)
    return clicks.join(stored(blocked, "blocked"), key, "left_anti")


def click_name(line: Column) -> Column:
    """The second field of a click line ``"time name"``; a line without one is an error."""
    name = F.get(F.split(line, " "), 1)
    return F.coalesce(name, F.raise_error(F.concat(F.lit("no name in click: "), line)).cast("string"))


def valid_click_lines(lines: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Click lines, as they came, whose name is not blocked. ``blacklist`` holds name and blocked."""
    named = lines.select("value", click_name(F.col("value")).alias("name"))
    return drop_blacklisted(named, blacklist, "name").select("value")


def count_words(df: DataFrame, text: str) -> DataFrame:
    """Count space-separated words; an empty line counts as one empty word."""
    split = df.select(F.explode(words(F.col(text), " ")).alias("word"))
    return split.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def start_per_batch(
    stream: DataFrame,
    per_batch: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    seconds: int | None = None,
) -> StreamingQuery:
    """Apply a batch operator to each micro-batch by itself and write its result.

    A batch that runs again after a failure replaces its own folder, so each
    batch is written once. No state passes from batch to batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        per_batch(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**micro_batch(seconds)).start()


def start_word_count(
    stream: DataFrame, text: str, out: str, checkpoint: str, seconds: int | None = None
) -> StreamingQuery:
    """Words of each micro-batch with their counts."""
    return start_per_batch(stream, lambda batch: count_words(batch, text), out, checkpoint, seconds)


def start_append(
    stream: DataFrame, out: str, checkpoint: str, seconds: int | None = None
) -> StreamingQuery:
    """Append the rows of a stream to Parquet files, each row once."""
    writer = stream.writeStream.format("parquet").option("path", out)
    writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
    return writer.trigger(**micro_batch(seconds)).start()


def start_console(stream: DataFrame, checkpoint: str, rows: int = 10, seconds: int | None = None) -> StreamingQuery:
    """Print the first rows of each micro-batch."""
    writer = stream.writeStream.format("console").option("numRows", rows).option("truncate", "false")
    return writer.option("checkpointLocation", checkpoint).trigger(**micro_batch(seconds)).start()


def start_kafka(
    stream: DataFrame, value: Column, servers: str, topic: str, checkpoint: str, seconds: int | None = None
) -> StreamingQuery:
    """Send rows on to a message queue; needs the Kafka connector on the class path."""
    writer = stream.select(value.cast("string").alias("value")).writeStream.format("kafka")
    writer = writer.option("kafka.bootstrap.servers", servers).option("topic", topic)
    return writer.option("checkpointLocation", checkpoint).trigger(**micro_batch(seconds)).start()
