"""Session building and the shared folder that jobs write to."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def local_session(cpus: str | int = "*", app: str = "adflow", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", os.environ.get("ADFLOW_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A session in one JVM (``local[...]``) that names none gets a folder of its
    own, which is removed when Python ends. A cluster session must name one: a
    machine-local folder would lose data with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        folder = tempfile.mkdtemp(prefix="adflow-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_folders[context.applicationId] = folder
    return _local_folders[context.applicationId]


def run_folder(spark: SparkSession) -> str:
    """The folder of all that this application writes between its steps."""
    return f"{shared_folder(spark)}/adflow/{spark.sparkContext.applicationId}"


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path below the run's folder that nothing else uses."""
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def folder_exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def remove_written(spark: SparkSession) -> None:
    """Remove the run's folder. Call it when a run has written its results."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


SMALL_GROUPS = 4 << 20
"""Row groups of this size let many tasks read what few tasks have written."""


def stored(df: DataFrame, label: str, group_bytes: int | None = None) -> DataFrame:
    """The table written to the shared folder and read back.

    This cuts the lineage for good: a lost executor costs a read, not the jobs
    before. It also tells the planner how large the table is, so it broadcasts
    the table if it is small and shuffles if it is not. A table that is read many
    times can have row groups of its own size.
    """
    path = fresh_folder(df.sparkSession, label)
    writer = df.write if group_bytes is None else df.write.option("parquet.block.size", group_bytes)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
