"""Tables that change in versions.

A version is a small file that names, for each table and bucket of its key, the
folder with the rows. Writers add folders and then rename the new version's file
into place, which fails if another writer was there first; readers see the
version before or the one after, never a part. Buckets without a change keep
their folder, so a change rewrites the buckets it touches and no others.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 64


class VersionTaken(Exception):
    """Another writer has made the next version."""


@dataclass
class Table:
    """One table of a version: its key, its columns and the folder of each bucket that has rows."""

    key: str
    schema: dict
    buckets: int
    folders: dict[int, str] = field(default_factory=dict)


@dataclass
class Version:
    number: int
    runs: list[str]
    """The runs whose changes this version holds."""
    tables: dict[str, Table]


def _hadoop(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.hadoop.fs


def _path(spark: SparkSession, *parts: str):
    path = _hadoop(spark).Path("/".join(parts))
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _file(number: int) -> str:
    return f"versions/{number:012d}.json"


def current(spark: SparkSession, root: str) -> Version | None:
    """The newest version below a folder, or None if there is none."""
    path, fs = _path(spark, root, "versions")
    if not fs.exists(path):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_"))]
    return read_version(spark, root, max(numbers)) if numbers else None


def read_version(spark: SparkSession, root: str, number: int) -> Version:
    path, fs = _path(spark, root, _file(number))
    stream = fs.open(path)
    try:
        told = json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
    tables = {
        name: Table(t["key"], t["schema"], t["buckets"], {int(b): f for b, f in t["folders"].items()})
        for name, t in told["tables"].items()
    }
    return Version(number, told["runs"], tables)


def _publish(spark: SparkSession, root: str, version: Version) -> None:
    """Write a version's file under another name and rename it, unless its name is taken."""
    told = {"runs": version.runs, "tables": {n: vars(t) for n, t in version.tables.items()}}
    draft, fs = _path(spark, root, "versions", f"_draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(told).encode()))
    finally:
        stream.close()
    final, _ = _path(spark, root, _file(version.number))
    if fs.exists(final):
        fs.delete(draft, False)
        raise VersionTaken(version.number)
    context = _hadoop(spark).FileContext.getFileContext(draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = getattr(_hadoop(spark), "Options$Rename")
    try:
        context.rename(draft, final, spark.sparkContext._gateway.new_array(rename, 0))
    except Exception as error:
        if "FileAlreadyExists" not in str(error):
            raise
        fs.delete(draft, False)
        raise VersionTaken(version.number) from error


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket of a key; NULL is a key like others."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def touched_buckets(changes: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets that rows fall into: at most as many numbers as there are buckets."""
    return sorted(r[0] for r in changes.select(bucket_of(F.col(key), buckets)).distinct().collect())


def read_table(spark: SparkSession, root: str, version: Version, name: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """The rows of a table as of a version; of some buckets if these are named."""
    table = version.tables[name]
    schema = StructType.fromJson(table.schema)
    folders = [f for b, f in sorted(table.folders.items()) if buckets is None or b in buckets]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{f}" for f in folders])


def _written(root: str, name: str, table: Table, rows: DataFrame, buckets: Sequence[int]) -> Table:
    """The table with the given buckets replaced by the rows, which go to a new folder."""
    spark, folder = rows.sparkSession, f"data/{name}-{uuid.uuid4().hex}"
    label = "_bucket"
    while label in rows.columns:
        label = f"_{label}"
    keyed = rows.withColumn(label, bucket_of(F.col(table.key), table.buckets))
    keyed.hint("rebalance", F.col(label)).write.partitionBy(label).parquet(f"{root}/{folder}")
    path, fs = _path(spark, root, folder)
    made = [s.getPath().getName() for s in fs.listStatus(path)]
    fresh = {int(n.split("=")[1]): f"{folder}/{n}" for n in made if n.startswith(f"{label}=")}
    if not set(fresh) <= set(buckets):
        raise ValueError(f"rows outside the buckets of the change: {sorted(set(fresh) - set(buckets))}")
    kept = {b: f for b, f in table.folders.items() if b not in set(buckets)}
    return Table(table.key, table.schema, table.buckets, kept | fresh)


def create(spark: SparkSession, root: str, tables: Mapping[str, tuple[DataFrame, str]], buckets: int = BUCKETS) -> Version:
    """The first version of some tables, each with its key."""
    made = {}
    for name, (rows, key) in tables.items():
        empty = Table(key, rows.schema.jsonValue(), buckets)
        made[name] = _written(root, name, empty, rows, range(buckets))
    version = Version(0, [], made)
    _publish(spark, root, version)
    return version


def commit(
    spark: SparkSession, root: str, base: Version, changes: Mapping[str, tuple[DataFrame, Sequence[int]]], run: str
) -> Version:
    """The version after ``base``: some buckets of some tables replaced, all at once.

    Raises ``VersionTaken`` if another writer has followed ``base`` already; the
    caller then starts again from the newest version.
    """
    tables = dict(base.tables)
    for name, (rows, buckets) in changes.items():
        if buckets:
            tables[name] = _written(root, name, tables[name], rows, buckets)
    version = Version(base.number + 1, [*base.runs, run], tables)
    _publish(spark, root, version)
    return version

