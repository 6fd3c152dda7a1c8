"""Streams that remember: running counts and state machines, kept in the state store between batches.

A stream that is stopped and started again with its checkpoint goes on from its
state. Each micro-batch writes the keys that changed to a folder of its own, in
overwrite mode, so a batch that runs again replaces what it wrote; ``newest``
reads the result as of the last batch.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from adflow.streaming.batches import count_words, micro_batch

# The processor runs in Python workers, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_KEY = "_entity"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocks_store(spark: SparkSession):
    """Streams that start inside keep their state in RocksDB, on disk and not on the heap."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def start_changes(changed: DataFrame, out: str, checkpoint: str, seconds: int | None = None) -> StreamingQuery:
    """Write the keys that each micro-batch changes, with their new values."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    with rocks_store(changed.sparkSession):
        writer = changed.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
        return writer.trigger(**micro_batch(seconds)).start()


def newest(spark: SparkSession, out: str, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """Each key with its values of the last batch that changed it."""
    values = [c for c in schema.names if c not in keys]
    rows = spark.read.schema(StructType([*schema.fields, StructField("batch_id", LongType())])).parquet(out)
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_last"))
    return last.select(*keys, "_last.*")


def start_running_words(stream: DataFrame, text: str, out: str, checkpoint: str, seconds: int | None = None) -> StreamingQuery:
    """Words with their counts since the stream first began."""
    return start_changes(count_words(stream, text), out, checkpoint, seconds)


class _Walk(StatefulProcessor):
    """The last state of each entity, and where its walk went wrong."""

    def __init__(self, machine: Mapping[str, Mapping[str, str]], start: str, order: Sequence[str], event: str, state: StructType):
        self._machine, self._start, self._order, self._event, self._schema = machine, start, list(order), event, state

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._value = handle.getValueState("walk", self._schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state, events, bad = self._start, 0, [None] * len(self._order)
        if self._value.exists():
            state, events, *bad = self._value.get()
        steps = pd.concat(list(rows)).sort_values(self._order)
        for event, *place in steps[[self._event, *self._order]].itertuples(index=False, name=None):
            events += 1
            if state is not None:
                state = self._machine.get(event, {}).get(state)
                bad = bad if state is not None else place
        bad = [None if b is None else b.item() if hasattr(b, "item") else b for b in bad]
        self._value.update((state, int(events), *bad))
        names = [_KEY, "valid", "end_state", "events", *[f"bad_{c}" for c in self._order]]
        yield pd.DataFrame([[*key, state is not None, state, int(events), *bad]], columns=names)

    def close(self) -> None:
        pass


def walk_schema(stream: DataFrame, entity: str, order: Sequence[str]) -> StructType:
    """The columns of ``walks``: entity, valid, end_state, events, and bad_<order column> of the first bad event."""
    places = [StructField(f"bad_{c}", stream.schema[c].dataType) for c in order]
    end = [StructField("valid", BooleanType()), StructField("end_state", StringType()), StructField("events", LongType())]
    return StructType([StructField(entity, stream.schema[entity].dataType), *end, *places])


def walks(
    stream: DataFrame,
    entity: str,
    order: Sequence[str],
    event: str,
    machine: Mapping[str, Mapping[str, str]],
    start: str,
) -> DataFrame:
    """The walk of each entity so far, for entities with new events.

    Events of one batch are taken in order; those of a later batch come after
    all earlier ones. Verdicts are those of ``machines.run_machine`` over all
    events, however they are cut into batches that keep their order.
    """
    out = walk_schema(stream, entity, order)
    state = StructType([out["end_state"], out["events"], *[out[f"bad_{c}"] for c in order]])
    # Entities are keys as text, so that NULL is one like others.
    steps = stream.select(F.to_json(F.struct(entity)).alias(_KEY), *order, event)
    named = StructType([StructField(_KEY, StringType()), *out.fields[1:]])
    found = steps.groupBy(_KEY).transformWithStateInPandas(
        statefulProcessor=_Walk(dict(machine), start, order, event, state),
        outputStructType=named,
        outputMode="Update",
        timeMode="None",
    )
    own = F.from_json(_KEY, StructType([out[entity]]))[entity].alias(entity)
    return found.select(own, *out.names[1:])


def start_walks(
    stream: DataFrame,
    entity: str,
    order: Sequence[str],
    event: str,
    machine: Mapping[str, Mapping[str, str]],
    start: str,
    out: str,
    checkpoint: str,
    seconds: int | None = None,
) -> StreamingQuery:
    """Write the walk of each entity that a micro-batch brings events of."""
    return start_changes(walks(stream, entity, order, event, machine, start), out, checkpoint, seconds)
