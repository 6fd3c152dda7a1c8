"""State machines whose events may be allowed from several states.

An event is a partial map from states to states. Maps compose associatively, so
a long walk is cut into short runs, each run becomes one map, and maps are
composed level by level, always a bounded number in one group. No task sees more
of an entity than that, however long its walk is.

A map holds for each state it may start from where the run ends and, if the run
fails, the place of the first event that was not allowed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.operators.lookups import null_safe_join
from adflow.session import stored

RUN_BITS = 8
"""A run has up to 2^8 events, and so many maps are composed at a time."""

Machine = Mapping[str, Mapping[str, str]]
"""For each event, the state it leads to from each state that allows it."""


def machine_states(machine: Machine, start: str) -> list[str]:
    """All states of a machine, the start first and the others by name."""
    named = {s for moves in machine.values() for pair in moves.items() for s in pair}
    return [start, *sorted(named - {start})]


def reversed_machine(moves: Mapping[str, tuple[str, str]]) -> Machine:
    """A machine whose events each have one state before and one after."""
    return {event: {before: after} for event, (before, after) in moves.items()}


def _numbers(values: Sequence[int]) -> Column:
    return F.expr(f"array({', '.join(map(str, values))})")


def _step_table(machine: Machine, states: Sequence[str]) -> Column:
    """Where each event leads from each state, flat; -1 where it is not allowed."""
    place = {s: i for i, s in enumerate(states)}
    return _numbers([place[moves[s]] if s in moves else -1 for moves in machine.values() for s in states])


def _end(state: Column, bad: Column) -> Column:
    return F.struct(state.cast("int").alias("state"), bad.cast("long").alias("bad"))


def _event_runs(rows: DataFrame, entity: str, machine: Machine, states: Sequence[str]) -> DataFrame:
    """(entity, node, ends): the map of each run of ordered events; takes (row, entity, code, node)."""
    size, table = len(states), _step_table(machine, states)
    steps = F.sort_array(F.collect_list(F.struct("row", "code"))).alias("steps")
    runs = rows.groupBy(entity, "node").agg(steps)

    def walk(state: Column) -> Column:
        def step(done: Column, event: Column) -> Column:
            led = F.when(event["code"] < 0, F.lit(-1)).otherwise(F.get(table, event["code"] * size + done["state"]))
            return F.when(done["state"] < 0, done).otherwise(_end(led, F.when(led < 0, event["row"])))

        return F.aggregate("steps", _end(state, F.lit(None)), step)

    return runs.select(entity, "node", F.transform(_numbers(range(size)), walk).alias("ends"))


def _composed(maps: DataFrame, entity: str, size: int) -> DataFrame:
    """The maps of each entity, ``2^RUN_BITS`` neighbours composed to one."""
    parts = F.sort_array(F.collect_list(F.struct("node", "ends"))).alias("parts")
    grouped = maps.groupBy(entity, F.shiftright("node", RUN_BITS).alias("node")).agg(parts)

    def through(state: Column) -> Column:
        def step(done: Column, part: Column) -> Column:
            return F.when(done["state"] < 0, done).otherwise(F.get(part["ends"], done["state"]))

        return F.aggregate("parts", _end(state, F.lit(None)), step)

    return grouped.select(entity, "node", F.transform(_numbers(range(size)), through).alias("ends"))


def run_machine(
    df: DataFrame,
    entity: str,
    order: Sequence[str],
    event: str,
    machine: Machine,
    start: str,
    parts: int | None = None,
) -> DataFrame:
    """(entity, valid, end_state, first_bad): whether each entity's events are a legal walk from the start state.

    ``end_state`` is NULL for a walk that fails, and ``first_bad`` has the order
    columns of the first event that is not allowed, or NULL. Unknown and NULL
    events are allowed from no state. Rows without an entity are one more
    entity. ``order`` must tell an entity's events apart, else events that tie
    come in any order. ``parts`` sets the number of ranges the rows are dealt to.
    """
    states = machine_states(machine, start)
    codes = F.create_map(*[F.lit(x) for code, name in enumerate(machine) for x in (name, code)]) if machine else None
    name = F.coalesce(F.col(event), F.lit(""))
    known = F.lit(None).cast("int") if codes is None else F.try_element_at(codes, name)
    code = F.when(F.col(event).isNull(), F.lit(-1)).otherwise(F.coalesce(known, F.lit(-1)))

    count = [] if parts is None else [parts]
    ordered = df.select(entity, *order, code.alias("_code")).repartitionByRange(*count, entity, *order)
    ordered = ordered.sortWithinPartitions(entity, *order).withColumn("_row", F.monotonically_increasing_id())
    ordered = stored(ordered, "events")

    # Runs are numbered without gaps between ranges, so that few levels bring them together.
    part, place = F.shiftright("_row", 33), F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    run = F.shiftright(place, RUN_BITS)
    most_parts, most_runs = ordered.agg(F.max(part), F.max(run)).first()
    width = (most_runs or 0).bit_length()
    node = F.shiftleft(part, width).bitwiseOR(run)
    rows = ordered.select(entity, F.col("_row").alias("row"), F.col("_code").alias("code"), node.alias("node"))
    maps = _event_runs(rows, entity, machine, states)
    for _ in range(-(-((most_parts or 0).bit_length() + width) // RUN_BITS)):
        maps = _composed(maps, entity, len(states))

    walked = maps.select(entity, F.get("ends", F.lit(0)).alias("end"))
    named = F.array(*[F.lit(s) for s in states])
    judged = walked.select(
        entity,
        (F.col("end.state") >= 0).alias("valid"),
        F.when(F.col("end.state") >= 0, F.get(named, F.col("end.state"))).alias("end_state"),
        F.col("end.bad").alias("_row"),
    )
    # The order columns of the one row that each failed walk names.
    failed = stored(judged.where(~F.col("valid")).select(entity, "_row"), "failed")
    places = ordered.select("_row", F.struct(*order).alias("first_bad")).join(failed.select("_row"), "_row")
    named_rows = null_safe_join(failed, places, ["_row"]).select(entity, "first_bad")
    return null_safe_join(judged.drop("_row"), named_rows, [entity], "left").select(entity, "valid", "end_state", "first_bad")
