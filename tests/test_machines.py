"""General state machines against a sequential walk."""

from __future__ import annotations

import random

import pytest

from adflow.operators import machines
from adflow.operators.machines import reversed_machine, run_machine
from adflow.operators.sequences import PHASE_CHANGES, validate_transitions


def literal_walk(machine, events, start):
    """(valid, end state, place of the first event that is not allowed) of ordered (place, event) pairs."""
    state = start
    for place, event in events:
        state = machine.get(event, {}).get(state)
        if state is None:
            return False, None, place
    return True, state, None


def results(df, machine, start, parts=None):
    got = run_machine(df, "who", ["seq"], "event", machine, start, parts).collect()
    return {r["who"]: (r["valid"], r["end_state"], r["first_bad"] and r["first_bad"]["seq"]) for r in got}


@pytest.mark.parametrize("seed", range(4))
def test_random_machines_at_any_number_of_ranges(spark, monkeypatch, seed):
    monkeypatch.setattr(machines, "RUN_BITS", 2)  # runs of four events: several levels of maps
    rng = random.Random(seed)
    states = [f"s{i}" for i in range(rng.randint(2, 6))]
    machine = {f"e{i}": {s: rng.choice(states) for s in states if rng.random() < 0.95} for i in range(5)}
    rows = [(99, 0, "e9")]
    for who in [None, *range(14)]:
        for seq in range(rng.choice([1, 2, 5, 30, 200])):
            odd = rng.random() < 0.002
            rows.append((who, seq, rng.choice([None, "", "e9"]) if odd else f"e{rng.randrange(5)}"))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "who int, seq int, event string")
    people = {who for who, _, _ in rows}
    expected = {p: literal_walk(machine, sorted((s, e) for who, s, e in rows if who == p), "s0") for p in people}
    assert {v[0] for v in expected.values()} == {True, False}
    for parts in (1, 3, 8):
        assert results(df, machine, "s0", parts) == expected


def test_one_long_walk_is_cut(spark, monkeypatch):
    monkeypatch.setattr(machines, "RUN_BITS", 3)
    machine = {"go": {"a": "b", "b": "c", "c": "a"}, "back": {"b": "a"}}
    df = spark.range(5000).selectExpr("1 AS who", "CAST(id AS INT) AS seq", "'go' AS event")
    assert results(df, machine, "a", 6) == {1: (True, "c", None)}
    broken = df.selectExpr("who", "seq", "CASE WHEN seq = 4321 THEN 'back' ELSE event END AS event")
    expected = literal_walk(machine, [(i, "back" if i == 4321 else "go") for i in range(5000)], "a")
    assert results(broken, machine, "a", 6) == {1: expected}


def test_phase_changes_agree_with_the_special_form(spark):
    rng = random.Random(8)
    names = list(PHASE_CHANGES)
    rows = [(w, i, rng.choice(names)) for w in range(200) for i in range(rng.randint(1, 4))]
    rows += [(900, i, e) for i, e in enumerate(["Melting", "Vaporization", "Ionization", "Deionization"])]
    df = spark.createDataFrame(rows, "who int, seq int, event string")
    special = validate_transitions(df, "who", ["seq"], "event", "solid").collect()
    general = results(df, reversed_machine(PHASE_CHANGES), "solid")
    assert {r["who"]: r["valid"] for r in special} == {w: v[0] for w, v in general.items()}
    assert general[900] == (True, "vapor", None)


def test_nothing_to_walk(spark):
    empty = spark.createDataFrame([], "who int, seq int, event string")
    assert results(empty, {"go": {"a": "b"}}, "a") == {}
    some = spark.createDataFrame([(1, 1, "go")], "who int, seq int, event string")
    assert results(some, {}, "a") == {1: (False, None, 1)}
