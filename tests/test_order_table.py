"""Versioned tables, and pricing results applied to an order table."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from adflow.operators import order_table, pricing
from adflow.plans.pricing import stored_prices
from adflow.session import stored
from adflow.sources import versions
from adflow.sources.versions import VersionTaken

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
AT = "2016-01-31"


def table_of(spark, root, name, version=None):
    version = version or versions.current(spark, root)
    return sorted(map(tuple, versions.read_table(spark, root, version, name).collect()), key=repr)


def start(spark, root, results, buckets=8):
    known = order_table.new_orders(results.where("order_key % 3 <> 0"), "order_id", "2015-12-01")
    seen = order_table.audit_rows(results.where("order_key % 5 = 0"), "2015-12-01").withColumn("audit_status", F.lit(2))
    tables = {order_table.ORDERS: (known, "order_id"), order_table.AUDITS: (seen, "order_id")}
    return versions.create(spark, root, tables, buckets)


def run_statements(first_orders, first_audits, audit_columns, statements):
    """The tables after all statements have run one after the other in a database."""
    con = duckdb.connect()
    con.execute("CREATE TABLE pre_order (order_id VARCHAR PRIMARY KEY, order_price DECIMAL(18,2), pre_state INT, mod_time VARCHAR)")
    kinds = {"order_id": "VARCHAR PRIMARY KEY", "ssp_name": "VARCHAR", "ssp_url": "VARCHAR", "add_time": "VARCHAR", "mod_time": "VARCHAR"}
    money = ("advice_price", "adjusted_price", "average_price", "channel_highest_price")
    made = ", ".join(f"{c} {kinds.get(c, 'DECIMAL(18,2)' if c in money else 'BIGINT')}" for c in audit_columns)
    con.execute(f"CREATE TABLE pre_order_audit ({made})")
    for name, rows in (("pre_order", first_orders), ("pre_order_audit", first_audits)):
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", [list(r) for r in rows])
    for statement in statements:
        con.execute(statement.replace("insert ignore into", "INSERT OR IGNORE INTO"))
    return [sorted(con.execute(f"FROM {name}").fetchall(), key=repr) for name in ("pre_order", "pre_order_audit")]


def test_results_agree_with_their_statements_run_in_order(spark, folder):
    results = stored_prices(spark, SF_DIR)
    # Orders that come twice, once with another price and once as a failure.
    again = results.where("order_key % 4 = 0 AND status = 'success'").withColumn("order_key", F.col("order_key") + 10**6)
    dearer = again.withColumn("premium_rate", F.col("premium_rate") + 100)
    failed = results.where("order_key % 11 = 0 AND status = 'success'").withColumn("status", F.lit("fail"))
    results = stored(results.unionByName(dearer).unionByName(failed), "results")
    root = folder("orders")
    start(spark, root, results)
    before = [table_of(spark, root, name) for name in (order_table.ORDERS, order_table.AUDITS)]
    columns = versions.read_table(spark, root, versions.current(spark, root), order_table.AUDITS).columns
    ranked = results.withColumn("rank", F.when(F.col("status") == "success", 0).when(F.col("status") == "fail", 1).otherwise(2))
    ordered = ranked.orderBy("rank", "order_key").drop("rank")
    statements = [r["statement"] for r in pricing.price_statements(ordered, AT).collect()]
    expected = run_statements(*before, columns, statements)

    version = order_table.apply_results(spark, root, results, AT, "january")
    assert version.number == 1
    assert [table_of(spark, root, name) for name in (order_table.ORDERS, order_table.AUDITS)] == expected
    assert expected != before
    # The same run again makes no version; the same results under another name change no row.
    assert order_table.apply_results(spark, root, results, AT, "january").number == 1
    assert order_table.apply_results(spark, root, results, AT, "january, once more").number == 2
    assert [table_of(spark, root, name) for name in (order_table.ORDERS, order_table.AUDITS)] == expected
    # Old versions stay readable.
    first = versions.read_version(spark, root, 0)
    assert [table_of(spark, root, name, first) for name in (order_table.ORDERS, order_table.AUDITS)] == before


def people(spark, *rows):
    return spark.createDataFrame(rows, "id long, name string")


def test_a_change_rewrites_only_the_buckets_it_touches(spark, folder):
    root = folder("people")
    versions.create(spark, root, {"people": (people(spark, *[(i, f"n{i}") for i in range(100)], (None, "nobody")), "id")}, 16)
    base = versions.current(spark, root)
    change = people(spark, (7, "seven"))
    touched = versions.touched_buckets(change, "id", 16)
    old = versions.read_table(spark, root, base, "people", touched)
    new = versions.commit(spark, root, base, {"people": (old.where("id <> 7 OR id IS NULL").unionByName(change), touched)}, "one")
    moved = {b for b, f in new.tables["people"].folders.items() if f != base.tables["people"].folders.get(b)}
    assert moved == set(touched) and len(touched) == 1
    names = dict(table_of(spark, root, "people"))
    assert names[7] == "seven" and names[None] == "nobody" and len(names) == 101
    # A bucket that loses its rows is gone, and rows outside the named buckets are refused.
    emptied = versions.commit(spark, root, new, {"people": (old.limit(0), touched)}, "two")
    assert touched[0] not in emptied.tables["people"].folders
    with pytest.raises(ValueError, match="outside"):
        versions.commit(spark, root, emptied, {"people": (people(spark, *[(i, "x") for i in range(50)]), touched)}, "three")


def test_two_writers_of_one_version(spark, folder, monkeypatch):
    root = folder("orders")
    results = stored(stored_prices(spark, SF_DIR).where("order_key < 200"), "results")
    base = start(spark, root, results)
    versions.commit(spark, root, base, {}, "first")
    with pytest.raises(VersionTaken):
        versions.commit(spark, root, base, {}, "second")
    assert versions.current(spark, root).runs == ["first"]
    # A writer that comes second starts again from the newer version, and both changes stay.
    real, calls = versions.commit, []

    def late(*args):
        calls.append(args[-1])
        if len(calls) == 1:
            real(spark, root, versions.current(spark, root), {}, "rival")
        return real(*args)

    monkeypatch.setattr(versions, "commit", late)
    assert order_table.apply_results(spark, root, results, AT, "mine").runs == ["first", "rival", "mine"]
    assert calls == ["mine", "mine"]


def test_a_lost_draft_is_no_version(spark, folder):
    root = folder("people")
    assert versions.current(spark, root) is None
    versions.create(spark, root, {"people": (people(spark, (1, "a")).where("id > 5"), "id")}, 4)
    path, fs = versions._path(spark, root, "versions", "_draft-lost")
    fs.create(path, False).close()
    assert versions.current(spark, root).number == 0
    assert table_of(spark, root, "people") == []
    with pytest.raises(ValueError, match="no order table"):
        order_table.apply_results(spark, folder("nothing"), people(spark, (1, "a")), AT, "x")
