from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from adflow import jobs
from adflow.sources import readers, sinks


def lines_of(spark, path):
    return sorted(r["value"] for r in spark.read.text(path).collect())


def write(spark, folder, *lines):
    path = folder("lines")
    sinks.write_lines(spark.createDataFrame([(x,) for x in lines], "line string"), F.col("line"), path)
    return path


def test_report_log_ignores_extra_fields_and_stops_at_bad_ones(spark, folder):
    good = write(spark, folder, "1\t2\t3\t100\t5\t7", "1\t2\t3\t50\t1\t1\textra")
    rows = readers.read_strict(spark, good, readers.REPORT_LOG).collect()
    assert sorted(tuple(r) for r in rows) == [(1, 2, 3, 50, 1, 1), (1, 2, 3, 100, 5, 7)]
    for bad in ("1\t2\tx\t1\t1\t1", "1\t2\t3"):
        with pytest.raises(Exception, match="bad line"):
            readers.read_strict(spark, write(spark, folder, "1\t2\t3\t1\t1\t1", bad), readers.REPORT_LOG).collect()


def test_rejected_lines_are_kept(spark, folder):
    path = write(spark, folder, "1\t2\t3\t1\t1\t1", "nonsense", "")
    good, rejected = readers.read_delimited(spark, path, readers.REPORT_LOG)
    assert good.count() == 1
    assert sorted(r["_line"] for r in rejected.collect()) == ["", "nonsense"]


def test_ssp_lines(spark, folder):
    path = write(spark, folder, "7 a b x.com c 10 2 3.99", "7\ta\tb  x.com c 5 1 0.10", "7 a b x.com c 5 1", "x a b c d 1 1 1")
    good, rejected = readers.read_ssp(spark, path)
    assert sorted(tuple(r) for r in good.collect()) == [(7, "x.com", 5, 1, 10), (7, "x.com", 10, 2, 399)]
    assert rejected.count() == 2


def test_a_line_is_cut_once(spark, folder):
    """Neither the filter on good rows nor each field cuts the line again, and bad lines have no casts that fail."""
    path = write(spark, folder, "7 a b x.com c 10 2 3.99", "7 a b x.com c 10 3.99", "7 a b x.com c 10 two 3.99")
    good, rejected = readers.read_ssp(spark, path)
    for part in (good, rejected):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") == 1
        casts = plan.count("try_cast(")
        assert casts and plan.count("THEN try_cast(") == casts
    assert [tuple(r) for r in good.collect()] == [(7, "x.com", 10, 2, 399)]
    assert sorted(r["_line"] for r in rejected.collect()) == ["7 a b x.com c 10 3.99", "7 a b x.com c 10 two 3.99"]


def test_stats_filter(spark, folder):
    row = "1\t9\ta.com\t1\t{}\t{}\t5\t1\t960*60"
    path = write(spark, folder, row.format(10, 3), row.format(0, 0), row.format(2, 3), row.format(4, 4))
    got = readers.read_stats(spark, path).collect()
    assert sorted(r["impression"] for r in got) == [4, 10]
    assert {r["size_code"] for r in got} == {257698038720}


@pytest.mark.parametrize("encoding", ["UTF-8", "GBK"])
def test_encodings(spark, folder, encoding):
    path = folder("encoded")
    rows = spark.createDataFrame([("PC贴片\t1",), ("未知\t2",)], "line string")
    sinks.write_lines(rows, F.col("line"), path, encoding=encoding)
    fields = [readers.Field("name", 0, "string"), readers.Field("n", 1, "int")]
    got = readers.read_strict(spark, path, fields, encoding=encoding).collect()
    assert sorted(tuple(r) for r in got) == [("PC贴片", 1), ("未知", 2)]
    raw = spark.read.format("binaryFile").load(path).collect()
    assert b"".join(bytes(r["content"]) for r in raw).decode(encoding).count("\n") == 2


def test_tokens(spark, folder):
    path = write(spark, folder, "12 3", "  4\t5 ", "", "\t6", " \t ")
    assert sorted(r["number"] for r in readers.tokens_to_ints(readers.read_lines(spark, path)).collect()) == [3, 4, 5, 6, 12]
    with pytest.raises(Exception, match="not a number: x"):
        readers.tokens_to_ints(readers.read_lines(spark, write(spark, folder, "1 x"))).collect()


def test_line_count_prefix_and_sizes(spark, folder):
    path = write(spark, folder, *[f"{i:012d}" for i in range(20)])
    assert readers.count_lines(spark, path).first()["lines"] == 20
    heads = readers.file_prefix(spark, path, 10).collect()
    assert heads and all(bytes(r["prefix"])[:9] == b"000000000" and len(r["prefix"]) == 10 for r in heads)
    sizes = readers.read_sizes(spark, write(spark, folder, "300*250", "0")).collect()
    assert sorted(tuple(r) for r in sizes) == [("0", 0), ("300*250", 1073741824300)]


def test_tsv_keeps_nulls_as_empty_fields(spark, folder):
    path = folder("tsv")
    sinks.write_tsv(spark.createDataFrame([(1, None, "x")], "a int, b string, c string"), path)
    assert lines_of(spark, path) == ["1\t\tx"]


def test_report_log_job(spark, folder):
    source, target = folder("log"), folder("sums")
    jobs.make_log(spark, source, groups=500, batch_count=4)
    log = readers.read_strict(spark, source, readers.REPORT_LOG)
    assert log.count() == 2000
    jobs.report_log(spark, source, target)
    sums = readers.read_strict(spark, target, readers.REPORT_LOG)
    assert sums.count() == 500
    columns = [F.sum(c).alias(c) for c in ("show", "clk", "cost")]
    assert sums.agg(*columns).first() == log.agg(*columns).first()
    shards = spark.read.text(target).select(
        F.input_file_name().alias("file"), (F.split("value", "\t")[2].cast("int") % 10).alias("shard")
    )
    assert shards.groupBy("file").agg(F.count_distinct("shard").alias("n")).where("n > 1").count() == 0


def test_pricing_job(spark, folder):
    from test_pricing import AUDIT_ORDER, AUDIT_STATS

    stats, orders, target = folder("stats"), folder("orders"), folder("prices")
    for path, content in ((stats, AUDIT_STATS), (orders, AUDIT_ORDER)):
        rows = spark.createDataFrame([(x,) for x in content.splitlines()], "line string")
        sinks.write_lines(rows, F.col("line"), path, encoding="GBK")
    priced = jobs.price(spark, stats, orders, target, "2016-01-31")
    assert [(r["status"], r["ssp_name"]) for r in priced.collect()] == [("audit", "ABC网站")]
    assert lines_of(spark, f"{target}/results")[1] == "Output audit results, num=1"
    assert lines_of(spark, f"{target}/messages") == [
        "Auditable PD order num is 1", "Failed to cacludate PD order num is 0", "Successful PD order num is 0",
    ]
    assert lines_of(spark, f"{target}/statements")[0].startswith("insert ignore into pre_order_audit(")


def test_supply_side_job(spark, folder):
    source = write(spark, folder, "7 a b x.com c 10 2 3.99 ", "7 a b x.com c 5 1 0.10\t", "broken line", "8 a b y c 1 1 30000000")
    target = folder("ssp")
    jobs.supply_side(spark, source, target)
    assert lines_of(spark, f"{target}/sums") == ["7\tx.com\t15\t3\t409", "8\ty\t1\t1\t2147483647"]
    assert lines_of(spark, f"{target}/rejected") == ["broken line"]


def test_salaries_job(spark, folder):
    path = write(spark, folder, "Reds\ta\t100\tP", "Reds\tb\t200\tC", "Mets\tc\t5\tP")
    jobs.salaries(spark, path, target := folder("averages"))
    assert lines_of(spark, target) == ["Mets\t5.0", "Reds\t150.0"]
