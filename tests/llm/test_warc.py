from __future__ import annotations

import hashlib

import pytest
from cases import CLASHES
from pyspark.sql import functions as F

from adflow.llm import warc

BIG, SMALL = "é" * 500, "x" * 999


def pages(spark, rows):
    schema = "page_id long, url string, html string" + "".join(f", `{c}` string" for c in CLASHES)
    return spark.createDataFrame([(*r, *["extra"] * len(CLASHES)) for r in rows], schema)


ROWS = [
    (1, "http://a/1", BIG),
    (5, "http://a/5", BIG),
    (3, "http://a/3 x\r\ny", BIG),
    (None, "http://a/n", BIG),
    (2, None, SMALL),
    (4, "", SMALL),
    (6, "http://a/6", None),
    (7, "http://a/7", ""),
    (8, "http://a/8", "<p>" + "long " * 60_000),
    (9, "u", "twice " * 300),
    (9, "u", "twice " * 300),
]


def literal(rows):
    """(type, refers to) of each row."""
    out = []
    for i, _, html in rows:
        same = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        big = len((html or "").encode()) >= 1000 and same
        out.append(("revisit", max(same)) if big and i != max(same) else ("response", None))
    return out


def test_archive_and_back(spark, folder):
    path = folder("archive")
    warc.write_archive(pages(spark, ROWS), path)
    got = warc.read_archive(spark, path).collect()
    found = []
    for r in got:
        head, http, payload = (bytes(r[c]) for c in ("warc_header", "http_header", "payload"))
        lines = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:-2])
        body = b"" if lines["WARC-Type"] == "revisit" else payload
        assert bytes(r["record"]) == head + http + body + b"\r\n\r\n"
        assert int(lines["Content-Length"]) == len(http) + len(body)
        assert lines["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(payload).hexdigest()
        refers = lines.get("WARC-Refers-To")
        found.append((r["id"], payload, lines["WARC-Type"], refers and int(refers[len("<urn:page:") : -1])))
    expected = [(i, (h or "").encode(), *t) for (i, _, h), t in zip(ROWS, literal(ROWS))]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    uris = {bytes(r["warc_header"]).decode().split("WARC-Target-URI: ")[1].split("\r\n")[0] for r in got}
    assert {"about:blank", "http://a/3%20x%0D%0Ay"} <= uris
    payloads = spark.read.parquet(f"{path}/payloads")
    assert payloads.count() == len({(h or "") for _, _, h in ROWS})


def test_a_changed_payload_is_an_error(spark, folder):
    path, bad = folder("archive"), folder("archive")
    warc.write_archive(pages(spark, ROWS[:3]), path)
    spark.read.parquet(f"{path}/records").write.parquet(f"{bad}/records")
    changed = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.encode(F.lit("other"), "UTF-8"))
    changed.write.parquet(f"{bad}/payloads")
    with pytest.raises(Exception, match="payload missing or changed"):
        warc.read_archive(spark, bad).collect()


def test_nothing(spark, folder):
    path = folder("archive")
    warc.write_archive(pages(spark, []), path)
    assert warc.read_archive(spark, path).count() == 0
