"""Content-addressed WARC archive.

An archive is a folder of two Parquet tables. ``payloads`` holds each distinct
payload once under its SHA-256; ``records`` holds the exact bytes of each WARC
header and HTTP header, the digest of the payload, and no payload. Records are
rebuilt byte for byte by joining the two. The digest is verified when payloads
are stored (rows of one digest must agree in length and SHA-1 too) and again
when they are read (the digest of the stored bytes must be their key).

Of records with equal payloads of at least ``revisit_from`` bytes the one with
the largest id is the response and the others are revisits that refer to it;
smaller payloads are all responses.

Defined cases. A null payload is the empty one. Rows that repeat both the id and
the payload of a response are responses too. Among equal payloads a null id is
a revisit of the largest id; if all ids are null, all are responses. A null or
empty address is written as ``about:blank``; line breaks and blanks in it are
percent-encoded. An empty table makes an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adflow.llm.tables import column

REVISIT_FROM = 1000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LINE = "\r\n"


def _joined(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _uri(url: Column) -> Column:
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A"), "[ \t]", "%20")
    return F.when(F.coalesce(F.length(url), F.lit(0)) == 0, F.lit("about:blank")).otherwise(clean)


def _urn(id_: Column) -> Column:
    return _joined("<urn:page:", F.coalesce(id_.cast("string"), F.lit("none")), ">")


def warc_records(
    pages: DataFrame,
    id_column: str = "page_id",
    url: str = "url",
    payload: str = "html",
    revisit_from: int = REVISIT_FROM,
    date: str = DATE,
) -> DataFrame:
    """(id, record_type, refers_to, sha256, warc_header, http_header) of every page; payloads are not moved."""
    body = F.coalesce(column(pages, payload).cast("string"), F.lit("")).cast("binary")
    facts = pages.select(
        column(pages, id_column).alias("id"),
        column(pages, url).cast("string").alias("url"),
        F.sha2(body, 256).alias("sha256"),
        F.octet_length(body).cast("long").alias("bytes"),
    )
    firsts = facts.where(F.col("bytes") >= revisit_from).groupBy("sha256").agg(F.max("id").alias("response_id"))
    told = facts.join(firsts, "sha256", "left")
    revisit = F.col("response_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("response_id"))
    http = _joined(
        "HTTP/1.1 200 OK", _LINE, "Content-Type: text/html; charset=utf-8", _LINE,
        "Content-Length: ", F.col("bytes"), _LINE, _LINE,
    )
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    refers = F.when(
        revisit, _joined("WARC-Refers-To: ", _urn(F.col("response_id")), _LINE, "WARC-Profile: ", PROFILE, _LINE)
    ).otherwise("")
    head = _joined(
        "WARC/1.1", _LINE,
        "WARC-Type: ", F.when(revisit, "revisit").otherwise("response"), _LINE,
        "WARC-Record-ID: ", _urn(F.col("id")), _LINE,
        "WARC-Target-URI: ", _uri(F.col("url")), _LINE,
        "WARC-Date: ", date, _LINE,
        "WARC-Payload-Digest: sha256:", F.col("sha256"), _LINE,
        refers,
        "Content-Type: application/http; msgtype=response", _LINE,
        "Content-Length: ", length, _LINE, _LINE,
    )
    return told.select("id", "sha256", head.cast("binary").alias("warc_header"), http.cast("binary").alias("http_header"))


def distinct_payloads(rows: DataFrame, payload: str) -> DataFrame:
    """(sha256, payload) once for each distinct payload; raises if a digest stands for two payloads."""
    body = F.coalesce(column(rows, payload).cast("string"), F.lit("")).cast("binary")
    marked = rows.select(
        F.sha2(body, 256).alias("sha256"), F.octet_length(body).alias("bytes"), F.sha1(body).alias("sha1"), body.alias("payload")
    )
    # Copies meet by all three marks; two rows left under one digest are a collision.
    return marked.dropDuplicates(["sha256", "bytes", "sha1"])


def write_archive(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url: str = "url",
    payload: str = "html",
    revisit_from: int = REVISIT_FROM,
) -> None:
    """Write the archive of a table of pages to a new folder."""
    spark = pages.sparkSession
    zstd = {"compression": "zstd"}
    warc_records(pages, id_column, url, payload, revisit_from).write.options(**zstd).parquet(f"{folder}/records")
    distinct_payloads(pages, payload).write.options(**zstd).parquet(f"{folder}/payloads")
    marks = spark.read.parquet(f"{folder}/payloads").select("sha256")
    twice = marks.groupBy("sha256").agg(F.count("*").alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"two payloads have the digest {twice[0]['sha256']}")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """(id, warc_header, http_header, payload, record) of every record, rebuilt from the tables.

    ``payload`` is the full payload also of a revisit; ``record`` has the exact
    bytes of the record, in which a revisit has none. A payload that is missing
    or whose digest is not its key is an error.
    """
    records = spark.read.parquet(f"{folder}/records")
    payloads = spark.read.parquet(f"{folder}/payloads").select("sha256", "payload")
    broken = F.raise_error(F.concat(F.lit("payload missing or changed: "), F.col("sha256"))).cast("binary")
    checked = F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload")).otherwise(broken)
    joined = records.join(payloads, "sha256", "left").withColumn("payload", checked)
    revisit = header(F.col("warc_header"), "WARC-Type") == "revisit"
    end = F.lit(_LINE * 2).cast("binary")
    body = F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload"))
    record = F.concat(F.col("warc_header"), F.col("http_header"), body, end)
    return joined.select("id", "sha256", "warc_header", "http_header", "payload", record.alias("record"))


def header(block: Column, name: str) -> Column:
    """A field of a header block; null if it is not there."""
    found = F.regexp_extract(block.cast("string"), f"\\n{name}: ([^\\r\\n]*)\\r", 1)
    return F.when(found != "", found)
