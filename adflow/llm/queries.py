"""The registered queries of this subpackage, each on its whole table, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adflow.llm import (
    bpe,
    credentials,
    decontaminate,
    divergence,
    fingerprints,
    jaccard,
    language,
    prefix_trie,
    shards,
    simhash,
    surrogates,
    token_files,
    warc,
)
from adflow.session import fresh_folder, stored

Query = Callable[[SparkSession, str], DataFrame]

FOLDS = 5
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "archive")
    warc.write_archive(read(spark, sf_dir, "pages"), folder)
    records = warc.read_archive(spark, folder)
    head = F.col("warc_header")
    return records.select(
        F.col("id").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        warc.header(head, "WARC-Type").alias("record_type"),
        F.regexp_extract(warc.header(head, "WARC-Refers-To"), "<urn:page:(.*)>", 1).cast("long").alias("refers_to"),
    )


OP1_SQL = """WITH marked AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
         coalesce(html, '') AS html FROM pages),
firsts AS (SELECT html, max(page_id) AS response_id FROM marked WHERE payload_bytes >= 1000 GROUP BY html)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN response_id IS NOT NULL AND response_id IS DISTINCT FROM page_id
         THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response_id IS DISTINCT FROM page_id THEN response_id END AS refers_to
FROM marked LEFT JOIN firsts USING (html)"""


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs)


def op3_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return decontaminate.find_leaks(docs.select("doc_id", "text"), benchmark)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, shingle=3, distance=2)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    terms = stored(fingerprints.lexicon(docs), "lexicon")
    compared = fingerprints.compare_edits(docs, terms)
    return compared.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "token-files")
    token_files.write_token_files(read(spark, sf_dir, "documents").select("doc_id", "text"), folder, TOKENIZER)
    back = token_files.read_token_files(spark, folder)
    return back.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0
    marked = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    profiles = stored(language.learn_profiles(marked.where(~F.col("held_out"))), "profiles")
    found = language.identify(marked.select("doc_id", "held_out", "text"), profiles)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.assign_shards(read(spark, sf_dir, "documents").select("doc_id", "text"), shards=24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    back = bpe.encode_and_decode(docs, TOKENIZER)
    listed = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return back.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = credentials.find_secrets(docs, ["doc_id"], repository="doc_id", owner="source")
    spans = F.col("secrets")
    base = F.filter(spans, lambda s: s["kind"] < 3)

    def count(test) -> Column:
        return F.size(F.filter(spans, test)).cast("long")

    return found.select(
        "doc_id",
        count(lambda s: s["kind"] == 0).alias("n_assign"),
        count(lambda s: s["kind"] == 1).alias("n_access"),
        count(lambda s: s["kind"] == 2).alias("n_hex"),
        F.sha2(credentials.written(base), 256).alias("base_sha256"),
        credentials.written(spans).alias("spans"),
        count(lambda s: s["live"]).alias("n_owner_specific"),
        count(lambda s: ~s["live"]).alias("n_copied"),
    )


def _spans_sql(kind: int, pattern: str, value: str, keep: str) -> str:
    """Spans of one kind: the lengths of the texts between matches and of the matches, added up."""
    return f"""
  SELECT doc_id, source, {kind} AS kind, here + gap AS "start", here + gap + length(found) AS "end", {value} AS value
  FROM (
    SELECT *, coalesce(sum(gap + length(found)) OVER (
      PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS here
    FROM (
      SELECT doc_id, source, unnest(regexp_extract_all(text, '{pattern}')) AS found,
             unnest([length(g) FOR g IN regexp_split_to_array(text, '{pattern}')[:-2]]) AS gap,
             unnest(range(len(regexp_extract_all(text, '{pattern}')))) AS i
      FROM documents WHERE regexp_matches(text, '{pattern}')))
  WHERE {keep}"""


_KEYS = "|".join("".join(f"[{c.upper()}{c}]" for c in word) for word in ("password", "passwd", "secret", "token"))
_ASSIGN_SQL = (
    f"({_KEYS}|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)
_ASSIGNED = f"regexp_extract(found, '{_ASSIGN_SQL}', 2)"
_MIXED = " AND ".join(f"regexp_matches(found, '{c}')" for c in ("[A-Z]", "[a-z]", "[0-9]"))
_SPANS = [
    _spans_sql(0, _ASSIGN_SQL, _ASSIGNED, f"length({_ASSIGNED}) >= 12"),
    _spans_sql(1, "AKIA[A-Z0-9]+", "found", "length(found) >= 18"),
    _spans_sql(2, "[0-9a-f]+", "found", "length(found) >= 16"),
    _spans_sql(3, credentials.WIDE, "found", _MIXED),
]
OP10_SQL = f"""WITH spans AS ({" UNION ALL ".join(_SPANS)}),
owned AS (
  SELECT value, count(DISTINCT coalesce('=' || source, '')) <= {credentials.MAX_OWNERS} AS live
  FROM spans GROUP BY value),
told AS (
  SELECT s.*, live, ['assign', 'access', 'hex', 'live'][kind + 1] || ':' || "start" || ':' || "end" AS written
  FROM spans s JOIN owned USING (value)),
kept AS (
  SELECT * FROM told t WHERE kind < 3 OR (live AND NOT EXISTS (
    SELECT 1 FROM told b WHERE b.doc_id = t.doc_id AND b.kind < 3 AND b."start" < t."end" AND t."start" < b."end"))),
sums AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex,
         string_agg(written, ',' ORDER BY "start", kind) FILTER (kind < 3) AS base,
         string_agg(written, ',' ORDER BY "start", kind) AS spans,
         count(*) FILTER (live) AS n_owner_specific, count(*) FILTER (NOT live) AS n_copied
  FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_owner_specific, 0) AS n_owner_specific, coalesce(n_copied, 0) AS n_copied
FROM documents d LEFT JOIN sums USING (doc_id)"""


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents").select("text", "lang", "source"))


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_SHARE_SQL = "(1 + 1000000000::HUGEINT * ({count} + 1) // ({total} + v))"
OP11_SQL = f"""WITH docs AS (
  SELECT row_number() OVER () AS doc, translate(coalesce(text, ''), {_LOWER}) AS text,
         coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
words AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS lang_count FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= {divergence.LEAST_DOCS}),
langs AS (SELECT lang, count(*) AS v, sum(lang_count) AS lang_total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
         {_SHARE_SQL.format(count="coalesce(n, 0)", total="coalesce(total, 0)")} AS p,
         {_SHARE_SQL.format(count="lang_count", total="lang_total")} AS lang_p
  FROM groups g JOIN kept k USING (lang) JOIN langs USING (lang)
  LEFT JOIN totals USING (lang, source) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - lang_p) * (p - lang_p) // lang_p AS value
  FROM shares WHERE n > 0 AND p > lang_p),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (FROM every UNION ALL FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP}"""


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations"))


def op13_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(read(spark, sf_dir, "documents").select("doc_id", "text"))


_CRC_STEP = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), "
    f"lambda d: ord(d)::BIGINT)), lambda c, b: {_CRC_STEP}), 4294967295)"
)
OP12_SQL = f"""WITH turns AS (
  SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(said ORDER BY place) AS said, {_CRC} % {prefix_trie.HEADS} AS h FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.said[1:c.h], []), c.said[c.h + 1:]) AS said
  FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % {prefix_trie.BASE}),
members AS (
  SELECT conv_id, len(said) AS length, depth, said[1:depth] AS path
  FROM (SELECT *, unnest(range(len(said) + 1)) AS depth FROM rebuilt)),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length = depth) AS ends,
         CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(path[-1].text, '[^\x20\x09-\x0D]+')) END AS words
  FROM members GROUP BY path, depth),
children AS (
  SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
told AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (path)),
above AS (SELECT *, path[1:unnest(range(depth + 1))] AS top FROM told),
sums AS (
  SELECT top AS path, sum((n_convs - 1) * words) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM above GROUP BY ALL)
SELECT t.conv_id, t.depth, p.conv_id AS parent_conv_id, t.n_convs, t.n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(t.ends, '')) AS ends_sha256
FROM told t JOIN sums s USING (path) LEFT JOIN nodes p ON t.depth > 0 AND p.path = t.path[1:t.depth - 1]"""


QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_surrogates": op2_surrogates,
    "op3_leaks": op3_leaks,
    "op4_simhash": op4_simhash,
    "op5_fingerprints": op5_fingerprints,
    "op6_token_files": op6_token_files,
    "op7_language": op7_language,
    "op8_shards": op8_shards,
    "op9_bpe": op9_bpe,
    "op10_secrets": op10_secrets,
    "op11_divergence": op11_divergence,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_jaccard": op13_jaccard,
}

ORACLES: dict[str, str] = {
    "op1_warc": OP1_SQL,
    "op10_secrets": OP10_SQL,
    "op11_divergence": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
}
