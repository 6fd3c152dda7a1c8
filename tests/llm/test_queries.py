"""The registered queries of the subpackage, and the pipeline stage by stage."""

from __future__ import annotations

import hashlib
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import empty_table, odd_table
from check_oracle import difference, oracle_connection
from pyspark.sql import functions as F
from test_simhash import literal_classes, literal_print
from tokenizers import Tokenizer

import corpus_pipeline
from adflow.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_oracles(spark, key):
    got = QUERIES[key](spark, SF_DIR).toPandas()
    assert len(got) and difference(got, oracle_connection(SF_DIR).execute(ORACLES[key]).df()) is None


def test_native_queries_run_no_python(spark):
    for key in ("op2_surrogates", "op10_secrets"):
        plan = QUERIES[key](spark, SF_DIR)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_simhash_query(spark):
    got = {r["doc_id"]: r for r in QUERIES["op4_simhash"](spark, SF_DIR).collect()}
    rows = sorted((r["doc_id"], literal_print(r["text"])) for r in documents(spark).collect())
    firsts = literal_classes([f for _, f in rows], 2)
    assert len(got) == len(rows)
    for (i, f), first in zip(rows, firsts):
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{f:016x}", rows[first][0])


def test_token_queries(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] or "" for r in documents(spark).collect()}
    ids = {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    for r in QUERIES["op9_bpe"](spark, SF_DIR).collect():
        listed = ",".join(map(str, ids[r["doc_id"]]))
        assert tuple(r)[1:] == (
            len(ids[r["doc_id"]]), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest(),
        )
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op6_token_files"](spark, SF_DIR).collect()}
    start = 0
    for i in sorted(ids):
        data = np.array([*ids[i], 0], "<u4").tobytes()
        assert got[i] == (start, len(ids[i]) + 1, zlib.crc32(data))
        start += len(ids[i]) + 1


def test_shard_and_fingerprint_queries(spark):
    got = QUERIES["op8_shards"](spark, SF_DIR)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert got.groupBy("shard").count().count() == 24
    prints = QUERIES["op5_fingerprints"](spark, SF_DIR)
    share = prints.agg(F.avg((F.col("near_edited") > F.col("near_next")).cast("double"))).first()[0]
    assert share > 0.9 and prints.count() == documents(spark).count()


def test_pipeline_stages(spark):
    from adflow.session import stored

    docs, kept = documents(spark), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF_DIR), name)
        kept[name] = (before, docs)
        if name != "tokens":
            assert docs.columns == columns and docs.dtypes == before.dtypes
    before, after = kept["language"]
    assert after.count() == before.where(F.col("text").rlike(r"\p{L}")).count()
    before, after = kept["near_duplicates"]
    rows = sorted((r["doc_id"], literal_print(r["text"])) for r in before.collect())
    firsts = set(literal_classes([f for _, f in rows], 2))
    assert {r["doc_id"] for r in after.collect()} == {rows[i][0] for i in firsts}
    before, after = kept["decontamination"]
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    gone = {r["doc_id"] for r in before.collect()} - {r["doc_id"] for r in after.collect()}
    assert {r["doc_id"] for r in before.collect() if any(x in r["text"] for x in items)} <= gone
    before, after = kept["secrets"]
    old, new = ({r["doc_id"]: r for r in df.collect()} for df in (before, after))
    assert old.keys() == new.keys()
    changed = [i for i in old if old[i]["text"] != new[i]["text"]]
    assert changed and all("[SECRET]" in new[i]["text"] and new[i]["n_chars"] == len(new[i]["text"]) for i in changed)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in kept["tokens"][1].collect():
        assert r["token_ids"] == library.encode(new[r["doc_id"]]["text"], add_special_tokens=False).ids
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF_DIR).collect()} == set(new)


def test_stages_take_odd_and_empty_tables(spark):
    from adflow.session import stored

    for start in (odd_table(spark), empty_table(spark)):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF_DIR), name)
        assert (docs.count() > 0) == (start.count() > 0)
