"""A corpus pipeline: language, near-duplicates, benchmark leaks, secrets, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result to the shared folder and reads it again as the next stage's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adflow.llm import bpe, credentials, decontaminate, language, simhash
from adflow.llm.tables import column
from adflow.session import stored

MIN_SCORE = 0.2
"""Texts below this likeness to every language's profile are no prose of a known language."""


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; null texts and texts without a letter go."""
    profiles = stored(language.learn_profiles(docs), "profiles")
    guess = language.predict(docs, profiles)
    kept = (guess["lang_pred"] != language.UNDETERMINED) & (guess["score"] >= MIN_SCORE)
    return docs.where(kept).select(*[column(docs, c) for c in docs.columns])


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the smallest id."""
    return simhash.deduplicated(docs, shingle=3, distance=2)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_live_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with owner-specific secrets masked; a text that changes gets its new length."""
    return credentials.mask_secrets(docs, length="n_chars")


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, token_ids, decoded_sha256) of every document."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    back = bpe.encode_and_decode(docs.select("doc_id", "text"), path)
    return back.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        "token_ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", mask_live_secrets),
    ("tokens", encode_tokens),
]

ORACLE_SQL = None
"""SQL cannot express stages that learn, hash by XXH64 or encode; tests compare them with brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
