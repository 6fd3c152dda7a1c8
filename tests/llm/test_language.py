from __future__ import annotations

import os

import pytest
from cases import empty_table, odd_table
from pyspark.sql import functions as F

from adflow.llm import language, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
EN = "the cat and the dog went to the house with the small garden and they were happy "
FR = "le chat et le chien sont dans la maison avec une petite table pour les enfants "


def literal_grams(text: str) -> dict[str, int]:
    padded = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    padded = " " + " ".join(padded.split()) + " "
    counts: dict[str, int] = {}
    for n in (1, 2, 3):
        for i in range(len(padded) - n + 1):
            g = padded[i : i + n]
            if g.strip() and not (n == 3 and g[1] == " "):
                counts[g] = counts.get(g, 0) + 1
    return counts


def test_gram_counts_agree_with_a_literal_count():
    for text in (EN, "É a", "x", "a1b2  c", "漢字 и мир"):
        codes = language.grams(text)
        counts = sorted(dict(zip(*map(list, __import__("numpy").unique(codes, return_counts=True)))).values())
        assert counts == sorted(literal_grams(text).values())
    assert len(language.grams("12 -")) == len(language.grams("")) == 0


def test_distance_by_hand():
    import numpy as np
    import pandas as pd

    codes = language.ranked(language.grams("aab"), 10)
    rows = pd.DataFrame({"lang": "x", "code": codes[::-1], "rank": np.arange(len(codes))})
    model = language.Profiles(*language.Profiles.arrays(rows, 10))
    moved = sum(abs(2 * i - len(codes) + 1) for i in range(len(codes)))
    assert model.nearest("aab") == ("x", pytest.approx(1 - moved / (10 * len(codes))))


def test_held_out_accuracy(spark):
    got = queries.op7_language(spark, SF_DIR).where("held_out")
    truth = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    judged = got.join(truth, "doc_id").select((F.col("lang") == F.col("lang_pred")).alias("right"), "score").collect()
    assert len(judged) > 20 and sum(r["right"] for r in judged) / len(judged) > 0.97
    assert all(0 <= r["score"] <= 1 for r in judged)


def test_odd_rows(spark):
    labelled = spark.createDataFrame([(EN, "en"), (FR, "fr"), (None, "fr"), (FR, None)], "text string, lang string")
    profiles = language.learn_profiles(labelled)
    assert {r["lang"] for r in profiles.collect()} == {"en", "fr"}
    df = odd_table(spark)
    got = language.identify(df, profiles)
    assert got.columns == [*df.columns, "lang_pred", "score"] and got.count() == df.count()
    for r in got.collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and (letters or r["score"] == 0)
    texts = spark.createDataFrame([(FR.upper(),), ("happy cats and dogs in the garden",)], "text string")
    assert [r["lang_pred"] for r in language.identify(texts, profiles).collect()] == ["fr", "en"]
    none = language.learn_profiles(empty_table(spark))
    assert none.count() == 0
    assert {r["lang_pred"] for r in language.identify(texts, none).collect()} == {"und"}
    assert language.identify(empty_table(spark), profiles).count() == 0
