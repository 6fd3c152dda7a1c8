"""Language identification by rank-order profiles of character n-grams.

A profile is the list of the most frequent n-grams (one to three letters, words
padded by a blank) of a language, by falling count. A document's own list is
compared with each profile by the out-of-place distance: the sum over the
document's n-grams of how far their ranks are apart, where an n-gram that the
profile lacks counts as the profile's length.

Defined cases. A text that is null or has no letter has the language ``und`` and
the score 0; so has every text if nothing was learned. Equal counts are ranked
by n-gram code, equal distances by language name. Whole texts count, however
long. Training rows with a null language are not learned from. Other columns
pass through untouched; the two new names must not be among them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adflow.llm.tables import column, flat

CODE_BITS = 18
PROFILE_SIZE = 400
UNDETERMINED = "und"
_PIECE = 1 << 20
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Whether each code point is a letter; made once, and sent along with the functions that use it."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(text: str) -> np.ndarray:
    """Codes of all n-grams of a text, one for each place where one stands."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    points = np.where(_letter_table()[points], points, np.uint32(0))
    if not points.any():
        return np.zeros(0, np.uint32)
    points = np.concatenate([np.zeros(1, np.uint32), points, np.zeros(1, np.uint32)])
    keep = points != 0
    keep[1:] |= points[:-1] != 0
    keep[0] = bool(points[1])
    padded = points[keep]
    if padded[0]:
        padded = np.concatenate([np.zeros(1, np.uint32), padded])
    a, b, c = padded[:-2], padded[1:-1], padded[2:]
    single = b[b != 0] * np.uint32(0x9E3779B1) + np.uint32(0x7F4A7C15)
    double = padded[:-1] * np.uint32(0x85EBCA77) + padded[1:] * np.uint32(0xC2B2AE3D)
    triple = (a * np.uint32(0x27D4EB2F) + b * np.uint32(0x165667B1) + c * np.uint32(0xD3A2646D))[b != 0]
    codes = np.concatenate([single, double, triple])
    codes ^= codes >> np.uint32(15)
    codes *= np.uint32(0x2C1B3C6D)
    return codes >> np.uint32(32 - CODE_BITS)


def ranked(codes: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes by falling count, then by code."""
    if not len(codes):
        return codes
    codes = np.sort(codes)
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    counts = np.diff(np.append(starts, len(codes))).astype(np.int64)
    order = np.argsort((-counts << CODE_BITS) + codes[starts])[:size]
    return codes[starts][order]


def _count(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for lang, texts in frame.groupby("lang", sort=False)["text"]:
            total = np.zeros(1 << CODE_BITS, np.int64)
            held: list[np.ndarray] = []
            size = 0
            for text in texts:
                held.append(grams(flat(text)))
                size += len(held[-1])
                if size >= _PIECE:
                    total += np.bincount(np.concatenate(held), minlength=len(total))
                    held, size = [], 0
            if held:
                total += np.bincount(np.concatenate(held), minlength=len(total))
            codes = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "code": codes, "count": total[codes]})


def learn_profiles(labelled: DataFrame, lang: str = "lang", text: str = "text", size: int = PROFILE_SIZE) -> DataFrame:
    """Profiles (lang, code, rank) from all texts of a table with labels."""
    _letter_table()
    rows = labelled.select(column(labelled, lang).cast("string").alias("lang"), column(labelled, text).alias("text"))
    counted = rows.where("lang is not null and text is not null").mapInPandas(_count, "lang string, code long, count long")
    sums = counted.groupBy("lang", "code").agg(F.sum("count").alias("count"))
    order = Window.partitionBy("lang").orderBy(F.desc("count"), "code")
    return sums.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < size).select("lang", "code", "rank")


class Profiles:
    """Learned profiles as arrays: a row of ranks for each n-gram that any profile has."""

    def __init__(self, langs: list[str], place: np.ndarray, ranks: np.ndarray, size: int):
        self.langs, self.place, self.ranks, self.size = langs, place, ranks, size

    @staticmethod
    def arrays(rows: pd.DataFrame, size: int) -> tuple[list[str], np.ndarray, np.ndarray, int]:
        langs = sorted(rows["lang"].unique())
        codes = rows["code"].to_numpy(np.int64)
        known = np.unique(codes)
        place = np.full(1 << CODE_BITS, len(known), np.int32)
        place[known] = np.arange(len(known))
        ranks = np.full((len(known) + 1, max(1, len(langs))), -1, np.int32)
        at = {lang: i for i, lang in enumerate(langs)}
        ranks[place[codes], rows["lang"].map(at).to_numpy(np.int64)] = rows["rank"]
        return langs, place, ranks, size

    def nearest(self, text: str | None) -> tuple[str, float]:
        """The language at the least distance, and one minus that distance as a share of the greatest."""
        top = ranked(grams(flat(text)), self.size)
        if not len(top) or not self.langs:
            return UNDETERMINED, 0.0
        ranks = self.ranks[self.place[top]]
        apart = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(top))[:, None]))
        distance = apart.sum(axis=0)
        best = int(np.argmin(distance))
        return self.langs[best], 1.0 - float(distance[best]) / (self.size * len(top))


def predict(docs: DataFrame, profiles: DataFrame, text: str = "text", size: int = PROFILE_SIZE) -> Column:
    """A column (lang_pred, score) for each text.

    The profiles come to the driver: at most ``size`` rows for each language.
    """
    _letter_table()
    sent = docs.sparkSession.sparkContext.broadcast(Profiles.arrays(profiles.toPandas(), size))

    @F.pandas_udf("lang_pred string, score double")
    def nearest(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Profiles(*sent.value)
        for part in texts:
            yield pd.DataFrame([model.nearest(t) for t in part], columns=["lang_pred", "score"])

    return nearest(column(docs, text).cast("string"))


def identify(docs: DataFrame, profiles: DataFrame, text: str = "text", size: int = PROFILE_SIZE) -> DataFrame:
    """All columns of the table with ``lang_pred`` and ``score``."""
    guess = predict(docs, profiles, text, size)
    return docs.select("*", guess.alias("_guess")).select(*[column(docs, c) for c in docs.columns], "_guess.*")


