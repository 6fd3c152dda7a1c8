"""Source divergence audit: which terms, and which other sources, set a source apart from its language.

Terms travel as 64-bit digests. The counts of each (language, source, term) are
shuffled with digests alone; the texts of terms stay behind and are joined back
for the few rows of the output. A digest that is kept has its smallest and its
largest text compared: where they differ, terms collided, and these digests are
counted once more with their texts and split by a number after the digest.

Shares are integers: a share is ``1 + floor(10^9 * (count + 1) / (N + V))``, and
the divergence of a term is ``floor((p - q)^2 / q)``. The sums over all kept
terms of a pair of sources touch only terms that one of them has: with ``p0``
the share of an absent term,

    sum f(p, q) = V f(p0, q0)
                + sum over terms of a       f(p, q0) - f(p0, q0)
                + sum over terms of b       f(p0, q) - f(p0, q0)
                + sum over terms of both    f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

The middle sums need only how many terms a source has at each count; the last
one is a join on the term, summed as it is made. A result holds each pair of
sources of a language, so its size is the number of these pairs.

Defined cases. Null texts, languages and sources are the empty text. A source
without kept terms has every other source of its language as a pair; in a
language without kept terms all values are 0. Terms that tie are in the order of
their UTF-8 bytes. Repeated rows are documents of their own. Very long texts are
cut between terms into pieces that are counted one by one. An empty table gives
no rows. Only the three named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adflow.llm.tables import text_of
from adflow.session import stored

LEAST_DOCS = 3
TOP = 200
BITS = 64
UNITS = 1_000_000_000
"""Shares are in units of 10^-9."""
FLUSH = 300_000
"""A task sends its counts on when it holds so many terms."""
_PIECE = 1 << 20

# Letters: ASCII ones in lower case and all bytes of other characters; everything else is a blank.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_COUNTED = "lang_key long, source_key long, term binary, n long, docs long"


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded length."""
    letters = text.translate(_LETTERS)
    start = 0
    while start < len(letters):
        end = letters.find(b" ", start + _PIECE)
        end = len(letters) if end < 0 else end
        yield letters[start:end].split()
        start = end


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of the terms of each group, summed within the task."""
    groups: dict[tuple[int, int], tuple[Counter, Counter]] = {}
    held = 0

    def summed() -> Iterator[pa.RecordBatch]:
        for (lang_key, source_key), (occurrences, documents) in groups.items():
            terms, count = list(occurrences), len(occurrences)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(count, lang_key, np.int64)),
                    pa.array(np.full(count, source_key, np.int64)),
                    pa.array(terms, pa.binary()),
                    pa.array(list(occurrences.values()), pa.int64()),
                    pa.array([documents[t] for t in terms], pa.int64()),
                ],
                ["lang_key", "source_key", "term", "n", "docs"],
            )

    for batch in batches:
        keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        for key, text in zip(keys, batch.column(2).cast(pa.binary())):
            occurrences, documents = groups.setdefault(key, (Counter(), Counter()))
            before, seen = len(occurrences), set()
            for terms in _pieces(text.as_py()):
                occurrences.update(terms)
                seen.update(terms)
            documents.update(seen)
            held += len(occurrences) - before
            if held >= FLUSH:
                yield from summed()
                groups, held = {}, 0
    yield from summed()


def _seen_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of a task's texts, in parts."""
    seen: set[bytes] = set()
    for batch in batches:
        for text in batch.column(0).cast(pa.binary()):
            for terms in _pieces(text.as_py()):
                seen.update(terms)
            if len(seen) >= FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary())], ["term"])
                seen = set()
    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary())], ["term"])


def _hashed(salt: int, name: str) -> Column:
    return F.xxhash64(F.lit(salt), F.col(name))


def _free_salt(groups: DataFrame) -> int:
    """The first salt whose digests tell all languages and all sources apart."""
    salt = 0
    while True:
        pairs = [(n, d) for name in ("lang", "source") for n, d in ((F.col(name), _hashed(salt, name)),)]
        counts = groups.agg(*[F.count_distinct(x) for pair in pairs for x in pair]).first()
        if counts[0] == counts[1] and counts[2] == counts[3]:
            return salt
        salt += 1


def _share(count: str, size: str) -> str:
    """SQL of ``1 + floor(10^9 * (count + 1) / size)``, by long division in two steps so that nothing overflows."""
    ahead = f"(({count}) + 1) * 10000"
    return f"(1 + ({ahead}) div ({size}) * 100000 + (({ahead}) % ({size}) * 100000) div ({size}))"


def _apart(p: str, q: str) -> str:
    """SQL of the divergence of two shares."""
    return f"((({p}) - ({q})) * (({p}) - ({q})) div ({q}))"


def _kept(counted: DataFrame, least_docs: int) -> DataFrame:
    """Counts of the terms that enough documents of their language have, with the language's own count.

    Rows are dealt out by language and term, so the sums per source and the sums
    per language share one exchange. ``first`` marks one row of each term.
    """
    key = ["lang_key", "digest", "sub"]
    dealt = counted.repartition("lang_key", "digest")
    sums = dealt.groupBy(*key, "source_key").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    across = Window.partitionBy(*key)
    told = sums.select(
        *key,
        "source_key",
        "n",
        F.sum("n").over(across).alias("lang_n"),
        F.sum("docs").over(across).alias("lang_docs"),
        (F.min("source_key").over(across) == F.col("source_key")).cast("long").alias("first"),
    )
    return told.where(F.col("lang_docs") >= least_docs).drop("lang_docs")


def kept_terms(rows: DataFrame, salt: int, least_docs: int = LEAST_DOCS, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """Counts (lang_key, source_key, digest, sub, n, lang_n, first) and texts (digest, sub, term) of the kept terms.

    Takes (lang, source, text) rows. ``bits`` is the width of the digests.
    """
    keyed = rows.select(_hashed(salt, "lang").alias("lang_key"), _hashed(salt, "source").alias("source_key"), "text")

    def told(terms: DataFrame) -> DataFrame:
        digest = F.shiftrightunsigned(F.xxhash64("term"), 64 - bits)
        return terms.withColumn("digest", digest).withColumn("term", F.col("term").cast("string"))

    counted = told(keyed.mapInArrow(_count_terms, _COUNTED))
    plain = counted.select("lang_key", "source_key", "digest", F.lit(0).alias("sub"), "n", "docs")
    kept = stored(_kept(plain, least_docs), "kept")

    digests = stored(kept.select("digest").distinct(), "digests")
    seen = told(rows.select("text").mapInArrow(_seen_terms, "term binary")).join(digests, "digest", "left_semi")
    ends = stored(seen.groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high")), "ends")
    texts = ends.where("low = high").select("digest", F.lit(0).alias("sub"), F.col("low").alias("term"))
    clashes = ends.where("low <> high").select("digest")
    if clashes.isEmpty():
        return kept, texts

    clashes = stored(clashes, "clashes")
    whole = counted.join(clashes, "digest", "left_semi")
    number = F.row_number().over(Window.partitionBy("digest").orderBy("term"))
    named = stored(whole.select("digest", "term").distinct().withColumn("sub", number), "split")
    apart = whole.join(named, ["digest", "term"]).select("lang_key", "source_key", "digest", "sub", "n", "docs")
    split = stored(_kept(apart, least_docs), "kept")
    kept = kept.join(clashes, "digest", "left_anti").unionByName(split)
    return stored(kept, "kept"), texts.unionByName(named.select("digest", "sub", "term"))


def _pair_values(told: DataFrame, sized: DataFrame) -> DataFrame:
    """(lang_key, source_key, other_key, value) for each ordered pair of sources of a language."""

    def side(name: str) -> DataFrame:
        own = [F.col(c).alias(f"{name}{c}") for c in ("source_key", "p", "p0")]
        return told.select("lang_key", "digest", "sub", *own)

    def extra(p: str, q: str, p0: str, q0: str) -> str:
        return f"{_apart(p, q)} - {_apart(p, q0)} - {_apart(p0, q)} + {_apart(p0, q0)}"

    both = side("a").join(side("b"), ["lang_key", "digest", "sub"]).where("asource_key < bsource_key")
    both = both.groupBy("lang_key", "asource_key", "bsource_key").agg(
        F.expr(f"sum({extra('ap', 'bp', 'ap0', 'bp0')})").alias("ab"),
        F.expr(f"sum({extra('bp', 'ap', 'bp0', 'ap0')})").alias("ba"),
    )
    parts = [
        both.selectExpr("lang_key", "asource_key AS source_key", "bsource_key AS other_key", "ab AS value"),
        both.selectExpr("lang_key", "bsource_key AS source_key", "asource_key AS other_key", "ba AS value"),
    ]
    shares = stored(told.groupBy("lang_key", "source_key", "p", "p0").agg(F.count("*").alias("terms")), "shares")
    others = sized.selectExpr("lang_key", "source_key AS other_key", "p0 AS q0")
    one = shares.join(others, "lang_key").where("source_key <> other_key")
    one = one.groupBy("lang_key", "source_key", "other_key").agg(
        F.expr(f"sum(terms * ({_apart('p', 'q0')} - {_apart('p0', 'q0')}))").alias("ab"),
        F.expr(f"sum(terms * ({_apart('q0', 'p')} - {_apart('q0', 'p0')}))").alias("ba"),
    )
    parts += [
        one.selectExpr("lang_key", "source_key", "other_key", "ab AS value"),
        one.selectExpr("lang_key", "other_key AS source_key", "source_key AS other_key", "ba AS value"),
    ]
    every = sized.join(others, "lang_key").where("source_key <> other_key")
    absent = F.expr(f"CASE WHEN v > 0 THEN v * {_apart('p0', 'q0')} ELSE 0L END")
    values = every.select("lang_key", "source_key", "other_key", absent.alias("value"))
    for part in parts:
        values = values.unionByName(part)
    return values.groupBy("lang_key", "source_key", "other_key").agg(F.sum("value").alias("value"))


def _ranked(rows: DataFrame) -> DataFrame:
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", "part", "item", "value", F.row_number().over(best).alias("rank"))


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_docs: int = LEAST_DOCS,
    top: int = TOP,
    bits: int = BITS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): other sources by divergence, and the terms a source has too much of.

    Part ``pair`` has every other source of the language, part ``term`` the
    ``top`` terms whose share in the source is above that in the language.
    """
    rows = docs.select(*[text_of(docs, c).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    groups = stored(rows.select("lang", "source").distinct(), "groups")
    salt = _free_salt(groups)
    kept, texts = kept_terms(rows, salt, least_docs, bits)

    totals = kept.groupBy("lang_key", "source_key").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang_key").agg(F.sum("first").alias("v"), F.sum("n").alias("lang_total"))
    named = groups.select("lang", "source", _hashed(salt, "lang").alias("lang_key"), _hashed(salt, "source").alias("source_key"))
    sized = named.join(totals, ["lang_key", "source_key"], "left").join(langs, "lang_key", "left").fillna(0)
    sized = stored(sized.withColumn("p0", F.expr(f"CASE WHEN v > 0 THEN {_share('0', 'total + v')} END")), "sources")

    shares = sized.select("lang_key", "source_key", "total", "v", "lang_total", "p0")
    told = kept.join(shares, ["lang_key", "source_key"]).withColumns(
        {"p": F.expr(_share("n", "total + v")), "q": F.expr(_share("lang_n", "lang_total + v"))}
    )
    names = sized.select("lang_key", "source_key", "lang", "source")
    others = sized.select("lang_key", F.col("source_key").alias("other_key"), F.col("source").alias("item"))
    pairs = _pair_values(told, shares).join(names, ["lang_key", "source_key"]).join(others, ["lang_key", "other_key"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    # Ranks that ties share keep all rows that can be among the first, before any text is joined.
    above = told.where("p > q").select("lang_key", "source_key", "digest", "sub", F.expr(_apart("p", "q")).alias("value"))
    place = F.rank().over(Window.partitionBy("lang_key", "source_key").orderBy(F.desc("value")))
    first = stored(above.withColumn("place", place).where(F.col("place") <= top).drop("place"), "first")
    terms = first.join(texts, ["digest", "sub"]).join(names, ["lang_key", "source_key"])
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    return _ranked(pairs).unionByName(_ranked(terms).where(F.col("rank") <= top))
