"""I-Match fingerprints over randomised lexicon subsets.

The lexicon holds the terms whose inverse document frequency ln(N / df) lies in
a band: neither words of most texts nor words of next to none. A document's
distinct lexicon terms are sorted; the hash of all of them is its I-Match
signature. As one changed term changes that hash, subsets of the lexicon are
drawn too: for each of ``DRAWS`` random draws and each level ``j`` the subset
that keeps a term with probability 2^-j (those of a draw are nested), and the
terms that a subset keeps are hashed likewise.

A fingerprint is a text: number of terms, signature, then for each draw the
hashes of its levels, ``-`` for a subset that keeps none of the terms. Likeness
of two fingerprints goes from the sparsest level to denser ones until
``ENOUGH`` subsets keep a term of either, and is the share of these whose hashes
agree.

The lexicon is bounded by the band, not by the corpus: a term in it occurs in at
least e^-IDF_MOST of the documents, so there are at most e^IDF_MOST times the
mean number of distinct terms of a document. Terms are known by 32 bits of a
hash; terms that share them count as one.

Defined cases. A null text is the empty one. A text without lexicon terms takes
all its terms instead, a text without words its own hash; equal texts have equal
fingerprints in each case. Two fingerprints without a subset to compare are
alike (1) if equal and else not (0).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.llm.tables import column, text_of, words_of

IDF_LEAST = 2.5
IDF_MOST = 9.0
DRAWS = 16
LEVELS = 14
ENOUGH = 24
_ROWS = 1000


def terms_of(text: str | None) -> np.ndarray:
    """Hashes of the distinct words, sorted."""
    words = set(words_of(text))
    return np.sort(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = [(terms_of(t) & np.uint64(0xFFFFFFFF)).astype(np.uint32) for t in batch.column(0).to_pylist()]
        if held:
            terms, counts = np.unique(np.concatenate(held), return_counts=True)
            arrays = [pa.array(terms.view(np.int32)), pa.array(counts.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, names=["term", "count"])


def lexicon(docs: DataFrame, text: str = "text", least: float = IDF_LEAST, most: float = IDF_MOST) -> DataFrame:
    """The terms (32-bit hashes) whose inverse document frequency over all documents lies in the band."""
    rows = max(1, docs.count())
    counted = docs.select(column(docs, text).cast("string")).mapInArrow(_counted, "term int, count int")
    sums = counted.groupBy("term").agg(F.sum("count").alias("count"))
    low, high = rows * math.exp(-most), rows * math.exp(-least)
    return sums.where((F.col("count") >= low) & (F.col("count") <= max(high, 1.0))).select("term")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEEDS = np.array([(d * 0x9E3779B97F4A7C15 + 0x1F83D9ABFB41BD6B) % (1 << 64) for d in range(DRAWS)], np.uint64)
_LIMITS = np.array([1 << (64 - level) for level in range(LEVELS, 0, -1)], np.uint64)


def subset_hashes(terms: np.ndarray) -> list[str]:
    """For each draw the hashes of what each level's subset keeps, four digits each, up to the last that keeps a term.

    The hash of a set of distinct terms is made from the sum of their mixed
    hashes, so it does not depend on an order and all levels come from one pass.
    """
    mixed = _mixed(terms[None, :] + _SEEDS[:, None])
    # A draw's subsets are nested: a term is in those of levels 1 to its own.
    level = LEVELS - np.searchsorted(_LIMITS, mixed, side="right")
    sums = np.zeros((DRAWS, LEVELS + 1), np.uint64)
    np.add.at(sums, (np.arange(DRAWS)[:, None], level), np.broadcast_to(_mixed(terms), mixed.shape))
    sums = np.cumsum(sums[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
    digits = (_mixed(sums) >> np.uint64(48)).astype(">u2")
    return [row[1 : top + 1].tobytes().hex() or "-" for row, top in zip(digits, level.max(axis=1).tolist())]


class Fingerprinter:
    """Fingerprints of texts by a sorted array of the lexicon's terms."""

    def __init__(self, known: np.ndarray):
        self.known = known

    def kept(self, text: str | None) -> np.ndarray:
        """The text's lexicon terms, sorted; all its terms if there are none."""
        terms = terms_of(text)
        if not len(terms) or not len(self.known):
            return terms
        short = (terms & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        place = np.minimum(np.searchsorted(self.known, short), len(self.known) - 1)
        inside = terms[self.known[place] == short]
        return inside if len(inside) else terms

    def of(self, text: str | None) -> str:
        terms = self.kept(text)
        if not len(terms):
            return f"0:{xxhash.xxh3_64_hexdigest((text or '').encode('utf-8', 'replace'))}"
        whole = f"{len(terms)}:{xxhash.xxh3_64_hexdigest(terms.tobytes())}"
        return ":".join([whole, *subset_hashes(terms)])


def likeness(a: str, b: str) -> float:
    """How alike two fingerprints are, from 0 to 1."""
    if a == b:
        return 1.0
    left, right = a.split(":")[2:], b.split(":")[2:]
    if not left or not right:
        return 0.0
    left, right = ["" if x == "-" else x for x in left], ["" if x == "-" else x for x in right]
    seen = same = 0
    for at in range(4 * LEVELS - 4, -1, -4):
        for x, y in zip(left, right):
            p, q = x[at : at + 4], y[at : at + 4]
            if p or q:
                seen += 1
                same += p == q
        if seen >= ENOUGH:
            break
    return same / seen if seen else 0.0


def known_terms(terms: DataFrame) -> np.ndarray:
    """The lexicon as a sorted array on the driver; its size is bounded by the band."""
    return np.sort(terms.toPandas()["term"].to_numpy(np.int32).view(np.uint32))


def fingerprint(docs: DataFrame, terms: DataFrame, text: str = "text") -> Column:
    """The fingerprint of each text as a column."""
    sent = docs.sparkSession.sparkContext.broadcast(known_terms(terms))

    @F.pandas_udf("string")
    def printed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        maker = Fingerprinter(sent.value)
        for part in parts:
            yield pd.Series([maker.of(t if isinstance(t, str) else None) for t in part], dtype="object")

    return printed(column(docs, text).cast("string"))


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many characters from the start of the following one, or all it has."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def compare_edits(docs: DataFrame, terms: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint beside that of its edited text and that of the next document.

    (id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next)
    in order of falling id, nulls last; documents that share an id by the hash
    of their text. The documents are cut into blocks of ids by quantiles; the
    first document of a block also goes, as a guest, to the block before it,
    whose last document has it as the next one. Texts move once, compressed.
    """
    spark = docs.sparkSession
    narrow = docs.select(column(docs, id_column).cast("long").alias("id"), text_of(docs, text).alias("text"))
    blocks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = narrow.select("id").where("id is not null")
    cuts = ids.agg(F.percentile_approx("id", [i / blocks for i in range(1, blocks)] or [0.5], 10_000)).first()[0]
    cuts = np.unique(np.array(cuts if cuts and blocks > 1 else [], np.int64))

    def block_of(values: np.ndarray) -> np.ndarray:
        """1 and up for ids between the cuts; block 0 has the nulls."""
        return np.searchsorted(cuts, values, side="right") + 1

    def tops(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = frame["id"].to_numpy(np.int64)
            yield pd.DataFrame({"block": block_of(values), "top": values}).groupby("block", as_index=False).max()

    found = ids.mapInPandas(tops, "block long, top long").groupBy("block").agg(F.max("top").alias("top")).toPandas()
    top_of = dict(zip(found["block"].tolist(), found["top"].tolist()))
    used = sorted(top_of)
    nulls = narrow.where("id is null").limit(1).count()
    used = ([0] if nulls else []) + used
    # A block's first document is the guest of the block above; the very first one of the lowest block.
    above = {b: a for b, a in zip(used, used[1:])} | ({used[-1]: used[0]} if used else {})
    sent_terms = spark.sparkContext.broadcast(known_terms(terms))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            rows: list[tuple] = []
            for id_, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = value.encode("utf-8", "replace")
                block = 0 if id_ is None else int(block_of(np.array([id_]))[0])
                row = (id_, xxhash.xxh3_64_intdigest(data) >> 1, press.compress(data))
                rows.append((block, 0, *row))
                if block in above and (id_ is None or id_ == top_of[block]):
                    rows.append((above[block], 1, *row))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            names = ["block", "guest", "id", "mark", "data"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    moved = narrow.mapInArrow(packed, "block long, guest int, id long, mark long, data binary")
    order = ["block", "guest", F.desc_nulls_last("id"), "mark"]
    dealt = moved.repartition(blocks, "block").sortWithinPartitions(*order)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker, expand = Fingerprinter(sent_terms.value), zstandard.ZstdDecompressor()
        names = ["id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        waiting = None
        done: list[tuple] = []
        for batch in batches:
            for block, guest, id_, _, data in zip(*(c.to_pylist() for c in batch.columns)):
                if guest and (waiting is None or waiting[0] != block):
                    continue
                now = expand.decompress(data).decode()
                mine = maker.of(now)
                if waiting is not None and waiting[0] == block:
                    _, before, before_text, before_print = waiting
                    changed = edited(before_text, now)
                    other = maker.of(changed)
                    near = (likeness(before_print, other), likeness(before_print, mine))
                    done.append((before, len(before_text), changed, before_print, other, *near))
                waiting = None if guest else (block, id_, now, mine)
                if len(done) >= _ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
                    done = []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

    schema = (
        "id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return dealt.mapInArrow(compared, schema).withColumnRenamed("id", id_column)
