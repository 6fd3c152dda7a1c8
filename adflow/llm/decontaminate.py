"""Benchmark leaks by latent semantic retrieval.

1. Texts become codes over the benchmark's vocabulary; document frequencies are
   counted over all documents.
2. All passages (windows of ``2 * STEP`` words at every ``STEP``-th word), as
   TF-IDF rows of unit length, and the benchmark's own passages make the matrix
   of a randomised SVD: each task multiplies its rows with a random matrix and
   back, the products are summed by Spark, and a small factorisation on the
   driver gives the latent basis.
3. Each passage is searched in the latent space: its cosine with a benchmark
   passage makes a candidate. So does the plain cosine of the TF-IDF rows, so
   what lies outside the latent basis is not lost.
4. A candidate is a leak if the longest common subsequence of the words around
   it and the benchmark passage covers ``SURE`` of the latter, or ``LIKELY`` of
   it while the answer's words are there in order (``ANSWERED``).

The benchmark is taken in blocks of a bounded number of words and passages, each
with its own vocabulary, basis and search over all passages, so what is broadcast
and what comes to the driver is bounded by ``BLOCK_WORDS`` and ``BLOCK_PASSAGES``,
not by the data. The rank is no less than the passages of the block.
Benchmark items of more than ``LONGEST`` words are cut into passages of that length.

Words are runs of characters other than ASCII white space and punctuation, in
lower case. Defined cases. Null, empty and wordless texts and items leak
nothing. Repeated items are found under each of their ids, repeated documents
each give rows. Null ids stay null. Without documents or items the result is
empty. Texts of any length are searched whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adflow.llm.tables import column, fresh_name, words_of
from adflow.session import stored

STEP = 16
LONGEST = 64
"""Longer benchmark items are cut into passages of so many words."""
RANK = 192
"""The least rank; a block of more passages has a rank of their number."""
OVERSAMPLING = 16
BLOCK_WORDS = 40_000
BLOCK_PASSAGES = 256
STOP_SHARE = 0.02
"""Words in more than this share of documents say nothing about a passage, but for an item's rarest ``KEPT_WORDS``."""
KEPT_WORDS = 6
COSINE = 0.12
SURE = 0.7
LIKELY = 0.5
ANSWERED = 0.6
ANSWER_WORDS = 4
"""Without an answer column, the answer is the item's last sentence, or this many last words if that is shorter."""
_ROWS = 250


class Item:
    """A passage of a benchmark item with its words and the answer's words."""

    def __init__(self, item_id, words: list[bytes], answer: list[bytes]):
        self.item_id, self.words, self.answer = item_id, words, answer


def items_of(item_id, text: str | None, answer: str | None) -> list[Item]:
    """The item as passages of ``LONGEST`` words at most."""
    words = words_of(text)
    if answer is not None:
        told = words_of(answer)[-LONGEST:]
    else:
        sentences = [s for s in map(words_of, re.split(r"[.?!\n]", text or "")) if s]
        told = sentences[-1] if sentences and len(sentences[-1]) >= ANSWER_WORDS else words[-ANSWER_WORDS:]
    if len(words) <= LONGEST:
        return [Item(item_id, words, told)] if words else []
    starts = [*range(0, len(words) - LONGEST, LONGEST // 2), len(words) - LONGEST]
    parts = [words[s : s + LONGEST] for s in starts]
    return [Item(item_id, p, told if p is parts[-1] else p[-ANSWER_WORDS:]) for p in parts]


def blocks_of(benchmark: DataFrame, item_id: str, text: str, answer: str | None) -> Iterator[list[Item]]:
    """The benchmark's passages in blocks of a bounded number of words and passages."""
    told = column(benchmark, answer) if answer else F.lit(None).cast("string")
    rows = benchmark.select(column(benchmark, item_id), column(benchmark, text).cast("string"), told.cast("string"))
    held: list[Item] = []
    size = 0
    for row in rows.toLocalIterator():
        for item in items_of(*row):
            full = len(held) == BLOCK_PASSAGES or size + len(item.words) + len(item.answer) > BLOCK_WORDS
            if held and full:
                yield held
                held, size = [], 0
            held.append(item)
            size += len(item.words) + len(item.answer)
    if held:
        yield held


def _coded(docs: DataFrame, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """A row (id, codes) for each text with words, and rows (code, count) of document frequencies; code 0 is any other word."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = docs.schema["id"].dataType
    names = ["id", "codes", "code", "count"]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code_of = sent.value.get
        seen = np.zeros(len(sent.value) + 1, np.int64)
        for batch in batches:
            codes, kept = [], []
            for i, value in enumerate(batch.column(1).to_pylist()):
                words = words_of(value)
                if words:
                    found = np.fromiter(map(code_of, words, repeat(0)), "<u2", count=len(words))
                    seen[np.unique(found)] += 1
                    seen[0] += not (found == 0).any()
                    codes.append(found.tobytes())
                    kept.append(i)
            ids = batch.column(0).take(pa.array(kept, pa.int64()))
            none = pa.nulls(len(kept), pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(codes, pa.binary()), none, none], names=names)
        used = np.flatnonzero(seen)
        if len(used):
            blank = [pa.nulls(len(used), batch.schema.field(0).type), pa.nulls(len(used), pa.binary())]
            yield pa.RecordBatch.from_arrays([*blank, pa.array(used), pa.array(seen[used])], names=names)

    kinds = [kind, T.BinaryType(), T.LongType(), T.LongType()]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])
    return docs.select("id", column(docs, text).cast("string").alias("text")).mapInArrow(coded, schema)


def _weights(counts: np.ndarray, items: list[np.ndarray]) -> np.ndarray:
    """Inverse document frequencies by code; stop words weigh nothing, other words as much as a word of one document."""
    documents = max(1, int(counts[0]))
    rarity = np.log(documents / np.maximum(1, counts)) + 1.0
    weights = np.where(counts > max(1.0, STOP_SHARE * documents), 0.0, rarity)
    for item in items:
        words = np.unique(item)
        rarest = words[np.argsort(-rarity[words], kind="stable")[:KEPT_WORDS]]
        weights[rarest] = rarity[rarest]
    weights[0] = np.log(documents) + 1.0
    return weights.astype(np.float32)


class Passages:
    """Passages of some texts: a block of ``STEP`` words and the one after it in the same text."""

    def __init__(self, codes: list[np.ndarray], weights: np.ndarray):
        lengths = np.array([len(c) for c in codes])
        counts = -(-lengths // STEP)
        self.text = np.repeat(np.arange(len(codes)), counts)
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.place = np.arange(counts.sum()) - np.repeat(first, counts)
        every = np.concatenate(codes)
        within = np.arange(len(every)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        block = np.repeat(first, lengths) + within // STEP
        weight = weights[every]
        mass = np.bincount(block, weight.astype(np.float64) ** 2, len(self.text))
        known = np.flatnonzero((every > 0) & (weight > 0))
        self.code, self.block, self.weight = every[known], block[known], weight[known]
        self.pair = np.zeros(len(self.text), bool)
        self.pair[:-1] = self.text[1:] == self.text[:-1]
        self.norm = np.sqrt(np.maximum(self.joined(mass), 1e-9))

    def joined(self, sums: np.ndarray) -> np.ndarray:
        """Sums over passages from sums over blocks."""
        total = sums.astype(np.float64)
        at = np.flatnonzero(self.pair)
        total[at] += sums[at + 1]
        return total

    def summed(self, values: np.ndarray) -> np.ndarray:
        """For each passage the sum of a number for each of its known words."""
        return self.joined(np.bincount(self.block, values, len(self.text)))

    def _needed(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the blocks of some passages, the known words in them, and which passages have two blocks."""
        both = which[self.pair[which]]
        need = np.zeros(len(self.text), bool)
        need[which] = need[both + 1] = True
        return np.cumsum(need) - 1, np.flatnonzero(need[self.block]), np.flatnonzero(self.pair[which])

    def project(self, vectors: np.ndarray, which: np.ndarray) -> np.ndarray:
        """For some passages the weighted sum of the vectors of their known words."""
        at, words, both = self._needed(which)
        sums = np.zeros((at[-1] + 1 if len(at) else 0, vectors.shape[1]), np.float32)
        if len(words):
            block = at[self.block[words]]
            starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            sums[block[starts]] = np.add.reduceat(vectors[self.code[words]] * self.weight[words, None], starts, axis=0)
        rows = sums[at[which]]
        rows[both] += sums[at[which[both] + 1]]
        return rows

    def back(self, rows: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each known word of some passages the weighted sum of the passages' rows."""
        at, words, both = self._needed(which)
        spread = np.zeros((at[-1] + 1 if len(at) else 0, rows.shape[1]), np.float32)
        spread[at[which]] += rows
        spread[at[which[both] + 1]] += rows[both]
        words = words[np.argsort(self.code[words], kind="stable")]
        code = self.code[words]
        if not len(code):
            return code, np.zeros((0, rows.shape[1]), np.float32)
        starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        return code[starts], np.add.reduceat(spread[at[self.block[words]]] * self.weight[words, None], starts, axis=0)

    def product(self, omega: np.ndarray) -> np.ndarray:
        """AᵀAΩ for the rows of unit length that the passages are.

        A passage with one known word only adds to that word's own entry of AᵀA.
        """
        total = np.zeros(omega.shape, np.float64)
        count, scale = self.summed(np.ones(len(self.code))), 1.0 / self.norm**2
        many = np.flatnonzero(count > 1)
        rows = self.project(omega, many) * scale[many, None]
        used, sums = self.back(rows.astype(np.float32), many)
        total[used] += sums
        alone = np.where(count == 1, scale, 0.0)
        before = np.concatenate([[0.0], np.where(self.pair, alone, 0.0)[:-1]])
        own = np.bincount(self.code, self.weight.astype(np.float64) ** 2 * (alone + before)[self.block], len(omega))
        return total + own[:, None] * omega


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    """Frames of a bounded number of words, with their codes; a very long text is a frame of its own."""
    for frame in frames:
        codes = [np.frombuffer(c, "<u2") for c in frame["codes"]]
        start, size = 0, 0
        for i, c in enumerate(codes):
            if i > start and (size + len(c) > _ROWS * 500):
                yield frame.iloc[start:i], codes[start:i]
                start, size = i, 0
            size += len(c)
        if codes:
            yield frame.iloc[start:], codes[start:]


def _random(words: int, width: int) -> np.ndarray:
    return np.random.default_rng(42).standard_normal((words, width)).astype(np.float32)


def latent_basis(coded: DataFrame, weights: np.ndarray, items: list[np.ndarray], rank: int = RANK) -> np.ndarray:
    """The leading right singular vectors (a row for each word) of all passages and the benchmark's.

    One pass: with Y = AᵀAΩ and Q an orthonormal basis of Y, the small matrix
    QᵀY(QᵀΩ)⁺ stands for AᵀA in that basis. The benchmark's passages weigh as much
    as the corpus together, so that their directions are kept.
    """
    words, spark = len(weights), coded.sparkSession
    width = min(rank + OVERSAMPLING, words)
    sent = spark.sparkContext.broadcast(weights)
    names = [f"v{i}" for i in range(width)]

    def multiplied(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        omega, total = _random(words, width), np.zeros((words, width), np.float64)
        for _, codes in _batches(frames):
            total += Passages(codes, sent.value).product(omega)
        used = np.flatnonzero(np.abs(total).sum(axis=1))
        yield pd.DataFrame(total[used].astype(np.float32), columns=names).assign(code=used)

    schema = ", ".join([*(f"{n} float" for n in names), "code long"])
    few = coded.coalesce(2 * spark.sparkContext.defaultParallelism)
    summed = few.mapInPandas(multiplied, schema).groupBy("code").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    omega = _random(words, width).astype(np.float64)
    omega[weights == 0] = 0
    omega[0] = 0
    product = np.zeros((words, width))
    product[summed["code"].to_numpy(np.int64)] = summed[names].to_numpy(np.float64)
    own = Passages(items, weights).product(omega.astype(np.float32))
    product += own * max(1.0, np.linalg.norm(product) / max(np.linalg.norm(own), 1e-9))
    basis, _ = np.linalg.qr(product)
    small = basis.T @ product @ np.linalg.pinv(basis.T @ omega)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    best = np.argsort(-values)[:rank]
    return (basis @ vectors[:, best[values[best] > 1e-9]]).astype(np.float32)


def common(words: np.ndarray, around: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    masks: dict[int, int] = {}
    for i, w in enumerate(words.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(words)) - 1
    row = full
    for w in around.tolist():
        if w in masks:
            hit = row & masks[w]
            row = ((row + hit) | (row - hit)) & full
    return len(words) - row.bit_count()


def _search(
    coded: DataFrame,
    weights: np.ndarray,
    basis: np.ndarray,
    items: list[np.ndarray],
    answers: list[np.ndarray],
    cosine: float,
) -> DataFrame:
    """A row (id, item, cosine, lcs, answer, word) for each text and benchmark passage that leaked into it."""
    spark, kind = coded.sparkSession, coded.schema["id"].dataType
    latent, plain = latent_items(items, weights, basis), plain_items(items, weights)
    # The most that a word can add to the product with any benchmark passage.
    most = np.maximum((basis @ latent.T).max(axis=1, initial=0.0), plain.max(axis=1, initial=0.0))
    sent = spark.sparkContext.broadcast((weights, np.hstack([basis, plain]), latent, most, items, answers))

    def searched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, vectors, latent, most, items, answers = sent.value
        for frame, codes in _batches(frames):
            passages = Passages(codes, weights)
            likely = np.flatnonzero(passages.summed(passages.weight * most[passages.code]) >= cosine * passages.norm)
            if not len(likely):
                continue
            near = cosines(passages, vectors, latent, likely)
            found = []
            tried: dict[tuple[int, int], list] = {}
            for i, q in zip(*np.nonzero(near >= cosine)):
                p = likely[i]
                best = tried.setdefault((int(passages.text[p]), int(q)), [])
                best.append((float(near[i, q]), int(passages.place[p])))
            for (t, q), places in tried.items():
                leak = None
                for score, place in sorted(places, reverse=True):
                    start = max(0, place * STEP - LONGEST)
                    around = codes[t][start : (place + 2) * STEP + LONGEST]
                    share = common(items[q], around) / len(items[q])
                    told = common(answers[q], around) / max(1, len(answers[q]))
                    if share >= SURE or (share >= LIKELY and told >= ANSWERED):
                        leak = max(leak or (0.0,), (share, told, score, start))
                    if share == 1.0:
                        break
                if leak:
                    found.append((t, q, *leak))
            if found:
                rows = pd.DataFrame(found, columns=["text", "item", "lcs", "answer", "cosine", "word"])
                rows["id"] = frame["id"].iloc[rows.pop("text")].to_numpy()
                yield rows[["id", "item", "cosine", "lcs", "answer", "word"]]

    schema = T.StructType(
        [T.StructField("id", kind)]
        + [T.StructField("item", T.LongType())]
        + [T.StructField(n, T.DoubleType()) for n in ("cosine", "lcs", "answer")]
        + [T.StructField("word", T.LongType())]
    )
    return coded.mapInPandas(searched, schema)


def latent_items(items: list[np.ndarray], weights: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The direction of each benchmark passage in the latent space."""
    latent = np.zeros((len(items), basis.shape[1]), np.float32)
    for i, words in enumerate(items):
        latent[i] = (basis[words] * weights[words, None]).sum(axis=0)
    return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)


def plain_items(items: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """The TF-IDF rows of unit length of the benchmark passages, as a column for each."""
    plain = np.zeros((len(weights), len(items)), np.float32)
    for i, words in enumerate(items):
        np.add.at(plain[:, i], words, weights[words])
    return plain / np.maximum(np.linalg.norm(plain, axis=0), 1e-9)


def cosines(passages: Passages, vectors: np.ndarray, latent: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The larger of the latent and the plain cosine of some passages (rows) with each benchmark passage.

    The vectors are the latent basis and, beside it, the benchmark's plain rows.
    """
    rows, rank = passages.project(vectors, which), latent.shape[1]
    return np.maximum(rows[:, :rank] @ latent.T, rows[:, rank:]) / passages.norm[which, None]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    answer: str | None = None,
    rank: int = RANK,
    cosine: float = COSINE,
) -> DataFrame:
    """A row (id, item id, cosine, lcs, answer, word) for each document and benchmark item that leaked into it."""
    spark = docs.sparkSession
    narrow = docs.select(column(docs, id_column).alias("id"), column(docs, text).cast("string").alias("text"))
    names = T.StructType([T.StructField("item", T.LongType()), T.StructField(item_id, benchmark.schema[item_id].dataType)])
    results = []
    for block in blocks_of(benchmark, item_id, item_text, answer):
        counts = Counter(w for item in block for w in (*item.words, *item.answer))
        vocabulary = {w: i + 1 for i, w in enumerate(sorted(counts))}
        coded = stored(_coded(narrow, "text", vocabulary), "codes")
        sums = coded.where("codes is null").groupBy("code").agg(F.sum("count").alias("count")).toPandas()
        frequency = np.zeros(len(vocabulary) + 1, np.int64)
        frequency[sums["code"].to_numpy(np.int64)] = sums["count"]
        texts = coded.where("codes is not null").select("id", "codes")
        items = [np.array([vocabulary[w] for w in item.words], np.uint16) for item in block]
        answers = [np.array([vocabulary[w] for w in item.answer], np.uint16) for item in block]
        weights = _weights(frequency, items)
        basis = latent_basis(texts, weights, items, max(rank, len(items)))
        found = stored(_search(texts, weights, basis, items, answers, cosine), "leaks")
        ids = spark.createDataFrame([(i, item.item_id) for i, item in enumerate(block)], names)
        leak = F.struct("cosine", "lcs", "answer", "word").alias("leak")
        results.append(found.join(ids, "item").select(F.col("id").alias(id_column), column(ids, item_id).alias(item_id), leak))
    if not results:
        empty = narrow.select(F.col("id").alias(id_column)).where(F.lit(False))
        none = [F.lit(None).cast(benchmark.schema[item_id].dataType).alias(item_id)]
        none += [F.lit(None).cast("double").alias(n) for n in ("cosine", "lcs", "answer")]
        return empty.select(id_column, *none, F.lit(None).cast("long").alias("word"))
    all_results = results[0]
    for more in results[1:]:
        all_results = all_results.unionByName(more)
    # Passages of one item may lie in two blocks.
    best = F.max_by("leak", F.struct("leak.lcs", "leak.answer", "leak.cosine")).alias("best")
    return all_results.groupBy(id_column, item_id).agg(best).select(id_column, item_id, "best.*")


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The rows of the table whose text has no leak.

    Whether a text leaks depends on the text and the corpus only, so leaking
    texts are found by their digest: repeated rows and null ids need no key.
    """
    (digest,) = fresh_name(docs, "text_digest")
    keyed = docs.withColumn(digest, F.sha2(column(docs, text).cast("string"), 256))
    leaks = find_leaks(keyed, benchmark, digest, text, item_id, item_text)
    bad = stored(leaks.select(F.col(digest)).distinct(), "leaking")
    return keyed.join(bad, digest, "left_anti").select(*[column(docs, c) for c in docs.columns])
