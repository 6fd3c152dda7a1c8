"""Byte-level BPE encoding and decoding with a contiguous rank array.

Each short word holds its parts, their boundaries and the ranks of adjacent
pairs in contiguous arrays. The least rank is searched by a scan, its boundary is
deleted and the two ranks beside it are looked up anew, until no pair has a
rank. The words of a batch that have equally many parts are rows of one array,
so that each step does this for all of them. Words of more than ``SHORT`` bytes use a heap of pairs instead, whose
result is the same, as a scan of a very long word would take quadratic time.

The vocabulary file (JSON of the tokenizers library) is read on the driver and
broadcast; its size does not depend on the data.

Defined cases. A null text encodes to no ids, like the empty one. The strings of
special tokens in a text become their ids. Decoding null gives null, no ids give
the empty text, ids outside the vocabulary are skipped, and bytes that are no
UTF-8 become U+FFFD. Other columns pass through; one that has the name of a new
column gives way to it. Repeated rows are rows of their own, and an empty table
gives an empty one.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from adflow.llm.units import UnitEncoder, byte_letters, held_in, lists, simple_pieces, texts_of, with_columns

SHORT = 64
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPLIT = regex.compile(SPLIT)
_NONE = 1 << 60


class Vocabulary:
    """Ids of bytes, ranks of pairs and the bytes of each id."""

    def __init__(self, text: str):
        held = json.loads(text)
        vocab: dict[str, int] = held["model"]["vocab"]
        byte_of = {letter: b for b, letter in enumerate(byte_letters())}
        pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in held["model"]["merges"]]
        added = held.get("added_tokens") or []
        self.special = {t["content"]: t["id"] for t in added}
        self.bytes_of = {i: bytes(byte_of[c] for c in token) for token, i in vocab.items() if token not in self.special}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.first = [vocab[letter] for letter in byte_letters()]
        self.shift = max(self.bytes_of).bit_length()
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for left, right in pairs:
            self.rank.setdefault(vocab[left] << self.shift | vocab[right], len(self.merged))
            self.merged.append(vocab[left + right])
        self.keys = np.sort(np.fromiter(self.rank, np.int64, len(self.rank)))
        self.key_ranks = np.fromiter((self.rank[k] for k in self.keys.tolist()), np.int64, len(self.keys))


class Encoder(UnitEncoder):
    """Encodes units by the vocabulary's pattern and pairs."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(vocabulary.special)
        self.vocabulary = vocabulary

    def split(self, unit: str) -> list[str]:
        pieces = simple_pieces(unit)
        return _SPLIT.findall(unit) if pieces is None else pieces

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        data = [p.encode("utf-8", "replace") for p in pieces]
        found: list[bytes] = [b""] * len(data)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(data):
            if len(word) > SHORT:
                found[i] = np.array(self.by_heap([self.vocabulary.first[b] for b in word])[0], "<u4").tobytes()
            else:
                by_length.setdefault(len(word), []).append(i)
        for rows, ids, _ in self.by_scan(data, by_length):
            flat, width = ids.astype("<u4").tobytes(), 4 * ids.shape[1]
            for n, i in enumerate(rows.tolist()):
                found[i] = flat[n * width : (n + 1) * width]
        return found

    def by_scan(self, data: list[bytes], by_length: dict[int, list[int]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(places of words, ids of their parts, boundaries of their parts) of words that end with equally many parts.

        All words with ``n`` parts are rows of one array. Each step scans every
        row for its least rank and deletes one boundary of it, so the rows that
        go on have ``n - 1`` parts and are joined by the words of that length.
        """
        first, merged = np.array(self.vocabulary.first, np.int64), np.array(self.vocabulary.merged, np.int64)
        longest = max(by_length, default=0)
        rows = np.zeros(0, np.int64)
        ids, bounds = np.zeros((0, longest), np.int64), np.zeros((0, longest + 1), np.int64)
        ranks = np.zeros((0, max(0, longest - 1)), np.int64)
        for n in range(longest, 0, -1):
            new = by_length.get(n, [])
            if new:
                fresh = first[np.frombuffer(b"".join(data[i] for i in new), np.uint8).reshape(len(new), n)]
                rows = np.concatenate([rows, new])
                ids = np.concatenate([ids, fresh])
                bounds = np.concatenate([bounds, np.broadcast_to(np.arange(n + 1), (len(new), n + 1))])
                ranks = np.concatenate([ranks, self.ranks_of(fresh[:, :-1], fresh[:, 1:])])
            if n == 1:
                yield rows, ids, bounds
                return
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(rows)), at]
            ended = least == _NONE
            yield rows[ended], ids[ended], bounds[ended]
            going = ~ended
            rows, at, least = rows[going], at[going], least[going]
            line, places = np.arange(len(rows)), np.arange(n)
            ids, bounds, ranks = ids[going], bounds[going], ranks[going]
            ids[line, at] = merged[least]
            ids = ids[places != (at + 1)[:, None]].reshape(len(rows), n - 1)
            bounds = bounds[np.arange(n + 1) != (at + 1)[:, None]].reshape(len(rows), n)
            ranks = ranks[places[:-1] != at[:, None]].reshape(len(rows), n - 2)
            right = np.flatnonzero(at < n - 2)
            ranks[right, at[right]] = self.ranks_of(ids[right, at[right]], ids[right, at[right] + 1])
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.ranks_of(ids[left, at[left] - 1], ids[left, at[left]])

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or a value above all ranks."""
        keys = left << self.vocabulary.shift | right
        place = np.searchsorted(self.vocabulary.keys, keys)
        place[place == len(self.vocabulary.keys)] = 0
        return np.where(self.vocabulary.keys[place] == keys, self.vocabulary.key_ranks[place], _NONE)

    def by_heap(self, ids: list[int]) -> tuple[list[int], list[int]]:
        """Ids and boundaries of the parts of one word, in time that grows as n log n."""
        rank, merged, shift = self.vocabulary.rank.get, self.vocabulary.merged, self.vocabulary.shift
        end = len(ids)
        before, after = list(range(-1, end - 1)), list(range(1, end + 1))
        heap = [(r, i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := rank(a << shift | b)) is not None]
        heapq.heapify(heap)
        while heap:
            least, at = heapq.heappop(heap)
            right = after[at]
            if ids[at] < 0 or right >= end or rank(ids[at] << shift | ids[right]) != least:
                continue
            ids[at], ids[right] = merged[least], -1
            after[at] = after[right]
            if after[at] < end:
                before[after[at]] = at
            for i, j in ((before[at], at), (at, after[at])):
                if i >= 0 and j < end and (r := rank(ids[i] << shift | ids[j])) is not None:
                    heapq.heappush(heap, (r, i))
        bounds = [i for i, x in enumerate(ids) if x >= 0]
        return [ids[i] for i in bounds], [*bounds, end]


def _sent(df: DataFrame, path: str) -> Broadcast:
    with open(path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast({"text": file.read()})


_IDS = T.ArrayType(T.IntegerType(), False)


def _encoded(sent: Broadcast, batch: pa.RecordBatch, at: int) -> pa.Array:
    encoder = held_in(sent, lambda text: Encoder(Vocabulary(text)))
    return lists(encoder.encode(texts_of(batch, at)))


def _decoded(sent: Broadcast, ids: pa.Array) -> pa.Array:
    # An encoder of this worker has the vocabulary already.
    made = held_in(sent, lambda text: Vocabulary(text))
    bytes_of = getattr(made, "vocabulary", made).bytes_of

    def texts() -> Iterator[str | None]:
        for value in ids:
            if not value.is_valid:
                yield None
            else:
                known = (bytes_of.get(i, b"") for i in value.values.to_numpy(zero_copy_only=False).tolist())
                yield b"".join(known).decode("utf-8", "replace")

    return pa.array(texts(), pa.string())


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """All columns and the token ids of the text (array of int)."""
    sent, at = _sent(docs, path), docs.columns.index(text)
    return with_columns(docs, {ids: _IDS}, lambda batch: [_encoded(sent, batch, at)])


def decode(rows: DataFrame, path: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """All columns and the text of the token ids."""
    sent, at = _sent(rows, path), rows.columns.index(ids)
    return with_columns(rows, {text: T.StringType()}, lambda batch: [_decoded(sent, batch.column(at))])


def encode_and_decode(
    docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids", decoded: str = "decoded"
) -> DataFrame:
    """All columns, the token ids of the text, and the text that these ids decode to, in one pass."""
    sent, at = _sent(docs, path), docs.columns.index(text)

    def both(batch: pa.RecordBatch) -> list[pa.Array]:
        found = _encoded(sent, batch, at)
        return [found, _decoded(sent, found)]

    return with_columns(docs, {ids: _IDS, decoded: T.StringType()}, both)
