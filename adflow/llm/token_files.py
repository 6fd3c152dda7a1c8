"""Token-id files: each document compressed by itself with one shared zstandard dictionary.

A folder of token files holds ``dictionary`` (one Parquet row: the zstandard
dictionary, its SHA-256, the width of an id in bytes), ``data-*.bin`` (the
compressed documents one after another, in ascending order of document id
within and across files) and ``index`` (Parquet: document id, file, offset and
length in the file, number of ids, number of ids before the document, hash of
the dictionary). A short document is read by one short range of one file.

The dictionary is trained on the serialized ids of a bounded sample of
documents (``SAMPLE_DOCUMENTS``, ``SAMPLE_BYTES``); it only affects the size of
the files. Files carry the name of the task attempt that wrote them, and the
index names the files of the attempts that succeeded, so a repeated task leaves
no wrong data. Files are written and read by pyarrow's file systems.

Defined cases. A null text has the end id only, as has the empty one. Null
document ids come first; documents that share an id are kept side by side in
any order. An empty table gives an empty index. A reader that meets a dictionary
with another hash raises an error.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from adflow.llm.tables import column
from adflow.llm.units import (
    UnitEncoder,
    are_simple,
    byte_letters,
    held_in,
    mixes_simple_pieces,
    simple_pieces,
    texts_of,
    with_columns,
)

END_ID = 0
LEVEL = 3
BYTES_A_CALL = 4096
DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCUMENTS = 1000
SAMPLE_BYTES = 4 << 20
_INDEX = "id long, file string, place long, length long, n_tokens long, part long, before long"


class LibraryEncoder(UnitEncoder):
    """Encodes units with a tokenizer of the tokenizers library.

    The bytes 0xC0 and 0xC1 occur in no UTF-8. If no other token has them, the
    model merges nothing over them: many units go to it in one call, with these
    bytes between them and their pieces, and get the ids that each has by
    itself. If no token mixes the kinds of pieces of simple units either, these
    need no cutting. New units are so cheap then that pieces have no cache, whose
    third of the memory stays free.
    """

    def __init__(self, tokenizer: str):
        library = Tokenizer.from_str(tokenizer)
        super().__init__({t.content: i for i, t in library.get_added_tokens_decoder().items()})
        self.model, self.splitter = library.model, library.pre_tokenizer
        self.letters = dict(enumerate(byte_letters()))
        self.codes = np.array([ord(letter) for letter in byte_letters()], "<u2")
        between = [self.letters[0xC0], self.letters[0xC1]]
        self.between, self.after = map(self.model.token_to_id, between)
        tokens = list(library.get_vocab(with_added_tokens=False))
        changed = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        self.joins = (
            sorted(t for t in tokens if any(b in t for b in between)) == between
            and not any(map(mixes_simple_pieces, tokens))
            and not any(getattr(self.model, name, True) for name in changed)
        )

    def split(self, unit: str) -> list[str]:
        pieces = simple_pieces(unit)
        if pieces is None:
            pieces = [unit[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(unit)] if unit else []
        return pieces

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        tokenize, letters = self.model.tokenize, self.letters
        ids = [[t.id for t in tokenize(p.encode().decode("latin-1").translate(letters))] for p in pieces]
        flat = np.fromiter((i for row in ids for i in row), "<u4").tobytes()
        ends = np.cumsum([0, *map(len, ids)]) * 4
        return [flat[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]

    def learn(self, units: list[str]) -> list[bytes]:
        if not self.joins:
            return super().learn(units)
        simple = are_simple(units)
        rows = [u.encode() if s else b"\xc0".join(map(str.encode, self.split(u))) for u, s in zip(units, simple)]
        # A call takes so many bytes and the unit that ends beyond them.
        call = np.cumsum([0, *map(len, rows)])[:-1] // BYTES_A_CALL
        starts = np.flatnonzero(np.diff(call, prepend=-1)).tolist()
        parts = [np.zeros(0, "<u4")]
        for start, end in zip(starts, [*starts[1:], len(rows)]):
            data = np.frombuffer(b"\xc1".join([*rows[start:end], b""]), np.uint8)
            tokens = self.model.tokenize(self.codes[data].tobytes().decode("utf-16-le"))
            parts.append(np.array([t.id for t in tokens], "<u4"))
        ids = np.concatenate(parts)
        ids = ids[ids != self.between]
        last = np.flatnonzero(ids == self.after)
        ends = ((last - np.arange(len(last))) * 4).tolist()
        flat = ids[ids != self.after].tobytes()
        return [flat[start:end] for start, end in zip([0, *ends], ends)]


def serialized(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", end_id: int = END_ID) -> DataFrame:
    """All columns and the ids of each text with the end id: unsigned 32-bit integers, little-endian.

    Texts are encoded by the tokenizer in ``path``, no special tokens added.
    """
    with open(path, encoding="utf-8") as file:
        sent = docs.sparkSession.sparkContext.broadcast({"text": file.read()})
    at, end = docs.columns.index(text), np.array([end_id], "<u4").tobytes()

    def encoded(batch: pa.RecordBatch) -> pa.Array:
        return pa.array([ids + end for ids in held_in(sent, LibraryEncoder).encode(texts_of(batch, at))], pa.binary())

    return with_columns(docs, {ids: T.BinaryType()}, lambda batch: [encoded(batch)])


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary; empty if the samples are too few or too small to train one."""
    if sum(map(len, samples)) < 8 * size or len(samples) < 8:
        return b""
    return zstandard.train_dictionary(size, samples).as_bytes()


def _narrow(ids: bytes, width: int) -> bytes:
    return np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes()


def sample_of(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """About so many documents, chosen by a hash of their text."""
    rows = max(1, docs.count())
    share = F.lit(min(1.0, documents / rows))
    return docs.where(F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1 << 20)) < share * (1 << 20)).limit(2 * documents)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, id_column: str = "doc_id", text: str = "text") -> None:
    """Encode all texts of a table and write them as token files to a new folder."""
    spark = docs.sparkSession
    rows = docs.select(column(docs, id_column).cast("long").alias("id"), column(docs, text).cast("string").alias("text"))
    width = 2 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else 4
    samples, room = [], SAMPLE_BYTES
    for row in serialized(sample_of(rows), tokenizer).select("ids").toLocalIterator():
        samples.append(_narrow(bytes(row["ids"]), width)[:room])
        room -= len(samples[-1])
        if room <= 0:
            break
    dictionary = train_dictionary(samples)
    digest = hashlib.sha256(dictionary).hexdigest()
    head = spark.createDataFrame([(dictionary, digest, width)], "dictionary binary, dictionary_sha256 string, width int")
    head.coalesce(1).write.parquet(f"{folder}/dictionary")
    sent = spark.sparkContext.broadcast(dictionary)
    spot = rows.columns.index("text")
    end = np.array([END_ID], "<u4").tobytes()
    with open(tokenizer, encoding="utf-8") as file:
        library = spark.sparkContext.broadcast({"text": file.read()})

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(sent.value) if sent.value else None
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=True)
        store, path = fs.FileSystem.from_uri(folder)
        encoder = held_in(library, LibraryEncoder)
        name, place, before, sink = f"data-{uuid.uuid4().hex}.bin", 0, 0, None
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                some = batch.slice(first, 1000)
                ids = [x + end for x in encoder.encode(texts_of(some, spot))]
                data = [press.compress(_narrow(x, width)) for x in ids]
                if sink is None:
                    store.create_dir(path, recursive=True)
                    sink = store.open_output_stream(f"{path}/{name}")
                sink.write(b"".join(data))
                sizes, counts = np.array([len(x) for x in data], np.int64), np.array([len(x) // 4 for x in ids], np.int64)
                places, starts = place + np.cumsum(sizes) - sizes, before + np.cumsum(counts) - counts
                place, before = place + int(sizes.sum()), before + int(counts.sum())
                columns = [some.column(0), pa.array([name] * len(data), pa.string()), pa.array(places), pa.array(sizes)]
                columns += [pa.array(counts), some.column(2), pa.array(starts)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "file", "place", "length", "n_tokens", "part", "before"])
        if sink is not None:
            sink.close()

    part = F.spark_partition_id().cast("long").alias("part")
    dealt = rows.repartitionByRange("id").sortWithinPartitions("id", "text").select("id", "text", part)
    dealt.mapInArrow(written, _INDEX).write.parquet(f"{folder}/entries")
    entries = spark.read.schema(_INDEX).parquet(f"{folder}/entries")
    sums = entries.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    running = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    starts = sums.select("part", (running - F.col("n")).alias("first"))
    start = (F.col("first") + F.col("before")).alias("start")
    index = entries.join(starts, "part").select(
        "id", "file", "place", "length", "n_tokens", start, F.lit(digest).alias("dictionary_sha256")
    )
    index.write.parquet(f"{folder}/index")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(id, start, n_tokens, ids) of every document: ids as unsigned 32-bit integers, little-endian."""
    head = spark.read.parquet(f"{folder}/dictionary").first()
    digest, width = head["dictionary_sha256"], head["width"]
    sent = spark.sparkContext.broadcast(bytes(head["dictionary"]))
    index = spark.read.parquet(f"{folder}/index")
    index = index.repartitionByRange("file", "place").sortWithinPartitions("file", "place")

    def opened(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = fs.FileSystem.from_uri(folder)
        if hashlib.sha256(sent.value).hexdigest() != digest:
            raise ValueError("the dictionary is not the one that the files were written with")
        shared = zstandard.ZstdCompressionDict(sent.value) if sent.value else None
        expand = zstandard.ZstdDecompressor(dict_data=shared)
        source, name = None, None
        for frame in frames:
            if (frame["dictionary_sha256"] != digest).any():
                raise ValueError("a document was written with another dictionary")
            ids = []
            for row in frame.itertuples(index=False):
                if row.file != name:
                    if source is not None:
                        source.close()
                    source, name = store.open_input_file(f"{path}/{row.file}"), row.file
                data = expand.decompress(source.read_at(row.length, row.place))
                ids.append(np.frombuffer(data, f"<u{width}").astype("<u4").tobytes())
            yield frame[["id", "start", "n_tokens"]].astype({"id": "Int64"}).assign(ids=ids)
        if source is not None:
            source.close()

    return index.mapInPandas(opened, "id long, start long, n_tokens long, ids binary")
