"""Byte-level token ids of whole texts, with a cache of the units a text is cut into.

A byte-level vocabulary's splitting pattern never lets a piece reach over a
blank that has no white space on either side, so a text may be cut before such
blanks and each unit encoded on its own, with the same ids. Most units repeat;
their ids are kept, short units only and up to a bounded number of bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BYTES_KEPT = 224 << 20
"""What units, pieces and their ids may take in one Python worker: a third for the pieces, if they have a cache, and a third
for each of two generations of units; the older one goes when the newer is full."""
LONGEST_KEPT = 64
"""Longer units and pieces, such as lines of base64 or text without blanks, are encoded each time."""
_ENTRY = 230
"""Bytes that an entry of a dict takes besides its text and ids."""

_SHARED_WHITE_SPACE = re.compile(r" (?:\s|\Z)")
_LONE_BLANK = re.compile(r"(?<=\S) (?=\S)")

_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ʯ", r"!-&(-/:-@\[-`{-~"
_SIMPLE = re.compile(rf"(?: ?[{_LETTERS}]+| ?[{_MARKS}]+|(?<=\S)\n(?=\S))+")
_SIMPLE_PIECE = re.compile(rf" ?[{_LETTERS}]+| ?[{_MARKS}]+|\n")
_SIMPLE_UNIT = rf"\A ?[{_LETTERS}{_MARKS}]+(?:\n[{_LETTERS}{_MARKS}]+)*\z"


def simple_pieces(unit: str) -> list[str] | None:
    """The pieces of a unit of Latin letters, ASCII marks other than apostrophes and lone line breaks; else None.

    On such units all byte-level splitting patterns in use agree: runs of letters
    and runs of marks, each with the blank before it, and the line breaks.
    """
    if unit.isascii() and unit[1:].isalpha() and (unit[0] == " " or unit[0].isalpha()):
        return [unit]
    return _SIMPLE_PIECE.findall(unit) if _SIMPLE.fullmatch(unit) else None


def are_simple(units: list[str]) -> list[bool]:
    """Whether each unit is one that ``simple_pieces`` cuts, with no blank but its first letter."""
    return pc.match_substring_regex(pa.array(units, pa.string()), _SIMPLE_UNIT).to_numpy(zero_copy_only=False).tolist()


def mixes_simple_pieces(token: str) -> bool:
    """Whether a token of a byte-level vocabulary may reach over the end of a piece of a simple unit."""
    return bool(_SIMPLE_BYTES.fullmatch(token)) and not _ONE_KIND.fullmatch(token)


class Kept(dict):
    """Ids by text, with about what they take in bytes."""

    size = 0

    def add(self, ids: dict[str, bytes]) -> list[str]:
        """Add ids; gives the texts that are too long to stay, which ``drop`` takes out again."""
        self.update(ids)
        self.size += _ENTRY * len(ids) + 2 * sum(map(len, ids)) + sum(map(len, ids.values()))
        return [text for text in ids if len(text) > LONGEST_KEPT]

    def drop(self, texts: list[str]) -> None:
        for text in texts:
            self.size -= _ENTRY + 2 * len(text) + len(self.pop(text))


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + len(letters) - len(plain))
    return [letters[b] for b in range(256)]


# The letters that stand for the bytes of simple units: Latin letters begin with 0xC3 to 0xCA.
_HIGH = "".join(re.escape(byte_letters()[b]) for b in [*range(0x80, 0xC0), *range(0xC3, 0xCB)])
_BLANK, _BREAK = byte_letters()[ord(" ")], byte_letters()[ord("\n")]
_SIMPLE_BYTES = re.compile(f"[{_BLANK}{_BREAK}A-Za-z{_HIGH}{_MARKS}]+")
_ONE_KIND = re.compile(f"{_BLANK}?[A-Za-z{_HIGH}]+|{_BLANK}?[{_MARKS}]+|[{_BLANK}{_BREAK}]+")


class UnitEncoder:
    """Ids of texts as bytes (unsigned 32-bit, little-endian); subclasses split and encode."""

    def __init__(self, special: dict[str, int], kept: int = BYTES_KEPT):
        self.special = special
        self.kept = kept
        self.spaced, self.older, self.pieces = Kept(), Kept(), Kept()
        longest_first = sorted(special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if special else None

    def split(self, unit: str) -> list[str]:
        """The pieces of a unit, in the form that ``encode_pieces`` takes."""
        raise NotImplementedError

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        raise NotImplementedError

    def units_of(self, texts: list[str]) -> tuple[list[int], pa.ListArray]:
        """The texts cut before lone blanks, which are left out, and the order that they are in."""
        shared = [i for i, text in enumerate(texts) if _SHARED_WHITE_SPACE.search(text)]
        apart = set(shared)
        plain = [i for i in range(len(texts)) if i not in apart]
        kind = pa.list_(pa.string())
        cut = [pc.split_pattern(pa.array([texts[i] for i in plain], pa.string()), " ").cast(kind)] if plain else []
        if shared:
            cut.append(pa.array([_LONE_BLANK.split(texts[i]) for i in shared], kind))
        return plain + shared, pa.concat_arrays(cut)

    def learn(self, units: list[str]) -> list[bytes]:
        """Ids of units that no cache has; their pieces may be known."""
        if self.pieces.size >= self.kept // 3:
            self.pieces = Kept()
        cut = list(map(self.split, units))
        unknown = list({p for pieces in cut if len(pieces) > 1 for p in pieces if p not in self.pieces})
        # A unit of one piece is kept as a unit, not a second time as a piece.
        ids = self.encode_pieces(unknown + [pieces[0] for pieces in cut if len(pieces) == 1])
        long = self.pieces.add(dict(zip(unknown, ids)))
        alone, known = iter(ids[len(unknown) :]), self.pieces.__getitem__
        found = [next(alone) if len(pieces) == 1 else b"".join(map(known, pieces)) for pieces in cut]
        self.pieces.drop(long)
        return found

    def ordinary(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without special tokens."""
        if self.spaced.size >= self.kept // 3:
            self.older, self.spaced = self.spaced, Kept()
        if not texts:
            return []
        order, cut = self.units_of(texts)
        places = cut.offsets.to_numpy()
        flat = cut.flatten()
        # The first unit of a text has no blank before it; the others are looked up once each, however often they occur.
        first = np.zeros(len(flat), bool)
        first[places[:-1]] = True
        body = flat.filter(pa.array(~first)).dictionary_encode()
        units = body.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.spaced.get, units))
        missing = [i for i, ids in enumerate(found) if ids is None]
        unknown = [units[i] for i in missing]
        met = list(map(self.older.get, unknown))
        learnt = iter(self.learn([" " + unit for unit, ids in zip(unknown, met) if ids is None]))
        fresh = dict(zip(unknown, [next(learnt) if ids is None else ids for ids in met]))
        self.spaced.drop(self.spaced.add(fresh))
        for i, ids in zip(missing, fresh.values()):
            found[i] = ids
        ids = pa.array(found, pa.large_binary()).take(body.indices)
        data = memoryview(ids.buffers()[2] or b"")
        ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1) if len(ids) else np.zeros(1, np.int64)
        ends = ends[places - np.arange(len(places))].tolist()
        heads = self.learn(flat.take(pa.array(places[:-1])).to_pylist())
        by_text: list[bytes] = [b""] * len(texts)
        for i, head, start, end in zip(order, heads, ends, ends[1:]):
            by_text[i] = head + data[start:end]
        return by_text

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts; strings of special tokens become their ids."""
        marked = [i for i, text in enumerate(texts) if any(s in text for s in self.special)]
        if not marked:
            return self.ordinary(texts)
        ids = self.ordinary(["" if i in set(marked) else text for i, text in enumerate(texts)])
        for i in marked:
            parts = self.cut.split(texts[i])
            between = self.ordinary(parts[::2])
            tokens = [np.array([self.special[p]], "<u4").tobytes() for p in parts[1::2]]
            ids[i] = b"".join(x for pair in zip(between, [*tokens, b""]) for x in pair)
        return ids


def held_in(sent, make):
    """What ``make`` gives for the text that a broadcast dict holds, made once in a Python worker."""
    held = sent.value
    if "made" not in held:
        held["made"] = make(held["text"])
    return held["made"]


def texts_of(batch: pa.RecordBatch, at: int) -> list[str]:
    """The texts of a column, the empty text for null."""
    return [text or "" for text in batch.column(at).to_pylist()]


def lists(parts: Iterable[bytes]) -> pa.ListArray:
    """A list of ids for each given run of bytes."""
    parts = list(parts)
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)])
    values = pa.array(np.frombuffer(b"".join(parts), "<i4"), pa.int32())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def with_columns(df: DataFrame, kinds: dict[str, T.DataType], make) -> DataFrame:
    """All columns and those that ``make`` gives for each Arrow batch; a column that has the name of a new one gives way."""
    new = {name.lower() for name in kinds}
    kept = [i for i, name in enumerate(df.columns) if name.lower() not in new]
    fields = [df.schema.fields[i] for i in kept] + [T.StructField(name, kind) for name, kind in kinds.items()]

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in kept], *make(part)], names=[f.name for f in fields])

    return df.mapInArrow(added, T.StructType(fields))
