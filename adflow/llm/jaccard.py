"""N-gram Jaccard join with prefix filters under several token orders.

A document is its set of distinct word shingles, told apart by 64-bit digests.
Two sets of similarity ``t`` or more must share a token among the first
``n - ceil(t n) + 1`` tokens of each, under any order of all tokens. The filters
of four orders are intersected before a pair is verified:

1. Tokens of a fixed quarter of all digests, the rarest first, then the others.
   A set that has alone as many tokens of the quarter as its prefix is long can
   have no partner. Only a quarter of all tokens is shuffled to find that out.
2. Among the sets left, all tokens, the rarest first. Sets meet in the buckets of
   their prefix tokens. Where two sets meet for the first time, what follows the
   token in each of them bounds their overlap, so most pairs are never made.
3. Tokens by digest, and
4. tokens by digest with its halves exchanged: a candidate whose prefixes do not
   meet under one of these is dropped.

What is left is verified on whole sets.

Equal sets are one set before any join. In each bucket all sets are first
compared with one leader, the one with the least share of own tokens; once links
have made classes, only pairs whose sets lie in different classes are left, so a
bucket of many copies costs a comparison for each copy and not for each pair.
Other leaders are drawn while that leaves much fewer pairs. The pairs that
remain are all compared, large buckets in cells of bounded size. No link between
classes is lost.

Defined cases. Texts with fewer words than a shingle are one shingle of all
their words; null, empty and blank texts have no shingle and are linked with
nothing, not even each other. Repeated rows are rows of one class. Rows without
an id take part; a class of such rows alone has no id. Very long texts are cut
whole; one text must fit in a worker. Other columns are not read, so they may
have any name. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adflow.llm.simhash import components
from adflow.llm.tables import column, text_of
from adflow.session import stored

SHINGLE = 3
PERCENT = 90
COUNTED_BITS = 2
"""Tokens whose digest starts with so many zero bits come first in the first order: one in four."""
CELL = 2048
"""Sets of a bucket that one task compares with so many others."""
LEFT = 4
"""Leaders are drawn again while more than so many pairs for each row of a bucket are left."""
ROUNDS = 8

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Fixed odd multipliers of the places in a shingle and of the final mixing.
_PLACES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def shingle_digests(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The digests of a text's distinct shingles, sorted."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    width = min(shingle, len(words))
    mixed = np.full(len(words) - width + 1, width, np.uint64)
    for place in range(width):
        mult = np.uint64(_PLACES[place % len(_PLACES)] + 2 * (place // len(_PLACES)))
        mixed += hashes[place : place + len(mixed)] * mult
        mixed ^= mixed >> np.uint64(31)
    for shift, mult in zip((30, 27), _MIX):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(mult)
    mixed ^= mixed >> np.uint64(31)
    mixed.sort()
    return mixed[np.concatenate(([True], mixed[1:] != mixed[:-1]))]


def prefix_length(n: Column | int, percent: int = PERCENT):
    """How many first tokens a set of ``n`` must share with another one: ``n - ceil(percent n / 100) + 1``."""
    whole = n * percent + 99
    return n - (F.floor(whole / 100) if isinstance(n, Column) else whole // 100) + 1


def _turned(tokens: np.ndarray) -> np.ndarray:
    return (tokens << np.uint64(32)) | (tokens >> np.uint64(32))


def _list_array(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.uint64).view(np.int64)))


def _set_rows(shingle: int):
    """Of (id, text_digest, text): size, key and the tokens of the first order's quarter."""
    cut = np.uint64(1 << (64 - COUNTED_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, quarters = [], [], []
            for text in batch.column(2).cast(pa.binary()):
                tokens = shingle_digests(text.as_py(), shingle)
                sizes.append(len(tokens))
                keys.append(xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None)
                quarters.append(tokens[: np.searchsorted(tokens, cut)])
            arrays = [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), _list_array(quarters)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["id", "text_digest", "n", "set_key", "quarter"])

    return run


def _whole_sets(shingle: int, percent: int):
    """Of texts: key, all tokens, and the prefixes of the third and fourth order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sets, thirds, fourths = [], [], [], []
            for text in batch.column(0).cast(pa.binary()):
                tokens = shingle_digests(text.as_py(), shingle)
                length = prefix_length(len(tokens), percent)
                keys.append(xxhash.xxh3_128_digest(tokens.tobytes()))
                sets.append(tokens)
                thirds.append(tokens[:length])
                fourths.append(np.sort(_turned(tokens))[:length])
            arrays = [pa.array(keys, pa.binary()), *map(_list_array, (sets, thirds, fourths))]
            yield pa.RecordBatch.from_arrays(arrays, ["set_key", "tokens", "third", "fourth"])

    return run


def document_sets(docs: DataFrame, id_column: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """(row, id, text_digest, n, set_key, quarter) of each row, written."""
    kind = docs.select(column(docs, id_column)).schema[0].dataType.simpleString()
    whole = text_of(docs, text)
    rows = docs.select(column(docs, id_column).alias("id"), F.xxhash64(whole).alias("text_digest"), whole.alias("text"))
    schema = f"id {kind}, text_digest long, n long, set_key binary, quarter array<long>"
    sets = rows.mapInArrow(_set_rows(shingle), schema)
    return stored(sets.withColumn("row", F.monotonically_increasing_id()), "sets")


def _counted(tokens: DataFrame) -> DataFrame:
    """(token, members, sid): how many sets have a token, and one of these sets; takes (token, sid)."""
    return tokens.groupBy("token").agg(F.count("*").alias("members"), F.min("sid").alias("sid"))


def _own_tokens(counted: DataFrame) -> DataFrame:
    """(sid, own): how many tokens a set has that no other set has."""
    return counted.where("members = 1").groupBy("sid").agg(F.count("*").alias("own"))


def with_partners(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The distinct sets (sid, n, ..) that the first order leaves: their prefix has a token that others may have."""
    own = _own_tokens(_counted(sets.select("sid", F.explode("quarter").alias("token"))))
    left = sets.drop("quarter").join(stored(own, "own-tokens").hint("merge"), "sid", "left")
    return left.where(F.coalesce("own", F.lit(0)) < prefix_length(F.col("n"), percent)).drop("own")


def whole_sets(docs: DataFrame, sets: DataFrame, text: str, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(sid, n, tokens, third, fourth) of the given sets, written; only their texts are read again."""
    whole = text_of(docs, text)
    texts = docs.select(F.xxhash64(whole).alias("text_digest"), whole.alias("text"))
    # Texts, arrays and tokens are merged at every size: no plan that only a small table can have.
    texts = texts.join(sets.select("text_digest").distinct().hint("merge"), "text_digest", "left_semi").distinct()
    schema = "set_key binary, tokens array<long>, third array<long>, fourth array<long>"
    found = texts.select("text").mapInArrow(_whole_sets(shingle, percent), schema)
    return stored(found.join(sets.select("sid", "n", "set_key").hint("merge"), "set_key").drop("set_key"), "whole-sets")


def rare_prefixes(found: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(token, sid, n, own, place, members): prefix tokens of the second order that at least two sets have, written.

    A set's own tokens come first in the order and meet no other set, so they
    are only counted; a set with a prefix of own tokens is left out. ``place`` is
    that of the token in the order of all tokens of the set, from 1.
    """
    # One pass over the tokens: a row for each frequent token, and a row for each set with the number of its own ones.
    counted = _counted(found.select("sid", F.explode("tokens").alias("token")))
    single = F.col("members") == 1
    counted = counted.groupBy(F.when(~single, F.col("token")).alias("token"), F.when(single, F.col("sid")).alias("sid"))
    counted = stored(counted.agg(F.max("members").alias("members"), F.count("*").alias("own")), "counted")
    own = counted.where("token IS NULL").select("sid", "own")
    frequent = counted.where("token IS NOT NULL").select("token", "members")
    told = found.select("sid", "n", "tokens").join(own.hint("merge"), "sid", "left").fillna(0, ["own"])
    told = told.where(F.col("own") < prefix_length(F.col("n"), percent))
    tokens = told.select("sid", "n", "own", F.explode("tokens").alias("token"))
    # A merge also lets hot tokens be split.
    shared = tokens.join(frequent.hint("merge"), "token")
    unsigned = F.col("token").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
    place = F.row_number().over(Window.partitionBy("sid").orderBy("members", unsigned)) + F.col("own")
    kept = shared.withColumn("place", place).where(F.col("place") <= prefix_length(F.col("n"), percent))
    met = stored(kept.select("token", "sid", "n", "own", "place"), "prefixes")
    buckets = met.groupBy("token").agg(F.count("*").alias("members")).where("members > 1")
    return stored(met.join(stored(buckets, "buckets"), "token"), "prefixes")


def _can_link(n: str, place: str, other_n: str, other_place: str, percent: int) -> Column:
    """Whether sets that meet at a token may be similar enough if they have no token before it in common.

    Two sets that link pass this at the first token of the order that they share;
    that they may fail it at later ones does no harm.
    """
    most = F.least(F.col(n) - F.col(place), F.col(other_n) - F.col(other_place)) + 1
    return most * (100 + percent) >= (F.col(n) + F.col(other_n)) * percent


def leader_pairs(prefixes: DataFrame, draw: int, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) of each bucket's leader and its other sets.

    The first leader is the set with the least share of own tokens; later ones are drawn.
    """
    rank = F.floor(F.col("own") * 1_000_000 / F.col("n")) if draw == 0 else F.xxhash64(F.lit(draw), "sid")
    lot = F.struct(rank.alias("rank"), *[F.col(c).alias(f"leader_{c}") for c in ("sid", "n", "place")])
    leaders = stored(prefixes.groupBy("token").agg(F.min(lot).alias("l")).select("token", "l.*").drop("rank"), "leaders")
    met = prefixes.join(leaders, "token").where("sid <> leader_sid").where(_can_link("n", "place", "leader_n", "leader_place", percent))
    return met.select(F.least("sid", "leader_sid").alias("a"), F.greatest("sid", "leader_sid").alias("b")).distinct()


def remaining_pairs(prefixes: DataFrame, cell: int = CELL, percent: int = PERCENT) -> DataFrame:
    """All pairs (a, b) of a bucket in different classes that may link; takes (token, sid, n, place, root, members).

    A bucket of more than ``cell`` sets is cut into blocks, and each pair of
    blocks is a cell of its own: a set goes to as many cells as there are blocks.
    """
    blocks = F.ceil(F.col("members") / cell).cast("int")
    rows = prefixes.withColumn("block", F.pmod(F.xxhash64("sid"), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    own = ["block", "sid", "n", "place", "root"]
    rows = rows.select("token", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), *own)
    a, b = [rows.select("token", "low", "high", *[F.col(c).alias(f"{side}_{c}") for c in own]) for side in "ab"]
    once = (F.col("low") == F.col("high")) | (F.col("a_block") != F.col("b_block"))
    pairs = a.join(b, ["token", "low", "high"]).where("a_sid < b_sid AND a_root <> b_root").where(once)
    pairs = pairs.where(_can_link("a_n", "a_place", "b_n", "b_place", percent))
    return pairs.select(F.col("a_sid").alias("a"), F.col("b_sid").alias("b")).distinct()


def verified(pairs: DataFrame, found: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs that share prefix tokens under the third and fourth order and are similar enough as whole sets, written."""

    def end(name: str, *columns: str) -> DataFrame:
        return found.select(F.col("sid").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in columns]).hint("merge")

    near = stored(pairs, "pairs").join(end("a", "third", "fourth"), "a").join(end("b", "third", "fourth"), "b")
    near = near.where(F.arrays_overlap("a_third", "b_third") & F.arrays_overlap("a_fourth", "b_fourth")).select("a", "b")
    met = stored(near, "candidates").join(end("a", "tokens"), "a").join(end("b", "tokens"), "b")
    common = F.size(F.array_intersect("a_tokens", "b_tokens"))
    union = F.size("a_tokens") + F.size("b_tokens") - common
    return stored(met.where(common * 100 >= union * percent).select("a", "b"), "links")


def set_classes(found: DataFrame, percent: int = PERCENT, cell: int = CELL) -> DataFrame:
    """(sid, root): the class of each set that has a link; takes whole sets."""
    prefixes = rare_prefixes(found, percent)
    links, left = None, None
    for draw in range(ROUNDS):
        linked = verified(leader_pairs(prefixes, draw, percent), found, percent)
        links = linked if links is None else links.unionByName(linked)
        roots = stored(components(links).select(F.col("f").alias("sid"), "root"), "roots")
        rooted = prefixes.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
        same = rooted.groupBy("token", "root").agg(F.count("*").alias("k"))
        mixed = same.groupBy("token").agg(F.sum("k").alias("m"), F.sum(F.col("k") * F.col("k")).alias("s"), F.count("*").alias("roots"))
        mixed = stored(mixed.where("roots > 1").selectExpr("token", "m", "(m * m - s) div 2 AS pairs"), "mixed")
        before, counts = left, mixed.agg(F.sum("pairs"), F.sum("m")).first()
        left, rows = counts[0] or 0, counts[1] or 0
        if left <= LEFT * rows or (before is not None and left * 2 > before):
            break
    rooted = stored(rooted.join(mixed.select("token"), "token", "left_semi"), "rooted")
    last = verified(remaining_pairs(rooted, cell, percent), found, percent)
    return components(links.unionByName(last)).select(F.col("f").alias("sid"), "root")


def jaccard_classes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    cell: int = CELL,
) -> DataFrame:
    """A row (id, n_shingles, component_id) for each row: the smallest id that links reach.

    Two sets link if 100 times the size of their intersection is at least
    ``percent`` times that of their union.
    """
    rows = document_sets(docs, id_column, text, shingle)
    named = rows.where(F.col("set_key").isNotNull()).groupBy("set_key").agg(F.min("id").alias("least"), F.min("row").alias("row"))
    named = stored(named, "distinct-sets")
    sets = rows.join(named.select("row").hint("merge"), "row", "left_semi").select(F.col("row").alias("sid"), "set_key", "text_digest", "n", "quarter")
    near = stored(with_partners(sets, percent), "near-sets")
    roots = set_classes(whole_sets(docs, near, text, shingle, percent), percent, cell)
    rooted = named.join(roots.withColumnRenamed("sid", "row"), "row", "left")
    rooted = stored(rooted.select("set_key", "least", F.coalesce("root", "row").alias("root")), "rooted")
    ids = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "class-ids")
    classes = stored(rooted.join(ids, "root").select("set_key", "component_id"), "classes")
    own = F.when(F.col("set_key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return rows.select("id", "n", "set_key").join(classes, "set_key", "left").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), own.alias("component_id")
    )
