"""SimHash near-duplicates with pigeonring filtering of candidate pairs.

The 64 bits of a fingerprint are cut into segments on a ring. If two
fingerprints differ in at most ``distance`` bits, some chain of consecutive
segments starts at which every prefix of ``l`` segments differs in at most
``l * distance / segments`` bits. The first prefixes of a chain have a budget
below one bit, so they must be equal: these are the join key. The other
prefixes prune the candidates before the full Hamming distance is taken.

Buckets of equal keys are joined pair by pair only while they are small. In a
large bucket each fingerprint instead emits itself with up to
``ceil(distance / 2)`` bits flipped: two fingerprints within an even distance
meet in such a middle value, and all that meet in one are within the distance,
so a star over each middle value gives the same components with work linear in
the bucket. No link is dropped. (An odd distance takes the middle of the next
even one and checks each link.)

Defined cases. Null and blank texts have no word and the fingerprint zero, which
links like any other. Fewer words than a shingle has make one shingle. Repeated
rows are rows of the same class. A row with a null id takes part, is never the
smallest id of a class unless all ids of it are null, and then the class id is
null. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.llm.tables import column, fresh_name, text_of
from adflow.session import stored

BITS = 64
SHINGLE = 3
DISTANCE = 2
SEGMENTS = 5
SEED = 42
PAIRED = 64
"""Buckets of up to so many fingerprints are joined pair by pair."""
_PIECE = 1 << 16


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a text as an unsigned integer."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
        count = 1
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        count = len(words) - shingle + 1
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype="<u8", count=count)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, count, _PIECE):
        part = hashes[start : start + _PIECE]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<u8")[0])


def fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> Column:
    """The fingerprint of each text, as a signed 64-bit integer."""

    @F.pandas_udf("long")
    def hashed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([simhash(t if isinstance(t, str) else None, shingle) for t in part], dtype="uint64").astype("int64")

    return hashed(column(docs, text).cast("string"))


def segment_bounds(segments: int) -> list[tuple[int, int]]:
    """Start and width of each segment; widths differ by one at most."""
    edges = [BITS * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _segment(value: Column, bound: tuple[int, int]) -> Column:
    start, width = bound
    return F.shiftrightunsigned(value, start).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def _apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def chain_holds(a: Column, b: Column, start: int, distance: int, segments: int) -> Column:
    """Whether each prefix of the chain at a segment keeps within its proportional budget."""
    bounds = segment_bounds(segments)
    held = F.lit(True)
    total = F.lit(0)
    for length in range(1, segments + 1):
        bound = bounds[(start + length - 1) % segments]
        total = total + _apart(_segment(a, bound), _segment(b, bound))
        held = held & (total * segments <= length * distance)
    return held


def free_prefix(distance: int, segments: int) -> int:
    """How many segments at the start of a chain must be equal."""
    return max(n for n in range(segments + 1) if n * distance < segments)


def _ring_keys(prints: DataFrame, distance: int, segments: int) -> DataFrame:
    """A row (start, key, f) for each fingerprint and each start of a chain."""
    bounds, width = segment_bounds(segments), free_prefix(distance, segments)
    if not width:
        raise ValueError("more segments than bits of distance are needed")
    keys = []
    for start in range(segments):
        key = F.lit(0).cast("bigint")
        for step in range(width):
            bound = bounds[(start + step) % segments]
            key = F.shiftleft(key, bound[1]).bitwiseOR(_segment(F.col("f"), bound))
        keys.append(F.struct(F.lit(start).alias("start"), key.alias("key")))
    return prints.select("f", F.explode(F.array(*keys)).alias("k")).select("k.start", "k.key", "f")


def _flipped(value: Column, distance: int) -> Column:
    """The value and all values up to half the distance (rounded up) away from it."""
    masks = [0]
    for n in range(1, (distance + 1) // 2 + 1):
        masks += [sum(1 << b for b in bits) for bits in combinations(range(BITS), n)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.transform(F.lit(np.array(signed, np.int64)), lambda m: value.bitwiseXOR(m))


def links(prints: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS, paired: int = PAIRED) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``f`` that connect the same classes as all pairs within the distance."""
    keyed = _ring_keys(prints, distance, segments)
    sizes = keyed.groupBy("start", "key").agg(F.count("*").alias("n")).where("n > 1")
    sized = stored(keyed.join(sizes, ["start", "key"]), "ring")
    small = sized.where(F.col("n") <= paired).select("start", "key", "f")
    a, b = small.select("start", "key", F.col("f").alias("a")), small.select("start", "key", F.col("f").alias("b"))
    held = F.lit(False)
    for start in range(segments):
        held = held | ((F.col("start") == start) & chain_holds(F.col("a"), F.col("b"), start, distance, segments))
    near = _apart(F.col("a"), F.col("b")) <= distance
    pairs = a.join(b, ["start", "key"]).where("a < b").where(held).where(near).select("a", "b")
    large = sized.where(F.col("n") > paired).select("f").distinct()
    middles = large.select("f", F.explode(_flipped(F.col("f"), distance)).alias("middle"))
    least = middles.groupBy("middle").agg(F.min("f").alias("a"), F.count("*").alias("n")).where("n > 1")
    stars = middles.join(least, "middle").select("a", F.col("f").alias("b")).where("a < b").where(near)
    if distance % 2:
        stars = middles.alias("x").join(middles.alias("y"), "middle").select(F.col("x.f").alias("a"), F.col("y.f").alias("b"))
        stars = stars.where("a < b").where(near)
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(f, root) for each end of an edge (a, b): the smallest value that it reaches.

    Large-star and small-star steps in turn, each written to the shared folder;
    the number of rounds grows with the logarithm of the longest path.
    """
    current = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    both = current.select(F.max_by("a", "b"), F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    mark = both.first()
    while mark[1]:
        around = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = around.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(least, "b")
        small = joined.select("b", "m").unionByName(joined.where("a <> m").select(F.col("a").alias("b"), "m"))
        current = stored(small.select(F.col("m").alias("a"), "b").where("a <> b").distinct(), "edges")
        before = mark
        mark = current.select(F.max_by("a", "b"), F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
    roots = current.select(F.col("a").alias("f"), F.col("a").alias("root"))
    return current.select(F.col("b").alias("f"), F.col("a").alias("root")).unionByName(roots).distinct()


def classes(rows: DataFrame, print_column: str, id_column: str, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """(f, component_id) for each distinct fingerprint of a written table: the smallest id of its class."""
    prints = rows.groupBy(column(rows, print_column).alias("f")).agg(F.min(column(rows, id_column)).alias("least"))
    prints = stored(prints, "prints")
    roots = components(links(prints.select("f"), distance, segments))
    rooted = prints.join(roots, "f", "left").select("f", "least", F.coalesce("root", "f").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(ids, "root").select("f", "component_id")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    segments: int = SEGMENTS,
) -> DataFrame:
    """A row (id, fingerprint, component_id) for each row of the table."""
    marked = docs.select(column(docs, id_column).alias("id"), fingerprint(docs, text, shingle).alias("f"))
    marked = stored(marked, "simhash")
    found = classes(marked, "f", "id", distance, segments)
    written = F.lpad(F.lower(F.hex("f")), 16, "0")
    return marked.join(found, "f").select(
        F.col("id").alias(id_column), written.alias("fingerprint"), "component_id"
    )


def deduplicated(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    segments: int = SEGMENTS,
) -> DataFrame:
    """The rows of the table with one of each class: the smallest id, of repeated ids one row.

    Rows are known by a digest of their id and text, so texts are neither
    written nor numbered. Rows that agree in both are one; which of their other
    columns stay is open.
    """
    own, whole = column(docs, id_column), text_of(docs, text)
    (key,) = fresh_name(docs, "row_digest")
    digest = F.sha2(F.concat_ws("|", F.coalesce(own.cast("string"), F.lit("-")), F.sha2(whole, 256)), 256)
    smallest = F.struct(own.isNull().alias("none"), own.alias("id"), digest.alias("key"))
    marked = stored(docs.select(smallest.alias("id"), fingerprint(docs, text, shingle).alias("print")), "simhash")
    kept = classes(marked, "print", "id", distance, segments).select(F.col("component_id.key").alias(key)).distinct()
    keyed = docs.withColumn(key, digest)
    # The join deals rows out by the key, so the duplicates need no second exchange.
    left = keyed.join(stored(kept, "kept"), key, "left_semi").dropDuplicates([key])
    return left.select(*[column(docs, c) for c in docs.columns])
