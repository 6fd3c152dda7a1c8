"""Prefix trie of conversations that are rebuilt from heads of others, by composable fingerprints.

A conversation is rebuilt from the first turns of its base conversation and its
own turns after as many. No rebuilt text is made. The fingerprint of a run of
turns is a monoid element (turns, words, lanes): a lane is the sum of
``hash * M^place`` modulo a prime, so

    (n, w, s) . (m, v, t) = (n + m, w + v, s + M^n t)

and what remains of a run after its head is dropped follows by division. Ranges
of the ordered turns are summed on their own and composed, so one very long
conversation is spread over many tasks. A rebuilt prefix is the base's head
composed with a part of the own run, computed from stored prefix elements.

Prefixes of equal depth and fingerprint are a group. A group is a node if its
members agree in their parent's fingerprint and in their last turn. Equal turn
references are equal turns; where references differ, the stored roles and texts
behind them are compared. If any group fails, other hashes are taken for all.

The smallest member of a node names it. It names a path from some depth of its
conversation to its end, so whatever is summed over a subtree is summed over
members: each member brings what its own path holds from the node's depth on.
This is linear in the turns, whatever the depth.

Defined cases. Null roles and texts are empty. Turns are ordered by number, null
first; turns of one number by their hash. Rows without a conversation id belong
to no conversation and are left out. Repeated rows are turns of their own. Very
long texts are hashed and counted whole. Other columns are not read, so they may
have any name. A table without conversations gives no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count, groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adflow.llm.tables import column, text_of
from adflow.session import stored

BASE = 20
HEADS = 4
"""A head has fewer turns than this."""
PRIME = (1 << 31) - 1
LANES = 4
_ROOTS = (16807, 48271, 69621, 39373)
"""Bases of the lanes."""
_DIGIT = 6
_DIGITS = 7
_ID_BITS = 12
WORD = r"[^\x20\x09-\x0D]+"


def _at(table: list[int], index: Column) -> Column:
    return F.get(F.expr(f"array({', '.join(f'{v}L' for v in table)})"), index.cast("int"))


def power(exponent: Column, root: int, prime: int) -> Column:
    """``root^exponent`` modulo the prime, for exponents below 2^42: one factor for each six bits."""
    result = None
    for digit in range(_DIGITS):
        step = pow(root, 1 << (_DIGIT * digit), prime)
        table = [pow(step, k, prime) for k in range(1 << _DIGIT)]
        here = F.shiftright(exponent, _DIGIT * digit).bitwiseAND(F.lit((1 << _DIGIT) - 1).cast("long"))
        factor = _at(table, here)
        result = factor if result is None else (result * factor) % prime
    return result


def _lanes(prefix: str) -> list[str]:
    return [f"{prefix}{i}" for i in range(LANES)]


def _mod(value: Column, prime: int) -> Column:
    return F.pmod(value, F.lit(prime).cast("long"))


def _packed(lanes: list[Column]) -> list[Column]:
    """Four lanes of 31 bits as two longs."""
    return [F.shiftleft(a, 31).bitwiseOR(b) for a, b in zip(lanes[::2], lanes[1::2])]


def ordered_turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str, partitions: int | None = None) -> DataFrame:
    """The turns, range-partitioned in order and written: (rid, conv_id, role, text).

    ``rid`` is the reference of a turn. Its upper bits are the number of its
    range, its lower ones the place there.
    """
    own, number = column(conversations, conv_id).cast("long"), column(conversations, turn)
    rows = conversations.where(own.isNotNull()).select(
        own.alias("conv_id"), number.alias("turn"), text_of(conversations, role).alias("role"), text_of(conversations, text).alias("text")
    )
    rows = rows.withColumn("digest", F.xxhash64("role", "text"))
    order = ["conv_id", "turn", "digest"]
    ranged = rows.repartitionByRange(*([] if partitions is None else [partitions]), *order).sortWithinPartitions(*order)
    return stored(ranged.select(F.monotonically_increasing_id().alias("rid"), "conv_id", "role", "text"), "turns")


def run_prefixes(turns: DataFrame, salt: int, prime: int) -> DataFrame:
    """The element of each prefix of the own turns: (rid, conv_id, place, w, words, s0.., b0..).

    ``s`` are the lanes up to the turn and ``b`` those before it.
    """
    hashes = [_mod(F.xxhash64(F.lit(salt * LANES + i), F.col("role"), F.col("text")), prime).alias(f"h{i}") for i in range(LANES)]
    part = F.shiftright("rid", 33).alias("part")
    rows = turns.select("rid", "conv_id", part, F.regexp_count("text", F.lit(WORD)).cast("long").alias("w"), *hashes)
    along = Window.partitionBy("conv_id", "part").orderBy("rid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("near", F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("rid")).cast("long"))
    weighted = {f"t{i}": (F.col(f"h{i}") * power(F.col("near"), _ROOTS[i], prime)) % prime for i in range(LANES)}
    rows = rows.withColumns(weighted)
    sums = {f"r{i}": _mod(F.sum(f"t{i}").over(along), prime) for i in range(LANES)}
    rows = stored(rows.withColumns({**sums, "run_words": F.sum("w").over(along)}).drop(*_lanes("h")), "runs")

    # One element for each range of a conversation, composed in order. A conversation that lies in one
    # range needs nothing, so at most two rows for each range are left.
    ends = [F.max("near").alias("length"), F.max("run_words").alias("run_words")]
    ends += [F.max_by(f"r{i}", "near").alias(f"r{i}") for i in range(LANES)]
    wholes = rows.groupBy("conv_id", "part").agg(*ends)
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    wholes = wholes.withColumns({"ahead": F.coalesce(F.sum("length").over(earlier), F.lit(0)), "words_ahead": F.sum("run_words").over(earlier)})
    shifted = {f"r{i}": (F.col(f"r{i}") * power(F.col("ahead"), _ROOTS[i], prime)) % prime for i in range(LANES)}
    wholes = wholes.withColumns(shifted)
    summed = [_mod(F.sum(f"r{i}").over(earlier), prime).alias(f"a{i}") for i in range(LANES)]
    starts = stored(wholes.select("conv_id", "part", "ahead", "words_ahead", *summed).where("ahead > 0"), "starts")

    joined = rows.join(starts, ["conv_id", "part"], "left").fillna(0, ["ahead", "words_ahead", *_lanes("a")])
    through, before = [], []
    for i in range(LANES):
        shift = power(F.col("ahead"), _ROOTS[i], prime)
        through.append(_mod(F.col(f"a{i}") + (F.col(f"r{i}") * shift) % prime, prime).alias(f"s{i}"))
        rest = _mod(F.col(f"r{i}") - F.col(f"t{i}"), prime)
        before.append(_mod(F.col(f"a{i}") + (rest * shift) % prime, prime).alias(f"b{i}"))
    place, words = F.col("ahead") + F.col("near"), F.col("words_ahead") + F.col("run_words")
    return stored(joined.select("rid", "conv_id", place.alias("place"), "w", words.alias("words"), *through, *before), "prefixes")


def _plans(prefixes: DataFrame, base: int, heads: int) -> DataFrame:
    """How each conversation is rebuilt: head length k from the base, own turns skipped, and the elements at both cuts."""
    kept = F.struct("place", "rid", "w", "words", *_lanes("s"), *_lanes("b"))
    firsts = F.sort_array(F.collect_list(F.when(F.col("place") < heads, kept)))
    whole = prefixes.groupBy("conv_id").agg(F.max("place").alias("n"), F.max("words").alias("own_words"), firsts.alias("firsts"))
    whole = stored(whole, "conversations")
    wanted = F.crc32(F.col("conv_id").cast("string")) % heads
    own = whole.withColumns({"wanted": wanted, "base_id": F.col("conv_id") - F.col("conv_id") % base})
    bases = whole.select(F.col("conv_id").alias("base_id"), F.col("n").alias("base_n"), F.col("firsts").alias("base_firsts"))
    both = own.join(bases, "base_id", "left").withColumns(
        {"k": F.least("wanted", F.coalesce("base_n", F.lit(0))), "skip": F.least("wanted", "n")}
    )

    def cut(firsts: str, at: str, field: str) -> Column:
        return F.when(F.col(at) > 0, F.get(F.col(firsts), (F.col(at) - 1).cast("int"))[field]).otherwise(F.lit(0).cast("long"))

    cuts = [cut("base_firsts", "k", f"s{i}").alias(f"k{i}") for i in range(LANES)]
    cuts += [cut("firsts", "skip", f"s{i}").alias(f"o{i}") for i in range(LANES)]
    head_words, skipped = cut("base_firsts", "k", "words"), cut("firsts", "skip", "words")
    return stored(
        both.select(
            "conv_id", "k", "skip", *cuts,
            F.coalesce(F.slice("base_firsts", F.lit(1), F.col("k").cast("int")), F.array().cast(whole.schema["firsts"].dataType)).alias("head"),
            head_words.alias("head_words"), skipped.alias("skipped_words"),
            (F.col("k") + F.col("n") - F.col("skip")).alias("length"),
            (head_words + F.col("own_words") - skipped).alias("total"),
        ),
        "plans",
    )


def _rebuilt(prefixes: DataFrame, plans: DataFrame, heads: int, prime: int) -> DataFrame:
    """A row for each rebuilt prefix: (conv_id, length, depth, fa, fb, pa, pb, rid, w, ahead) with ``ahead`` the words before its last turn."""
    tail = prefixes.join(plans.drop("head"), "conv_id").where(F.col("place") > F.col("skip"))
    back = F.col("skip") - F.col("k")

    def composed(lane: str, i: int) -> Column:
        inverse = [pow(pow(_ROOTS[i], -1, prime), e, prime) for e in range(heads)]
        rest = _mod(F.col(f"{lane}{i}") - F.col(f"o{i}"), prime)
        return _mod(F.col(f"k{i}") + (rest * _at(inverse, back)) % prime, prime)

    names = ["fa", "fb", "pa", "pb"]
    ends = _packed([composed("s", i) for i in range(LANES)]) + _packed([composed("b", i) for i in range(LANES)])
    ahead = F.col("head_words") + F.col("words") - F.col("w") - F.col("skipped_words")
    own = tail.select(
        "conv_id", "length", (F.col("place") - back).alias("depth"), *[e.alias(n) for e, n in zip(ends, names)], "rid", "w", ahead.alias("ahead")
    )
    head = plans.select("conv_id", "length", F.explode("head").alias("t"))
    ends = _packed([F.col(f"t.s{i}") for i in range(LANES)]) + _packed([F.col(f"t.b{i}") for i in range(LANES)])
    ahead = F.col("t.words") - F.col("t.w")
    first = head.select(
        "conv_id", "length", F.col("t.place").alias("depth"), *[e.alias(n) for e, n in zip(ends, names)], "t.rid", "t.w", ahead.alias("ahead")
    )
    return stored(own.unionByName(first), "rebuilt")


def _differ(groups: DataFrame, members: DataFrame, turns: DataFrame) -> bool:
    """Whether some group of equal fingerprints holds different prefixes."""
    if not groups.where("low_parent <> high_parent").isEmpty():
        return True
    # Equal references need no look; the others meet the text of their group's first reference.
    pairs = stored(members.where("rid <> first_rid").select("rid", "first_rid").distinct(), "references")
    content = turns.select("rid", F.struct("role", "text").alias("content"))
    first = content.select(F.col("rid").alias("first_rid"), F.col("content").alias("first_content"))
    seen = pairs.join(content, "rid").join(first, "first_rid")
    return not seen.where(F.col("content") != F.col("first_content")).isEmpty()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each node, which come in order; no more than one piece is held."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    done: list[tuple] = []
    for (owner, depth), pieces in groupby(rows(), key=itemgetter(0, 1)):
        digest = hashlib.sha256()
        for i, piece in enumerate(pieces):
            digest.update((("," if i else "") + piece[2]).encode())
        done.append((owner, depth, digest.hexdigest()))
        if len(done) == 10_000:
            yield _as_batch(done)
            done = []
    yield _as_batch(done)


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))]
    return pa.RecordBatch.from_arrays(arrays, ["owner", "depth", "ends_sha256"])


def _end_digests(ends: DataFrame) -> DataFrame:
    """(owner, depth, ends_sha256) from (owner, depth, conv_id) rows.

    Ids of one range of 4,096 make a piece of text; a hash needs its pieces in
    order, so a node's pieces, not its ids, meet in one task and pass through.
    """
    bucket = F.shiftright("conv_id", _ID_BITS).alias("bucket")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    pieces = ends.groupBy("owner", "depth", bucket).agg(ids.alias("ids"))
    dealt = pieces.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "bucket")
    return dealt.select("owner", "depth", "ids").mapInArrow(_digests, "owner long, depth long, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    base: int = BASE,
    heads: int = HEADS,
    partitions: int | None = None,
    first_prime: int = PRIME,
) -> DataFrame:
    """A row for each node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    Conversation c takes the first ``crc32(c) % heads`` turns of conversation
    ``c - c % base``. ``first_prime`` is the modulus of the first try; a small
    prime that divides no base of a lane, such as 13, makes fingerprints collide.
    """
    turns = ordered_turns(conversations, conv_id, turn, role, text, partitions)
    for salt in count():
        prime = first_prime if salt == 0 else PRIME
        prefixes = run_prefixes(turns, salt, prime)
        plans = _plans(prefixes, base, heads)
        rows = _rebuilt(prefixes, plans, heads, prime)
        parents = F.struct("pa", "pb")
        groups = stored(
            rows.groupBy("depth", "fa", "fb").agg(
                F.min("conv_id").alias("owner"),
                F.max("length").alias("longest"),
                F.min("rid").alias("first_rid"),
                F.min(parents).alias("low_parent"),
                F.max(parents).alias("high_parent"),
            ),
            "groups",
        )
        named = groups.select("depth", "fa", "fb", "owner", "longest", "first_rid")
        members = stored(rows.join(named, ["depth", "fa", "fb"]).drop("fa", "fb", "pa", "pb"), "members")
        if not _differ(groups, members, turns):
            break

    root = plans.agg(F.min("conv_id")).first()[0]
    foreign = F.col("owner") != F.col("conv_id")
    shared_depth = F.when(foreign, F.col("depth"))
    ends_here = (F.col("depth") == F.col("length")) & ~foreign & (F.col("longest") == F.col("length"))
    paths = members.groupBy("conv_id").agg(
        F.max(shared_depth).alias("shared"),
        F.max_by("owner", shared_depth).alias("attached"),
        F.max(F.when(foreign, F.col("ahead") + F.col("w"))).alias("shared_words"),
        F.max(ends_here.cast("long")).alias("leaf"),
    )
    paths = plans.select("conv_id", "length", "total").join(paths, "conv_id", "left")
    paths = paths.fillna(0, ["shared", "shared_words", "leaf"])
    attached = F.when(F.col("shared") > 0, F.col("attached")).otherwise(F.lit(root).cast("long"))
    paths = stored(paths.withColumn("attached", attached), "paths")

    joined = members.drop("length").join(paths, "conv_id")
    depth, shared = F.col("depth"), F.col("shared")
    parent = F.when(depth > shared + 1, F.col("conv_id")).otherwise(F.col("attached"))
    nodes = joined.groupBy("owner", "depth").agg(
        F.max(F.when(F.col("owner") == F.col("conv_id"), parent)).alias("parent_conv_id"),
        F.count("*").alias("n_convs"),
        F.sum(((F.col("length") > depth) & (depth >= shared)).cast("long")).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        # All words from here on, less those of the nodes that the member itself names.
        F.sum(F.greatest(F.col("shared_words") - F.col("ahead"), F.lit(0))).alias("saved_tokens"),
    )
    turnless = F.col("length") == 0
    top = paths.agg(
        F.lit(root).cast("long").alias("owner"),
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.count("*").alias("n_convs"),
        F.sum((~turnless & (shared == 0)).cast("long")).alias("n_children"),
        F.greatest(F.sum("leaf"), F.lit(1)).alias("n_leaves"),
        F.sum("shared_words").alias("saved_tokens"),
    ).where("n_convs > 0")
    ends = members.where(F.col("depth") == F.col("length")).select("owner", "depth", "conv_id")
    empty = paths.where(turnless).select(F.lit(root).cast("long").alias("owner"), F.lit(0).cast("long").alias("depth"), "conv_id")
    digests = _end_digests(ends.unionByName(empty))
    none = F.lit(hashlib.sha256().hexdigest())
    return (
        nodes.unionByName(top)
        .join(digests, ["owner", "depth"], "left")
        .select(
            F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", none).alias("ends_sha256"),
        )
    )
