"""Secret scan with corpus-wide ownership: who else has this credential?

Three base kinds are found in every text, and a wider kind of long mixed tokens
as candidates. The hash of each found value is counted over the whole corpus by
distinct repositories and owners. A value that more than ``max_owners`` owners
have is a widely copied example; one that few owners have looks like a live
credential of theirs. Base spans always stay; a wider candidate becomes a span
of the kind ``live`` only if it is owner-specific and lies in no base span.

Only DataFrame functions are used. Spans are code point offsets, the end
exclusive; matches are leftmost and do not overlap within a kind.

Defined cases. Null and empty texts have no spans. A null repository or owner
counts as one repository or owner. Repeated rows each get their spans and count
once. A table without rows gives none. Long texts are scanned whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.llm.tables import column, fresh_name, text_of
from adflow.session import stored

MAX_OWNERS = 2
MASK = "[SECRET]"

# Fixed patterns of the base kinds.
ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
# Candidates of the wider kind: long tokens with a capital, a small letter and a digit.
WIDE = r"[A-Za-z0-9+/_=-]{20,}"
LEAST_ASSIGNED = 12

KINDS = ("assign", "access", "hex", "live")
_SPAN = "array<struct<start:int,end:int,kind:int,value:string>>"


def _matches(text: Column, pattern: str, kind: int) -> Column:
    """All matches of a pattern as spans; the value is the matched text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(found)).alias("gap"), found.alias("found"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(done: Column, pair: Column) -> Column:
        begin = done["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["found"])
        span = F.struct(begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), pair["found"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(done["spans"], span).alias("spans"))

    spans = F.aggregate(pairs, start, step, lambda done: done["spans"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPAN))


def found_spans(text: Column) -> Column:
    """Spans of all kinds, the wider candidates included, by start and kind."""
    assigned = F.transform(
        _matches(text, ASSIGN, 0),
        lambda s: F.struct(s["start"], s["end"], s["kind"], F.regexp_extract(s["value"], ASSIGN, 1).alias("value")),
    )
    assigned = F.filter(assigned, lambda s: F.length(s["value"]) >= LEAST_ASSIGNED)
    wide = F.filter(
        _matches(text, WIDE, 3),
        lambda s: s["value"].rlike("[A-Z]") & s["value"].rlike("[a-z]") & s["value"].rlike("[0-9]"),
    )
    spans = F.concat(assigned, _matches(text, ACCESS, 1), _matches(text, HEX, 2), wide)
    keyed = F.transform(
        spans, lambda s: F.struct(s["start"], s["kind"], s["end"], F.sha2(s["value"], 256).alias("hash"))
    )
    return F.array_sort(keyed)


def ownership(spans: DataFrame) -> DataFrame:
    """(hash, repositories, owners) of found values; takes (hash, repository, owner) rows."""
    once = spans.groupBy("hash", "repository", "owner").agg(F.lit(1).alias("one"))
    named = once.select(
        "hash", F.struct("repository").alias("repository"), F.struct("owner").alias("owner")
    )
    return named.groupBy("hash").agg(
        F.count_distinct("repository").alias("repositories"), F.count_distinct("owner").alias("owners")
    )


def find_secrets(
    docs: DataFrame,
    keep: list[str],
    text: str = "text",
    repository: str = "doc_id",
    owner: str = "source",
    max_owners: int = MAX_OWNERS,
) -> DataFrame:
    """The kept columns and ``secrets`` for each row: spans (start, kind, end, hash, repositories, owners, live).

    Base kinds are all there; of the wider candidates those that no base span
    overlaps and that few owners have.
    """
    row, spans = fresh_name(docs.select(*[column(docs, k) for k in keep]), "row", "spans")
    scanned = stored(
        docs.select(
            *[column(docs, k) for k in keep],
            F.monotonically_increasing_id().alias(row),
            F.struct(
                column(docs, repository).cast("string").alias("repository"), column(docs, owner).cast("string").alias("owner")
            ).alias("of_"),
            found_spans(text_of(docs, text)).alias(spans),
        ),
        "scanned",
    )
    single = scanned.where(F.size(spans) > 0).select(
        F.col(row).alias("row"), "of_.repository", "of_.owner", F.explode(spans).alias("span")
    )
    owned = stored(ownership(single.select("span.hash", "repository", "owner")), "ownership")
    told = single.select("row", "span", F.col("span.hash").alias("hash")).join(owned, "hash")
    span = F.struct(
        "span.start", "span.kind", "span.end", "hash", "repositories", "owners", (F.col("owners") <= max_owners).alias("live")
    )
    regrouped = told.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("all_spans"))
    base = F.filter("all_spans", lambda s: s["kind"] < 3)
    outside = F.filter(
        "all_spans",
        lambda s: (s["kind"] == 3)
        & s["live"]
        & ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    kept = regrouped.select(F.col("row").alias(row), F.array_sort(F.concat(base, outside)).alias("secrets"))
    none = F.array().cast(kept.schema["secrets"].dataType)
    joined = scanned.join(kept, row, "left")
    return joined.select(*[column(scanned, k) for k in keep], F.coalesce("secrets", none).alias("secrets"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def shown(s: Column) -> Column:
        return F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))

    return F.array_join(F.transform(spans, shown), ",")


def masked(text: Column, spans: Column, mask: str = MASK) -> Column:
    """The text with a mask in place of each live span; spans that overlap get one."""
    live = F.filter(spans, lambda s: s["live"])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        ahead = F.concat(done["out"], F.substring(text, done["at"] + 1, s["start"] - done["at"]), F.lit(mask))
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(s["start"] >= done["at"], ahead).otherwise(done["out"]).alias("out"),
        )

    rest = lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
    return F.when(F.size(live) > 0, F.aggregate(live, start, step, rest)).otherwise(text)


def mask_secrets(
    docs: DataFrame,
    text: str = "text",
    repository: str = "doc_id",
    owner: str = "source",
    max_owners: int = MAX_OWNERS,
    length: str | None = None,
) -> DataFrame:
    """All rows and columns, with live-looking secrets masked in the text; widely copied examples stay.

    A column named as ``length`` gets the new length of the texts that change.

    What is found in a text depends on the text and the corpus only, so findings
    are joined by the text's digest: repeated rows and null ids need no key.
    """
    (digest,) = fresh_name(docs, "text_digest")
    keyed = docs.withColumn(digest, F.sha2(text_of(docs, text), 256))
    found = find_secrets(keyed, [digest], text, repository, owner, max_owners)
    live = found.where(F.exists("secrets", lambda s: s["live"])).dropDuplicates([digest])
    (secrets,) = fresh_name(keyed, "secrets_found")
    live = stored(live.select(digest, F.col("secrets").alias(secrets)), "live")
    joined = keyed.join(live, digest, "left")
    unchanged = F.col(secrets).isNull()
    clean = F.when(unchanged, column(docs, text)).otherwise(masked(column(docs, text), F.col(secrets)))
    # In a column of its own: names inside a lambda would find a new column of the same select.
    (fresh,) = fresh_name(joined, "masked_text")
    joined = joined.withColumn(fresh, clean)
    new = {text: F.col(fresh)}
    if length:
        chars = F.length(fresh).cast(docs.schema[length].dataType)
        new[length] = F.when(unchanged, column(docs, length)).otherwise(chars)
    return joined.select(*[new[c].alias(c) if c in new else column(docs, c) for c in docs.columns])
