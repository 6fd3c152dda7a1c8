"""Source divergence against the contract written out."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from cases import empty_table, odd_rows, odd_table, prose
from pyspark.sql import functions as F

from adflow.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def literal_audit(rows, least_docs=3, top=200):
    """Rows (lang, source, part, item, value, rank) from (text, lang, source)."""
    docs = [(TERM.findall((t or "").translate(LOWER)), a or "", s or "") for t, a, s in rows]
    df, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for terms, lang, source in docs:
        df[lang].update(set(terms))
        counts[lang, source].update(terms)
        groups.add((lang, source))
    found = []
    for lang, source in groups:
        kept = [t for t, n in df[lang].items() if n >= least_docs]
        v = len(kept)

        def shares(own):
            total = sum(own[t] for t in kept)
            return {t: 1 + 10**9 * (own[t] + 1) // (total + v) for t in kept}

        p = shares(counts[lang, source])
        whole = Counter()
        for other in [s for a, s in groups if a == lang]:
            whole.update(counts[lang, other])
        pairs = []
        for other in [s for a, s in groups if a == lang and s != source]:
            q = shares(counts[lang, other])
            pairs.append((-sum((p[t] - q[t]) ** 2 // q[t] for t in kept), other.encode()))
        q = shares(whole)
        terms = [(-((p[t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            found += [(lang, source, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(items, 1)]
    return sorted(found)


def audited(docs, **options):
    return sorted(map(tuple, divergence.audit(docs, **options).collect()))


def some_documents(spark):
    rows = []
    for i in range(90):
        words = prose(40 + i % 7, i % 13).split()
        # Sources lean towards some words; a few words are in fewer than three documents.
        text = " ".join(words[i % 5 :] + ["Ünï", "漢字"] * (i % 4) + [f"rare{i // 2}x"] + ["dolor"] * (i % 3))
        rows.append((text.upper() if i % 6 == 0 else text, ["la", "xx", None][i % 3 if i % 7 else 0], f"s{i % 4}" if i % 9 else None))
    return rows, spark.createDataFrame(rows, "text string, lang string, source string")


@pytest.mark.parametrize("bits", [64, 5])
def test_agrees_with_the_contract_written_out(spark, monkeypatch, bits):
    monkeypatch.setattr(divergence, "FLUSH", 50)  # counts leave a task in many parts
    rows, docs = some_documents(spark)
    # With digests of five bits nearly all terms collide and are split by their texts.
    assert audited(docs.repartition(5), bits=bits, top=7) == literal_audit(rows, top=7)


def test_odd_and_empty_tables(spark):
    rows = [(r[1], r[2], r[3]) for r in odd_rows()]
    assert audited(odd_table(spark)) == literal_audit(rows)
    assert audited(odd_table(spark), least_docs=1, top=5) == literal_audit(rows, 1, 5)
    assert audited(empty_table(spark)) == []
    # Groups without any term still have their pairs, in the order of their names.
    bare = spark.createDataFrame([("1 2", "la", "b"), (None, "la", "a"), ("", "la", None)], "text string, lang string, source string")
    assert audited(bare) == literal_audit([("1 2", "la", "b"), (None, "la", "a"), ("", "la", None)])
    assert len(audited(bare)) == 6 and {r[4] for r in audited(bare)} == {0}


def test_ties_are_cut_by_the_bytes_of_the_term(spark):
    words = [f"w{c}" for c in "zyxwvutsrqponmlkjihgfedcbaéß漢"]
    rows = [(" ".join(words), "la", "a")] * 3 + [("other " * 50, "la", "b")] * 3
    got = audited(spark.createDataFrame(rows, "text string, lang string, source string"), top=4)
    assert got == literal_audit(rows, top=4)
    assert [r[3] for r in got if r[1] == "a" and r[2] == "term"] == ["wa", "wb", "wc", "wd"]


def test_very_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "_PIECE", 10)
    text = ("abc " * 50 + "x" * 100 + " -- Tail É").encode()
    pieces = list(divergence._pieces(text))
    assert len(pieces) > 10
    assert [t for p in pieces for t in p] == [b"abc"] * 50 + [b"x" * 100, b"tail", "É".encode()]


def test_shares_do_not_overflow(spark):
    counts = [(0, 1), (5, 9), (10**12, 10**12 + 7), (8 * 10**13, 9 * 10**13), (3, 9 * 10**13)]
    df = spark.createDataFrame(counts, "n long, size long")
    got = df.select(F.expr(divergence._share("n", "size")).alias("p")).collect()
    assert [r["p"] for r in got] == [1 + 10**9 * (n + 1) // size for n, size in counts]


def test_salt_that_tells_all_groups_apart(spark, monkeypatch):
    groups = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "lang string, source string")
    assert divergence._free_salt(groups) == 0
    real = divergence._hashed
    # Digests of one bit or none until the third salt.
    monkeypatch.setattr(divergence, "_hashed", lambda salt, name: real(salt, name) if salt > 1 else F.lit(0).cast("long"))
    assert divergence._free_salt(groups) == 2
