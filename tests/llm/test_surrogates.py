from __future__ import annotations

import hashlib
import re

from cases import PLAIN, empty_table, odd_table
from pyspark.sql import functions as F

from adflow.llm import surrogates

TEXT = (
    "Mail JOHN.Doe42@Mail8.Example.com or john.doe42@mail8.example.com, +1 (988) 555-2485 / +1 988 555 2485; "
    "IP 42.144.35.254. Card 4111-1111-1111-1111 or 4111111111111111, SSN 123-45-6789, IBAN DE89370400440532013000. "
    "Mr. John Smith met Mrs Smith and Mary Jones; г-н Иванов, Frau MÜLLER."
)
CLEAN = "In 1990 2000 2010 v1.2.3.4.5 he paid 12.50; Mr of the house, 1234567 and 10:30-11:45."


def draw(seed: str, at: int) -> int:
    return int(hashlib.sha256(f"{seed}#{at}".encode()).hexdigest()[:8], 16)


def luhn(digits: str) -> int:
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10


def rewritten(spark, *texts, key=surrogates.KEY):
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(texts)], PLAIN)
    return [r["text"] for r in surrogates.replace_entities(df, key=key).orderBy("doc_id").collect()]


def test_formats_and_coreference(spark):
    got, clean = rewritten(spark, TEXT, CLEAN)
    assert clean == CLEAN
    form = lambda t: re.sub("[a-zа-яüäöß]", "a", re.sub("[A-ZА-ЯÜ]", "A", re.sub("[0-9]", "0", t)))
    for pattern in (r"\+1 \(\d{3}\) \d{3}-\d{4}", r"\d{4}-\d{4}-\d{4}-\d{4}", r"(?<!\d)\d{16}(?!\d)", r"\d{3}-\d{2}-\d{4}(?!\d)"):
        [a], [b] = re.findall(pattern, TEXT)[-1:], re.findall(pattern, got)[-1:]
        assert a != b and form(a) == form(b)
    phones = re.findall(r"\+1 \(?\d{3}\)? \d{3}[- ]\d{4}", got)
    assert len({re.sub(r"\D", "", p) for p in phones}) == 1 and len(phones) == 2
    cards = {re.sub("-", "", c) for c in re.findall(r"(?<![A-Z\d])\d{4}-?\d{4}-?\d{4}-?\d{4}(?!\d)", got)}
    assert len(cards) == 1 and luhn(cards.pop()) == 0 and luhn("4111111111111111") == 0
    mails = re.findall(r"\S+@\S+\.example\b", got)
    assert len(mails) == 2 and len(set(mails)) == 1 and form(mails[0].split("@")[0]) == "aaaa.aaa00"
    [iban] = re.findall(r"DE\d{20}", got)
    moved = "".join(str(int(c, 36)) for c in iban[4:] + iban[:4])
    assert int(moved) % 97 == 1 and iban != "DE89370400440532013000"
    ip = re.search(r"IP (\d+)\.(\d+)\.(\d+)\.(\d+)\.", got)
    assert 240 <= int(ip[1]) < 255 and all(int(x) < 256 for x in ip.groups())
    names = re.search(r"Mr\. (\w+) (\w+) met Mrs (\w+) and (\w+) (\w+); г-н ([А-Я][а-я]+), Frau (\w+)\.", got)
    assert names[1] in surrogates.GIVEN["m"] and names[4] in surrogates.GIVEN["f"]
    assert names[2] == names[3] != "Smith" and names[5] != "Jones" and names[6] != "Иванов" and names[7].isupper()
    shape = lambda w: re.sub("[aeiou]", "v", re.sub("[^aeiou]", "c", w.lower()))
    assert shape(names[2]).translate(str.maketrans("vc", "vc")) == "ccvcc"


def test_texts_are_searched_once(spark):
    """The search for mentions is over when the result is planned; only texts with one are cut at them."""
    df = spark.createDataFrame([(1, TEXT, None, None, 0), (2, CLEAN, None, None, 0), (3, None, None, None, 0)], PLAIN)
    got = surrogates.replace_entities(df)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan.upper() and "regexp_extract_all" not in plan
    assert {r["doc_id"]: r["n_entities"] for r in got.collect()} == {1: 14, 2: 0, 3: 0}


def test_digits_by_a_literal_draw(spark):
    [got] = rewritten(spark, "call 988-555-2485 now", key="k")
    norm = "9885552485"
    drawn = norm[0] + "".join(str(draw(f"k|phone|{norm}|0", i) % 10) for i in range(1, 10))
    assert got == f"call {drawn[:3]}-{drawn[3:6]}-{drawn[6:]} now"
    assert rewritten(spark, "call 988-555-2485 now", key="other") != [got]


def test_distinct_and_never_an_original(spark):
    """Few given names for many persons, and candidates that are taken."""
    ips = [f"10.0.{i // 250}.{i % 250}" for i in range(400)]
    names = sorted({a.capitalize() for a in (f"{x}{y}{z}" for x in "bcdfg" for y in "aeiou" for z in ("n", "ra"))})
    rows = [("ip", x) for x in ips] + [("given_m", n.lower()) for n in names]
    rows += [("phone", f"{i}55555{i % 10}") for i in range(10)]
    first = f"0{''.join(str(draw('surrogates|phone|0555550|0', i) % 10) for i in range(1, 7))}"
    rows += [("phone", first)]
    df = spark.createDataFrame(sorted(set(rows)), "kind string, norm string")
    got = surrogates.draw_surrogates(df).collect()
    assert {(r["kind"], r["norm"]) for r in got} == set(rows)
    assert len({(r["kind"], r["surrogate"]) for r in got}) == len(set(rows))
    assert not {(r["kind"], r["surrogate"]) for r in got} & set(rows)
    given = [r["surrogate"].capitalize() for r in got if r["kind"] == "given_m"]
    assert sum(g in surrogates.GIVEN["m"] for g in given) >= 8


def test_given_names_beyond_the_lists(spark):
    """Gender and script are kept though the corpus has every listed name and many more."""
    rows = []
    for gender in "mfn":
        listed = surrogates.GIVEN[gender] + surrogates.GIVEN_CYRILLIC[gender]
        others = [f"{a}{b}{c}{gender}" for a in "bdfg" for b in "aeiou" for c in "klmnp"]
        cyrillic = [f"{a}{b}{c}" for a in "бдф" for b in "аеи" for c in {"m": "кл", "f": "мн", "n": "пр"}[gender]]
        greek = [f"{a}{b}{c}" for a in "βδ" for b in "αε" for c in {"m": "κλ", "f": "μν", "n": "πρ"}[gender]]
        rows += [(f"given_{gender}", n.lower()) for n in [*listed, *others, *cyrillic, *greek, f"čeněk{gender}"]]
    got = surrogates.draw_surrogates(spark.createDataFrame(rows, "kind string, norm string")).collect()
    assert {(r["kind"], r["norm"]) for r in got} == set(rows)
    assert len({r["surrogate"] for r in got}) == len(rows) and not {r["surrogate"] for r in got} & {n for _, n in rows}
    script = lambda w: "c" if re.search("[а-яё]", w) else "g" if re.search("[α-ως]", w) else "l"
    endings = {g: tuple(e for by in surrogates.ENDINGS.values() for e in by[g]) for g in "mfn"}
    for r in got:
        assert script(r["surrogate"]) == script(r["norm"])
        assert [g for g in "mfn" if r["surrogate"].endswith(endings[g])] == [r["kind"][-1]], r


def test_forms_of_longer_surrogates(spark, monkeypatch):
    """What is drawn when a format is used up is still a name, an address or a number of its kind."""
    monkeypatch.setattr(surrogates, "MOST_DRAWS", 0)
    got = rewritten(spark, TEXT)[0]
    mails = re.findall(r"\S+@\S+\.example\b", got)
    assert len(mails) == 2 and len(set(mails)) == 1 and re.fullmatch(surrogates.PATTERNS["email"], mails[0])
    assert re.search(r"[a-z]{4}\.[a-z]{3}\d{2}\.[0-9a-f]{32}@", mails[0])
    assert len({re.sub(r"\D", "", p) for p in re.findall(r"\+1 \(?\d{3}\)? \d{3}[- ]\d{28}", got)}) == 1
    assert re.search(r"IP 2001:db8(:[0-9a-f]{4}){6}\.", got) and re.search(r"SSN 9\d\d-\d\d-\d{28},", got)
    cards = {re.sub("-", "", c) for c in re.findall(r"\b\d{4}-?\d{4}-?\d{4}-?\d{28}\b", got)}
    assert len(cards) == 1 and luhn(cards.pop()) == 0
    [iban] = re.findall(r"DE\d{32}\b", got)
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    names = re.search(r"Mr\. (\w+) (\w+) met Mrs (\w+) and (\w+) (\w+); г-н ([А-Я][а-я]+), Frau (\w+)\.$", got)
    assert names[2] == names[3] and len(names[2]) == 21 and names[7].isupper()


def test_when_a_format_is_used_up(spark):
    """Eleven one-digit entities cannot have one-digit surrogates; none is lost."""
    df = spark.createDataFrame([("surname", c) for c in "bcdfghjklmnpqrstvwxyz"], "kind string, norm string")
    got = surrogates.draw_surrogates(df).collect()
    assert len({r["surrogate"] for r in got}) == 21 and all(len(r["surrogate"]) > 1 for r in got)


def test_odd_rows(spark):
    df = odd_table(spark).withColumn("text", F.when(F.col("doc_id") == 1, "a@b.example.org").otherwise(F.col("text")))
    got = surrogates.replace_entities(df)
    assert got.columns == [*df.columns, "n_entities"]
    rows = got.collect()
    assert len(rows) == df.count()
    plain = {(str(r["doc_id"]), r["text"]) for r in df.where("doc_id is null or doc_id <> 1").collect()}
    assert {(str(r["doc_id"]), r["text"]) for r in rows if r["doc_id"] != 1} == plain
    one = {r["text"] for r in rows if r["doc_id"] == 1}
    assert len(one) == 1 and re.fullmatch(r"[a-z]@[a-z]\.[a-z]{7}\.example", one.pop())
    assert {r["n_entities"] for r in rows if r["doc_id"] != 1} == {0}
    assert surrogates.replace_entities(empty_table(spark)).count() == 0
