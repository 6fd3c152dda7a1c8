from __future__ import annotations

import json

import public_tokenizers
import pytest
from cases import empty_table, odd_table, prose
from pyspark.sql import functions as F
from test_bpe import ids_of, random_texts
from tokenizers import Tokenizer

from adflow.llm import token_files, units

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, rows):
    """(id, start, ids) in ascending order of id, nulls first, then text."""
    start, out = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, start, ids))
        start += len(ids)
    return out


def test_library_ids_in_units(library):
    with open(PATH, encoding="utf-8") as file:
        encoder = token_files.LibraryEncoder(file.read())
    texts = random_texts(4000)
    assert [ids_of(x) for x in encoder.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_round_trip_with_a_dictionary(spark, folder, library):
    rows = [(i * 7 % 401, prose(300 + i % 50, i)) for i in range(401)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = folder("tokens")
    token_files.write_token_files(df, path, PATH)
    head = spark.read.parquet(f"{path}/dictionary").first()
    assert len(head["dictionary"]) > 1000 and head["width"] == 2
    got = token_files.read_token_files(spark, path).orderBy("id").collect()
    assert [(r["id"], r["start"], ids_of(bytes(r["ids"]))) for r in got] == expected(library, rows)
    index = spark.read.parquet(f"{path}/index")
    assert index.agg(F.sum("length")).first()[0] < sum(2 * r["n_tokens"] for r in got) / 2
    ends = index.groupBy("file").agg(F.max(F.col("place") + F.col("length")).alias("end"), F.sum("length").alias("sum"))
    assert ends.where("end <> sum").count() == 0


def test_odd_rows(spark, folder, library):
    df = odd_table(spark)
    path = folder("tokens")
    token_files.write_token_files(df, path, PATH)
    got = token_files.read_token_files(spark, path).collect()
    found = sorted(((r["id"], r["start"], ids_of(bytes(r["ids"]))) for r in got), key=lambda r: r[1])
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert found == expected(library, rows)
    token_files.write_token_files(empty_table(spark), none := folder("tokens"), PATH)
    assert token_files.read_token_files(spark, none).count() == 0


def test_another_dictionary_is_refused(spark, folder):
    a, b = folder("tokens"), folder("tokens")
    for path, seed in ((a, 1), (b, 2)):
        rows = [(i, prose(400, i + seed * 1000)) for i in range(300)]
        token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), path, PATH)
    mixed = folder("tokens")
    spark.read.parquet(f"{b}/dictionary").write.parquet(f"{mixed}/dictionary")
    spark.read.parquet(f"{a}/index").write.parquet(f"{mixed}/index")
    with pytest.raises(Exception, match="another dictionary"):
        token_files.read_token_files(spark, mixed).collect()


def test_a_unit_is_looked_up_once_a_batch():
    class Counted(units.Kept):
        asked = 0

        def get(self, *key):
            self.asked += 1
            return super().get(*key)

    class Letters(units.UnitEncoder):
        def split(self, unit):
            return [unit]

        def encode_pieces(self, pieces):
            return [len(p).to_bytes(4, "little") for p in pieces]

    encoder = Letters({})
    encoder.spaced = Counted()
    found = encoder.encode(["one three one  three", "", "one three one three one"] * 20)
    assert found[:3] == [b"".join(n.to_bytes(4, "little") for n in row) for row in ([3, 6, 11], [0], [3, 6, 4, 6, 4])]
    assert found == found[:3] * 20 and encoder.spaced.asked <= 4


def spelled(n):
    """Words that are told apart, with marks and line breaks in some."""
    names = ["".join("aeiouéñklmnrst"[i // 14**k % 14] for k in range(5)) for i in range(n)]
    return [name + ("", ",", ".\nThe", "***", "\n(no", "'s", "7")[i % 7] for i, name in enumerate(names)]


def test_many_new_units_go_to_the_library_at_once(library):
    with open(PATH, encoding="utf-8") as file:
        encoder = token_files.LibraryEncoder(file.read())

    class Counted:
        calls, longest, model = 0, 0, encoder.model

        def tokenize(self, text):
            self.calls, self.longest = self.calls + 1, max(self.longest, len(text))
            return self.model.tokenize(text)

    encoder.model = Counted()
    texts = [" ".join(spelled(7000)), "x" * 20_000, "y" * 20_000 + " \x00\x01 z", "", "\n", " "]
    assert [ids_of(x) for x in encoder.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert encoder.model.calls < 100 and encoder.model.longest < 25_000


@pytest.mark.parametrize("change", ["a mark and a letter", "a byte of no text", "whole words"])
def test_units_go_apart_where_the_vocabulary_may_join_them(change):
    held = json.loads(Tokenizer.from_file(PATH).to_str())
    model = held["model"]
    if change == "whole words":
        model["ignore_merges"] = True
    else:
        left, right = (".", "T") if change == "a mark and a letter" else ("e", "\u00c1")
        model["vocab"][left + right] = max(model["vocab"].values()) + 2
        model["merges"].insert(0, [left, right])
    encoder, other = token_files.LibraryEncoder(json.dumps(held)), Tokenizer.from_str(json.dumps(held))
    texts = [*random_texts(200), "end.The next", " ".join(spelled(300))]
    assert not encoder.joins
    assert [ids_of(x) for x in encoder.encode(texts)] == [e.ids for e in other.encode_batch(texts, add_special_tokens=False)]
