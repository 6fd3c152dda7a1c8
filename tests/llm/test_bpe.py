from __future__ import annotations

import random

import public_tokenizers
import pytest
from cases import empty_table, odd_table, prose
from tokenizers import Tokenizer

from adflow.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [*"abcdefgz'  \n\t\r.,!#_-0123٣é漢字١²½ⅧǅÀß́ 　​\x1c\x85\x00̀😀", "<|endoftext|>", "  ", "\n\n", " the", "'s", "'ll", "wörd"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Encoder(bpe.Vocabulary(file.read()))


def random_texts(n: int) -> list[str]:
    rng = random.Random(4)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(n)] + ["", prose(3000), "ab" * 4000, "é" * 900]


def ids_of(encoded: bytes) -> list[int]:
    return [int.from_bytes(encoded[i : i + 4], "little") for i in range(0, len(encoded), 4)]


def test_ids_are_the_library_s(library, encoder):
    texts = random_texts(8000)
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids_of(x) for x in encoder.encode(texts)] == expected
    again = [x for t in texts[:500] for x in encoder.encode([t])]
    assert [ids_of(x) for x in again] == expected[:500]


def test_scan_and_heap_agree(encoder):
    for word in (b"incomprehensibilities", b"aaaaaaaaab", "żółć".encode(), b"x"):
        first = [encoder.vocabulary.first[b] for b in word]
        [(_, ids, bounds)] = [r for r in encoder.by_scan([word], {len(word): [0]}) if len(r[0])]
        heap_ids, heap_bounds = encoder.by_heap(first)
        assert ids[0].tolist() == heap_ids and bounds[0].tolist() == heap_bounds
        assert b"".join(encoder.vocabulary.bytes_of[i] for i in heap_ids) == word


def test_caches_stay_bounded(encoder):
    small = bpe.Encoder(encoder.vocabulary)
    small.kept = 50
    texts = random_texts(400)
    assert small.encode(texts[:200]) + small.encode(texts[200:]) == encoder.encode(texts)
    small.encode(["a b"])
    assert len(small.spaced) < 50


def test_decoding_as_the_library(spark, library):
    rng = random.Random(2)
    rows = [([rng.randrange(50257) for _ in range(rng.randint(0, 12))],) for _ in range(300)]
    got = bpe.decode(spark.createDataFrame(rows, "token_ids array<int>"), PATH).collect()
    assert all(r["decoded"] == library.decode(r["token_ids"], skip_special_tokens=False) for r in got)
    odd = spark.createDataFrame([(None,), ([],), ([60000, 64],)], "token_ids array<int>")
    assert [r["decoded"] for r in bpe.decode(odd, PATH).collect()] == [None, "", "a"]


def test_odd_rows(spark, library):
    df = odd_table(spark)
    back = bpe.decode(bpe.encode(df, PATH), PATH)
    assert back.columns == [*df.columns, "token_ids", "decoded"]
    rows = back.collect()
    assert len(rows) == df.count()
    for r in rows:
        assert r["token_ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["decoded"] == (r["text"] or "")
    assert bpe.decode(bpe.encode(empty_table(spark), PATH), PATH).count() == 0
