from __future__ import annotations

import os
import random

import numpy as np
from cases import PLAIN, empty_table, odd_table, prose

from adflow.llm import decontaminate
from adflow.llm.tables import words_of

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def literal_common(a: list, b: list) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            row[j], last = (last + 1 if x == y else max(row[j], row[j - 1])), row[j]
    return row[-1]


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.randint(1, 6) for _ in range(rng.randint(1, 64))]
        b = [rng.randint(1, 9) for _ in range(rng.randint(0, 90))]
        assert decontaminate.common(np.array(a), np.array(b, int)) == literal_common(a, b)


def test_verbatim_items_of_the_tables(spark):
    docs, benchmark = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, benchmark).collect()}
    items = [(r["item_id"], b" ".join(words_of(r["text"]))) for r in benchmark.collect()]
    expected = {
        (d["doc_id"], i) for d in docs.collect() for i, x in items if b" " + x + b" " in b" " + b" ".join(words_of(d["text"])) + b" "
    }
    assert expected and expected <= found
    # Nothing else but texts that hold most of an item in order.
    texts = {d["doc_id"]: words_of(d["text"]) for d in docs.collect()}
    for d, i in found - expected:
        item = dict(items)[i].split()
        assert literal_common(item, texts[d]) >= 0.5 * len(item)


def words(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(n)]


def test_paraphrases_and_clean_texts(spark):
    rng = random.Random(7)
    items = [words(rng.randint(15, 60), i) for i in range(40)]
    rows, leaks = [], set()
    for d in range(200):
        text = words(rng.randint(60, 400), 1000 + d)
        if d % 4 == 0:
            i = rng.randrange(40)
            body = list(items[i])
            for _ in range(len(body) // 6):
                body[rng.randrange(len(body))] = "changed"
            at = rng.randrange(len(text))
            text[at:at] = body
            leaks.add((d, i))
        if d % 4 == 1:
            # A few words of an item out of order are no leak.
            text[5:5] = rng.sample(items[d % 40], 5)
        rows.append((d, " ".join(text), None, None, 0))
    rows.append((500, "", None, None, 0))
    docs = spark.createDataFrame(rows, PLAIN).repartition(4)
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = decontaminate.find_leaks(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == leaks
    assert all(0.6 <= r["lcs"] <= 1 and r["cosine"] > 0 for r in got)
    kept = decontaminate.decontaminated(docs, benchmark)
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {d for d, _ in leaks}


def test_candidates_of_latent_search(spark):
    """The latent cosine finds at least 0.9 of the passages that the plain one ranks near."""
    rng = np.random.default_rng(5)
    items = [rng.integers(1, 800, rng.integers(15, 40)).astype(np.uint16) for _ in range(60)]
    codes = [np.concatenate([rng.integers(1, 1600, 40) % 801, items[i % 60], rng.integers(1, 1600, 30) % 801]).astype(np.uint16) for i in range(300)]
    df = spark.createDataFrame([(i, c.tobytes()) for i, c in enumerate(codes)], "id long, codes binary")
    weights = np.concatenate([[7.0], rng.uniform(2, 6, 800)]).astype(np.float32)
    basis = decontaminate.latent_basis(df, weights, items, rank=48)
    assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-3)
    passages = decontaminate.Passages(codes, weights)
    every = np.arange(len(passages.text))

    def near(vectors: np.ndarray) -> np.ndarray:
        latent = decontaminate.latent_items(items, weights, vectors)
        return passages.project(vectors, every) @ latent.T / passages.norm[:, None]

    plain = near(np.eye(801, dtype=np.float32) * (np.arange(801) > 0)[:, None])
    hits = plain >= 0.4
    assert hits.sum() >= 300 and (near(basis)[hits] >= decontaminate.COSINE).mean() >= 0.9


def leaked_corpus(items: list[list[str]], filler: int) -> tuple[list[tuple], set]:
    """A text for each item that holds it verbatim, or with a quarter of its words changed, between other words."""
    rng, rows = random.Random(11), []
    for i, item in enumerate(items):
        body = list(item)
        for at in rng.sample(range(len(body)), i % 2 * len(body) // 4):
            body[at] = f"changed{rng.randrange(10**6)}"
        around = [f"other{rng.randrange(filler)}" for _ in range(60)]
        rows.append((i, " ".join(around[:30] + body + around[30:]), None, None, 0))
    return rows, {(i, i) for i in range(len(items))}


def full_benchmark(spark, n: int):
    """Items that fill a block: words of a shared vocabulary."""
    rng, vocabulary = random.Random(3), words(6000, 9)
    items = [[vocabulary[int(6000 * rng.random() ** 1.5)] for _ in range(37)] for _ in range(n)]
    return items, spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")


def test_recall_of_a_benchmark_that_fills_a_block(spark):
    items, benchmark = full_benchmark(spark, 1050)
    rows, leaks = leaked_corpus(items, 20_000)
    got = decontaminate.find_leaks(spark.createDataFrame(rows, PLAIN).repartition(4), benchmark).collect()
    assert leaks <= {(r["doc_id"], r["item_id"]) for r in got}
    assert len(got) == len({(r["doc_id"], r["item_id"]) for r in got})
    sizes = [len(b) for b in decontaminate.blocks_of(benchmark, "item_id", "text", None)]
    assert sum(sizes) == 1050 and max(sizes) <= decontaminate.BLOCK_PASSAGES


def test_nothing_of_the_plain_cosine_is_lost(spark):
    """At a rank far below the items, what the plain cosine ranks near stays a candidate."""
    rng = np.random.default_rng(8)
    items = [rng.integers(1, 3000, 37).astype(np.uint16) for _ in range(decontaminate.BLOCK_PASSAGES)]
    codes = [np.concatenate([np.zeros(30, np.uint16), q, np.zeros(30, np.uint16)]) for q in items]
    weights = np.concatenate([[7.0], rng.uniform(2, 6, 2999)]).astype(np.float32)
    df = spark.createDataFrame([(i, c.tobytes()) for i, c in enumerate(codes)], "id long, codes binary")
    basis = decontaminate.latent_basis(df, weights, items, rank=8)
    latent, plain = decontaminate.latent_items(items, weights, basis), decontaminate.plain_items(items, weights)
    passages = decontaminate.Passages(codes, weights)
    every = np.arange(len(passages.text))
    dense = np.zeros((len(every), 3000))
    for p in every:
        at = passages.place[p] * decontaminate.STEP
        window = codes[passages.text[p]][at : at + 2 * decontaminate.STEP]
        np.add.at(dense[p], window[window > 0], weights[window[window > 0]])
    literal = dense @ plain / passages.norm[:, None]
    got = decontaminate.cosines(passages, np.hstack([basis, plain]), latent, every)
    assert (got >= literal - 1e-4).all()
    found = decontaminate._search(df, weights, basis, items, items, decontaminate.COSINE).collect()
    assert {(i, i) for i in range(len(items))} <= {(r["id"], r["item"]) for r in found}


def test_one_row_for_an_item_in_two_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 150)
    benchmark = spark.createDataFrame([(1, " ".join(words(300, 1)))], "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join(words(300, 1)), None, None, 0)], PLAIN)
    assert [(r["doc_id"], r["item_id"], r["lcs"]) for r in decontaminate.find_leaks(docs, benchmark).collect()] == [(1, 1, 1.0)]


def test_product_by_a_dense_matrix():
    rng = np.random.default_rng(2)
    codes = [(rng.integers(0, 40, n) * (rng.random(n) < 0.2)).astype(np.uint16) for n in (5, 16, 17, 100, 33, 1)]
    weights = rng.uniform(0.5, 3, 40).astype(np.float32)
    weights[[3, 4]] = 0
    rows, norms = [], []
    for c in codes:
        for start in range(0, len(c), decontaminate.STEP):
            window = c[start : start + 2 * decontaminate.STEP]
            row = np.zeros(40)
            np.add.at(row, window[window > 0], weights[window[window > 0]])
            rows.append(row)
            norms.append((weights[window].astype(float) ** 2).sum())
    a = np.array(rows) / np.sqrt(np.array(norms))[:, None]
    omega = rng.standard_normal((40, 7)).astype(np.float32)
    got = decontaminate.Passages(codes, weights).product(omega)
    assert np.allclose(got, a.T @ a @ omega, atol=1e-4)


def test_long_items_answers_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 150)
    long, short = words(200, 1), words(20, 2)
    benchmark = spark.createDataFrame(
        [(1, " ".join(long), "x"), (2, " ".join(short), " ".join(short[-3:])), (2, " ".join(short), None), (3, None, None), (4, " .", None)],
        "item_id long, text string, answer string",
    )
    half = short[:11] + words(9, 3)
    docs = spark.createDataFrame(
        [(1, " ".join(words(50, 4) + long[70:150] + words(50, 5)), None, None, 0), (2, " ".join(half), None, None, 0),
         (3, " ".join(half[:11] + short[-3:]), None, None, 0)],
        PLAIN,
    )
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, benchmark, answer="answer").collect()}
    # Half an item is a leak only if the answer is there.
    assert got == {(1, 1), (3, 2)}


def test_odd_rows(spark):
    df = odd_table(spark)
    benchmark = spark.createDataFrame([(1, prose(30_000, 3)[4000:4300]), (None, None), (2, "")], "item_id long, text string")
    got = decontaminate.find_leaks(df, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} >= {(7, 1)}
    kept = decontaminate.decontaminated(df, benchmark)
    assert kept.columns == df.columns
    ids = [str(r["doc_id"]) for r in kept.collect()]
    assert "7" not in ids and {"3", "4", "5", "6", "8", "9", "None"} <= set(ids)
    none = benchmark.where("false")
    assert decontaminate.find_leaks(df, none).count() == 0
    assert decontaminate.decontaminated(df, none).count() == df.count()
    assert decontaminate.find_leaks(empty_table(spark), benchmark).count() == 0
    assert decontaminate.decontaminated(empty_table(spark), benchmark).count() == 0
