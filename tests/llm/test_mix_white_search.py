"""Mixing, whitening and search against plain computations."""

import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from gazetta.llm import lexical, mixing, whitening
from gazetta.llm.queries import QUERIES
from pyspark.sql import functions as F

# mixing


def slow_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    held = set()
    while True:
        share = Fraction(sum(sizes.values()) - sum(most * sizes[s] for s in held), sum(weight[s] for s in names if s not in held) or 1)
        over = {s for s in names if s not in held and share * weight[s] > most * sizes[s]}
        if not over:
            return {s: Fraction(most * sizes[s]) if s in held else share * weight[s] for s in names}
        held |= over


@pytest.mark.parametrize("seed", range(4))
def test_targets_match_water_filling(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, 7, 300, 5000]) for s in [None, "", "Z", "a", "é", "\U0001f600", *(f"s{k}" for k in range(rng.randrange(9)))]}
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "_source string, _size long").withColumn("_n", F.lit(1).cast("long"))
    got, _ = mixing.targets(rows)
    want = slow_targets(sizes)
    got = {r.source: r.target for r in got.collect()}
    assert got == pytest.approx({s: float(t) for s, t in want.items()}) and sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_taken_words_come_near_the_targets_and_reruns_agree(spark):
    rows = spark.range(30000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, "rare").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"), F.repeat(F.lit("w "), (F.col("id") % 20).cast("int")).alias("text"))
    got = mixing.decide(rows)
    first = sorted(map(tuple, got.collect()))
    assert first == sorted(map(tuple, mixing.decide(rows.repartition(7)).collect()))
    for r in got.groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.sum(F.col("size") * F.col("size")).alias("spread")).collect():
        assert abs(r.taken - r.target) <= 4 * math.sqrt(r.spread) / 2 + 1
    assert got.where("taken > 3 * size").count() == 0


def test_repeats_of_one_row_are_drawn_one_by_one(spark):
    rows = spark.range(8000).select(F.lit(None).cast("long").alias("doc_id"), F.when(F.col("id") < 6000, "a").otherwise("b").alias("source"), F.lit("one two").alias("text"), F.col("id").alias("n_chars"))
    got = {r.source_size: (r.taken, r.target) for r in mixing.decide(rows).groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()}
    assert all(abs(taken - target) < 0.05 * target for taken, target in got.values()) and len(got) == 2
    decided = mixing.decide(rows).agg(F.sum("copies")).first()[0]
    mixed = mixing.emit(rows)
    assert mixed.count() == decided and mixed.columns == rows.columns


def test_emitted_rows_are_the_decided_ones(spark, sf001):
    documents = spark.read.parquet(f"{sf001}/documents.parquet")
    want = Counter({r.doc_id: r.copies for r in mixing.decide(documents).collect() if r.copies})
    assert Counter(r.doc_id for r in mixing.emit(documents).select("doc_id").collect()) == want


# whitening


def slow_whitening(vectors):
    x = [[math.floor(1024 * c) + 100000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[k] for r in x) for k in range(d)]
    covariance = [[sum((n * r[a] - sums[a]) * (n * r[b] - sums[b]) for r in x) / n**3 for b in range(d)] for a in range(d)]
    return x, sums, np.array(covariance)


@pytest.mark.parametrize("scale", [1.0, 1e6, 2e12])
def test_scatter_is_exact_and_whitened_rows_are_white(spark, scale):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(300, 12)) * np.linspace(1, 30, 12) + 5).astype(np.float64) * scale
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(5)
    x, sums, covariance = slow_whitening(vectors.tolist())
    model = whitening.fit(df)
    assert model.n == 300 and model.sums == sums
    assert whitening.fit(df, shift=12345).sums == sums
    values = np.linalg.eigvalsh(covariance)[::-1][:8]
    assert model.values == pytest.approx(values) and model.explained == pytest.approx(values / np.trace(covariance))
    assert np.abs(covariance @ model.vectors - model.vectors * model.values).max() < 1e-9 * values[0]
    rows = whitening.transform(df, model).collect()
    assert len(rows) == 300 * 8
    white = np.zeros((300, 8))
    for r in rows:
        white[r.vec_id, r.component - 1] = r.whitened
    measured = np.abs(np.cov(white.T, bias=True) - np.eye(8)).max()
    assert measured < 1e-9 and rows[0].identity_error == pytest.approx(measured, abs=1e-9)
    exact = [sum((300 * a - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
    assert all(r.deviation == (exact[r.vec_id] if exact[r.vec_id] < 1 << 63 else None) for r in rows)


def test_sums_of_products_are_exact_beyond_longs():
    rng = random.Random(5)
    y = [[rng.randrange(-(1 << 62), 1 << 62) for _ in range(3)] for _ in range(5000)]
    total = np.zeros((whitening.DIGITS, 3, 3), np.int64)
    whitening.add_products(total, np.array(y[:700]))
    whitening.add_products(total, np.array(y[700:]))
    for a in range(3):
        for b in range(3):
            assert sum(int(total[k, a, b]) << (whitening.BITS * k) for k in range(whitening.DIGITS)) == sum(r[a] * r[b] for r in y)


def test_whitening_query(spark, sf001):
    rows = QUERIES["op12_whitening"](spark, sf001)
    assert rows.count() == 8 * spark.read.parquet(f"{sf001}/embeddings.parquet").count()
    assert rows.agg(F.max("identity_error")).first()[0] < 1e-9


# search


def test_terms_match_the_pattern():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("abZ09 .-_'`é 中 \U0001f600\x00\x7f@[{/:") for _ in range(rng.randrange(40)))
        fold = text.translate({c: c + 32 for c in range(65, 91)})
        assert lexical.terms(text.encode()) == [t.encode() for t in re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", fold)]


def slow_search(documents, item, top=10):
    counts = [(key, Counter(lexical.terms(text.encode()))) for key, text in documents]
    counts = [(key, c) for key, c in counts if c]
    docs, length = len(counts), sum(c.total() for _, c in counts)
    asked, found = set(lexical.terms(item.encode())), []
    weight = {t: math.floor(1000 * math.log((2 * docs + 2) / (2 * sum(t in c for _, c in counts) + 1))) for t in asked}
    for key, c in counts:
        m = 10 + (90 * c.total() * docs) // length
        score = sum(weight[t] * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in asked & c.keys())
        if score > 0:
            found.append((-score, key))
    return [(k + 1, key, -score) for k, (score, key) in enumerate(sorted(found)[:top])]


@pytest.mark.parametrize("seed", range(3))
def test_search_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    pick = lambda n: " ".join(words[int(60 * rng.random() ** 3)] for _ in range(n))
    documents = [(k, pick(rng.choice([0, 1, 3, 20, 200]))) for k in range(400)] + [(1000 + k, "w3 w4 same text") for k in range(30)]
    rng.shuffle(documents)
    items = [(k, pick(rng.choice([1, 2, 8, 30]))) for k in range(25)] + [(99, "w3 w4 same text")]
    got = lexical.search(spark.createDataFrame(documents, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")).collect()
    for key, text in items:
        assert sorted((r["rank"], r.doc_id, r.score) for r in got if r.item_id == key) == slow_search(documents, text)


def test_blocks_are_pruned_without_losing_a_document(spark, sf001):
    documents, items = spark.read.parquet(f"{sf001}/documents.parquet"), spark.read.parquet(f"{sf001}/benchmark.parquet").collect()
    query = lexical.parse([r.text for r in items])
    blocks = lexical.forward(documents, query, block=4).cache()
    corpus = lexical.counts(blocks, query)
    group = [(r.ids, *(np.array(v) for v in r[1:])) for r in lexical.maxima(blocks, corpus).collect()]
    best = lexical.Best(len(items), 10, None)
    scored, pruned = lexical._search_group(group, query, corpus.weights, best, False)
    assert pruned > scored > 0
    texts = [(r.doc_id, r.text or "") for r in documents.collect()]
    for q in range(0, len(items), 5):
        assert [(k + 1, key, -score) for k, (score, _, key) in enumerate(best.rows.get(q, []))] == slow_search(texts, items[q].text)


def test_many_queries_take_several_passes(spark, monkeypatch):
    items = spark.createDataFrame([(k, f"w{k} " * 5) for k in range(20)], "item_id long, text string")
    assert [len(p) for p in lexical.query_passes(items, "item_id", most=150)] == [3] * 6 + [2]
    documents = spark.createDataFrame([(k, f"w{k}") for k in range(20)], "doc_id long, text string")
    monkeypatch.setattr(lexical.query_passes, "__defaults__", (200,))
    assert sorted((r.item_id, r.doc_id) for r in lexical.search(documents, items).collect()) == [(k, k) for k in range(20)]
