"""Operators against brute force, exact round trips, held-out accuracy and SQL."""

import functools
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from gazetta.llm import decontam, gbt, html, langid, license_texts, licenses, minhash, packing, quality, shard, toxicity, urlrules
from gazetta.llm.queries import ORACLE_SQL, QUERIES
from pyspark.sql import functions as F

TABLES = "documents pages benchmark labels".split()


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# quality rules


def slow_statistics(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    covered = {k + d for k, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:k] for k, x in enumerate(lines)), len(covered)]


@pytest.mark.parametrize("seed", range(30))
def test_statistics_match_brute_force(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(["a", "b", "é ", "c\n", " ", "\n", "\t#", "x y ", " ", "\U0001f600|", "\x1c"]) for _ in range(rng.randrange(120)))
    assert quality.statistics(text)[0] == slow_statistics(text)


def test_trees_learn_and_stay_monotone():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 3))
    y = (x[:, 0] - x[:, 1] + 0.3 * rng.normal(size=4000) > 0).astype(float)
    model = gbt.fit(x, y, [1, -1, 0], trees=30)
    assert ((gbt.predict(model, x) > 0.5) == y).mean() > 0.9
    grid = np.linspace(-3, 3, 60)
    for row in rng.normal(size=(40, 3)):
        for column, sign in ((0, 1), (1, -1)):
            many = np.tile(row, (60, 1))
            many[:, column] = grid
            assert (sign * np.diff(gbt.margin(model, many)) >= -1e-9).all()


def test_flat_arrays_score_like_a_walk():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 4))
    model = gbt.fit(x, (x[:, 0] * x[:, 1] > 0).astype(float), trees=5, depth=3)
    for row, want in zip(x[:50], gbt.margin(model, x[:50]), strict=True):
        total = model.base
        for t in range(5):
            node = 0
            while node < 7:
                node = 2 * node + 1 + int(row[model.feature[t, node]] > model.threshold[t, node])
            total += model.value[t, node - 7]
        assert total == pytest.approx(want)


def test_quality_agrees_with_labels(spark, sf001):
    rows = QUERIES["op1_quality"](spark, sf001).join(spark.read.parquet(f"{sf001}/labels.parquet"), "doc_id").where("not base_failed")
    assert rows.where("kept = (quality = 1)").count() >= 0.97 * rows.count()


# sharding


def test_rendezvous_moves_rows_only_into_the_new_shard(spark):
    rows = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    got = shard.assign(rows, [1.0, 1.0, 2.0], 1.0).collect()
    share = [sum(r.shard == s for r in got) / 20000 for s in range(3)]
    assert share == pytest.approx([0.25, 0.25, 0.5], abs=0.02)
    moved = [r for r in got if r.shard != r.grown_shard]
    assert {r.grown_shard for r in moved} == {3} and len(moved) / 20000 == pytest.approx(0.2, abs=0.02)
    text = zlib.crc32(b"t")
    assert {(r.size, r.text_crc32, r.law) for r in got} == {(2, text, "key")}
    for s in range(3):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_hot_rows_are_numbered_by_counts(spark):
    rows = spark.range(200_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    got = shard.assign(rows, [1.0] * 8).agg(F.count("*"), F.min("slot"), F.max("slot"), F.count_distinct("slot")).first()
    assert tuple(got) == (200_000, 0, 199_999, 200_000)


# near duplicates


def slow_sets(rows, width):
    out = {}
    for i, text in rows:
        words = [w for w in re.findall("[^\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))]
        out[i] = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else ({tuple(words)} if words else set())
    return out


def slow_components(sets, percent):
    label = {i: i for i in sets}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize(("width", "percent", "block", "hot"), [(3, 85, None, 8), (5, 80, None, 8), (3, 85, 8, 8), (3, 85, 4, 1)])
def test_near_duplicates_match_brute_force(spark, width, percent, block, hot, monkeypatch):
    split = []
    if hot == 1:  # buckets split by further minima
        monkeypatch.setattr(minhash, "HOT_BLOCKS", hot)
        own = minhash.further_cells
        monkeypatch.setattr(minhash, "further_cells", lambda rows, wide: split.append(rows.count()) or own(rows, wide))
    if block:  # large buckets: several cells a leader, several blocks a bucket
        monkeypatch.setattr(minhash, "BLOCK_ROWS", block)
        monkeypatch.setattr(minhash, "STAR_ROWS", block)
    rng = random.Random(width)
    rows, bases = [], [sentence(rng, n) for n in (40, 150, 300)]
    for k in range(240):
        words = rng.choice(bases).split()
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 8, 12])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(9)}"
        rows.append((k * 3, " ".join(words) if k % 5 else " ".join(words).upper()))
    rows += [(1, "one two"), (2, "ONE  TWO"), (4, ""), (5, None), *((1000 + k, sentence(rng, 60)) for k in range(40))]
    rng.shuffle(rows)
    got = {r.doc_id: r for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width, percent).collect()}
    sets = slow_sets(rows, width)
    want = slow_components(sets, percent)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.n_shingles == len(sets[i]) and r.kept == (i == want[i]) for i, r in got.items())
    assert hot > 1 or split[0] > 100


def test_unlike_rows_of_one_bucket_meet_in_few_pairs(spark):
    rng, n = random.Random(8), 2000
    shared = sentence(rng, 40)
    texts = [(k, f"{shared} {sentence(rng, 60)}") for k in range(n)] + [(n, f"{shared} {sentence(random.Random(1), 60)}"), (n + 1, f"{shared} {sentence(random.Random(1), 60)} end")]
    texts = spark.createDataFrame(texts, "id long, text string")
    bands, rows = minhash.bands_for(0.85)
    sketch = minhash.sketches(texts.withColumnRenamed("id", "doc_id"), 3, bands, rows)
    # all rows are put into the bucket of the first band, as if they agreed in it
    hot = sketch.select(F.element_at("bands", 1).alias("_"), F.lit(7).cast("long").alias("key"), F.col("doc_id").alias("id"), F.col("doc_id").alias("comp"), F.col("n_shingles").alias("n"), "sig",
                        F.concat(F.array(F.lit(7).cast("long")), F.slice("bands", 2, bands)).alias("bands")).drop("_")
    wide = minhash.further_bands(hot, texts, 3, rows)
    sizes = [r["count"] for r in minhash.further_cells(hot, wide).groupBy("key", "cell").count().collect()]
    assert sum(k * (k - 1) // 2 for k in sizes) < n * (n - 1) // 2 / 10
    together = minhash.further_cells(hot, wide).where(F.col("id") >= n).groupBy("key", "cell").count()
    assert together.where("count = 2").count() > 5


def test_estimates_are_corrected_for_collisions(spark):
    rng = random.Random(5)
    for share in (0.3, 0.6, 0.9):
        both, n = [f"s{k}" for k in range(3000)], 3000
        a = both
        b = both[: int(n * 2 * share / (1 + share))] + [f"t{rng.random()}" for _ in range(n - int(n * 2 * share / (1 + share)))]
        rows = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b))], "doc_id long, text string")
        sigs = {r.doc_id: r.sig for r in minhash.sketches(rows, 1, 20).collect()}
        pair = spark.createDataFrame([(sigs[1], sigs[2])], "x array<long>, y array<long>")
        assert pair.select(minhash.similarity(F.col("x"), F.col("y")).alias("s")).first().s == pytest.approx(share, abs=0.15)


def test_block_links_join_what_links_join():
    import pyarrow as pa

    rng = random.Random(3)
    base = sentence(rng, 80).split()
    texts = []
    for _ in range(60):
        words = base[:]
        for _ in range(rng.randrange(8)):
            words[rng.randrange(80)] = f"y{rng.randrange(5)}"
        texts.append(" ".join(words))
    got = minhash.block_links(pa.table({"comp": pa.array(range(60), pa.int64()), "text": texts}), 3, 85).to_pydict()
    want = slow_components(slow_sets(list(enumerate(texts)), 3), 85)
    label = {i: i for i in range(60)}
    for _ in range(60):
        for a, b in zip(got["a"], got["b"], strict=True):
            label[a] = label[b] = min(label[a], label[b])
    assert label == want and len(got["a"]) < 60


def test_sorted_groups_are_whole_over_batches():
    import pyarrow as pa
    from gazetta.llm.common import sorted_groups

    keys = [1, 1, 2, 3, 3, 3, 3, 3, 3, 4]
    for size in (1, 2, 3, 10):
        batches = [pa.record_batch({"k": keys[i : i + size], "v": list(range(i, min(i + size, 10)))}) for i in range(0, 10, size)]
        groups = [part.slice(a, b - a).to_pydict() for part, at in sorted_groups(iter(batches), 1) for a, b in zip(at[:-1], at[1:], strict=True)]
        assert [set(g["k"]) for g in groups] == [{1}, {2}, {3}, {4}] and [len(g["v"]) for g in groups] == [2, 1, 6, 1]
    assert list(sorted_groups(iter([]), 1)) == []


def test_components_of_long_chains(spark):
    links = [(k, k + 1) for k in range(1, 300)] + [(1000, 1002), (1002, 1001)]
    random.Random(1).shuffle(links)
    got = {r.id: r.component for r in minhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(2, 301)} | {1001: 1000, 1002: 1000}


@pytest.mark.parametrize("percent", [70, 50, 30])
def test_low_thresholds_lose_no_link(spark, percent):
    rng = random.Random(percent)
    texts = {}
    for k in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(60)]
        texts[3 * k] = " ".join(words)
        for d, share in ((1, 0.9), (2, 0.75)):
            keep = int(60 * (percent / 100 * 2 / (1 + percent / 100)) * share / 0.75) if d == 2 else int(60 * share)
            texts[3 * k + d] = " ".join(words[: min(60, keep)] + [f"v{rng.randrange(5000)}" for _ in range(max(0, 60 - keep))])
    label = slow_components(slow_sets(texts.items(), 1), percent)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 1, percent).collect()}
    assert got == label


def test_bands_keep_the_promised_chance():
    for percent in range(12, 100):
        bands, rows = minhash.bands_for(percent / 100)
        assert (1 - (percent / 100) ** rows) ** bands <= minhash.MISS and bands * rows <= minhash.MINIMA
    assert minhash.bands_for(0.85)[1] == minhash.bands_for(0.8)[1] == 4
    assert all(minhash.may_split(t, *minhash.bands_for(t)) for t in (0.3, 0.5, 0.8, 0.85, 1.0)) and not minhash.may_split(0.12, *minhash.bands_for(0.12))
    with pytest.raises(ValueError):
        minhash.bands_for(0.05)


# packing


def slow_best_fit(items, capacity):
    bins, out = [], [None] * len(items)
    for k in sorted(range(len(items)), key=lambda i: -items[i][0]):
        size, source, cluster = items[k]
        fits = [(capacity - sum(s for s, _, _ in b) - size, n) for n, b in enumerate(bins) if capacity - sum(s for s, _, _ in b) >= size and not any((source is not None and s == source) or (cluster is not None and c == cluster) for _, s, c in b)]
        n = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([])
        bins[n].append(items[k])
        out[k] = n
    return out


@pytest.mark.parametrize("seed", range(20))
def test_best_fit_matches_brute_force(seed):
    rng = random.Random(seed)
    items = [(rng.randint(1, 100), rng.choice([None, "a", "a", "b", "c", "d"]), rng.choice([None, 1, 2, 3, rng.random()])) for _ in range(80)]
    assert [b for b, _ in packing.best_fit(items, 100)] == slow_best_fit(items, 100)


def test_packing_is_whole_and_free_of_conflicts(spark, sf001):
    rows = QUERIES["op4_packing"](spark, sf001).collect()
    words = {r.doc_id: r.n for r in spark.read.parquet(f"{sf001}/documents.parquet").select("doc_id", F.size(F.filter(F.split("text", "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")).alias("n")).collect()}
    total, bins = dict.fromkeys(words, 0), {}
    for r in rows:
        total[r.doc_id] += r.n_tokens
        bins.setdefault(r.bin_id, []).append(r)
    assert total == words
    for name, held in bins.items():
        if name < 0:
            continue
        held.sort(key=lambda r: r.bin_offset)
        assert sum(r.n_tokens for r in held) <= packing.CAPACITY and [r.bin_offset for r in held] == list(itertools.accumulate([0] + [r.n_tokens for r in held[:-1]]))
        assert len({r.source for r in held}) == len({r.cluster for r in held}) == len(held)


# toxicity


def test_chain_finds_toxic_texts_it_was_not_trained_on(spark):
    rng = random.Random(4)
    rows, marks = [], []
    for k in range(1500):
        words = sentence(rng, 60).split()
        toxic = k % 6 == 0
        if toxic:
            words[rng.randrange(60)] = rng.choice(["idiot", "moron", "stupid", "worthless", "grumpfel", "grumpfels"])
        rows.append((k, " ".join(words)))
        if k % 2 == 0 or k < 600:
            marks.append((k, 1, int(toxic)))
    documents, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score(documents, toxicity.train(documents, labels)).collect()}
    held = [k for k in range(1500) if k % 2 and k >= 600]
    assert sum(got[k].toxic == (k % 6 == 0) for k in held) == len(held)
    seen = [k for k in range(1500) if k % 6 == 0]
    assert sum(got[k].toxic for k in seen) >= 0.98 * len(seen)


def slow_linear(rows, y, l2=0.02):
    """Newton steps in double precision on the penalised log-likelihood; weights, then the bias."""
    x = np.hstack([np.asarray(rows, float), np.ones((len(rows), 1))])
    w, penalty = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, l2), 1e-3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
    return w


def slow_p(row, w):
    return 1 / (1 + math.exp(-(sum(a * b for a, b in zip(row, w, strict=False)) + w[-1])))


def test_chain_matches_brute_force(spark):
    rng = random.Random(6)
    names = ("apple", "brick", "cloud", "delta", "ember", "flint")
    texts = [" ".join([*[w for w in names if rng.random() < 0.4], f"x{'yz'[k % 2]}"]) for k in range(600)]
    x = [[float(w in t.split()) for w in names] for t in texts]
    y = [[rng.random() < (0.6 if r[0] else 0.2), rng.random() < (0.7 if r[1] else 0.3), rng.random() < (0.8 if r[0] or r[2] else 0.1)] for r in x]
    fold = [rng.randrange(toxicity.FOLDS) for _ in texts]
    chain = toxicity.fit(np.array(x, np.float32), np.array(y), np.array(fold), names, {w: k for k, w in enumerate(names)})

    logit = lambda p: math.log(min(max(p, 1e-4), 1 - 1e-4) / (1 - min(max(p, 1e-4), 1 - 1e-4)))
    given, models = [list(r) for r in x], []
    for k in range(3):
        models.append(slow_linear(given, [r[k] for r in y]))
        out = {}
        for f in range(toxicity.FOLDS):  # a text is predicted by a model that has not seen it
            w = slow_linear([r for r, g in zip(given, fold, strict=True) if g != f], [r[k] for r, g in zip(y, fold, strict=True) if g != f])
            out |= {i: slow_p(r, w) for i, (r, g) in enumerate(zip(given, fold, strict=True)) if g == f}
        given = [[*r, logit(out[i])] for i, r in enumerate(given)]

    rows = [*enumerate(texts), (1000, ""), (1001, None), (1002, "APPLE, apple! brick " * 30_000)]
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), chain).collect()}
    for i, text in rows:
        row, want = [float(w in (text or "").lower().replace(",", " ").replace("!", " ").split()) for w in names], []
        for w in models:
            want.append(slow_p(row, w) if text else 0.0)
            row = [*row, logit(want[-1])]
        assert [got[i].p_kind1, got[i].p_kind2, got[i].p_toxic] == pytest.approx(want, abs=0.01)
        assert got[i].toxic == (got[i].p_toxic >= chain.threshold and bool(text))


def test_kinds_are_clusters_of_toxic_texts():
    rng = np.random.default_rng(2)
    x = (rng.random((200, 30)) < 0.02).astype(np.float32)
    x[:100, :4] = 1
    x[100:, 4:8] = 1
    own = toxicity.kinds(x)
    assert len(set(own[:100])) == len(set(own[100:])) == 1 and own[0] != own[150]
    assert len(toxicity.kinds(x[:1])) == 1 and len(toxicity.kinds(np.zeros((3, 0), np.float32))) == 3


def test_copies_are_in_one_fold(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(toxicity, "fit", lambda x, y, fold, names, index: seen.update(x=x, fold=fold))
    rows = [(k, f"some words of text {k % 7} idiot" if k % 3 == 0 else f"other words {k % 5} of a text") for k in range(60)]
    toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(60)], "doc_id long, toxic int"))
    folds = {}
    for (_, text), f in zip(rows, seen["fold"], strict=True):  # rows are sorted by id
        folds.setdefault(text, set()).add(f)
    assert all(len(v) == 1 for v in folds.values()) and len(set(seen["fold"])) > 1


def test_later_models_see_out_of_fold_predictions():
    rng = np.random.default_rng(0)
    x = (rng.random((400, 30)) < 0.3).astype(np.float32)
    y = rng.integers(0, 2, (400, 2)).astype(float)  # noise: what is remembered must not be trusted
    chain = toxicity.fit(x, y, np.arange(400) % toxicity.FOLDS, ("a", "b"), {})
    assert abs(chain.weights[1][30]) < 1.0 and len(chain.weights[1]) == 32


# licenses


def test_license_spans_and_coverage():
    scanner = licenses.Scanner()
    text = "Intro words here.\nLicensed under the  APACHE License, Version 2.0.\nMore. Released under the MIT License"
    got = scanner.scan(text)
    assert [(m.license, m.coverage) for m in got] == [("Apache-2.0", 1.0), ("MIT", 1.0)]
    assert text[got[0].start : got[0].end] == "Licensed under the  APACHE License, Version 2.0"
    assert scanner.scan("licensed under many terms, released in the wild") == []
    assert [m.license for m in scanner.scan("Licensed under CC BY-NC 4.0.")] == ["CC-BY-NC-4.0"]
    long = dict(license_texts.TEXTS)["MIT"].split()
    edited = " ".join(w for k, w in enumerate(long) if k % 9 != 4)
    (m,) = scanner.scan("Start. " + edited + " end.")
    assert m.license == "MIT" and 0.8 < m.coverage < 1


def test_versions_and_variants_of_notices():
    scanner = licenses.Scanner()
    for kind in license_texts.CREATIVE:
        for version in ("2.0", "3.0", "4.0"):
            assert [m.license for m in scanner.scan(f"It is licensed under CC {kind} {version} here")] == [f"CC-{kind}-{version}"]
    for text, want in [
        ("Licensed under the Apache License, Version 1.1", ["Apache-1.1"]), ("Licensed under the Apache License, Version 1.7", []), ("This work is licensed under the GNU General Public License, version 1.", ["GPL-1.0"]),
        ("Released under the GNU General Public License, version 7.", []), ("Licensed under CC BY-NC-SA 9.0", []),
    ]:
        assert [m.license for m in scanner.scan(text)] == want, text
    for n in (1, 7, 2000):
        assert len(scanner.scan("Licensed under the MIT License. " * n)) == n


notice_scanner = functools.cache(licenses.Scanner)


@pytest.mark.parametrize("lead", ["", "a ", "some of the words ", "x y z q "])
@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Released under GPLv3", "GPL-3.0"), ("the GPLv2 license", "GPL-2.0"), ("Licensed under the GNU General Public License v2.0", "GPL-2.0"), ("GNU General Public License (GPL) version 3", "GPL-3.0"),
        ("SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0-only"), ("SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1-or-later"), ("SPDX-License-Identifier: Zlib", "Zlib"), ("SPDX-License-Identifier: CC-BY-SA-4.0", "CC-BY-SA-4.0"),
        ("Apache License, Version 2.0", "Apache-2.0"), ("under the Apache License 2.0", "Apache-2.0"), ("This program is licensed under the terms of the MIT license", "MIT"), ("The MIT License", "MIT"),
        ("GNU GPL v3 or later", "GPL-3.0-or-later"), ("GNU General Public License version 2, or any later version", "GPL-2.0-or-later"), ("LGPL version 2.1", "LGPL-2.1"),
        ("SPDX-License-Identifier: Foo-9", None), ("Released under GPLv9", None), ("GNU GPL v7", None), ("SPDX-License-Identifier: GPL-5.0-only", None), ("under the bridge of version 2 of the general plan", None),
    ],
)
def test_usual_wordings_of_notices(lead, text, want):
    found = [m.license for m in notice_scanner().scan(f"{lead}{text} {lead}and more of it")]
    assert found == ([want] if want else [])


def test_recall_of_edited_license_texts():
    rng, scanner = random.Random(3), licenses.Scanner()
    for share, least in ((0.1, 1.0), (0.2, 1.0), (0.3, 0.85)):
        found = 0
        for name, text in license_texts.TEXTS * 5:
            edited = [y for x in text.split() for y in (rng.choice([[], ["zzz"], [x, "zzz"]]) if rng.random() < share else [x])]
            found += any(m.license == name for m in scanner.scan("lead words here " * 20 + " ".join(edited) + " tail words here" * 20))
        assert found >= least * 5 * len(license_texts.TEXTS), share


def test_templates_do_not_depend_on_the_machine(tmp_path):
    assert license_texts.templates() == (*license_texts.notices(), *license_texts.TEXTS)
    (tmp_path / "GPL-3").write_text("a text of the folder " * 20)
    assert license_texts.templates(str(tmp_path))[-1] == ("GPL-3.0", "a text of the folder " * 20)


def test_whole_license_texts():
    scanner = licenses.Scanner()
    for name, text in license_texts.TEXTS:
        (m,) = scanner.scan("Before it. " + text + " After it.")
        assert (m.license, m.coverage) == (name, 1.0)
        words = text.split()
        (part,) = scanner.scan(" ".join(words[len(words) // 7 :]))  # without its beginning
        assert part.license == name and 0.8 < part.coverage < 0.9


def test_alignment_matches_full_alignment():
    rng = random.Random(12)

    def common(a, b):  # longest common subsequence, all cells
        row = [0] * (len(b) + 1)
        for x in a:
            last = row[:]
            for j, y in enumerate(b):
                row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
        return row[-1]

    for _ in range(60):
        template = np.array([rng.randrange(30) for _ in range(rng.randrange(5, 60))])
        words = template.tolist()
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(2)] = [rng.randrange(30) for _ in range(rng.randrange(2))]
        lead = [40] * rng.randrange(9)
        text = np.array([*lead, *words, *[41] * rng.randrange(9)])
        n, first, last = licenses.aligned(template, text, len(lead), 30)
        assert n == common(template.tolist(), text.tolist())
        assert len(lead) <= first <= last < len(lead) + len(words) and common(template.tolist(), text[first : last + 1].tolist()) == n


@pytest.mark.parametrize("seed", range(20))
def test_winnowing_keeps_its_guarantee(seed):
    rng = random.Random(seed)
    shared = [f"s{k}" for k in range(licenses.GRAM + licenses.WINDOW - 1)]
    texts = [[*sentence(rng, rng.randrange(9)).split(), *shared, *sentence(rng, rng.randrange(9)).split()] for _ in range(2)]
    prints = [{int(h[p]) for p in licenses.winnowed(h)} for h in map(licenses.hashes, texts)]
    assert prints[0] & prints[1]


def test_licenses_match_a_plain_search(spark, sf001):
    rows = QUERIES["op6_licenses"](spark, sf001).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == {i for i, t in texts.items() if re.search(r"(Licensed|licensed) under|Released under the", t or "")}
    assert all(texts[r.doc_id][r.start : r.end] == r.matched for r in rows)


# main text


def test_articles_are_extracted_exactly(spark, sf001):
    from html import unescape

    rows = QUERIES["op7_html"](spark, sf001).join(spark.read.parquet(f"{sf001}/pages.parquet").select("page_id", "html"), "page_id").collect()
    for r in rows:
        inside = re.search("<article>(.*)</article>", r.html, re.S)[1]
        blocks = (" ".join(unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", inside))
        assert r.text == "\n".join(b for b in blocks if b)


def test_generated_sites_are_extracted():
    rng, model, good = random.Random(2024), html.train(), 0
    for _ in range(150):
        page = html.Page(html.sample_page(rng))
        marks = page.labels()
        want = [page.text[k] for k in range(len(page.tag)) if page.text[k] and marks[k]]
        got = page.decode(gbt.margin(model, page.features())).split("\n")
        good += len(set(want) & set(got)) / len(set(want) | set(got))
    assert good / 150 > 0.93


def test_decoding_keeps_no_block_without_its_parents():
    page = html.Page("<div><nav>a<p>b</p></nav><article><p>c</p><aside><p>d</p></aside></article></div>")
    odds = np.array([{"nav": -9.0, "aside": -9.0, "article": 2.0}.get(t, 1.0) for t in page.tag])
    assert page.decode(odds) == "c"
    best = max(sum(odds[k] for k in keep) for n in range(len(odds)) for keep in itertools.combinations(range(1, len(odds)), n) if all(page.parent[k] == 0 or page.parent[k] in keep for k in keep))
    kept = {0}
    gain = odds.tolist()
    for k in range(len(odds) - 1, 0, -1):
        gain[page.parent[k]] += max(gain[k], 0) if k else 0
    for k in range(1, len(odds)):
        if page.parent[k] in kept and gain[k] > 0:
            kept.add(k)
    assert sum(odds[k] for k in kept - {0}) == pytest.approx(best)


def test_references_and_spaces():
    text = html.extract_all(html.train(), ["<html><body><nav><ul><li><a href='/'>Home</a></ul></nav><article><h1>A &amp; B</h1><p>one\n two&nbsp;&#233;<br>three<p>Quite a long paragraph, with text.</article><footer>&copy; x</footer>"])[0]
    assert text == "A & B\none two é three\nQuite a long paragraph, with text."


def test_near_copies_can_be_kept_apart(spark):
    rows = spark.createDataFrame([(k, f"w{k} " * 10, f"s{k}") for k in range(40)], "doc_id long, text string, source string")
    clusters = spark.createDataFrame([(k, k % 2) for k in range(30)], "doc_id long, cluster long")
    bins = {}
    for r in packing.pack(rows, capacity=100, clusters=clusters).collect():
        bins.setdefault(r.bin_id, []).append(r.doc_id)
    assert all(sum(i < 30 and i % 2 == p for i in ids) <= 1 for ids in bins.values() for p in (0, 1))
    assert len({r.bin_id for r in packing.pack(rows, capacity=100).collect()}) == 4 < len(bins)


def test_packing_does_not_depend_on_the_layout(spark):
    rows = [(k, "w " * (1 + k * 37 % 900), f"s{k // 100}") for k in range(1200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    bound = max(-(-sum(1 + k * 37 % 900 for k in range(1200)) // 2048), 100)
    got = [{(r.doc_id, r.bin_id, r.bin_offset) for r in packing.pack(x, block=400).collect()} for x in (frame.coalesce(1), frame.repartition(60), frame.orderBy("source"))]
    assert got[0] == got[1] == got[2] and len({b for _, b, _ in got[0]}) <= 1.1 * bound


# decontamination


def edit_distance_inside(pattern, text):
    """Fewest edits of pattern against any substring of text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize("seed", range(8))
def test_leaks_match_brute_force(seed):
    rng = random.Random(seed)
    items = [(k, sentence(rng, rng.randint(14, 60), 3000)) for k in range(6)]
    index, texts = decontam.build(items), []
    for _ in range(30):
        _, item = rng.choice(items)
        words = list(item)
        for _ in range(rng.choice([0, 1, 3, 6, 10, 14, 20, 30])):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], ["q"], ["q", words[at]]])
        texts.append(f"{sentence(rng, rng.randrange(40))}. {''.join(words)}! {sentence(rng, rng.randrange(40))}" if rng.random() < 0.8 else sentence(rng, 80))
    got = {(row, item) for row, item, *_ in decontam.matches(index, texts)}
    want = set()
    for row, text in enumerate(texts):
        plain = " ".join(re.findall(r"[^\W_]+", text.lower()))
        for k in range(len(index.item)):
            segment = "".join(map(chr, index.code[k][: index.size[k]]))
            if edit_distance_inside(segment, plain) <= index.edits[k]:
                want.add((row, int(index.item[k])))
    assert got == want


@pytest.mark.parametrize("seed", range(4))
def test_excerpts_are_found_at_every_offset(seed):
    rng = random.Random(seed)
    item = sentence(rng, 120, 3000)
    index, words = decontam.build([(7, item)]), item.split()
    texts = [f"{sentence(rng, 20)} {' '.join(words[a : a + n])} {sentence(rng, 20)}" for n in (12, 16, 20, 25, 40) for a in range(len(words) - n + 1)]
    got = {row for row, *_ in decontam.matches(index, texts)}
    assert got == {k for k, t in enumerate(texts) if any("".join(map(chr, c)) in t for c in index.code)} == set(range(len(texts)))
    cjk = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(200))
    texts = [f"{cjk[::-1][:50]}{cjk[a : a + 34]}{cjk[::-1][50:90]}" for a in range(len(cjk) - 34 + 1)]
    assert {row for row, *_ in decontam.matches(decontam.build([(7, cjk)]), texts)} == set(range(len(texts)))


def test_short_items_match_as_whole_words():
    items = [(1, "What is the capital of France?"), (2, "法国的首都是哪里？"), (3, "Ohm"), (4, "..."), (None, "What"), (5, "what is THE capital of france")]
    texts = ["So: what is the  Capital of France", "What is the capital of Frances?", "请问法国的首都是哪里啊", "ohms, kiloohm", "what is the", "an ohm.", "capital of France"]
    got = decontam.matches(decontam.build(items), texts)
    assert {(row, item, texts[row][a:b]) for row, item, a, b, _ in got} == {(0, 1, texts[0][4:]), (0, 5, texts[0][4:]), (2, 2, "法国的首都是哪里"), (5, 3, "ohm")}
    rng = random.Random(0)
    items = [(k, sentence(rng, rng.randint(1, 3), 30)) for k in range(40)]
    texts = [sentence(rng, 30, 30) for _ in range(40)]
    assert {m[:2] for m in decontam.matches(decontam.build(items), texts)} == {(r, k) for r, t in enumerate(texts) for k, x in items if f" {x} " in f" {t} "}


def test_edits_may_lie_close_together():
    item = "".join(f"{k:03d} " for k in range(100, 130)).strip()
    text = f"x {item[:52]}{'z' * 9}{item[61:]} y"
    assert {m[:2] for m in decontam.matches(decontam.build([(1, item)]), [text])} == {(0, 1)}


@pytest.mark.parametrize("cut", range(1, 6))
def test_a_match_stays_in_its_text(cut):
    item = "Each of these passages is long enough, says the editor, to be found in it."
    index = decontam.build([(1, item)])
    texts = ["a clean text that ends before", item[cut:] + " and more of it", "another clean text", "so " + item[:-cut], "clean again", item[:35], item[35:]]
    got = decontam.matches(index, texts)
    assert {m[:2] for m in got} == {(1, 1), (3, 1)} and all(0 <= a < b <= len(texts[row]) for row, _, a, b, _ in got)
    assert [m[1:] for m in decontam.matches(index, texts[1:2])] == [m[1:] for m in got if m[0] == 1]


def test_spans_are_those_of_the_text():
    item = "Each of these passages is long enough, says the editor, to be found in a text again."
    text = f"Before — \U0001f600 it. {item.upper().replace(',', ' ;')} After."
    ((_, _, start, end, edits),) = decontam.matches(decontam.build([(1, item)]), [text])
    assert text[start:end] == item.upper().replace(",", " ;")[:-1] and edits == 0


def test_all_planted_items_are_found(spark, sf001):
    got = {(r.doc_id, r.item_id) for r in QUERIES["op8_decontamination"](spark, sf001).collect()}
    plain = lambda t: " ".join(re.findall(r"[^\W_]+", (t or "").lower()))
    items = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{sf001}/benchmark.parquet").collect()}
    want = {(r.doc_id, i) for r in spark.read.parquet(f"{sf001}/documents.parquet").collect() for t in [plain(r.text)] for i, x in items.items() if x in t}
    assert want and got == want


def test_a_large_benchmark_is_taken_in_blocks(spark, monkeypatch):
    rng = random.Random(0)
    items = [(k, sentence(rng, 30, 5000)) for k in range(12)]
    documents = spark.createDataFrame([(k, f"x {t} y") for k, t in items], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 500)
    assert sum(1 for _ in decontam.blocks(benchmark)) > 2
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(documents, benchmark).collect()} == {(k, k) for k in range(12)}
    assert decontam.clean(documents, benchmark).count() == 0


PROSE = "A long sentence of the story, with commas, follows here and goes on for a while. " * 4


def extracted(inside, tag="article"):
    return html.extract_all(html.train(), [f"<html><body><nav><ul><li><a href='/'>Home</a></ul></nav><{tag}><h1>A title</h1><p>{PROSE}</p>{inside}<p>{PROSE}</p></{tag}></body></html>"])[0]


@pytest.mark.parametrize("tag", ["article", "main"])
@pytest.mark.parametrize(
    "block",
    [
        '<section class="related-work"><h2>Related work</h2><p>{}</p></section>', '<div class="post-comments-intro"><p>{}</p></div>', '<div class="popular-science"><p>{}</p></div>',
        '<p class="lead search-result">{}</p>', '<div class="social_history"><p>{}</p></div>', '<div class="ad-free"><p>{}</p></div>',
    ],
)
def test_compound_class_words_are_words_of_their_own(tag, block):
    said = "Search teams found the boat near the northern shore, where it had been for months."
    text = extracted(block.format(said), tag).split("\n")
    assert said in text and text[0] == "A title" and text.count(PROSE.strip()) == 2 and "Home" not in text


@pytest.mark.parametrize(
    "block",
    [
        '<div class="cookie-notice"><p>{}</p></div>', '<div class="ad-banner">{}</div>', '<div class="sidebar_left"><p>{}</p></div>', '<div class="newsletter-signup"><p>{}</p></div>',
        '<div class="related-posts"><ul><li><a href="/x">{}</a></li></ul></div>', '<section class="comments-area"><h3>Two</h3><div class="comment"><p>{}</p></div></section>',
    ],
)
def test_compounds_of_boilerplate_and_layout_words_are_boilerplate(block):
    said = "Search teams found the boat near the northern shore."
    assert said not in extracted(block.format(said))


@pytest.mark.parametrize("tag", ["template", "noscript", "button", "iframe", "select"])
@pytest.mark.parametrize("inside", ["<div><p>secret words</p></div>", "<p>secret words", "secret <{tag}>words</{tag}> words", "<p>secret</p><ul><li>words</ul>"])
def test_silent_elements_stay_silent(tag, inside):
    if tag == "iframe" and "{tag}" in inside:
        return  # the text of an iframe ends at its first end tag
    text = extracted(f"<{tag}>{inside.format(tag=tag)}</{tag}>")
    assert "secret" not in text and "words" not in text and text.count(PROSE.strip()) == 2


def test_unclosed_buttons_end_with_their_block():
    text = extracted("<div><button>secret words</div>")
    assert "secret" not in text and text.count(PROSE.strip()) == 2


def test_formulas_stay_and_hyphenated_class_words_are_whole():
    assert "We have x = 2 as root." in extracted("<p>We have <math><mi>x</mi> = <mn>2</mn></math> as root. " + PROSE + "</p>")
    for name in ("ad-free story", "no-sidebar content"):
        assert "kept words" in extracted(f'<div class="{name}"><p>kept words of it. {PROSE}</p></div>')


@pytest.mark.parametrize("size", [1, 40, 150])
def test_repetitive_items_and_texts(size):
    item = "ab " * 60
    index = decontam.build([(1, item), (2, "the quick brown fox jumps over a lazy dog and seven wizards mix potions")])
    assert len(index.item) < 20  # units that read alike are kept once
    texts = ["Lead in text. " + item, "ab " * size, "unrelated words of another text", item + " tail"]
    found = decontam.matches(index, texts)
    assert {m[0] for m in found if m[1] == 1} == {0, 3} | ({1} if size >= 40 else set())
    assert all(0 <= a < b <= len(texts[row]) for row, _, a, b, _ in found)


def test_windows_lose_nothing_at_their_borders(monkeypatch):
    rng = random.Random(2)
    item = sentence(rng, 40)
    index = decontam.build([(1, item)])
    monkeypatch.setattr(decontam, "WINDOW", 700)
    for at in range(0, 200, 7):
        text = sentence(rng, 80 + at) + " " + item + " " + sentence(rng, 300)
        found = decontam.matches(index, [text])
        assert [m[1] for m in found] == [1] and text[found[0][2] : found[0][3]].strip() .startswith(item[:20])


def test_blocks_of_the_benchmark_take_turns(spark, monkeypatch):
    rng = random.Random(6)
    items = [(k, sentence(rng, 30)) for k in range(6)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    documents = spark.createDataFrame([(k, sentence(rng, 50) + " " + items[k % 6][1] if k % 2 else sentence(rng, 60)) for k in range(24)], "doc_id long, text string")
    want = sorted(map(tuple, decontam.leaks(documents, benchmark).collect()))
    kept = sorted(r.doc_id for r in decontam.clean(documents, benchmark).collect())
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 300)
    assert sum(1 for _ in decontam.blocks(benchmark)) > 2
    assert sorted(map(tuple, decontam.leaks(documents, benchmark).collect())) == want and len(want) == 12
    assert sorted(r.doc_id for r in decontam.clean(documents, benchmark).collect()) == kept == list(range(0, 24, 2))


# languages


def test_forward_sums_all_segmentations():
    pieces = langid.Pieces(["▁", "▁a", "a", "b", "ab", "▁ab", "abc", "c"])
    rng = np.random.default_rng(0)
    p = rng.random((pieces.size + 1, 2))
    names = ["▁", "▁a", "a", "b", "ab", "▁ab", "abc", "c"]

    def total(word, k):
        if not word:
            return 1.0
        out = sum(p[names.index(x), k] * total(word[len(x) :], k) for x in names if word.startswith(x))
        return out + (p[-1, k] * total(word[1:], k) if word[0] not in names else 0.0)

    words = ["▁abc", "▁", "▁abxab", "abcabc", "zz"]
    g = langid.lattice(pieces, words)
    got, back = langid.forward(g, p)[g.last], langid.backward(g, p)[g.first]
    for k in range(2):
        assert got[:, k] == pytest.approx([total(w, k) for w in words]) and back[:, k] == pytest.approx(got[:, k])


def test_long_runs_are_summed_whole():
    import math

    names = ["▁", "a", "b", "ab", "ba", "aab", "▁a"]
    pieces = langid.Pieces(names)
    p = np.random.default_rng(1).random((pieces.size + 1, 2)) * 1e-4
    rng = random.Random(4)
    words = ["".join(rng.choice("abx") for _ in range(n)) for n in (200, 31, 32, 33, 700, 5)]

    def total(word, k):  # exact sums of integers scaled by a power of two
        unit = 1 << 60
        score = [[round(v * unit) for v in p[:, j]] for j in range(2)][k]
        at = [0] * (len(word) + 1)
        at[0] = 1
        for e in range(1, len(word) + 1):
            for b in range(max(0, e - 3), e):
                x = word[b:e]
                s = score[names.index(x)] if x in names else score[-1] if len(x) == 1 else 0
                at[e] += at[b] * s * unit ** (len(x) - 1)  # every letter carries one factor of unit
        return math.log(at[-1]) - len(word) * math.log(unit)

    model = langid.Model(["x", "y"], pieces, p)
    model.learn(set(words))
    for w in words:
        assert model.scores[model.known[w]] == pytest.approx([total("▁" + w, k) for k in range(2)])
    g = langid.lattice(pieces, ["▁" + w for w in words])
    assert langid.log_backward(g, np.log(p))[g.first] == pytest.approx(langid.log_forward(g, np.log(p))[g.last])
    assert langid.fit([("x", "ab" * 100, 2), ("y", "aab" * 99, 1), ("y", "ab", 3)], pieces).p[:-1].sum(axis=0) == pytest.approx([1, 1], abs=0.05)


def test_texts_of_unlearned_languages_do_not_fit(spark):
    rng = random.Random(8)

    def text(syllables):
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(120))

    known = {"xx": ["the", "ing", "and", "er", "on", "st", "ly"], "yy": ["der", "ein", "sch", "ung", "ich", "ge"]}
    rows = [(k, text(known[x]), x) for k in range(300) for x in [("xx", "yy")[k % 2]]]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    new = [(k, text(known["xx"]), None) for k in range(20)] + [(100 + k, text(["kkö", "yyt", "ää", "vuo", "ksi"]), None) for k in range(20)]
    kept = langid.keep(spark.createDataFrame(new, "doc_id long, text string, lang string"), model).collect()
    assert sorted(r.doc_id for r in kept) == list(range(20))


def test_held_out_accuracy(spark, sf001):
    documents = spark.read.parquet(f"{sf001}/documents.parquet")
    rows = QUERIES["op9_langid"](spark, sf001)
    assert rows.count() == documents.count()
    held = rows.join(documents, "doc_id").where("held_out and lang is not null")
    assert held.where("lang_pred = lang").count() >= 0.98 * held.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows.collect())


def test_held_out_languages_are_never_learned(spark):
    rows = [(k, "texte " * 5, "held" if zlib.crc32(str(k).encode()) % 4 == 2 else "open") for k in range(100)]
    assert langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string")).languages == ["open"]


def test_an_id_with_many_rows_takes_one_place(spark):
    open_ids = [k for k in range(4000) if zlib.crc32(str(k).encode()) % 4 != 2]
    for one in open_ids[3000:3004]:
        rows = [(k, "the cat sat on that mat", "en") for k in open_ids[:400]] + [(one, f"zxq wvu {k}", "xx") for k in range(3000)]
        assert langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string")).languages == ["en", "xx"]


def test_all_languages_are_learned_and_words_are_bounded(spark, monkeypatch):
    rows = [(k, f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)} text", f"l{k % 130:03}") for k in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(langid.train(df).languages) == 130 and len(langid.train(df, languages=7).languages) == 7
    assert len(langid.train(df, words=260).languages) == 130
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 100)
    with pytest.raises(ValueError, match="languages"):
        langid.train(df)


# urls


@pytest.mark.parametrize("share", [0.02, 0.3])
def test_mined_rules_match_brute_force(spark, share):
    rng = random.Random(1)
    rows = []
    for _ in range(600):
        tokens = sorted({f"t{rng.randrange(8)}" for _ in range(5)})
        rows.append((tokens, ("t1" in tokens and "t2" in tokens and rng.random() < 0.9) or rng.random() < share))
    got = {c for r in urlrules.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), 0.02, 0.6) for c in r.combinations()}
    good = []
    for n in range(1, 6):
        for part in itertools.combinations([f"t{k}" for k in range(8)], n):
            have = [bad for tokens, bad in rows if set(part) <= set(tokens)]
            if sum(have) >= max(0.02 * 600, 10) and urlrules.least_share(sum(have), len(have)) >= 0.6:
                good.append(frozenset(part))
    assert got == {g for g in good if not any(h < g for h in good)} and frozenset({"t1", "t2"}) in got
    page = spark.createDataFrame(rows, "tokens array<string>, bad boolean")
    hits = urlrules.matched(page.select("tokens"), [urlrules.Rule(g, 1, 1) for g in got]).collect()
    assert all(r.hit == any(g <= set(r.tokens) for g in got) for r in hits)


def test_tokens_that_always_meet_are_mined_as_one(spark):
    rng, rows = random.Random(8), []
    for _ in range(500):
        tokens = {f"t{rng.randrange(6)}" for _ in range(3)}
        tokens |= {"a1", "a2", "a3"} if "t1" in tokens else set()
        tokens |= {"b1", "b2"} if "t2" in tokens else set()
        rows.append((sorted(tokens), {"t1", "t2"} <= tokens and rng.random() < 0.95))
    mined = urlrules.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), 0.02, 0.6)
    assert {c for r in mined for c in r.combinations()} >= {frozenset({a, b}) for a in ("t1", "a1", "a2", "a3") for b in ("t2", "b1", "b2")}
    assert len(mined) == 1 and mined[0].tokens == frozenset({"a1", "b1"})
    seen = [["a3", "b2"], ["a1", "a2"], ["b1", "t2"], ["t1", "x", "b1"], []]
    hits = urlrules.matched(spark.createDataFrame([(t,) for t in seen], "tokens array<string>"), mined).collect()
    assert {tuple(r.tokens): r.hit for r in hits} == {("a3", "b2"): True, ("a1", "a2"): False, ("b1", "t2"): False, ("t1", "x", "b1"): True, (): False}


def test_a_url_of_thirty_tokens_is_mined_to_its_query_keys(spark):
    rng, pages, labels = random.Random(10), [], []
    for k in range(400):
        bad = rng.random() < 0.2
        path = "/".join(f"{c}{rng.randrange(4)}x" for c in "abcdefghijklmnop")
        pages.append((k, f"https://s{rng.randrange(9)}.x.news.example.net/{path}/{k}.html?page=2&{'zref' if bad else 'ref'}=1&q=2&r=3#top"))
        labels.append((k, 1 - bad, 0))
    frame = spark.createDataFrame(pages, "page_id long, url string")
    rows = urlrules.labelled(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert rows.agg(F.min(F.size("tokens"))).first()[0] >= 29
    mined = urlrules.mine(rows, support=0.15)
    assert frozenset({"q:zref"}) in {r.tokens for r in mined}
    assert {r.page_id for r in urlrules.judge(frame, mined).where("verdict = 'block'").collect()} == {k for k, u in pages if "zref" in u}


def test_thousands_of_rules_match_by_a_join(spark):
    mined = [urlrules.Rule(frozenset({f"p:a{k}", f"p:b{k % 7}"}), 1.0, 1.0) for k in range(3000)]
    rng = random.Random(11)
    pages = [(k, f"http://e.net/a{rng.randrange(4000)}/b{rng.randrange(7)}") for k in range(300)]
    rows = spark.createDataFrame([(k, [f"p:{x}" for x in u.split("/")[3:]]) for k, u in pages], "page_id long, tokens array<string>")
    have = {r.tokens for r in mined}
    assert {r.page_id: r.hit for r in urlrules.matched(rows, mined).collect()} == {r.page_id: frozenset(r.tokens) in have for r in rows.collect()}


def test_chance_makes_no_rules(spark):
    rng = random.Random(3)
    rows = [(sorted({f"t{rng.randrange(40)}" for _ in range(6)}), rng.random() < 0.25) for _ in range(900)]
    assert urlrules.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean")) == []


def test_deep_tokens_are_mined_and_matched(spark):
    rng = random.Random(9)
    pages, labels = [], []
    for k in range(400):
        bad = rng.random() < 0.2
        url = f"https://s{rng.randrange(9)}.news.example.net/en/{'ads/top' if bad else 'text/top'}/{k}?page=2{'&ref=z' if rng.random() < 0.5 else ''}"
        pages.append((k, url))
        labels.append((k, 1 - bad, 0))
    frame = spark.createDataFrame(pages, "page_id long, url string")
    mined = urlrules.mine(urlrules.labelled(frame.withColumn("url", F.regexp_replace("url", "[?].*", "")), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
    assert frozenset({"p:ads"}) in {r.tokens for r in mined}
    got = {r.page_id: r.verdict for r in urlrules.judge(frame, mined).collect()}
    assert got == {k: "block" if "/ads/" in u else "allow" for k, u in pages}


def test_listed_rules(spark):
    urls = ["https://a.example.org/es/1", "https://example.org/en/12?x", "http://www.x.com/fr/", "http://x.com/de/1", "http://xorg/", "http://ORG/", "http://x.com/en/"]
    rows = urlrules.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), [urlrules.Rule(frozenset({"p:en", "h:com"}), 1.0, 1.0)]).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in rows] == [("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"), (None, "allow"), ("org/", "allow"), (None, "block")]


# queries and pipeline


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, sf001, name):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf001}/{t}.parquet'")
    want = db.execute(ORACLE_SQL[name])
    names = sorted(d[0] for d in want.description)
    at = [[d[0] for d in want.description].index(n) for n in names]
    got = QUERIES[name](spark, sf001)
    assert sorted(got.columns) == names
    assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=repr) == sorted((tuple(r[k] for k in at) for r in want.fetchall()), key=repr)


def test_pipeline_matches_its_stages_by_brute_force(spark, sf001):
    import corpus_pipeline

    documents = spark.read.parquet(f"{sf001}/documents.parquet")
    kept = {r.doc_id for r in QUERIES["op1_quality"](spark, sf001).where("kept").collect()}
    texts = {r.doc_id: r.text for r in documents.collect() if r.doc_id in kept}
    clean = {i: t for i, t in texts.items() if langid.letter_runs(t)}
    label = slow_components(slow_sets(clean.items(), 5), 80)
    plain = lambda t: " ".join(re.findall(r"[^\W_]+", (t or "").lower()))
    items = [plain(r.text) for r in spark.read.parquet(f"{sf001}/benchmark.parquet").collect()]
    want = {i for i, t in clean.items() if label[i] == i and not any(x in plain(t) for x in items)}
    rows = corpus_pipeline.run(spark, sf001).collect()
    assert {r.doc_id for r in rows} == want
    assert all(sum(r.n_tokens for r in rows if r.doc_id == i) == len(re.findall("[^\x20\x09-\x0d]+", clean[i])) for i in want)
