"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator and stage."""

import pytest
from gazetta.llm import decontam, html, langid, lexical, licenses, minhash, mixing, packing, quality, shard, toxicity, urlrules, whitening
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix potions beneath an old stone bridge near the river"
LONG = " ".join(f"{w}{k % 97}" for k in range(4000) for w in ("alpha", "beta", "gamma"))
ROWS = [
    (1, WORDS * 3, "en", "a", 1), (1, WORDS * 3, "en", "a", 1), (2, "", "en", "a", 0), (3, None, "en", None, None), (None, WORDS, None, "b", 3), (4, " \n\t ", None, "a", 4), (5, "x", "en", "a", 1),
    (6, LONG, "en", "a", 9), (7, LONG, "en", "b", 9), (8, "\U0001f600 **** ||| 123\x85456 ", "en", "c", 2), (None, None, None, None, None),
]


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    for name in ("shard", "slot", "score", "kept", "sig", "key", "id", "_n", "_y", "toxic", "cluster", "a", "b", "component"):
        rows = rows.withColumn(name, F.lit("clash"))
    return rows


@pytest.fixture(scope="module")
def empty(documents):
    return documents.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (6, 1, 1), (None, 1, 1), (7, None, None), (1, 1, 0)], "doc_id long, quality int, toxic int")


def test_quality(documents, empty, labels):
    model = quality.train(documents, labels)
    rows = quality.assess(documents, model).collect()
    assert len(rows) == len(ROWS) and all(r.base_failed and not r.kept for r in rows if r.n_words == 0)
    assert quality.assess(empty, model).count() == 0
    kept = quality.keep(documents, model)
    assert kept.columns == documents.columns and kept.count() == sum(r.kept for r in rows)
    assert quality.assess(documents, quality.train(empty, labels)).count() == len(ROWS)
    assert quality.assess(documents, quality.train(documents, labels.limit(0))).where("not base_failed and not kept").count() == 0


def test_sharding(documents, empty):
    rows = shard.assign(documents, [1.0] * 8).collect()
    assert len(rows) == len(ROWS)
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert {r.size for r in rows if r.doc_id == 3} == {1} and {r.text_crc32 for r in rows if r.doc_id == 3} == {0}
    assert shard.assign(empty, [1.0, 2.0]).count() == 0


def test_near_duplicates(documents, empty):
    rows = minhash.near_duplicates(documents, 3, 85).collect()
    assert len(rows) == len(ROWS)
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert (by[6].component_id, by[7].component_id, by[6].kept, by[7].kept) == (6, 6, True, False)
    assert by[2].n_shingles == by[3].n_shingles == by[4].n_shingles == 0 and by[5].n_shingles == 1 and by[3].kept
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    assert minhash.near_duplicates(empty).count() == 0


def test_packing(documents, empty):
    rows = packing.pack(documents, capacity=1000).collect()
    assert sorted({(r.doc_id or -1) for r in rows}) == sorted({(r[0] or -1) for r in ROWS})
    assert sum(r.n_tokens for r in rows if r.doc_id == 6) == 12000 and {r.bin_id for r in rows if r.doc_id in (2, 3, 4)} == {-1}
    assert packing.pack(empty).count() == 0


def test_toxicity(documents, empty, labels):
    chain = toxicity.train(documents, labels)
    assert toxicity.score(documents, chain).count() == len(ROWS)
    assert toxicity.score(documents, None).where("toxic").count() == 0 and toxicity.score(empty, None).count() == 0
    assert toxicity.train(empty, labels) is None and toxicity.train(documents, labels.limit(0)) is None


def test_licenses(documents, empty):
    assert licenses.scan(documents).count() == 0 and licenses.scan(empty).count() == 0
    assert licenses.scan(documents, ()).count() == 0


def test_html(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (3, "u", "<p"), (None, "u", "<![x[<p>&amp;&#x41;&bogus;"), (5, "u", "plain"), (6, "u", "<div>" * 3000 + "x"), (6, "u", "</p></p><table><tr><td>a<p>b"), (7, "u", "<p>" + "long words " * 50000)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    rows = html.extract(pages).collect()
    assert len(rows) == 8 and all(r.n_chars == len(r.text) for r in rows)
    assert {r.text for r in rows if r.page_id in (1, 2)} == {""}
    assert html.extract(pages.limit(0)).count() == 0


def test_decontamination(spark, documents, empty):
    benchmark = spark.createDataFrame([(1, WORDS), (2, None), (3, ""), (None, WORDS), (4, "short")], "item_id long, text string")
    rows = decontam.leaks(documents, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(1, 1), (None, 1)}
    assert decontam.leaks(documents, benchmark.limit(0)).count() == 0 and decontam.leaks(empty, benchmark).count() == 0
    kept = decontam.clean(documents, benchmark)
    assert kept.columns == documents.columns and kept.count() == len(ROWS) - 3
    assert decontam.clean(documents, benchmark.limit(0)).count() == len(ROWS)


def test_language(documents, empty):
    model = langid.train(documents)
    rows = langid.identify(documents, model).collect()
    assert len(rows) == len(ROWS) and {r.lang_pred for r in rows if r.doc_id in (2, 3, 4, 8)} == {"und"}
    assert all(0 <= r.score <= 1 and not r.held_out for r in rows if r.doc_id is None)
    nothing = langid.train(empty)
    assert {r.lang_pred for r in langid.identify(documents, nothing).collect()} == {"und"} and langid.identify(empty, model).count() == 0
    assert langid.keep(documents, model).columns == documents.columns and langid.keep(documents, nothing).count() == 0


def test_urls(spark, labels):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "no scheme/x"), (4, "http://"), (None, "HTTP://A.ORG/x?y#z"), (5, "http://org"), (6, "x" * 100000), (6, "http://a.org//b")], "page_id long, url string").withColumn("host", F.lit("clash"))
    rows = urlrules.judge(pages, urlrules.mine(urlrules.labelled(pages, labels))).collect()
    assert len(rows) == 8 and all(r.host == r.path == "" and r.rule is None and r.verdict == "allow" for r in rows if r.page_id in (1, 2, 3, 4))
    assert [(r.host, r.path, r.rule) for r in rows if r.page_id is None] == [("a.org", "/x", "org/")]
    assert [(r.path, r.rule) for r in rows if r.page_id == 5] == [("", None)]
    assert urlrules.judge(pages.limit(0), []).count() == 0 and urlrules.mine(urlrules.labelled(pages.limit(0), labels)) == []


def test_mixing(documents, empty):
    rows = mixing.decide(documents).collect()
    assert len(rows) == len(ROWS) and {r.size for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert all(r.taken == r.copies * r.size <= 3 * r.size for r in rows)
    assert mixing.decide(empty).count() == 0 and mixing.emit(empty).count() == 0
    mixed = mixing.emit(documents)
    assert sorted(mixed.columns) == sorted(documents.columns) and mixed.count() == sum(r.copies for r in rows)


def test_whitening(spark):
    good = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, -1.0]), (4, [0.5, 0.25]), (5, [1e300, 1.0])]
    bad = [(6, None), (7, [1.0, None]), (8, [float("nan"), 1.0]), (9, [1.0, float("inf")]), (10, []), (11, [1.0])]
    vectors = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").withColumn("n", F.lit("clash"))
    rows = whitening.whiten(vectors).collect()
    assert sorted((r.vec_id or 0, r.component) for r in rows) == sorted((v or 0, c) for v, _ in good for c in (1, 2))
    assert {r.n for r in rows} == {5} and {r.deviation for r in rows if r.vec_id == 5} == {None}
    same = whitening.whiten(vectors.where("vec_id = 1")).collect()
    assert len(same) == 6 - 2 and all(r.whitened == r.explained == r.identity_error == r.deviation == 0 for r in same)
    assert whitening.whiten(vectors.limit(0)).count() == 0 and whitening.whiten(vectors.where("vec_id in (6, 8, 10)")).count() == 0


def test_search(spark, documents, empty):
    items = spark.createDataFrame([(1, "Quick FOX, x"), (1, "alpha5"), (None, "\U0001f600 nothing"), (3, None), (4, " .,"), (5, "absent")], "item_id long, text string").withColumn("rank", F.lit("clash"))
    rows = lexical.search(documents, items).collect()
    assert sorted((r["rank"], r.doc_id or 0) for r in rows if r.item_id is None) == [(1, 8)]
    assert [r.doc_id for r in sorted(rows, key=lambda r: r["rank"]) if r.item_id == 1 and r.doc_id in (6, 7)] == [6, 7]
    assert sorted((r.doc_id or 0) for r in rows if r.item_id == 1) == [0, 1, 1, 5, 6, 7] and not [r for r in rows if r.item_id in (3, 4, 5)]
    assert lexical.search(empty, items).count() == 0 and lexical.search(documents, items.limit(0)).count() == 0


def test_stages(spark, documents, empty, sf001):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents, sf001).count() >= 0, name
        assert stage(spark, empty, sf001).count() == 0, name
        if name != "best_fit_packing":
            assert sorted(stage(spark, documents, sf001).columns) == sorted(documents.columns), name


def test_stages_keep_repeated_rows_apart(spark, sf001):
    import corpus_pipeline

    rows = spark.createDataFrame([(1, LONG, "en", "a", 1), (1, LONG, "en", "a", 1), (None, LONG, "en", "a", 1), (2, LONG + " end", "en", "a", 1)], SCHEMA)
    assert sorted((r.doc_id or 0) for r in corpus_pipeline.near_dedup(spark, rows, sf001).collect()) == [0, 1]
