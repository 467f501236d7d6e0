"""Quality rules: fixed base rules and gradient-boosted trees over document statistics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.llm import gbt
from gazetta.llm.common import map_batches, map_parts, words

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = b"0123456789"

#: Columns of the model and the sign of its monotonic constraint: more repetition or symbols never raise quality.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": 0, "digit_share": 0,
    "distinct_share": 0, "bang_share": -1, "words_a_line": 0, "punctuated_share": 0, "run_share": -1,
}
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The five integers of STATS and the floats of FEATURES of one whole text (None: an empty text)."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    tokens = raw.split()
    n = len(tokens)
    word_chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeat, distinct, runs = 0, 0, 0
    if n:
        seen: dict[bytes, int] = {}
        ids = np.fromiter((seen.setdefault(w, len(seen)) for w in tokens), np.int64, n)
        distinct, runs = len(seen), int((ids[1:] == ids[:-1]).sum())
        if n >= 3:
            pair = ids[:-1] * distinct + ids[1:]
            if distinct >= 1 << 20:  # three ids would not fit in 63 bits
                pair = np.unique(pair, return_inverse=True)[1]
            _, back, count = np.unique(pair[:-1] * distinct + ids[2:], return_inverse=True, return_counts=True)
            found = count[back] > 1
            cover = np.zeros(n, bool)
            for k in range(3):
                cover[k : n - 2 + k] |= found
            repeat = int(cover.sum())
    size = max(len(raw) - (len(text) - word_chars), 1)
    share = lambda keep: (len(raw) - len(raw.translate(None, keep))) / size
    upper, lower = share(UPPER), share(LOWER)
    features = [
        np.log1p(n), word_chars / max(n, 1), symbols / max(word_chars, 1), dup_lines / max(len(lines), 1), repeat / max(n, 1), upper / max(upper + lower, 1e-9), share(DIGITS),
        distinct / max(n, 1), text.count("!") / max(n, 1), n / max(len(lines), 1), (text.count(".") + text.count(",")) / max(n, 1), runs / max(n, 1),
    ]
    return [n, word_chars, symbols, dup_lines, repeat], features


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """Documents of the `rows` labelled ids that come first by hash, with their label. An id may have many rows: the caller bounds those."""
    ids = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).alias("_y"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id")


def train(documents: DataFrame, labels: DataFrame, rows: int = 20_000, trees: int = 40) -> gbt.Trees:
    """Fits quality (1 good, 0 bad) on at most `rows` labelled documents, however many rows an id has; without labels, a model that keeps all."""

    def features(batch: dict) -> dict:
        return {"y": batch["_y"], "x": [statistics(t)[1] for t in batch["text"]]}

    sample = map_batches(labelled_sample(documents, labels, "quality", rows), features, "y int, x array<double>")
    sample = sample.orderBy(F.xxhash64("x"), "x", "y").limit(rows).collect()
    if not sample:
        return gbt.constant(0.999)
    y, x = np.array([r.y for r in sample]), np.array([r.x for r in sample])
    order = np.lexsort(np.column_stack([x, y]).T)  # rows come in any order; sums of floats must not depend on it
    return gbt.fit(x[order], y[order], list(FEATURES.values()), trees=trees)


def assess(documents: DataFrame, model: gbt.Trees, least_words: int = 50, most_repeat: int = 50, threshold: float = 0.5) -> DataFrame:
    """doc_id, the counts of STATS, base_failed, kept and score of every document, from its whole text.

    A null or empty text has no words, so it fails the base rule. Rows with a null or repeated
    doc_id are judged each by its own text. Other columns don't matter.
    """

    def judge(batch: dict) -> dict:
        got = [statistics(t) for t in batch["text"]]
        stats = np.array([g[0] for g in got], np.int64).reshape(-1, len(STATS))
        score = gbt.predict(model, np.array([g[1] for g in got]).reshape(-1, len(FEATURES)))
        failed = (stats[:, 0] < least_words) | (100 * stats[:, 4] > most_repeat * stats[:, 0])
        out = {"doc_id": batch["doc_id"], "base_failed": failed, "kept": ~failed & (score >= threshold), "score": score}
        return out | {name: stats[:, k] for k, name in enumerate(STATS)}

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double"
    return map_batches(documents.select("doc_id", "text"), judge, schema)


def keep(documents: DataFrame, model: gbt.Trees, least_words: int = 50, most_repeat: int = 50, threshold: float = 0.5) -> DataFrame:
    """The documents that `assess` keeps, whole and with all their columns, in one pass and without a join."""

    def good(part: pa.RecordBatch) -> pa.Array:
        got = [statistics(t) for t in part.column(part.schema.get_field_index("text")).to_pylist()]
        score = gbt.predict(model, np.array([g[1] for g in got]).reshape(-1, len(FEATURES)))
        fair = [g[0][0] >= least_words and 100 * g[0][4] <= most_repeat * g[0][0] and s >= threshold for g, s in zip(got, score, strict=True)]
        return pa.array(fair, pa.bool_())

    return map_parts(documents, good)
