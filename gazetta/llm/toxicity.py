"""Toxicity by a classifier chain of linear models.

Categories are predicted in a fixed order. Each model sees which selected features a text has and the
log-odds of the categories before it; in training these come from out-of-fold predictions, so a later
model does not learn to trust what an earlier one remembers. The labels mark toxicity as a whole only:
that is the last category. Those before it are two kinds of toxic texts found in the training sample itself, by
a cut of the toxic texts along their rarer features: they have numbers, no names, and only the last
probability has a meaning that labels vouch for.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.llm.common import map_batches, scratch

CATEGORIES = ("kind1", "kind2", "toxic")
STEMS = (4, 5)  #: word beginnings of these lengths are features too
FOLDS = 4

_word = re.compile(r"[^\W\d_]+")


def features_of(text: str | None) -> set[str]:
    """Distinct lower-cased words of the whole text, and their beginnings marked with *."""
    words = set(_word.findall(text.lower())) if text else set()
    return words | {f"{w[:n]}*" for w in words for n in STEMS if len(w) >= n}


class Chain(NamedTuple):
    names: tuple[str, ...]
    index: dict[str, int]
    weights: list[np.ndarray]  #: of the features, then of the earlier log-odds, then the bias
    threshold: float  #: of the last category


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def with_bias(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1), x.dtype)])


def linear(x: np.ndarray, y: np.ndarray, steps: int = 300, l2: float = 0.02) -> np.ndarray:
    """L2-regularised logistic regression by accelerated gradient steps; the bias (last) is not penalised.

    Columns are scaled to unit length for the steps, so rare features move as fast as common ones.
    """
    x = with_bias(x)
    scale = np.sqrt(np.maximum((x * x).sum(axis=0), 1.0))
    x = x / scale
    penalty = np.append(np.full(x.shape[1] - 1, l2), 1e-3) / scale**2
    probe = np.ones(x.shape[1], x.dtype)
    for _ in range(12):  # largest curvature by power iteration
        probe = x.T @ (x @ probe)
        probe /= max(np.linalg.norm(probe), 1e-12)
    rate = 1 / (0.25 * np.linalg.norm(x.T @ (x @ probe)) * 1.1 + penalty.max())
    w = v = np.zeros(x.shape[1], x.dtype)
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -40, 40)))
        new = (v - rate * (x.T @ (p - y) + penalty * v)).astype(x.dtype)
        v = new + np.float32(k / (k + 3)) * (new - w)
        w = new
    return w / scale


def predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(with_bias(x) @ w, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, fold: np.ndarray, names: tuple[str, ...], index: dict[str, int]) -> Chain:
    """x: (rows, features) 0 or 1; y: (rows, categories); fold: of each row."""
    y = y.astype(x.dtype)
    weights, given, last = [], x, np.zeros(len(x))
    for k in range(y.shape[1]):
        out = np.zeros(len(x))
        for f in range(FOLDS):
            away = fold == f
            if away.any() and not away.all():
                out[away] = predict(given[away], linear(given[~away], y[~away, k]))
        weights.append(linear(given, y[:, k]))
        last = out
        given = np.hstack([given, logit(out)[:, None].astype(x.dtype)])
    order = np.argsort(-last, kind="stable")
    hits = np.cumsum(y[order, -1])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + max(y[:, -1].sum(), 1))
    cut = int(f1.argmax())
    threshold = (last[order][cut] + last[order][min(cut + 1, len(order) - 1)]) / 2  # between the last text to flag and the next
    return Chain(names, index, weights, float(np.clip(threshold, 0.1, 0.7)))


def chain_scores(chain: Chain, x: np.ndarray) -> np.ndarray:
    out = []
    for w in chain.weights:
        out.append(predict(x, w))
        x = np.hstack([x, logit(out[-1])[:, None].astype(x.dtype)])
    return np.stack(out, axis=1)


def matrix(index: dict[str, int], features: list[set[str]]) -> np.ndarray:
    x = np.zeros((len(features), len(index)), np.float32)
    for k, have in enumerate(features):
        x[k, [index[f] for f in have if f in index]] = 1
    return x


def kinds(x: np.ndarray) -> np.ndarray:
    """Kind 0 or 1 of each row: the sides of a cut across the direction in which rows differ most, rare features weighing more.

    Each kind gets a quarter of the rows at least, so that every fold has some of each.
    """
    w = x * np.log((len(x) + 1) / (x.sum(axis=0) + 1))
    w = w / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-9)
    w = w - w.mean(axis=0)
    along = np.linspace(1, 2, x.shape[1])  # leading direction by power iteration
    for _ in range(50):
        along = w.T @ (w @ along)
        along = along / max(np.linalg.norm(along), 1e-12)
    place = np.round(w @ along, 9)
    low, high = np.quantile(place, [0.25, 0.75])
    cut = place.mean()
    for _ in range(20):  # two means on a line
        above = place > cut
        if above.all() or not above.any():
            break
        cut = float(np.clip((place[above].mean() + place[~above].mean()) / 2, low, high))
    return (place > cut).astype(np.int64)


def train(documents: DataFrame, labels: DataFrame, rows: int = 6_000, selected: int = 700) -> Chain | None:
    """Fits on at most `rows` labelled documents (of an id one text counts) and the `selected` features that tell toxic ones best. None without both classes.

    Equal texts are in one fold, so a copy is never predicted from its original.
    """
    ids = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    sample = sample.withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int"))

    def split(batch: dict) -> dict:
        return {"doc_id": batch["doc_id"], "toxic": batch["toxic"], "fold": batch["fold"], "have": [sorted(features_of(t)) for t in batch["text"]]}

    with scratch() as keep:
        sample = keep(map_batches(sample, split, "doc_id long, toxic int, fold int, have array<string>"), "toxic-sample")
        n, bad = sample.agg(F.count("*"), F.sum((F.col("toxic") == 1).cast("long"))).first()
        if not n or not bad or bad == n:
            return None
        counts = sample.select("toxic", F.explode("have").alias("f")).groupBy("f").agg(F.count("*").alias("all"), F.sum((F.col("toxic") == 1).cast("long")).alias("bad"))
        expected = F.col("all") * (bad / n)
        chosen = counts.where("all >= 3").orderBy(F.desc(F.abs(F.col("bad") - expected) / F.sqrt(expected)), "f").limit(selected).collect()
        index = {f: k for k, f in enumerate(sorted(r.f for r in chosen))}
        got = sample.select("doc_id", "toxic", F.array_intersect("have", F.array(*map(F.lit, index)).cast("array<string>")).alias("have"), "fold").collect()
    got.sort(key=lambda r: (r.doc_id, r.toxic))
    have = [set(r.have) for r in got]
    x, toxic = matrix(index, have), np.array([r.toxic == 1 for r in got])
    kind = np.full(len(got), -1)
    kind[toxic] = kinds(x[toxic])
    y = np.stack([kind == 0, kind == 1, toxic], axis=1)
    return fit(x, y, np.array([r.fold for r in got]), CATEGORIES, index)


def score(documents: DataFrame, chain: Chain | None) -> DataFrame:
    """doc_id, p_kind1, p_kind2, p_toxic and toxic of every document, from its whole text.

    Null and empty texts, and all texts if nothing could be learned, have probabilities 0 and are not toxic.
    Rows that repeat or have no doc_id are judged each by its own text. Other columns don't matter.
    """
    held = documents.sparkSession.sparkContext.broadcast(chain)  # bounded by the number of selected features

    def judge(batch: dict) -> dict:
        chain = held.value
        n = len(batch["text"])
        p = np.zeros((n, len(CATEGORIES))) if chain is None else chain_scores(chain, matrix(chain.index, [features_of(t) for t in batch["text"]]))
        p[[k for k, t in enumerate(batch["text"]) if not t]] = 0
        flags = p[:, -1] >= (chain.threshold if chain else 2)
        return {"doc_id": batch["doc_id"]} | {f"p_{c}": p[:, k] for k, c in enumerate(CATEGORIES)} | {"toxic": flags}

    return map_batches(documents.select("doc_id", "text"), judge, "doc_id long, " + "".join(f"p_{c} double, " for c in CATEGORIES) + "toxic boolean")
