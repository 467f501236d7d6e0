"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The score of a word is
the sum over all its segmentations into pieces, by a forward pass; pieces never cross words, so a
text's log-likelihood is the sum over its words, and every distinct word is scored once per worker,
whole, however long it is. Texts are lower-cased, so pieces with capitals are left out of the vocabulary.
The piece probabilities come from EM (forward-backward counts) on a bounded sample of labelled texts.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.llm.common import map_batches, map_parts, scratch

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  #: stands before the first letter of a word, as in the vocabulary
LONG = 32  #: letter runs longer than this are summed over in logarithms, as their probabilities leave the range of doubles
UNKNOWN = 1e-7  #: probability of a letter that is no piece, the same in all languages
CACHE, CACHE_LETTERS = 200_000, 2_000_000  #: words that a worker remembers, and their letters
SLICE, SLICE_LETTERS = 5_000, 60_000  #: words in one forward pass, and their letters unless it is one word

_letters = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def letter_runs(text: str | None) -> list[str]:
    """Lower-cased runs of letters; empty if the text has no letter."""
    if not text:
        return []
    return [w for w in _letters.findall(unicodedata.normalize("NFC", text).lower()) if w.isalpha() or any(map(str.isalpha, w))]


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def scattered(code: np.ndarray) -> np.ndarray:
    h = (code + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Pieces:
    """The vocabulary as sorted substring hashes behind a bitmap, so most misses cost one look."""

    def __init__(self, pieces: list[str]):
        hashes = np.array([self.hash_of(p) for p in pieces], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(hashes >> np.uint64(44)).astype(np.int64)] = True
        self.size = len(pieces)
        self.longest = max(map(len, pieces), default=1)

    @staticmethod
    def hash_of(piece: str) -> int:
        h = np.zeros(1, np.uint64)
        for c in scattered(codes(piece)):
            h = h * _BASE + c
        return int(h[0])

    @classmethod
    def read(cls, path: str) -> Pieces:
        """The pieces of a sentencepiece model that can occur in lower-cased letter runs: those of letters, without capitals, with or without the mark."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        kept = [p for p in found if p == p.lower() and (p == MARK or p.removeprefix(MARK).isalpha())]
        return cls(sorted(set(kept)))


class Lattice(NamedTuple):
    """All pieces in a list of words. Nodes are the places between letters; a word's nodes follow one another."""

    first: np.ndarray  #: node at the start of each word
    last: np.ndarray
    start: np.ndarray  #: of each edge, sorted by the place of its end in the word
    end: np.ndarray
    piece: np.ndarray  #: number of pieces stands for an unknown letter
    steps: np.ndarray  #: edges[steps[t]:steps[t + 1]] end at place t + 1
    nodes: int


def lattice(pieces: Pieces, words: list[str]) -> Lattice:
    sizes = np.array([len(w) for w in words], np.int64)
    flat = scattered(codes("".join(words)))
    word = np.repeat(np.arange(len(words)), sizes)
    begin = np.cumsum(sizes) - sizes
    place = np.arange(len(flat)) - begin[word]
    left = sizes[word] - place  # letters to the end of the word, this one included
    h = np.zeros(len(flat), np.uint64)
    starts, lengths, ids = [], [], []
    for n in range(1, pieces.longest + 1):
        here = np.flatnonzero(left >= n)
        if not len(here):
            break
        h[here] = h[here] * _BASE + flat[here + n - 1]
        hit = here[pieces.seen[(h[here] >> np.uint64(44)).astype(np.int64)]]
        at = np.minimum(np.searchsorted(pieces.hashes, h[hit]), pieces.size - 1)
        good = pieces.hashes[at] == h[hit]
        hit, at = hit[good], at[good]
        starts.append(hit), lengths.append(np.full(len(hit), n)), ids.append(pieces.ids[at])
        if n == 1:  # letters that are no piece get an edge of their own
            lone = np.ones(len(flat), bool)
            lone[hit] = False
            lone = np.flatnonzero(lone)
            starts.append(lone), lengths.append(np.ones(len(lone), np.int64)), ids.append(np.full(len(lone), pieces.size))
    start, length, piece = np.concatenate(starts), np.concatenate(lengths), np.concatenate(ids)
    end_place = place[start] + length
    order = np.argsort(end_place, kind="stable")
    start, length, piece, end_place = start[order], length[order], piece[order], end_place[order]
    node = start + word[start]
    steps = np.searchsorted(end_place, np.arange(1, sizes.max() + 2))
    first = begin + np.arange(len(words))
    return Lattice(first, first + sizes, node, node + length, piece, steps, len(flat) + len(words))


def forward(g: Lattice, p: np.ndarray) -> np.ndarray:
    """(nodes, languages): probability of each word up to a node, over all segmentations. p: (pieces + 1, languages)."""
    a = np.zeros((g.nodes, p.shape[1]))
    a[g.first] = 1
    for lo, hi in zip(g.steps[:-1], g.steps[1:], strict=True):
        np.add.at(a, g.end[lo:hi], a[g.start[lo:hi]] * p[g.piece[lo:hi]])
    return a


def backward(g: Lattice, p: np.ndarray) -> np.ndarray:
    b = np.zeros((g.nodes, p.shape[1]))
    b[g.last] = 1
    for lo, hi in zip(g.steps[-2::-1], g.steps[:0:-1], strict=True):
        np.add.at(b, g.start[lo:hi], b[g.end[lo:hi]] * p[g.piece[lo:hi]])
    return b


def log_forward(g: Lattice, q: np.ndarray) -> np.ndarray:
    """As forward, in logarithms; q: of p."""
    a = np.full((g.nodes, q.shape[1]), -np.inf)
    a[g.first] = 0
    for lo, hi in zip(g.steps[:-1], g.steps[1:], strict=True):
        np.logaddexp.at(a, g.end[lo:hi], a[g.start[lo:hi]] + q[g.piece[lo:hi]])
    return a


def log_backward(g: Lattice, q: np.ndarray) -> np.ndarray:
    b = np.full((g.nodes, q.shape[1]), -np.inf)
    b[g.last] = 0
    for lo, hi in zip(g.steps[-2::-1], g.steps[:0:-1], strict=True):
        np.logaddexp.at(b, g.start[lo:hi], b[g.end[lo:hi]] + q[g.piece[lo:hi]])
    return b


def word_slices(words: list[str]) -> Iterator[tuple[bool, int, int]]:
    """(long, start, end) of the slices of words sorted by length that one forward pass takes."""
    start = letters = 0
    for k, w in enumerate(words):
        turn = len(w) >= LONG and k > 0 and len(words[k - 1]) < LONG
        if k > start and (turn or k - start >= SLICE or letters + len(w) > SLICE_LETTERS):
            yield len(words[start]) >= LONG, start, k
            start, letters = k, 0
        letters += len(w)
    if start < len(words):
        yield len(words[start]) >= LONG, start, len(words)


class Model:
    """Piece probabilities p (pieces + 1, languages), and for each language the least log-likelihood a letter that a text of it has."""

    def __init__(self, languages: list[str], pieces: Pieces, p: np.ndarray, floor: np.ndarray | None = None):
        self.languages, self.pieces, self.p = languages, pieces, p
        self.floor = np.full(len(languages), -np.inf) if floor is None else floor
        self.clear()

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("languages", "pieces", "p", "floor")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.letters = 0
        self.scores = np.zeros((1024, len(self.languages)))

    def learn(self, words: set[str]) -> None:
        """Scores the words that are not remembered."""
        new = words - self.known.keys()
        letters = sum(map(len, new))
        if self.known and (len(self.known) + len(new) > CACHE or self.letters + letters > CACHE_LETTERS):
            self.clear()
            new, letters = words, sum(map(len, words))
        self.letters += letters
        new = sorted(new, key=lambda w: (len(w), w))
        size = len(self.known) + len(new)
        if size > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros((max(size, 2 * len(self.scores)) - len(self.scores), len(self.languages)))])
        for long, lo, hi in word_slices(new):
            g = lattice(self.pieces, [MARK + w for w in new[lo:hi]])
            at = len(self.known)
            self.scores[at : at + hi - lo] = log_forward(g, np.log(self.p))[g.last] if long else np.log(np.maximum(forward(g, self.p)[g.last], 1e-300))
            for k, w in enumerate(new[lo:hi]):
                self.known[w] = at + k

    def fits(self, texts: list[str | None]) -> list[tuple[np.ndarray, int]]:
        """The log-likelihood of each whole text in every language, and its letters (one more for each word; 0 for a text without any)."""
        runs = [letter_runs(t) for t in texts]
        self.learn(set().union(*runs))
        zero = np.zeros(len(self.languages))
        return [(self.scores[np.fromiter(map(self.known.__getitem__, ws), np.int64, len(ws))].sum(axis=0) if ws else zero, sum(map(len, ws)) + len(ws)) for ws in runs]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """The most likely language of each whole text, its posterior, and whether the text fits it; ("und", 0, False) without letters or languages."""
        names, scores, fitting = [], [], []
        for total, letters in self.fits(texts if self.languages else [None] * len(texts)):
            if not letters:
                names.append("und"), scores.append(0.0), fitting.append(False)
                continue
            best = int(total.argmax())
            names.append(self.languages[best])
            scores.append(float(1 / np.exp(np.clip(total - total[best], -700, 0)).sum()))
            fitting.append(bool(total[best] >= self.floor[best] * letters))
        return names, scores, fitting


def fit(counts: list[tuple[str, str, int]], pieces: Pieces, rounds: int = 4, add: float = 0.02) -> Model:
    """EM over all segmentations. counts: (language, word, times)."""
    languages = sorted({c[0] for c in counts})
    if not languages:
        return Model([], pieces, np.zeros((pieces.size + 1, 0)))
    index = {x: k for k, x in enumerate(languages)}
    words = sorted({c[1] for c in counts}, key=lambda w: (len(w), w))
    at = {w: k for k, w in enumerate(words)}
    weight = np.zeros((len(words), len(languages)))
    for lang, word, n in counts:
        weight[at[word], index[lang]] += n
    lattices = []  # in slices of the words, so the passes need little memory
    for long, lo, hi in word_slices(words):
        g = lattice(pieces, [MARK + w for w in words[lo:hi]])
        lattices.append((long, g, weight[lo:hi], np.searchsorted(g.first, g.start, side="right") - 1))
    p = np.full((pieces.size + 1, len(languages)), 1 / (pieces.size + 1))
    for _ in range(rounds):
        expected = np.zeros_like(p)
        q = np.log(p)
        for long, g, times, word_of in lattices:
            if long:
                a, b = log_forward(g, q), log_backward(g, q)
                share = np.exp(a[g.start] + q[g.piece] + b[g.end] - a[g.last][word_of]) * times[word_of]
            else:
                a, b = forward(g, p), backward(g, p)
                share = a[g.start] * p[g.piece] * b[g.end] * (times / np.maximum(a[g.last], 1e-300))[word_of]
            expected += np.stack([np.bincount(g.piece, share[:, k], pieces.size + 1) for k in range(len(languages))], axis=1)
        p = (expected + add) / (expected.sum(axis=0) + add * (pieces.size + 1))
        p[-1] = UNKNOWN
    return Model(languages, pieces, p)


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo 4."""
    return F.crc32(key.cast("string").cast("binary")) % 4


#: A text fits its language if its log-likelihood a letter is not further below the sample's mean than this, or so many standard deviations.
LEAST_MARGIN, DEVIATIONS = 1.4, 8


#: Languages of one model: it is broadcast, and has some 23,000 probabilities for each.
MOST_LANGUAGES = 2000


def sampled(documents: DataFrame, a_language: int, languages: int | None) -> DataFrame:
    """(lang, doc_id): of each language the `a_language` ids with the lowest hashes, outside the held-out fold, with a lang, an id and a text.

    Ids are told apart before they are counted, so an id with many rows takes one place. Without `languages` all values of lang are learned.
    """
    ids = documents.where((fold(F.col("doc_id")) != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "doc_id").distinct()
    lowest = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    if languages is not None:
        largest = ids.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
        ids = ids.join(largest.select("lang"), "lang", "left_semi")
    return ids.withColumn("k", F.row_number().over(lowest)).where(F.col("k") <= a_language).select("lang", "doc_id")


def train(documents: DataFrame, vocabulary: str = VOCABULARY, a_language: int = 300, languages: int | None = None, words: int = 1_000_000) -> Model:
    """Fits on `a_language` documents of each language (see sampled); of an id one text counts.

    All values of lang are learned. More than MOST_LANGUAGES of them are an error, since the model is broadcast; then
    `languages` names how many of the largest to learn. At most `words` distinct words are learned from, an equal share for
    each language, those with most occurrences.
    """
    open_rows = documents.select("doc_id", "text", "lang").where(F.col("text").isNotNull())
    with scratch() as keep:
        chosen = keep(sampled(documents, a_language, languages), "lang-ids")
        learned = chosen.select("lang").distinct().count()
        if learned > MOST_LANGUAGES:
            raise ValueError(f"{learned} languages are too many for one model; learn the largest with languages={MOST_LANGUAGES} or fewer")
        sample = open_rows.join(F.broadcast(chosen), ["lang", "doc_id"])  # MOST_LANGUAGES * a_language rows at most
        sample = sample.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
        sample = keep(sample.select("lang", "text"), "lang-sample")

        def count(batch: dict) -> dict:
            lang, word, n = [], [], []
            for x, text in zip(batch["lang"], batch["text"], strict=True):
                times: dict[str, int] = {}
                for w in letter_runs(text):
                    times[w] = times.get(w, 0) + 1
                lang += [x] * len(times)
                word += times.keys()
                n += times.values()
            return {"lang": lang, "word": word, "n": n}

        counted = map_batches(sample, count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
        often = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
        counted = counted.withColumn("k", F.row_number().over(often)).where(F.col("k") <= words // max(learned, 1))
        model = fit(sorted((r.lang, r.word, r.n) for r in counted.collect()), Pieces.read(vocabulary))
        if not model.languages:
            return model
        held = documents.sparkSession.sparkContext.broadcast(model)

        def own(batch: dict) -> dict:
            got = [(x, total[held.value.languages.index(x)] / n) for x, (total, n) in zip(batch["lang"], held.value.fits(batch["text"]), strict=True) if n]
            return {"lang": [x for x, _ in got], "fit": [f for _, f in got]}

        fits = map_batches(sample, own, "lang string, fit double").groupBy("lang").agg(F.avg("fit").alias("mean"), F.stddev_pop("fit").alias("sd")).collect()
        floor = {r.lang: r.mean - max(DEVIATIONS * r.sd, LEAST_MARGIN) for r in fits}
        held.unpersist()
    return Model(model.languages, model.pieces, model.p, np.array([floor[x] for x in model.languages]))


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, from its whole text alone.

    A null text or one without letters is `und` with score 0, as is every text if nothing could be learned.
    A null doc_id is not held out (and not learned from). Repeated rows are judged alike; other columns don't matter.
    """
    held = documents.sparkSession.sparkContext.broadcast(model)

    def judge(batch: dict) -> dict:
        names, scores, _ = held.value.predict(batch["text"])
        return {"doc_id": batch["doc_id"], "held_out": batch["held_out"], "lang_pred": names, "score": scores}

    rows = documents.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "text")
    return map_batches(rows, judge, "doc_id long, held_out boolean, lang_pred string, score double")


def keep(documents: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents that fit a learned language and have a score of `least` or more, whole, in one pass and without a join.

    A text in a language that was not learned scores high in the nearest one, but fits none: its log-likelihood
    a letter lies far below that of the texts learned from. Null texts and those without letters go.
    """
    held = documents.sparkSession.sparkContext.broadcast(model)

    def good(part: pa.RecordBatch) -> pa.Array:
        _, scores, fitting = held.value.predict(part.column(part.schema.get_field_index("text")).to_pylist())
        return pa.array([f and s >= least for f, s in zip(fitting, scores, strict=True)], pa.bool_())

    return map_parts(documents, good)
