"""License scans: winnowed fingerprints pick candidate templates, banded word alignment reports coverage and spans."""

from __future__ import annotations

import re
from bisect import bisect_left
from typing import NamedTuple

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from gazetta.llm import license_texts
from gazetta.llm.common import map_batches

GRAM = 3  #: words in a fingerprint
WINDOW = 2  #: any run of GRAM + WINDOW - 1 words that a text shares with a template shares a fingerprint
COVERAGE = 0.75  #: of a template's words, from which a match is reported
SHORT = 40  #: words up to which a template is a notice: one shared fingerprint picks it, and its telling words must agree
SUPPORT = 0.2  #: of a longer template's fingerprints that a band of diagonals must share; edits in two of five words leave more
CACHE = 20_000  #: alignments of notices that a worker remembers

_word = re.compile(r"\w+")


def tokens(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    spans = [m.span() for m in _word.finditer(text)]
    return [text[a:b].lower() for a, b in spans], spans


def hashes(words: list[str]) -> np.ndarray:
    """Hash of each run of GRAM words."""
    h = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    n = max(len(h) - GRAM + 1, 0)
    total = np.zeros(n, np.uint64)
    for k in range(GRAM):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
    return total ^ (total >> np.uint64(29))


def winnowed(h: np.ndarray) -> np.ndarray:
    """Places of the fingerprints: the least hash of every WINDOW neighbours, the last of equal ones."""
    if len(h) <= WINDOW:
        return np.array([len(h) - 1 - int(h[::-1].argmin())]) if len(h) else np.empty(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(h, WINDOW)
    return np.unique(np.arange(len(windows)) + WINDOW - 1 - windows[:, ::-1].argmin(axis=1))


def is_number(word: str) -> bool:
    return word.isdigit() or license_texts.NUMBER.fullmatch(word) is not None


class Match(NamedTuple):
    license: str
    template: int
    coverage: float
    matched: int
    start: int
    end: int


def band_of(template: int) -> int:
    """Words that an alignment with a template of so many words may drift to either side."""
    return max(1, template // 8) if template <= SHORT else 8 + template // 10


def aligned(template: np.ndarray, words: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int]:
    """Words in common, first and last place in `words`, of the best alignment within `band` of a diagonal; word ids stand for words.

    Of alignments with as many words in common one that starts late is taken, and of those one that ends early.
    """
    width = 2 * band + 1
    low = diagonal - band
    reach = np.arange(low, low + width + len(template) - 1)
    inside = (reach >= 0) & (reach < len(words))
    near = np.where(inside, words[np.clip(reach, 0, max(len(words) - 1, 0))], -1)
    unit = 1 << 42
    mask = (1 << 21) - 1
    best = np.zeros(width, np.int64)  # words in common, then the first of them, then mask less the last, as places in reach
    for i, want in enumerate(template):
        here = best.copy()
        here[:-1] = np.maximum(here[:-1], best[1:])
        hit = np.flatnonzero(near[i : i + width] == want)
        if len(hit):
            at, before = hit + i, best[hit]
            first = np.where(before >= unit, (before >> 21) & mask, at)
            here[hit] = np.maximum(here[hit], ((before >> 42) + 1 << 42) | (first << 21) | (mask - at))
        best = np.maximum.accumulate(here)
    value = int(best[-1])
    return value >> 42, (value >> 21 & mask) + low, mask - (value & mask) + low


class Scanner:
    def __init__(self, templates: tuple[tuple[str, str], ...] | None = None):
        chosen = license_texts.templates() if templates is None else templates
        cut = [tokens(t)[0] for _, t in chosen]
        self.names = [n for n, _ in chosen]
        self.cache: dict[tuple, tuple[int, int, int]] = {}
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for words in cut for w in words}))}
        self.words = [np.array([self.vocabulary[w] for w in words], np.int64) for words in cut]
        self.telling = np.array([w in license_texts.TELLING or is_number(w) for w in sorted(self.vocabulary)], bool)
        hashed = [hashes(words) for words in cut]
        places = [winnowed(h) for h in hashed]
        h = np.concatenate([np.empty(0, np.uint64), *(x[p] for x, p in zip(hashed, places, strict=True))])
        #: Hashes of templates of GRAM words, whose only run of words winnowing can pass over in a text.
        self.tiny = np.unique(np.concatenate([np.empty(0, np.uint64), *(x for x in hashed if len(x) == 1)]))
        order = np.argsort(h, kind="stable")
        self.known, self.first = np.unique(h[order], return_index=True)
        self.first = np.append(self.first, len(h))
        self.template = np.repeat(np.arange(len(cut)), [len(p) for p in places])[order]
        self.place = np.concatenate([np.empty(0, np.int64), *places]).astype(np.int64)[order]
        sizes = np.array([len(w) for w in cut], np.int64)
        self.band = np.array([band_of(n) for n in sizes], np.int64)
        self.need = np.where(sizes <= SHORT, 1, np.ceil([SUPPORT * len(p) for p in places])).astype(np.int64)

    def candidates(self, h: np.ndarray) -> list[tuple[int, int]]:
        """(template, diagonal) where enough fingerprints meet: each diagonal of a notice, one for each band of a longer template."""
        prints = winnowed(h)
        if len(self.tiny):
            tiny = np.flatnonzero(self.tiny[np.minimum(np.searchsorted(self.tiny, h), len(self.tiny) - 1)] == h)
            if len(tiny):
                prints = np.union1d(prints, tiny)
        at = np.minimum(np.searchsorted(self.known, h[prints]), len(self.known) - 1)
        good = self.known[at] == h[prints]
        prints, at = prints[good], at[good]
        if not len(prints):
            return []
        times = self.first[at + 1] - self.first[at]
        posting = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(self.first[at], times)
        template, diagonal = self.template[posting], np.repeat(prints, times) - self.place[posting]
        order = np.lexsort((diagonal, template))
        template, diagonal = template[order], diagonal[order]
        out: list[tuple[int, int]] = []
        starts = np.flatnonzero(np.concatenate([[True], template[1:] != template[:-1]]))
        for lo, hi in zip(starts, [*starts[1:], len(template)], strict=True):
            k, d = int(template[lo]), diagonal[lo:hi]
            if hi - lo < self.need[k]:
                continue
            band = int(self.band[k])
            if len(self.words[k]) <= SHORT:
                out += [(k, x) for x in np.unique(d).tolist()]
                continue
            count = np.searchsorted(d, d + band, side="right") - np.searchsorted(d, d - band)
            last = None
            for x in d[count >= self.need[k]].tolist():
                if last is None or x > last + band:
                    last = x
                    out.append((k, x))
        return out

    def scan(self, text: str | None) -> list[Match]:
        """Matches of a whole text, of which no two overlap: of those that do, the one with more words in common stays."""
        if not text or not len(self.known):
            return []
        words, spans = tokens(text)
        chosen = self.candidates(hashes(words))
        if not chosen:
            return []
        ids = np.fromiter((self.vocabulary[w] if w in self.vocabulary else -2 - is_number(w) for w in words), np.int64, len(words))
        matches = set()
        for k, diagonal in chosen:
            n, first, last = self.match(k, ids, diagonal)
            if n:
                matches.add((-n * n / len(self.words[k]), spans[first][0], k, n, spans[last][1]))
        kept: list[Match] = []
        starts: list[int] = []  # of the matches kept, which are disjoint
        ends: list[int] = []
        for _, start, k, n, end in sorted(matches):
            at = bisect_left(starts, start)
            if (at == 0 or ends[at - 1] <= start) and (at == len(starts) or starts[at] >= end):
                starts.insert(at, start), ends.insert(at, end)
                kept.insert(at, Match(self.names[k], k, n / len(self.words[k]), n, start, end))
        return kept

    def match(self, k: int, ids: np.ndarray, diagonal: int) -> tuple[int, int, int]:
        """Words in common, first and last place of a match with template k near a diagonal; 0 words if too few are in common."""
        want = self.words[k]
        short = len(want) <= SHORT
        band = int(self.band[k]) * (1 if short else 2)
        low = max(diagonal - band, 0)
        window = ids[low : max(diagonal + band + len(want), 0)]
        least = max(GRAM, COVERAGE * len(want))
        if not short:
            both = np.minimum(np.bincount(window[window >= 0], minlength=len(self.vocabulary)), np.bincount(want, minlength=len(self.vocabulary)))
            if both.sum() < least:  # no alignment can have more
                return 0, 0, 0
            n, first, last = aligned(want, window, diagonal - low, band)
            return (n, first + low, last + low) if n >= least else (0, 0, 0)
        key = (k, diagonal - low, window.tobytes())
        if key not in self.cache:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            found = np.isin(want, window)
            n, first, last = aligned(want, window, diagonal - low, band) if found.sum() >= least and found[self.telling[want]].all() else (0, 0, 0)
            self.cache[key] = (n, first, last) if n >= least and self.agree(want, window[first : last + 1]) else (0, 0, 0)
        n, first, last = self.cache[key]
        return n, first + low, last + low

    def agree(self, template: np.ndarray, words: np.ndarray) -> bool:
        """Whether names, variants and numbers are the same in both, in order; a number that no template has agrees with none."""
        own = words[(words == -3) | ((words >= 0) & self.telling[np.maximum(words, 0)])]
        return np.array_equal(own, template[self.telling[template]])


def scan(documents: DataFrame, templates: tuple[tuple[str, str], ...] | None = None) -> DataFrame:
    """One row a match: doc_id, license, template, coverage, n_words, start, end (code points of the text) and the matched text.

    Templates are those of license_texts if none are given: notices, and whole license texts, whose coverage tells how
    much of the license a text holds. Null and empty texts have none. Rows that repeat or have no doc_id are scanned each by its own text;
    other columns don't matter.
    """
    held = documents.sparkSession.sparkContext.broadcast(Scanner(templates))  # a fixed number of license texts

    def find(batch: dict) -> dict:
        out: dict[str, list] = {n: [] for n in ("doc_id", "license", "template", "coverage", "n_words", "start", "end", "matched")}
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            for m in held.value.scan(text):
                for n, v in zip(out, (doc_id, m.license, m.template, m.coverage, m.matched, m.start, m.end, text[m.start : m.end]), strict=True):
                    out[n].append(v)
        return out

    return map_batches(documents.select("doc_id", "text"), find, "doc_id long, license string, template int, coverage double, n_words long, start long, end long, matched string")
