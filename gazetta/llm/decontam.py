"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Benchmark items and documents are normalised (lower case, every run of other characters than letters
and digits one space). Items are cut into short overlapping units, one from every word start, and into
longer segments, in which edits may lie closer together. Of an item's q-grams every STEP-th is kept, so an edit destroys at most Q / STEP of them: a passage within k
edits of a unit shares all but k * Q / STEP of the unit's, on diagonals at most k apart. Shared q-grams
are counted in overlapping diagonal bands of twice that width, first for whole items, then for the units
of items that have enough; bands that meet the bound are verified by banded alignment. Items too short
for that are looked up whole, by hash, at every word start.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.llm.common import map_batches, map_parts, written

Q, STEP = 8, 4
WORDS, UNIT = 12, 80  #: a unit ends after so many words, or so many normalised characters if that comes first
SEGMENT = 160  #: characters of the longer units, one every half of it
STRIDE = 8  #: characters of a longer word after which another unit starts
WIDE = 3  #: characters that a character of a script without spaces counts for
BUDGET = 0.08  #: edits a character of a unit
LEAST = 40  #: items with fewer normalised characters match only as they are, as whole words
BLOCK_CHARS = 4_000_000  #: of the benchmark in one pass over the documents; larger benchmarks take more passes
WINDOW, OVERLAP = 100_000, 1_000  #: characters of a text whose q-grams are looked up at once, and by how much such windows overlap

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BREAK = np.uint32(1)  #: stands between documents
_ONE = 4096  #: an edit in alignment values, which also carry the start of the match
_FAR = _ONE * _ONE  #: more than any edits

_lowered: np.ndarray | None = None


def lowered() -> np.ndarray:
    """For each code point of the first plane its lower case, or a space for what is neither letter nor digit."""
    global _lowered
    if _lowered is None:
        out = np.full(0x10000, 32, np.uint32)
        for c in range(0x10000):
            x = chr(c)
            if x.isalnum():
                low = x.lower()
                out[c] = ord(low) if len(low) == 1 else c
        _lowered = out
    return _lowered


def normalised(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised code points of an array of code points (_BREAK stays), and the place in raw of each."""
    flat = lowered()[np.minimum(raw, 0xFFFF)]
    flat = np.where(raw > 0xFFFF, raw, flat)
    flat[raw == _BREAK] = _BREAK
    space = flat == 32
    keep = np.ones(len(flat), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    place = np.flatnonzero(keep)
    return flat[place], place


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(code: np.ndarray) -> np.ndarray:
    n = max(len(code) - Q + 1, 0)
    wide = code.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    wide ^= wide >> np.uint64(29)
    h = np.zeros(n, np.uint64)
    for k in range(Q):
        h *= _BASE
        h += wide[k : k + n]
    return h ^ (h >> np.uint64(31))


def units(code: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the units of an item, by start: WORDS words and LEAST characters, or UNIT characters, and segments; a shorter item is one unit."""
    n, space = len(code), code == 32
    total = np.concatenate([[0], np.cumsum(np.where(wide(code), WIDE, 1))])
    begins = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    ends = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    word = np.searchsorted(begins, np.arange(n), side="right") - 1
    step = (total[:-1] - total[begins[word]]) // STRIDE
    first = np.zeros(n, bool)
    first[begins] = True
    starts = np.flatnonzero(~space & (first | (np.diff(step, prepend=0) != 0)))
    by_words = np.maximum(word[starts] + WORDS - 1, np.searchsorted(total[ends], total[starts] + LEAST))
    by_words = np.where(by_words < len(ends), ends[np.minimum(by_words, len(ends) - 1)], n + 1)
    end = np.minimum(by_words, np.searchsorted(total, total[starts] + UNIT))
    out = [(int(a), int(b)) for a, b in zip(starts, end, strict=True) if b <= n]
    if out and out[-1][1] < n:
        out.append((out[-1][0], n))
    last = max(n - SEGMENT, 0)
    return sorted({*out, *((a, min(a + SEGMENT, n)) for a in (*range(0, last, SEGMENT // 2), last))})


class Index(NamedTuple):
    item: np.ndarray  #: item_id of each unit
    flat: np.ndarray  #: code points of all items
    start: np.ndarray  #: of each unit in flat, rising
    size: np.ndarray
    edits: np.ndarray  #: budget
    least: np.ndarray  #: shared q-grams that a band must have
    hashes: np.ndarray  #: distinct q-gram hashes, sorted
    first: np.ndarray  #: postings of hash k are first[k]:first[k + 1]
    place: np.ndarray  #: in flat, of each posting
    owner: np.ndarray  #: number of each posting's item
    low: np.ndarray  #: units low:high may hold a posting
    high: np.ndarray
    seen: np.ndarray  #: bitmap of the hashes
    short: dict[int, tuple[np.ndarray, dict[bytes, list[int]]]]  #: by length, the sorted hashes of items under LEAST, and their ids by code points

    @property
    def code(self) -> list[np.ndarray]:
        """Code points of each unit."""
        return [self.flat[a : a + n] for a, n in zip(self.start, self.size, strict=True)]


def wide(code: np.ndarray) -> np.ndarray:
    """Whether a character is of a script without spaces."""
    return (code >= 0x2E80) & (code < 0xE000)


def run_hashes(code: np.ndarray, at: np.ndarray, sizes: list[int]) -> Iterator[np.ndarray]:
    """For each size, the hash of code[a : a + size] of every a in `at` (which must not reach beyond the end)."""
    back = np.cumprod(np.full(len(code) + 1, np.uint64(pow(int(_BASE), -1, 1 << 64)))) * _BASE
    forth = np.cumprod(np.full(len(code) + 1, _BASE)) * np.uint64(pow(int(_BASE), -1, 1 << 64))
    mixed = (code.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * back[:-1], dtype=np.uint64)])
    for n in sizes:
        a = at[at + n <= len(code)]
        h = (total[a + n] - total[a]) * forth[a]
        yield h ^ (h >> np.uint64(31))


def whole(index: Index, code: np.ndarray) -> list[tuple[int, int, int]]:
    """(item, start, end) of the short items that stand in a text as they are; scripts without spaces need no word ends."""
    if not index.short:
        return []
    edge = (code == 32) | (code == _BREAK) | wide(code)
    free = np.concatenate([[True], edge]) | np.concatenate([edge, [True]])  # a word may start or end before this place
    letter = (code != 32) & (code != _BREAK)
    at = np.flatnonzero(free[:-1] & letter)
    out = []
    for (n, (known, ids)), h in zip(index.short.items(), run_hashes(code, at, list(index.short)), strict=True):
        a = at[: len(h)]
        hit = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
        for start in a[hit & free[a + n]].tolist():
            out += [(item, start, start + n) for item in ids.get(code[start : start + n].astype(np.uint32).tobytes(), ())]
    return out


def build(items: list[tuple[int, str | None]]) -> Index | None:
    brief: dict[int, dict[bytes, list[int]]] = {}
    codes, owner, start, end = [], [], [], []
    total = 0
    for item, text in items:
        code = normalised(points(text.replace(chr(_BREAK), " ")))[0] if text else np.empty(0, np.uint32)
        while len(code) and code[0] == 32:
            code = code[1:]
        while len(code) and code[-1] == 32:
            code = code[:-1]
        if item is None or not len(code):
            continue
        if len(code) < LEAST:
            brief.setdefault(len(code), {}).setdefault(code.astype(np.uint32).tobytes(), []).append(item)
            continue
        seen: set[bytes] = set()
        for a, b in units(code):  # of units that read alike in an item, one is enough
            if (own := code[a:b].tobytes()) not in seen:
                seen.add(own)
                owner.append(item), start.append(total + a), end.append(total + b)
        codes.append(code)
        total += len(code)
    short = {}
    for n, ids in sorted(brief.items()):
        flat = np.frombuffer(b"".join(ids), np.uint32)
        short[n] = np.sort(next(run_hashes(flat, np.arange(0, len(flat), n), [n]))), ids
    if not codes and not short:
        return None
    start, end = np.array(start, np.int64), np.array(end, np.int64)
    bounds = np.cumsum([0] + [len(c) for c in codes])
    place = np.concatenate([np.empty(0, np.int64)] + [np.arange(a, b - Q + 1, STEP) for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
    flat = np.concatenate([np.empty(0, np.uint32), *codes])
    open_units = np.cumsum(np.bincount(start, minlength=total + 1) - np.bincount(end - Q + 1, minlength=total + 1))
    place = place[open_units[place] > 0]  # q-grams of some unit
    h = grams(flat)[place]
    kept = np.searchsorted(place, end - Q, side="right") - np.searchsorted(place, start)  # no unit reaches beyond its item
    edits = np.minimum(((end - start) * BUDGET).astype(np.int64), (kept - 1) // (Q // STEP))
    order = np.argsort(h, kind="stable")
    distinct, first = np.unique(h[order], return_index=True)
    seen = np.zeros(1 << 22, bool)
    seen[(distinct >> np.uint64(42)).astype(np.int64)] = True
    place = place[order]
    number = np.searchsorted(bounds, place, side="right") - 1
    low, high = np.searchsorted(np.maximum.accumulate(end), place + Q), np.searchsorted(start, place, side="right")
    return Index(np.array(owner, np.int64), flat, start, end - start, edits, kept - edits * (Q // STEP), distinct, np.append(first, len(h)), place, number, low, high, seen, short)


def repeated(times: np.ndarray, first: np.ndarray) -> np.ndarray:
    """first[k], first[k] + 1, ... of every k, times[k] of them."""
    ends = np.cumsum(times)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - times, times) + np.repeat(first, times)


def regions(index: Index, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, first diagonal, diagonal of one shared q-gram) of the bands of a text that share enough q-grams; a diagonal is the place of the unit's start in the text."""
    if not len(index.hashes):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    h = grams(code)
    at = np.flatnonzero(index.seen[(h >> np.uint64(42)).astype(np.int64)])
    k = np.minimum(np.searchsorted(index.hashes, h[at]), len(index.hashes) - 1)
    good = index.hashes[k] == h[at]
    at, k = at[good], k[good]
    times = index.first[k + 1] - index.first[k]
    post, at = repeated(times, index.first[k]), np.repeat(at, times)

    # items with enough in bands as wide as any unit's
    shift = len(index.flat)  # diagonals before the text count too
    span = len(code) + shift + 2
    band = (at - index.place[post] + shift) // (int(index.edits.max()) + 1)
    key = index.owner[post] * span + band
    keys, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    after = np.minimum(np.searchsorted(keys, keys + 1), max(len(keys) - 1, 0))
    both = count + np.where(keys[after] == keys + 1, count[after], 0)  # this band and the next
    before = np.maximum(np.searchsorted(keys, keys - 1), 0)
    both = np.maximum(both, np.where(keys[before] == keys - 1, both[before], 0))
    enough = both[inverse] >= int(index.least.min())
    post, at = post[enough], at[enough]

    # their units
    times = np.maximum(index.high[post] - index.low[post], 0)
    unit, post, at = repeated(times, index.low[post]), np.repeat(post, times), np.repeat(at, times)
    within = (index.start[unit] <= index.place[post]) & (index.place[post] + Q <= index.start[unit] + index.size[unit])
    unit, post, at = unit[within], post[within], at[within]
    most = int(index.size.max())
    span = len(code) + 2 * most
    diagonal = at - (index.place[post] - index.start[unit])
    band = (diagonal + most) // (index.edits[unit] + 1)
    key, one, count = np.unique(np.concatenate([unit * span + band, unit * span + np.maximum(band - 1, 0)]), return_index=True, return_counts=True)
    unit, band = key // span, key % span
    enough = count >= index.least[unit]
    unit, band, one = unit[enough], band[enough], one[enough]
    return unit, band * (index.edits[unit] + 1) - most, diagonal[one % max(len(diagonal), 1)]


def windowed(index: Index, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As regions, by windows of the text that overlap by more than a unit, so that a very long or repetitive text needs bounded memory."""
    got = [(lo, regions(index, code[lo : lo + WINDOW + OVERLAP])) for lo in range(0, max(len(code), 1), WINDOW)]
    unit, diagonal, likely = (np.concatenate([g[k] + (lo if k else 0) for lo, g in got]) for k in range(3))
    _, one = np.unique(np.stack([unit, diagonal, likely], axis=1), axis=0, return_index=True)
    return unit[one], diagonal[one], likely[one]


def verbatim(index: Index, code: np.ndarray, segment: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether each unit stands in the text at its place without an edit."""
    size, good = index.size[segment], (place >= 0) & (place + index.size[segment] <= len(code))
    n = np.arange(int(size.max()))[None, :]
    same = code[np.clip(place[:, None] + n, 0, len(code) - 1)] == index.flat[np.minimum(index.start[segment][:, None] + n, len(index.flat) - 1)]
    return good & (same | (n >= size[:, None])).all(axis=1)


def align(index: Index, code: np.ndarray, segment: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fewest edits, start and end in the text of each unit within its band, all regions side by side."""
    most = int(index.edits[segment].max())
    width = 4 * most + 3  # diagonals of the band and `most` on either side
    low = diagonal - most
    column = low[:, None] + np.arange(width)[None, :]
    value = np.broadcast_to(np.arange(width, dtype=np.int64), column.shape).copy()  # no edits; starts anywhere
    value[(column < 0) | (column > len(code))] = _FAR
    ramp = np.arange(width, dtype=np.int64) * _ONE
    padded = np.concatenate([code, np.zeros(1, code.dtype)])
    final = np.zeros_like(value)
    for i in range(int(index.size[segment].max())):
        here = column + i
        letter = padded[np.where((here < 0) | (here >= len(code)), len(code), here)]
        broken = letter == _BREAK  # no alignment passes from one text to the next
        past = ramp + np.cumsum(broken, axis=1) * _FAR  # from a lower diagonal to this one the letters between are passed
        step = value + np.where(broken, _FAR, 0) + np.where(letter == index.flat[np.minimum(index.start[segment] + i, len(index.flat) - 1)][:, None], 0, _ONE)
        step[:, :-1] = np.minimum(step[:, :-1], value[:, 1:] + _ONE)
        value = np.minimum.accumulate(step - past, axis=1) + past
        ends = index.size[segment] == i + 1
        final[ends] = value[ends]
    best = final.argmin(axis=1)
    rows = np.arange(len(segment))
    edits, start = final[rows, best] // _ONE, final[rows, best] % _ONE
    return edits, low + start, low + best + index.size[segment]


def matches(index: Index, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
    """(row, item, start, end, edits) of the passages found in a list of texts: units that overlap are one passage, with their least edits; places are code points of the text."""
    sizes = np.array([len(t) + 1 if t else 1 for t in texts])
    raw = points(chr(_BREAK).join((t or "").replace(chr(_BREAK), " ") for t in texts) + chr(_BREAK))
    code, place = normalised(raw)
    segment, diagonal, likely = windowed(index, code)
    order = np.argsort(index.size[segment], kind="stable")  # units of about one size are aligned together
    segment, diagonal, likely = segment[order], diagonal[order], likely[order]
    begin = np.cumsum(sizes) - sizes
    out = []
    for item, start, end in whole(index, code):
        row = int(np.searchsorted(begin, place[start], side="right")) - 1
        out.append((row, item, int(place[start] - begin[row]), int(place[end - 1] + 1 - begin[row]), 0))
    for k in range(0, len(segment), 2000):
        s, d = segment[k : k + 2000], diagonal[k : k + 2000]
        start = likely[k : k + 2000]
        edits, end, other = np.zeros(len(s), np.int64), start + index.size[s], ~verbatim(index, code, s, start)
        if other.any():
            edits[other], start[other], end[other] = align(index, code, s[other], d[other])
        good = (edits <= index.edits[s]) & (end > start)
        a, b = place[start[good]], place[end[good] - 1] + 1
        row = np.searchsorted(begin, a, side="right") - 1
        out += zip(row.tolist(), index.item[s[good]].tolist(), (a - begin[row]).tolist(), (b - begin[row]).tolist(), edits[good].tolist(), strict=True)
    passages: list[tuple[int, int, int, int, int]] = []
    for row, item, a, b, edits in sorted(set(out)):
        if passages and passages[-1][:2] == (row, item) and a < passages[-1][3]:
            _, _, first, last, fewest = passages.pop()
            a, b, edits = first, max(b, last), min(edits, fewest)
        passages.append((row, item, a, b, edits))
    return passages


def blocks(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of the benchmark, each of about BLOCK_CHARS characters at most, one at a time; the items come to the driver one partition at a time."""
    items: list[tuple[int, str | None]] = []
    total = 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        if items and total + len(row[1] or "") > BLOCK_CHARS:
            if index := build(items):
                yield index
            items, total = [], 0
        items.append((row[0], row[1]))
        total += len(row[1] or "")
    if index := build(items):
        yield index


def passes(benchmark: DataFrame, step: Callable[[Broadcast, bool], None]) -> None:
    """Calls step(index, last) for each block of the benchmark. A block's index is released before the next is built, so step must not leave lazy rows that need it, but for the last."""
    held = None
    for index in blocks(benchmark):
        if held is not None:
            step(held, False)
            held.unpersist()
        held = benchmark.sparkSession.sparkContext.broadcast(index)  # bounded by BLOCK_CHARS
    if held is not None:
        step(held, True)


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item found in it: doc_id, item_id, start, end, edits, n_segments.

    start and end are code points of the text around all passages found, edits the least number in a unit
    of one, n_segments the number of passages. Null
    and empty texts match nothing, nor do items without an id, letter or digit; items shorter than LEAST
    normalised characters match as whole words without an edit; an empty benchmark gives no rows. Rows with equal doc_id (or null) are searched each on their own
    and reported together. A benchmark of several blocks takes a pass over the documents for each, all but the last written. Other columns don't matter.
    """
    schema = "doc_id long, item_id long, start long, end long, edits long"
    found = [documents.sparkSession.createDataFrame([], schema)]

    def step(held: Broadcast, last: bool) -> None:
        def search(batch: dict) -> dict:
            got = matches(held.value, batch["text"])
            return {"doc_id": [batch["doc_id"][m[0]] for m in got]} | {n: [m[k] for m in got] for k, n in enumerate(("item_id", "start", "end", "edits"), 1)}

        part = map_batches(documents.select("doc_id", "text"), search, schema)
        found.append(part if last else written(part, "leaks"))

    passes(benchmark, step)
    rows = reduce(DataFrame.union, found[1:] or found)
    return rows.groupBy("doc_id", "item_id").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("edits").alias("edits"), F.count_distinct("start").alias("n_segments"))


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item is found, whole, without a join; after each block of the benchmark but the last they are written and read again."""
    kept = [documents]

    def step(held: Broadcast, last: bool) -> None:
        def good(part: pa.RecordBatch) -> pa.Array:
            out = np.ones(part.num_rows, bool)
            out[[m[0] for m in matches(held.value, part.column(part.schema.get_field_index("text")).to_pylist())]] = False
            return pa.array(out)

        rows = map_parts(kept[0], good)
        kept[0] = rows if last else written(rows, "clean")

    passes(benchmark, step)
    return kept[0]
