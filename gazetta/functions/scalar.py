"""Scalar expressions: codes, levels, names, durations, retry rules. All are plain columns and stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators of a keyword list, level names by the first characters of a level text, retryable error texts.
SEPARATORS = (" ", "\n", "\t", ",", "，", "、", ";", "；")
LEVEL_PREFIXES = (("省", "province"), ("市", "city"), ("县", "district"), ("乡", "town"), ("镇", "town"), ("街道", "town"))
RETRY_TEXTS = ("超时", "连接错误")
TRUTHY = ("1", "true", "yes", "on")
#: Characters that Python's str.strip() drops in plain texts; trim() alone drops spaces only.
_BLANK = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{3000}]+"


def strip(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, f"^{_BLANK}", ""), f"{_BLANK}$", "")


def empty_to_null(text: Column) -> Column:
    return F.nullif(text.cast("string"), F.lit(""))


def distinct_chars(text: Column) -> Column:
    """Characters of a text in the order of their first occurrence, without separators; [] for null."""
    chars = F.filter(F.split(F.coalesce(text, F.lit("")), ""), lambda c: ~c.isin(*SEPARATORS) & (c != ""))
    return F.array_distinct(chars)


def level_from_length(code: Column) -> Column:
    n = F.length(code)
    return F.when(n <= 2, "province").when(n <= 4, "city").when(n <= 6, "district").when(n.isNotNull(), "town")


def level_from_text(text: Column) -> Column:
    plain, out = strip(F.coalesce(text, F.lit(""))), F.lit("unknown")
    for prefix, level in reversed(LEVEL_PREFIXES):
        out = F.when(plain.startswith(prefix), level).otherwise(out)
    return out


def url_code(href: Column) -> Column:
    """The nine digits before a final .html, else an empty text."""
    return F.regexp_extract(F.coalesce(href, F.lit("")), r"([0-9]{9})\.html$", 1)


def padded_code(code: Column) -> Column:
    """Codes of 6 or 9 digits padded to 12; any other text only stripped."""
    plain = strip(F.coalesce(code, F.lit("")))
    return F.when(plain.rlike("^[0-9]{6}$"), F.concat(plain, F.lit("000000"))).when(plain.rlike("^[0-9]{9}$"), F.concat(plain, F.lit("000"))).otherwise(plain)


def short_code(code: Column) -> Column:
    """The first 6 characters of a 12-character code that ends in six zeros, else the first 9."""
    return F.when((F.length(code) == 12) & code.endswith("000000"), F.substring(code, 1, 6)).otherwise(F.substring(code, 1, 9))


def run_id(ts: Column, local: bool = False) -> Column:
    return F.concat(F.lit("run_"), F.date_format(ts, "yyyyMMdd_HHmmss")) if local else F.date_format(ts, "yyyyMMddHHmmss")


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def duration_text(seconds: Column) -> Column:
    """1h02m03s, 2m03s or 3s; negative times count as 0."""
    s = F.greatest(F.lit(0), F.floor(F.greatest(F.lit(0.0), seconds.cast("double")))).cast("long")
    h, m, rest = F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return (
        F.when(h > 0, F.concat(h.cast("string"), F.lit("h"), two(m), F.lit("m"), two(rest), F.lit("s")))
        .when(m > 0, F.concat(m.cast("string"), F.lit("m"), two(rest), F.lit("s")))
        .otherwise(F.concat(rest.cast("string"), F.lit("s")))
    )


def progress_name(chars: Column, mode: Column, provinces: Column) -> Column:
    """File name of a progress table: the keyword characters, or their MD5 beyond 32, the match mode and the province codes."""
    safe = F.array_join(F.filter(F.split(chars, ""), lambda c: ~c.isin(*SEPARATORS)), "")
    safe = F.when(F.length(safe) > 32, F.md5(safe)).otherwise(safe)
    suffix = F.when(F.coalesce(F.size(provinces), F.lit(0)) == 0, "all").otherwise(F.array_join(provinces, "-"))
    return F.concat(F.lit("places_"), safe, F.lit("_"), mode, F.lit("_"), suffix, F.lit(".progress.json"))


def task_slug(stem: Column, fallback: Column) -> Column:
    """A file-safe task name: other characters than letters, digits, - and _ become -; a hash of `fallback` where nothing is left."""
    safe = F.regexp_replace(F.regexp_replace(strip(stem), r"[^\p{L}\p{N}_-]", "-"), "^[-_]+|[-_]+$", "")
    return F.when(safe != "", safe).otherwise(F.concat(F.lit("task-"), F.abs(F.xxhash64(fallback)).cast("string")))


def split_list(text: Column) -> Column:
    """Comma-separated items, stripped, without empty ones."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), strip), lambda x: x != "")


def truthy(text: Column) -> Column:
    return F.coalesce(F.lower(strip(text)).isin(*TRUTHY), F.lit(False))


def backoff(attempt: Column, status: Column, base: float = 1.0, most: float = 60.0, jitter_seed: int | None = None) -> Column:
    """Seconds to wait before a retry: exponential for 429, 403 and 5xx, linear otherwise, capped; with a seed plus up to 30 % at random."""
    power = lambda k: F.pow(F.lit(2.0), k)
    delay = (
        F.when(status == 429, 5.0 * power(attempt - 1)).when(status == 403, 30.0 * power(attempt - 1)).when(status >= 500, base * power(attempt)).otherwise(base * attempt.cast("double"))
    )
    delay = F.least(delay, F.lit(most))
    return delay if jitter_seed is None else delay * (1 + 0.3 * F.rand(jitter_seed))


def should_retry(status: Column, error: Column) -> Column:
    by_status = F.coalesce((status == 429) | (status == 403) | (status >= 500), F.lit(False))
    by_text = F.lit(False)
    for text in RETRY_TEXTS:
        by_text = by_text | F.coalesce(error.contains(text), F.lit(False))
    return by_status | by_text


def jitter(base: Column, low: float, high: float, seed: int = 0) -> Column:
    return base if high <= 0 else base + low + F.rand(seed) * max(0.0, high - low)


def search_type(mode: Column) -> Column:
    """The server's name of a match mode; null for an unknown mode."""
    return F.when(mode == "contain", "模糊").when(mode == "exact", "精确")


def name_matches(name: Column, keyword: Column, mode: str) -> Column:
    if mode not in ("contain", "exact"):
        raise ValueError(f"unknown match mode: {mode}")
    return F.contains(name, keyword) if mode == "contain" else name == keyword


def known_level(column: Column, levels: Sequence[str] = ("province", "city", "district", "town")) -> Column:
    return column.isin(*levels)
