"""Paged searches, division children and detail lookups, replayed from recorded answers or fetched by a given function.

A transport is a picklable function; network access, proxies and user agents are its own matter.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta import schemas
from gazetta.functions import scalar, variant


def search_places(spark: SparkSession, path: str, requests: list[dict]) -> DataFrame:
    """Records (keyword, partition_code, page, total, raw) for requests (keyword, code, pages) from files of recorded answers {keyword, code, page, payload}.

    Files are read once for all requests, and a payload may be an object or the text of one.
    """
    answers = spark.read.schema("keyword string, code string, page long, payload string").json(path)
    rows = [(r["keyword"], r["code"], int(p)) for r in requests for p in r["pages"]]
    wanted = spark.createDataFrame(rows, "keyword string, code string, page long").distinct()
    found = search_answers(answers.join(wanted, ["keyword", "code", "page"], "left_semi"))
    return found.withColumnRenamed("code", "partition_code")


def divisions(answers: DataFrame, now: Any, source: str = "places") -> DataFrame:
    """Divisions of recorded answers (code, payload): rows without a code are dropped, the parent defaults to the code asked for, the level to the code's length."""
    rows = answers.select(F.col("code").alias("_asked"), F.explode(variant.rows_of(variant.parsed(F.col("payload")))).alias("v"))
    text = lambda name: F.coalesce(F.try_variant_get("v", f"$.{name}", "string"), F.lit(""))
    code = text("code")
    return rows.where(code != "").select(
        code.alias("code"), text("name").alias("name"), F.coalesce(scalar.empty_to_null(text("parentCode")), "_asked").alias("parent_code"),
        F.coalesce(scalar.empty_to_null(text("level")), scalar.level_from_length(code)).alias("level"), F.lit(source).alias("source_name"), now.alias("captured_at"), now.alias("updated_at"),
    )


def search_answers(answers: DataFrame) -> DataFrame:
    """(keyword, code, page, total, raw) of recorded answers (keyword, code, page, payload), JSON throughout in the JVM."""
    v = variant.parsed(F.col("payload"))
    rows = answers.withColumn("_v", v).select("keyword", "code", "page", variant.total_of(F.col("_v"), F.lit(0).cast("long")).alias("total"), F.explode(variant.records_of(F.col("_v"))).alias("_r"))
    return rows.select("keyword", "code", "page", "total", variant.canonical(F.col("_r")).alias("raw"))


def fetch_answers(requests: DataFrame, fetch: Callable[[str, str, int], tuple[int, str]], qps: float = 0.0, attempts: int = 3, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Answers (keyword, code, page, status, payload, error) to requests (keyword, code, page); fetch returns (status, body) or raises.

    Each request is tried up to `attempts` times where its status or fault is worth it; one that fails gives a
    row with an error and no payload. qps bounds the calls of each partition.
    """
    schema = pa.schema([("keyword", pa.string()), ("code", pa.string()), ("page", pa.int64()), ("status", pa.int32()), ("payload", pa.string()), ("error", pa.string())])

    def one(keyword: str, code: str, page: int) -> tuple[int | None, str | None, str | None]:
        try:
            status, body = fetch(keyword, code, page)
        except TimeoutError:
            return None, None, "请求超时"
        except ConnectionError as e:
            return None, None, f"连接错误: {e}"
        except Exception as e:
            return None, None, f"{type(e).__name__}: {e}"
        return (status, body, None) if status == 200 else (status, None, f"HTTP {status}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from gazetta.streaming.control import TokenBucket

        bucket = TokenBucket(qps) if qps > 0 else None
        for batch in batches:
            rows = []
            for request in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for attempt in range(1, attempts + 1):
                    if bucket:
                        bucket.acquire()
                    status, body, error = one(*request)
                    again = status in (403, 429) or (status or 0) >= 500 or any(x in (error or "") for x in scalar.RETRY_TEXTS)
                    if error is None or not again or attempt == attempts:
                        break
                    sleep(wait_before(attempt, status))
                rows.append((*request, status, body, error))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], type=f.type) for k, f in enumerate(schema)], schema=schema)

    return requests.select("keyword", "code", F.col("page").cast("long").alias("page")).mapInArrow(run, "keyword string, code string, page long, status int, payload string, error string")


def wait_before(attempt: int, status: int | None, base: float = 1.0, most: float = 60.0) -> float:
    """Seconds before the next try, as scalar.backoff without jitter."""
    known = {429: 5.0 * 2 ** (attempt - 1), 403: 30.0 * 2 ** (attempt - 1)}
    return min(most, known.get(status, base * 2**attempt if (status or 0) >= 500 else base * attempt))


def fetch_details(ids: DataFrame, fetch: Callable[[str], tuple[int, str]], qps: float = 0.0, attempts: int = 1, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """FetchResult rows for ids: fetch returns (status, body) or raises. No fault of it fails the job; all are folded into the row.

    An id is tried up to `attempts` times where scalar.should_retry holds, with a pause before each new try.
    qps bounds the calls of each partition; divide a global rate by the number of partitions.
    """
    names = [f.name for f in schemas.FETCH_RESULT]

    def one(key: str) -> tuple:
        start = time.monotonic()
        status, body = None, None
        try:
            status, body = fetch(key)
            if status != 200:
                return key, False, status, None, body, f"HTTP {status}", (time.monotonic() - start) * 1000
            data = json.loads(body)
            if not isinstance(data, dict):
                raise ValueError("no object")
            return key, True, status, json.dumps(data, ensure_ascii=False), body, None, (time.monotonic() - start) * 1000
        except TimeoutError:
            error = "请求超时"
        except ConnectionError as e:
            error = f"连接错误: {e}"
        except ValueError as e:
            error = f"JSON 解析失败: {e}"
        except Exception as e:
            error = f"{type(e).__name__}: {e}"
        return key, False, status, None, body, error, (time.monotonic() - start) * 1000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from gazetta.streaming.control import TokenBucket

        bucket = TokenBucket(qps) if qps > 0 else None
        for batch in batches:
            rows = []
            for key in batch.column(0).to_pylist():
                for attempt in range(1, attempts + 1):
                    if bucket:
                        bucket.acquire()
                    row = one(key)
                    again = row[2] in (403, 429) or (row[2] or 0) >= 500 or any(x in (row[5] or "") for x in scalar.RETRY_TEXTS)
                    if row[1] or not again or attempt == attempts:
                        break
                    sleep(wait_before(attempt, row[2]))
                rows.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], type=t) for k, t in enumerate((pa.string(), pa.bool_(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.float64()))], names=names)

    return ids.select("id").mapInArrow(run, schemas.FETCH_RESULT)


def fetch_pages(codes: DataFrame, fetch: Callable[[str], str | None], base_url: str) -> DataFrame:
    """(code, url, html) of division pages; a page that fails is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for code in batch.column(0).to_pylist():
                url = f"{base_url}/{code[:9]}.html"
                try:
                    html = fetch(url)
                except Exception:
                    html = None
                if html is not None:
                    out.append((code, url, html))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], type=pa.string()) for k in range(3)], names=["code", "url", "html"])

    return codes.select("code").mapInArrow(run, "code string, url string, html string")


def seed_codes(pages: DataFrame, seed: str) -> DataFrame:
    """Codes of the sibling table of the seed page; the seed alone if the page is missing or lists none."""
    from gazetta.functions.html import siblings_of_pages

    found = siblings_of_pages(pages, []).distinct()
    fallback = pages.sparkSession.createDataFrame([(seed,)], "code string")
    none = found.agg(F.count("*").alias("_n")).where("_n = 0")  # one row
    return found.unionByName(fallback.join(none).select("code"))
