"""URL filters: fixed host and path rules, and association rules mined by FP-growth from labelled pages."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import product
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from gazetta.llm.common import scratch

#: (verdict, host, path) of the production list.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
BAD = "=bad"  #: the item that a labelled bad page carries besides its tokens
Z = 1.96  #: standard deviations of the interval in which a rule's confidence lies
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    tokens: frozenset[str]
    confidence: float
    support: float
    same: tuple[frozenset[str], ...] = ()  #: for each token those that were on the same labelled pages; each of them will do

    @property
    def parts(self) -> tuple[frozenset[str], ...]:
        return self.same or tuple(frozenset({t}) for t in sorted(self.tokens))

    def combinations(self) -> set[frozenset[str]]:
        return {frozenset(x) for x in product(*self.parts)}


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def listed(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule whose host is the url's or a parent of it and whose path starts the url's, and its verdict; nulls without one."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in reversed(ordered):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a url, sorted: scheme, the host and each of its parents, each path part with digits folded, extension, each query key, fragment."""
    url = F.coalesce(url, F.lit(""))
    host, path = host_of(url), path_of(url)
    rest = F.regexp_extract(url, "://(.*)$", 1)
    labels = F.split(host, "[.]")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.concat(F.lit("h:"), F.array_join(F.slice(labels, k, F.size(labels)), ".")))
    parts = F.transform(F.split(F.regexp_replace(path, "[0-9]+", "#"), "/"), lambda x: F.concat(F.lit("p:"), x))
    keys = F.transform(F.split(F.regexp_extract(rest, "[?]([^#]+)", 1), "&"), lambda x: F.concat(F.lit("q:"), F.regexp_replace(x, "=.*", "")))
    ones = F.array(F.concat(F.lit("s:"), F.regexp_extract(url, "^([a-zA-Z]+)://", 1)), F.concat(F.lit("x:"), F.regexp_extract(path, "[.]([A-Za-z0-9]+)$", 1)), F.when(rest.contains("#"), "f:#").otherwise(""))
    return F.array_sort(F.array_distinct(F.filter(F.concat(hosts, parts, keys, ones), lambda x: F.length(x) > 2)))


def labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(tokens, bad) of the pages whose url ends with the number of a labelled document; bad: of low quality or toxic."""
    number = F.regexp_extract(path_of(F.col("url")), "([0-9]{1,18})[^0-9]*$", 1)
    keyed = pages.select(number.try_cast("long").alias("doc_id"), tokens_of(F.col("url")).alias("tokens")).where("doc_id is not null")
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    marks = labels.where("doc_id is not null and (quality is not null or toxic is not null)").groupBy("doc_id").agg(F.max(bad).alias("bad"))
    return keyed.join(marks, "doc_id").select("tokens", "bad")


def least_share(bad: float, all: float, z: float = Z) -> float:
    """Lower end of Wilson's interval for the share of bad pages among all that a rule fits."""
    p = bad / all
    return (p + z * z / (2 * all) - z * math.sqrt(p * (1 - p) / all + z * z / (4 * all * all))) / (1 + z * z / all)


def _sure(bad: Column, all: Column, confidence: float, z: float = Z) -> Column:
    """Whether least_share(bad, all) reaches the confidence."""
    p = bad / all
    return (p + z * z / (2 * all) - z * F.sqrt(p * (1 - p) / all + z * z / (4 * all * all))) / (1 + z * z / all) >= confidence


def merged(rows: DataFrame, need: int) -> DataFrame:
    """(token, stands): the tokens on `need` bad rows (row, tokens, bad) or more, and the least of those that are on the very same rows.

    Sets of rows are told apart by their sizes and 128 bits of hashes.
    """
    each = rows.select("row", "bad", F.explode("tokens").alias("token"))
    sets = each.groupBy("token").agg(F.count_if("bad").alias("k"), F.count("*").alias("n"), *[F.bit_xor(F.xxhash64("row", F.lit(s))).alias(f"x{s}") for s in (1, 2)]).where(F.col("k") >= need)
    same = Window.partitionBy("k", "n", "x1", "x2")
    return sets.select("token", F.min("token").over(same).alias("stands"))


def minimal(sure: DataFrame) -> list[Row]:
    """The rows (antecedent, ...) whose tokens hold no other row's: size by size, so that what larger ones repeat never reaches the driver."""
    spark, kept = sure.sparkSession, []
    for size in sorted(r.n for r in sure.select(F.size("antecedent").alias("n")).distinct().collect()):
        level = sure.where(F.size("antecedent") == size)
        if kept:
            known = spark.createDataFrame([(t, k, len(r.antecedent)) for k, r in enumerate(kept) for t in r.antecedent], "token string, rule int, parts int")
            held = level.select("antecedent", F.explode("antecedent").alias("token")).join(known, "token").groupBy("antecedent", "rule", "parts").count().where("count = parts")
            level = level.join(held.select("antecedent"), "antecedent", "left_anti")
        kept += level.collect()
    return kept


def mine(rows: DataFrame, support: float = 0.005, confidence: float = 0.6, least: int = 10) -> list[Rule]:
    """FP-growth on the labelled rows: combinations that make a page bad, without those that a smaller combination covers.

    A rule must be seen on `least` bad pages and on a share of `support` of all, and the lower end of the 95 % interval of
    its confidence must reach `confidence`, so that chance makes no rules. All tokens of all urls are mined. What bounds
    the work: only tokens on that many bad pages are, of which a page has tokens / support at most, and tokens that always
    occur together, as a host and its parents do, are mined as one and told apart again in the rule.
    """
    n, bad = rows.agg(F.count("*"), F.count_if("bad")).first()
    need = max(least, math.ceil(support * n - 1e-9))
    if bad < need:
        return []
    with scratch() as keep:
        keyed = keep(rows.select(F.monotonically_increasing_id().alias("row"), F.array_distinct("tokens").alias("tokens"), "bad"), "url-rows")
        stands = keep(merged(keyed, need), "url-tokens")
        each = keyed.select("row", F.explode("tokens").alias("token")).join(stands.where("token = stands").select("token"), "token")
        items = each.groupBy("row").agg(F.collect_set("token").alias("found")).join(keyed.select("row", "bad"), "row", "right")
        found = F.coalesce("found", F.array().cast("array<string>"))
        items = keep(items.select(F.when(F.col("bad"), F.concat(found, F.array(F.lit(BAD)))).otherwise(found).alias("items")), "url-items")
        rules = FPGrowth(itemsCol="items", minSupport=need / n * (1 - 1e-9), minConfidence=confidence).fit(items).associationRules
        k = F.round(F.col("support") * n)
        rules = rules.where((F.element_at("consequent", 1) == BAD) & (k >= need) & _sure(k, F.round(k / F.col("confidence")), confidence))
        kept = minimal(keep(rules.select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support"), "url-rules"))
        names = {t for r in kept for t in r.antecedent}
        same: dict[str, set[str]] = {}
        for r in stands.collect() if names else ():
            same.setdefault(r.stands, set()).add(r.token)
    return [Rule(frozenset(r.antecedent), r.confidence, r.support, tuple(frozenset(same[t]) for t in sorted(r.antecedent))) for r in sorted(kept, key=lambda r: (len(r.antecedent), r.antecedent))]


#: Index rows (a token of a rule) up to this many are broadcast.
FEW_TOKENS = 100_000


def matched(rows: DataFrame, mined: Sequence[Rule]) -> DataFrame:
    """rows (with tokens) and `hit`: whether they have a token of every part of some mined rule.

    The rules are a table of tokens, which the rows' tokens meet in a join; what a page's tokens hit is counted once for
    pages with the same tokens.
    """
    if not mined:
        return rows.withColumn("hit", F.lit(False))
    index = [(t, k, part, len(r.parts)) for k, r in enumerate(mined) for part, tokens in enumerate(r.parts) for t in sorted(tokens)]
    table = rows.sparkSession.createDataFrame(index, "token string, rule int, part int, parts int")
    keyed = rows.withColumn("_set", F.md5(F.to_json("tokens")))
    met = keyed.select("_set", F.explode("tokens").alias("token")).join(F.broadcast(table) if len(index) <= FEW_TOKENS else table, "token")
    met = met.select("_set", "rule", "part", "parts").distinct().groupBy("_set", "rule", "parts").count().where("count = parts")
    return keyed.join(met.select("_set", F.lit(True).alias("hit")).distinct(), "_set", "left").withColumn("hit", F.coalesce("hit", F.lit(False))).drop("_set")


def judge(pages: DataFrame, mined: Sequence[Rule], rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    The longest listed rule decides; without one, a page that holds all tokens of a mined rule is blocked and
    any other allowed. Null urls and those without :// have empty host and path, fit no listed rule and hold
    no host tokens. Rows that repeat are judged alike; other columns don't matter.
    """
    url = F.col("url")
    name, verdict = listed(F.col("host"), F.col("path"), rules)
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), tokens_of(url).alias("tokens"))
    fallback = F.when(F.col("hit"), "block").otherwise("allow")
    return matched(rows, mined).select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, fallback).alias("verdict"))
