"""One query for each operator, over its whole table and with production parameters, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gazetta.llm import decontam, html, langid, lexical, licenses, minhash, mixing, packing, quality, shard, toxicity, urlrules, whitening
from gazetta.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.assess(documents, quality.train(documents, table(spark, sf_dir, "labels")))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.assign(table(spark, sf_dir, "documents"), [1.0] * 8)


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the chain flags; toxicity.score gives the probabilities of all."""
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.train(documents, table(spark, sf_dir, "labels"))).where("toxic")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return langid.identify(documents, langid.train(documents))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urlrules.judge(pages, urlrules.mine(urlrules.labelled(pages, table(spark, sf_dir, "labels"))))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.decide(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_sharding": op2_sharding,
    "op3_minhash": op3_minhash,
    "op4_packing": op4_packing,
    "op5_toxicity": op5_toxicity,
    "op6_licenses": op6_licenses,
    "op7_html": op7_html,
    "op8_decontamination": op8_decontamination,
    "op9_langid": op9_langid,
    "op10_urls": op10_urls,
    "op11_mixing": op11_mixing,
    "op12_whitening": op12_whitening,
    "op13_search": op13_search,
}

_UNIT = "((('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '#{s}'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)"

OP2_SQL = f"""
WITH crc AS (
    SELECT list(c ORDER BY n) AS t FROM (
        SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS n))
), bytes AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS h FROM documents
), sized AS (
    SELECT doc_id, octet_length(encode(text))::BIGINT + 1 AS size,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(h, lambda x: ('0x' || x)::BIGINT)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)::BIGINT AS text_crc32
    FROM bytes, crc
), scored AS (
    SELECT *, [{", ".join("-1.0 / ln(" + _UNIT.format(s=s) + ")" for s in range(9))}] AS v FROM sized
), placed AS (
    SELECT *, (list_position(v[1:8], list_max(v[1:8])) - 1)::INTEGER AS shard, (list_position(v, list_max(v)) - 1)::INTEGER AS grown_shard FROM scored
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
    row_number() OVER (PARTITION BY shard ORDER BY ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '#' || size || '#' || text_crc32), 1, 8))::BIGINT % 1024, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot
FROM placed
"""

_HOST = "translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP10_SQL = rf"""
WITH parsed AS (
    SELECT page_id, coalesce(url, '') AS url, {_HOST} AS host, regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(coalesce(url, ''), '://(.*)$', 1) AS rest FROM pages
), tokened AS (
    SELECT page_id, host, path, list_sort(list_distinct(list_filter(list_concat(
        list_transform(range(1, len(l) + 1), lambda k: 'h:' || array_to_string(l[k:], '.')),
        list_transform(string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/'), lambda x: 'p:' || x),
        list_transform(string_split(regexp_extract(rest, '[?]([^#]+)', 1), '&'), lambda x: 'q:' || regexp_replace(x, '=.*', '')),
        ['s:' || regexp_extract(url, '^([a-zA-Z]+)://', 1), 'x:' || regexp_extract(path, '[.]([A-Za-z0-9]+)$', 1), CASE WHEN contains(rest, '#') THEN 'f:#' ELSE '' END]), lambda x: len(x) > 2))) AS tokens
    FROM (SELECT *, string_split(host, '.') AS l FROM parsed)
), marks AS (
    SELECT doc_id, max(coalesce(quality = 0, false) OR coalesce(toxic = 1, false)) AS bad FROM labels WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY doc_id
), labelled AS (
    SELECT tokens, bad FROM tokened JOIN marks ON try_cast(regexp_extract(path, '([0-9]{{1,18}})[^0-9]*$', 1) AS BIGINT) = doc_id
), numbered AS (
    SELECT row_number() OVER () AS row, tokens, bad FROM labelled
), each AS (
    SELECT row, bad, unnest(tokens) AS token FROM numbered
), often AS (
    SELECT token FROM each GROUP BY token HAVING count(*) FILTER (bad) >= 10 AND count(*) FILTER (bad) >= 0.005 * (SELECT count(*) FROM labelled)
), thin AS (
    SELECT row, bad, list_sort(list(token)) AS t FROM each JOIN often USING (token) GROUP BY row, bad
), parts AS (
    SELECT list_filter(t, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS part, bad FROM (SELECT t, bad, unnest(range(1, 1 << len(t))) AS mask FROM thin)
), counted AS (
    SELECT part, count(*)::DOUBLE AS n, count(*) FILTER (bad) AS k, count(*) FILTER (bad) / count(*) AS p FROM parts GROUP BY part
), rules AS (
    SELECT part FROM counted WHERE k >= 10 AND k >= 0.005 * (SELECT count(*) FROM labelled)
        AND (p + 3.8416 / (2 * n) - 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n) >= 0.6
), blocked AS (
    SELECT DISTINCT tokens FROM (SELECT DISTINCT tokens FROM tokened) t JOIN rules ON list_has_all(t.tokens, rules.part)
), listed AS (
    SELECT t.*, b.tokens IS NOT NULL AS hit, (SELECT arg_max((r.h || r.p, r.v), length(r.h || r.p)) FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) r(v, h, p)
        WHERE (t.host = r.h OR ends_with(t.host, '.' || r.h)) AND starts_with(t.path, r.p)) AS best
    FROM tokened t LEFT JOIN blocked b ON t.tokens = b.tokens
)
SELECT page_id, host, path, best[1] AS rule, coalesce(best[2], CASE WHEN hit THEN 'block' ELSE 'allow' END) AS verdict FROM listed
"""

OP11_SQL = r"""
WITH keyed AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        md5(concat_ws('#', coalesce(doc_id::VARCHAR, 'null'), md5('s' || source), md5(coalesce(text, '')))) AS key
    FROM documents
), sources AS (
    SELECT source, source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight
    FROM (SELECT source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY source)
), filled AS (
    SELECT *, 3 * source_size * (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) < weight * (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0)) AS over
    FROM sources WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), rest AS (
    SELECT sum(source_size) - coalesce(sum(3 * source_size) FILTER (over), 0) AS words, coalesce(sum(weight) FILTER (NOT over), 1) AS weight FROM filled
), rated AS (
    SELECT source, source_size, CASE WHEN over THEN (3 * source_size)::DOUBLE ELSE (filled.weight * rest.words)::DOUBLE / rest.weight::DOUBLE END AS target FROM filled, rest
), drawn AS (
    SELECT *, ((('0x' || substr(md5(key || '#' || row_number() OVER (PARTITION BY key) - 1 || '#11'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) AS u FROM keyed
), rate AS (
    SELECT doc_id, size, source_size, target, u, CASE WHEN source_size > 0 THEN least(target / source_size::DOUBLE, 3.0) ELSE 0.0 END AS r FROM drawn JOIN rated ON drawn.source IS NOT DISTINCT FROM rated.source
)
SELECT doc_id, size, source_size, target, (size * (floor(r) + (u < r - floor(r))::BIGINT))::BIGINT AS taken FROM rate
"""

OP13_SQL = r"""
WITH parsed AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
), asked AS (
    SELECT item, item_id, unnest(list_distinct(t)) AS term FROM (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM benchmark)
), corpus AS (
    SELECT count(*) AS docs, sum(len(t))::BIGINT AS words FROM parsed WHERE len(t) > 0
), postings AS (
    SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, len(t) AS n, unnest(t) AS term FROM parsed) WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weighed AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM postings, corpus GROUP BY term
), scored AS (
    SELECT item, item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))))::BIGINT AS score
    FROM asked JOIN postings USING (term) JOIN weighed USING (term), corpus GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op10_urls": OP10_SQL,
    "op11_mixing": OP11_SQL,
    "op13_search": OP13_SQL,
    "op2_sharding": OP2_SQL,
    "op3_minhash": r"""
WITH RECURSIVE tokens AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) END AS s
    FROM tokens
), classes AS (
    SELECT min(doc_id) AS rep, len(s) AS n, s FROM sets WHERE len(s) > 0 GROUP BY s
), grams AS (
    SELECT rep, n, unnest(s) AS g FROM classes
), links AS (
    SELECT a.rep AS a, b.rep AS b FROM grams a JOIN grams b ON a.g = b.g AND a.rep < b.rep
    GROUP BY a.rep, b.rep HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
), both_ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT rep AS a, rep AS b FROM classes UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a
), component AS (
    SELECT a AS rep, min(b) AS component FROM reach GROUP BY a
)
SELECT t.doc_id, len(t.s)::BIGINT AS n_shingles, coalesce(p.component, t.doc_id) AS component_id, t.doc_id = coalesce(p.component, t.doc_id) AS kept
FROM sets t LEFT JOIN classes c ON t.s = c.s LEFT JOIN component p ON c.rep = p.rep
""",
}
