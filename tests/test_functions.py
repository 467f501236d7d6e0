from gazetta.functions import html, scalar, variant
from pyspark.sql import functions as F


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double' if isinstance(v, float) else 'long'}" for k, v in values.items())) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


def test_distinct_chars(spark):
    assert one(spark, scalar.distinct_chars(F.col("t")), t="村 村,山、\U00020000；尾\n村\r") == ["村", "山", "\U00020000", "尾", "\r"]
    assert one(spark, scalar.distinct_chars(F.col("t")), t=None) == []


def test_levels_and_codes(spark):
    assert [one(spark, scalar.level_from_length(F.lit(c))) for c in ("11", "1101", "110101", "110101001")] == ["province", "city", "district", "town"]
    assert one(spark, scalar.level_from_text(F.lit("  乡、镇（街道办事处）"))) == "town"
    assert one(spark, scalar.level_from_text(F.lit(None).cast("string"))) == "unknown"
    assert one(spark, scalar.padded_code(F.lit(" 110101 "))) == "110101000000"
    assert one(spark, scalar.short_code(F.lit("110101000000"))) == "110101"
    assert one(spark, scalar.short_code(F.lit("110101001000"))) == "110101001"
    assert one(spark, scalar.url_code(F.lit("/a/110101001.html"))) == "110101001"
    assert one(spark, scalar.url_code(F.lit("/a/110101001.html?x"))) == ""


def test_durations(spark):
    assert [one(spark, scalar.duration_text(F.lit(s))) for s in (3723.9, 123.0, 3.0, -5.0)] == ["1h02m03s", "2m03s", "3s", "0s"]


def test_retry_rules(spark):
    assert one(spark, scalar.backoff(F.lit(3), F.lit(429))) == 20.0
    assert one(spark, scalar.backoff(F.lit(3), F.lit(403))) == 60.0
    assert one(spark, scalar.backoff(F.lit(3), F.lit(503))) == 8.0
    assert one(spark, scalar.backoff(F.lit(3), F.lit(None).cast("int"))) == 3.0
    assert 3.0 <= one(spark, scalar.backoff(F.lit(3), F.lit(404), jitter_seed=1)) <= 3.9
    assert one(spark, scalar.should_retry(F.lit(None).cast("int"), F.lit("请求超时"))) is True
    assert one(spark, scalar.should_retry(F.lit(404), F.lit(None).cast("string"))) is False
    assert one(spark, scalar.jitter(F.lit(1.0), 0.5, 0.0)) == 1.0
    assert 1.5 <= one(spark, scalar.jitter(F.lit(1.0), 0.5, 0.9, 3)) <= 1.9


def test_names_and_lists(spark):
    assert one(spark, scalar.split_list(F.lit(" a, ,b\t,"))) == ["a", "b"]
    assert one(spark, scalar.truthy(F.lit(" Yes "))) is True and one(spark, scalar.truthy(F.lit(None).cast("string"))) is False
    assert one(spark, scalar.task_slug(F.lit("-a b/c_"), F.lit("x"))) == "a-b-c"
    assert one(spark, scalar.task_slug(F.lit("--"), F.lit("x"))).startswith("task-")
    assert one(spark, scalar.empty_to_null(F.lit(""))) is None
    assert one(spark, scalar.search_type(F.lit("exact"))) == "精确"


def points(spark, text):
    return one(spark, variant.coordinates(F.col("t")), t=text)


def test_coordinates(spark):
    assert points(spark, "[[1, 2, 3], [\"4.5\", 5], [1], null, [\"x\", 1]]") == [[1.0, 2.0], [4.5, 5.0]]
    assert points(spark, "[1, 2]") == []  # a flat point
    assert points(spark, "[[[1, 2], [3, 4]]]") == []  # rings
    assert points(spark, "") == points(spark, "{") == points(spark, "{}") == points(spark, None) == []


def shapes(spark, text):
    v = variant.parsed(F.col("t"))
    df = spark.createDataFrame([(text,)], "t string").select(F.size(variant.rows_of(v)).alias("a"), F.size(variant.records_of(v)).alias("b"), variant.total_of(v, F.lit(-1).cast("long")).alias("c"))
    return tuple(df.first())


def test_payload_shapes(spark):
    assert shapes(spark, '[{"a":1}, 2]') == (1, 1, -1)
    assert shapes(spark, '{"data":[{}],"records":[{},{}]}') == (1, 2, -1)
    assert shapes(spark, '{"data":{"records":[{}, 3]},"total":7}') == (1, 1, 7)
    assert shapes(spark, '{"data":{"children":[{}],"total":4}}') == (1, 0, 4)
    assert shapes(spark, '[{"records":[{},{}],"total":5}]') == (1, 2, 5)
    assert shapes(spark, "broken") == (0, 0, -1)


def test_canonical(spark):
    assert one(spark, variant.canonical(variant.parsed(F.lit('{"b": 1, "a": "村"}')))) == '{"a":"村","b":1}'


PAGE = """<ul><li>地区名称：东城区</li><li>区划代码：110101</li><li>统计用12位区划代码：110101</li><li>地区级别：县（市辖区）</li><li>状态：<span>停用</span></ul>
<h3>【同级行政区划】</h3><table><tr><td><a href="/1/110102000.html">西城区</a></td><td>x</td></tr></table>
<h3>【下辖行政区划】</h3><table><tr><th>a</th></tr><tr><td><a href="/x/110101001.html">东华门街道</a></td><td>1</td><td>正常</td></tr><tr><td><a href="/x/no.html">no</a></td><td>1</td></tr></table>"""


def test_titles_as_written(spark, tmp_path):
    from gazetta.plans.queries import QUERIES

    titles = ["and&amp;amp; so&amp", "token = &quot;0b", "\u3000\ta&nbsp;&lt; ", ""]
    pages = [(k, f'<head><title>{t}</title></head><h1> A &amp; B</h1><a href="x?a&amp;b">x</a><a name="n">') for k, t in enumerate(titles)] + [(4, "<p>no title"), (5, None)]
    df = spark.createDataFrame(pages, "page_id long, html string")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.title, r.n_links) for r in QUERIES["html_links"](spark, str(tmp_path)).collect()}
    assert got == {0: ("and&amp; so&amp", 1), 1: ("token = &quot;0b", 1), 2: ("\ta&nbsp;&lt;", 1), 3: ("", 1), 4: ("", 0), 5: (None, None)}
    decoded = df.select(html.page_outline("html").alias("o")).where("o.title like 'token%'").first().o
    assert (decoded.title, decoded.h1, decoded.links) == ('token = "0b', "A & B", ["x?a&b"])
    written = df.where("page_id = 0").select(html.page_outline("html", as_written=True).alias("o")).first().o
    assert (written.title, written.h1, written.links) == (titles[0], " A &amp; B", ["x?a&amp;b"])


def test_division_pages(spark):
    pages = spark.createDataFrame([(PAGE, "u"), (None, "v"), ("<p>unclosed", "w")], "html string, url string")
    rows = {r.source_url: r for r in html.divisions_of(pages).collect()}
    assert (rows["u"].code, rows["u"].name, rows["u"].short_code, rows["u"].level, rows["u"].status, rows["u"].full_name) == ("110101000000", "东城区", "110101", "district", "停用", "东城区")
    assert rows["v"].code == "" and rows["w"].status == "正常"
    children = html.children_of_pages(pages, ["url"])
    assert [tuple(r) for r in children.collect()] == [("u", "110101001000", "东华门街道", "正常")]
    made = html.child_divisions(children, F.lit("110101000000"), "https://example.org").first()
    assert (made.level, made.short_code, made.source_url) == ("town", "110101001", "https://example.org/110101001.html")
    assert [r.code for r in html.siblings_of_pages(pages, []).collect()] == ["110102000000"]
