"""Fields and link tables of division pages, by Arrow UDFs on the standard HTML parser (pages are no XML)."""

from __future__ import annotations

from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.functions import scalar

# Labels and headings that a division page carries.
LABELS = {"name": "地区名称：", "short_code": "区划代码：", "code": "统计用12位区划代码：", "code_half": "统计用12位区划代码:", "level_text": "地区级别：", "status": "状态：", "full_name": "全称："}
CHILD_HEADING, SIBLING_HEADING, ACTIVE = "下辖行政区划", "同级行政区划", "正常"
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Text(HTMLParser):
    """Text pieces in page order, each with the path of open elements, and where elements start."""

    def __init__(self, html: str | None):
        super().__init__(convert_charrefs=True)
        self.pieces: list[tuple[str, int]] = []  # (text, parent element)
        self.elements: list[tuple[str, int, dict, int]] = [("", -1, {}, 0)]  # tag, parent, attributes, pieces before it
        self.ends: dict[int, int] = {}  # pieces before the element's end
        self.stack = [0]
        self.feed(html or "")
        self.close()
        for k in self.stack:
            self.ends[k] = len(self.pieces)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.elements.append((tag, self.stack[-1], dict(attrs), len(self.pieces)))
        if tag in VOID:
            self.ends[len(self.elements) - 1] = len(self.pieces)
        else:
            self.stack.append(len(self.elements) - 1)

    def handle_endtag(self, tag: str) -> None:
        if any(self.elements[k][0] == tag for k in self.stack[1:]):
            while True:
                k = self.stack.pop()
                self.ends[k] = len(self.pieces)
                if self.elements[k][0] == tag:
                    return

    def handle_data(self, data: str) -> None:
        self.pieces.append((data, self.stack[-1]))

    def text(self, element: int, strip: bool = True) -> str:
        return "".join(t.strip() if strip else t for t, _ in self.pieces[self.elements[element][3] : self.ends[element]])

    def after(self, label: str) -> str:
        """The text that follows a label: in its own piece, else in the element around it."""
        found = [(t.strip(), p) for t, p in self.pieces if label in t]
        for text, parent in found:
            if text.startswith(label):
                value = text[len(label) :].strip() or self.text(parent).split(label, 1)[-1].strip()
                if value:
                    return value
        for _, parent in found:
            value = self.text(parent).split(label, 1)[-1].strip() if label in self.text(parent) else ""
            if value:
                return value
        return ""

    def inside(self, element: int, tag: str) -> list[int]:
        out = []
        for k in range(element + 1, len(self.elements)):
            up = self.elements[k][1]
            while up > element:
                up = self.elements[up][1]
            if up == element and self.elements[k][0] == tag:
                out.append(k)
        return out

    def table(self, heading: str) -> list[tuple[str, str, str]]:
        """(href, link text, last cell) of the rows of the first table after a heading that have two or more cells, the first with a link."""
        at = next((n for n, (t, _) in enumerate(self.pieces) if heading in t), None)
        start = next((k for k, e in enumerate(self.elements) if at is not None and e[0] == "table" and e[3] > at), None)
        out = []
        for row in self.inside(start, "tr") if start is not None else []:
            cells = self.inside(row, "td")
            links = self.inside(cells[0], "a") if len(cells) >= 2 else []
            if links:
                out.append((self.elements[links[0]][2].get("href") or "", self.text(links[0]), self.text(cells[-1])))
        return out


def _fields(html: pd.Series) -> pd.DataFrame:
    rows = []
    for page in map(_Text, html):
        got = {k: page.after(v) for k, v in LABELS.items()}
        half = got.pop("code_half")
        rows.append(got | {"code": got["code"] or half})
    return pd.DataFrame(rows, columns=["name", "short_code", "code", "level_text", "status", "full_name"])


def _children(html: pd.Series) -> pd.Series:
    return html.map(lambda h: [dict(zip(("href", "name", "status"), r, strict=True)) for r in _Text(h).table(CHILD_HEADING)])


def _siblings(html: pd.Series) -> pd.Series:
    return html.map(lambda h: [dict(zip(("href", "name", "status"), r, strict=True)) for r in _Text(h).table(SIBLING_HEADING)])


def _outlines(html: pd.Series, as_written: bool) -> pd.DataFrame:
    rows = []
    for page in map(_Text, html):
        first = {}
        for k, e in enumerate(page.elements):
            first.setdefault(e[0], k)
        title, h1 = (page.text(first[tag], not as_written) if tag in first else "" for tag in ("title", "h1"))
        rows.append({"title": title, "h1": h1, "links": [e[2]["href"] for e in page.elements if e[0] == "a" and e[2].get("href")]})
    return pd.DataFrame(rows, columns=["title", "h1", "links"])


def _outline(html: pd.Series) -> pd.DataFrame:
    return _outlines(html, as_written=False)


def _outline_as_written(html: pd.Series) -> pd.DataFrame:
    return _outlines(html.map(lambda h: (h or "").replace("&", "&amp;")), as_written=True)  # decoding gives back what the page says


# Made when used, since their types need a session.
def _links_udf(rows: Callable) -> Callable:
    return F.pandas_udf(rows, "array<struct<href:string,name:string,status:string>>")


def page_outline(html: str, as_written: bool = False) -> Column:
    """Title, first heading and link targets of any page; as_written leaves their character references and white space as they stand in it."""
    return F.pandas_udf(_outline_as_written if as_written else _outline, "struct<title:string,h1:string,links:array<string>>")(F.col(html))


def divisions_of(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """One division a page, with its defaults: short code from the code, full name from the name, an active status."""
    f = F.col("_f")
    rows = pages.withColumn("_f", F.pandas_udf(_fields, "struct<name:string,short_code:string,code:string,level_text:string,status:string,full_name:string>")(F.col(html)))
    code = scalar.padded_code(f["code"])
    return rows.select(
        code.alias("code"), f["name"].alias("name"), F.coalesce(scalar.empty_to_null(f["short_code"]), F.substring(code, 1, 6)).alias("short_code"), F.lit("").alias("parent_code"),
        scalar.level_from_text(f["level_text"]).alias("level"), f["level_text"].alias("level_text"), F.coalesce(scalar.empty_to_null(f["full_name"]), f["name"]).alias("full_name"),
        F.coalesce(scalar.empty_to_null(f["status"]), F.lit(ACTIVE)).alias("status"), F.col(url).alias("source_url"),
    )


def _linked(pages: DataFrame, udf: Column, keep: list[str]) -> DataFrame:
    rows = pages.select(*keep, F.explode(udf).alias("_l"))
    code = scalar.url_code(F.col("_l.href"))
    return rows.where(code != "").select(*keep, F.concat(code, F.lit("000")).alias("code"), F.col("_l.name").alias("name"), F.col("_l.status").alias("status"))


def children_of_pages(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """Rows of the table of subordinate divisions: code, name and status, beside the columns to keep."""
    return _linked(pages, _links_udf(_children)(F.col(html)), keep)


def siblings_of_pages(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    return _linked(pages, _links_udf(_siblings)(F.col(html)), keep).select(*keep, "code")


def child_divisions(children: DataFrame, parent: Column, base_url: str) -> DataFrame:
    """Divisions made of table rows alone: always towns, full name from the name."""
    code = F.col("code")
    return children.select(
        code, F.col("name"), scalar.short_code(code).alias("short_code"), parent.alias("parent_code"), F.lit("town").alias("level"), F.lit("").alias("level_text"), F.col("name").alias("full_name"),
        F.coalesce("status", F.lit(ACTIVE)).alias("status"), F.concat(F.lit(base_url + "/"), F.substring(code, 1, 9), F.lit(".html")).alias("source_url"),
    )
