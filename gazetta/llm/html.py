"""Main-text extraction: gradient-boosted trees over DOM nodes, then a decoding that respects the tree.

A page becomes a tree of block elements; each run of inline text between block borders is a leaf. The
trees give every node the probability that its subtree holds main text. Decoding keeps the set of
nodes with the largest sum of log-odds among those in which a node is kept only with its parent, so a
block is never kept inside a rejected section, nor a section for the sake of nothing.
"""

from __future__ import annotations

import random
import re
from functools import cache
from html import escape
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame

from gazetta.llm import gbt
from gazetta.llm.common import map_batches

BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr caption ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is not text of the page.
SILENT = frozenset("title script style noscript template svg iframe select button textarea canvas audio video datalist".split())
#: Of these, the ones that the end of a block around them closes too.
CLOSED_BY_BLOCKS = frozenset("select button canvas audio video datalist".split())
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}

#: Groups of attribute words; a node has a feature for each, and one for whether an ancestor has it.
WORDS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar tabs pagination pager toc",
    "edge": "header masthead footer foot colophon copyright legal banner contentinfo logo",
    "side": "sidebar aside side widget rail related recommended trending complementary popular more",
    "promo": "ad ads advert adverts advertisement sponsor sponsored promo promotion adsense dfp teaser",
    "notice": "cookie cookies consent notice alert popup modal overlay gdpr banner message warning",
    "talk": "comment comments reply replies respond disqus discussion thread feedback reviews",
    "form": "form login signup subscribe newsletter search contact share social follow",
    "body": "article content main post entry story text body page prose copy",
}
TAGS = {
    "nav": "nav menu", "header": "header hgroup", "footer": "footer", "aside": "aside dialog", "form": "form fieldset legend", "article": "article main", "section": "section div body html center details",
    "p": "p pre blockquote", "heading": "h1 h2 h3 h4 h5 h6", "list": "ul ol dl dir", "item": "li dt dd", "table": "table tbody thead tfoot tr td th caption", "figure": "figure figcaption", "text": "#text",
}
_group = {w: k for k, words in enumerate(WORDS.values()) for w in words.split()}
_BODY = list(WORDS).index("body")
_kind = {t: k for k, tags in enumerate(TAGS.values()) for t in tags.split()}
_split = re.compile(r"[a-z]+(?:[-_]+[a-z]+)*")
#: Parts of a compound that only say where or how a block is laid out ("site-footer", "ad-slot").
LAYOUT = frozenset("area bar bottom box block card center col column container content fixed global group header holder inline inner item items left list main mobile outer page panel primary right row secondary section site slot sticky the top unit wrap wrapper".split())
_own = [*TAGS, *(f"has_{w}" for w in WORDS), *(f"has_compound_{w}" for w in WORDS)]
_BOILER_TAGS = frozenset("nav footer aside form dialog menu".split())
_BOILER = sum(1 << k for k, name in enumerate(WORDS) if name != "body")  # plain words only
_upper = [*(f"in_{t}" for t in ("nav", "header", "footer", "aside", "form", "article", "p", "heading", "list", "table")), *(f"within_{w}" for w in WORDS), *(f"within_compound_{w}" for w in WORDS)]
FEATURES = [*_own, *_upper, "depth", "log_chars", "link_share", "chars_a_node", "stops", "paragraphs", "siblings", "place_among_siblings", "like_siblings", "place_in_page", "share_of_page", "hidden", "boiler_tags", "boiler_words"]
#: More link text never makes a node main text, nor does a hidden mark, nor one more boilerplate tag or word on it or above it.
MONOTONE = [-1 if f in ("link_share", "hidden", "boiler_tags", "boiler_words") else 0 for f in FEATURES]
_bits = {t: 1 << k for k, t in enumerate(("nav", "header", "footer", "aside", "form", "article", "p", "heading", "list", "table"))}
_above = {t: _bits[k] for k, tags in TAGS.items() if k in _bits for t in tags.split()}


def named(value: str) -> int:
    """Bits of the groups that an attribute's words belong to; those of compounds stand len(WORDS) higher.

    A compound names what its parts name if each of them is a word of a group or of the layout ("cookie-notice",
    "site-footer"). Otherwise it is a word of its own ("related-work", "ad-free", "popular-science"), which only its
    own features know; a part that speaks for main text counts in either case.
    """
    bits = 0
    for whole in _split.findall(value.lower()):
        parts = re.split("[-_]+", whole)
        plain = len(parts) == 1 or all(w in _group or w in LAYOUT for w in parts)
        for w in parts:
            if w in _group:
                k = _group[w]
                bits |= 1 << (k if plain or k == _BODY else k + len(WORDS))
    return bits


class Page(HTMLParser):
    """Block tree of a page as parallel lists; node 0 is the root. Tolerates unclosed, misnested and unknown tags."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.words, self.hidden, self.mark, self.text, self.linked = ["html"], [-1], [0], [0], [None], [""], [0]
        self.stack = [0]
        self.run: list[str] = []
        self.run_linked = 0
        self.link = False
        self.open: dict[str, int] = {}  # how many of each block tag are on the stack
        self.silent: str | None = None  # the silent element that is open, and how many elements of each name are open in it, itself included
        self.inside: dict[str, int] = {}
        try:
            self.feed(html)
            self.close()
        except AssertionError:  # the library's answer to some broken declarations
            self.__init__(html.replace("<![", "&lt;!["))
        self.flush()

    def node(self, tag: str, attrs: list) -> int:
        words = hidden = 0
        mark = None
        for name, value in attrs:
            if name in ("class", "id", "role", "itemprop") and value:
                words |= named(value)
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and value and "display:none" in value.replace(" ", "")):
                hidden = 1
            elif name == "data-y":
                mark = value == "1"
        self.tag.append(tag), self.parent.append(self.stack[-1]), self.words.append(words), self.hidden.append(hidden), self.mark.append(mark), self.text.append(""), self.linked.append(0)
        return len(self.tag) - 1

    def flush(self) -> None:
        if self.run:
            text = " ".join("".join(self.run).split())
            if text:
                k = self.node("#text", [])
                self.text[k], self.linked[k] = text, min(self.run_linked, len(text))
            self.run, self.run_linked = [], 0

    def pop(self) -> None:
        if len(self.stack) > 1:
            self.open[self.tag[self.stack.pop()]] -= 1
        self.link = False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.silent is not None:
            self.inside[tag] = self.inside.get(tag, 0) + 1
            return
        if tag in SILENT:
            self.silent, self.inside = tag, {tag: 1}
            return
        if tag not in BLOCKS:
            if tag == "br":
                self.run.append(" ")
            elif tag == "a":
                self.link = True
            return
        self.flush()
        if tag in ("html", "body"):
            if tag == "html" or "body" in self.tag:
                return
        while len(self.stack) > 1 and (self.tag[self.stack[-1]] == "p" or self.tag[self.stack[-1]] in IMPLIED.get(tag, ())):
            self.pop()
        if tag != "hr":
            self.stack.append(self.node(tag, attrs))
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag in SILENT:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self.silent is not None:  # up to its own end tag, or that of a block around it
            if self.inside.get(tag):
                self.inside[tag] -= 1
            elif self.silent in CLOSED_BY_BLOCKS and self.open.get(tag):
                self.silent = None
            if self.silent is not None:
                if not self.inside[self.silent]:
                    self.silent = None
                return
        if tag == "a":
            self.link = False
        if tag not in BLOCKS or tag in ("html", "body") or not self.open.get(tag):
            return
        self.flush()
        while self.tag[self.stack[-1]] != tag:
            self.pop()
        self.pop()

    def handle_data(self, data: str) -> None:
        if self.silent is None:
            self.run.append(data)
            if self.link:
                self.run_linked += len(data.strip())

    def features(self) -> np.ndarray:
        n = len(self.tag)
        chars = [len(t) for t in self.text]
        linked, stops, nodes, paragraphs = self.linked[:], [t.count(".") + t.count(",") for t in self.text], [1] * n, [int(t == "p") for t in self.tag]
        before, total = [0] * n, 0
        for k in range(n):
            before[k] = total
            total += chars[k]
        for k in range(n - 1, 0, -1):
            p = self.parent[k]
            chars[p] += chars[k]
            linked[p] += linked[k]
            stops[p] += stops[k]
            nodes[p] += nodes[k]
            paragraphs[p] += paragraphs[k]
        depth, upper, within, place, children, kinds = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n, {}
        for k in range(1, n):
            p = self.parent[k]
            depth[k] = depth[p] + 1
            upper[k] = upper[p] | _above.get(self.tag[p], 0)
            within[k] = within[p] | self.words[p]
            place[k] = children[p]
            children[p] += 1
            key = (p, self.tag[k])
            kinds[key] = kinds.get(key, 0) + 1
        x = np.zeros((n, len(FEATURES)))
        x[np.arange(n), [_kind.get(t, 6) for t in self.tag]] = 1
        at = len(TAGS)
        for bits, width in ((self.words, 2 * len(WORDS)), (upper, len(_bits)), (within, 2 * len(WORDS))):
            x[:, at : at + width] = (np.array(bits)[:, None] >> np.arange(width)) & 1
            at += width
        c, parent = np.array(chars, float), np.array(self.parent)
        siblings = np.array(children)[parent]
        same = np.array([kinds.get((self.parent[k], self.tag[k]), 1) for k in range(n)])
        tags, words = [0] * n, [0] * n
        for k in range(1, n):
            tags[k] = tags[self.parent[k]] + (self.tag[k] in _BOILER_TAGS)
            words[k] = words[self.parent[k]] + (self.words[k] & _BOILER > 0)
        x[:, at:] = np.column_stack(
            [depth, np.log1p(c), np.array(linked) / np.maximum(c, 1), c / np.array(nodes), np.array(stops) / np.maximum(c, 1), np.log1p(paragraphs), np.log1p(siblings), np.array(place) / np.maximum(siblings, 1), same / np.maximum(siblings, 1), np.array(before) / max(total, 1), c / max(total, 1), self.hidden, tags, words]
        )
        return x

    def decode(self, odds: np.ndarray) -> str:
        """Texts of the leaves that the best parent-closed set keeps, one a line."""
        n = len(self.tag)
        gain = odds.tolist()
        for k in range(n - 1, 0, -1):
            if gain[k] > 0:
                gain[self.parent[k]] += gain[k]
        kept = [True] * n
        out = []
        for k in range(1, n):
            kept[k] = kept[self.parent[k]] and gain[k] > 0
            if kept[k] and self.text[k]:
                out.append(self.text[k])
        return "\n".join(out)

    def labels(self) -> list[bool]:
        """From data-y marks: a leaf has its nearest marked ancestor's, a section is main if a leaf in it is."""
        n = len(self.tag)
        own: list = [False] * n
        for k in range(1, n):
            own[k] = own[self.parent[k]] if self.mark[k] is None else self.mark[k]
        main = [own[k] and bool(self.text[k]) for k in range(n)]
        for k in range(n - 1, 0, -1):
            main[self.parent[k]] = main[self.parent[k]] or main[k]
        return main


def sample_page(rng: random.Random) -> str:
    """A random page whose blocks carry data-y marks: the training data. Sites differ in tags, class names, order and what they have."""
    syllables = [a + b for a in "bcdfglmnprstv" for b in ("a", "e", "i", "o", "u", "an", "er", "in")]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))

    def prose(low: int, high: int) -> str:
        out = []
        while len(out) < rng.randint(low, high):
            out += [*(word() for _ in range(rng.randint(2, 14))), word() + rng.choice([".", ".", ",", "?"])]
        return escape(" ".join(out))

    layout, boiler = sorted(LAYOUT), [w for k, words in WORDS.items() if k != "body" for w in words.split()]

    def el(tag: str, inside: str, names: str = "", y: int | None = None, plain: bool = False) -> str:
        """An element; a plain one has no compound but with words of the layout."""
        name = rng.choice(names.split()) if names and rng.random() < 0.85 else ""
        if name and rng.random() < 0.4:
            other = rng.choice(layout) if plain or rng.random() < 0.5 else word()
            name = rng.choice([f"{name}-{other}", f"{other}-{name}", f"{name} {word()}"])
        attr = f' {rng.choice(["class", "class", "id"])}="{name}"' if name else ""
        return f"<{tag}{attr}{'' if y is None else f' data-y={y}'}>{inside}" + ("" if tag == "p" and rng.random() < 0.1 else f"</{tag}>")

    def links(n: int) -> str:
        return el("ul", "".join(el("li", f'<a href="/{word()}">{prose(1, 3)}</a>') for _ in range(n)))

    def paragraphs(low: int, high: int) -> list[str]:
        out = []
        for _ in range(rng.randint(low, high)):
            text = prose(*rng.choice([(1, 8), (10, 60), (30, 150)]))
            if rng.random() < 0.2:
                text = f"<b>{text}</b>" if rng.random() < 0.5 else f"{text}<br>"
            if rng.random() < 0.15:
                text += f' <a href="#">{word()}</a> {prose(2, 9)}'
            out.append(el("p", text))
        return out

    def compound() -> str:
        """Main text whose class only sounds like boilerplate."""
        name = rng.choice([f"{rng.choice(boiler)}-{word()}", f"{word()}-{rng.choice(boiler)}", f"{rng.choice(boiler)}-{word()}-{word()}", f"{word()}_{rng.choice(boiler)}"])
        name = rng.choice([name, name, f"{word()} {name}", f"text-{name}"])
        tag = rng.choice(["p", "div", "section"])
        inside = prose(*rng.choice([(2, 12), (10, 60)])) if tag == "p" else (el("h2", prose(1, 5)) if rng.random() < 0.5 else "") + "".join(paragraphs(1, 3))
        return f'<{tag} class="{name}">{inside}</{tag}>'

    def article() -> str:
        body = paragraphs(1, 9) if rng.random() < 0.75 else [el("p", prose(1, 12)) for _ in range(rng.randint(1, 2))]
        for _ in range(rng.randint(0, 3)):
            extra = rng.choice(
                [
                    lambda: el("h2", prose(2, 8)), lambda: el("ul", "".join(el("li", prose(2, 20)) for _ in range(rng.randint(2, 6)))), lambda: el("blockquote", el("p", prose(8, 40))),
                    lambda: el("table", "".join(el("tr", el("td", word()) + el("td", prose(1, 5))) for _ in range(rng.randint(2, 5)))), lambda: el("pre", prose(5, 20)), lambda: el("div", prose(10, 50), "text copy"),
                ]
            )()
            body.insert(rng.randint(0, len(body)), extra)
        for _ in range(rng.randint(1, 2) if rng.random() < 0.35 else 0):
            body.insert(rng.randint(0, len(body)), compound())
        for _ in range(rng.randint(0, 2) if rng.random() < 0.5 else 0):
            junk = rng.choice(
                [
                    lambda: el("div", prose(2, 20), "ad advert promo sponsored", 0, True), lambda: el("aside", links(3), "related", 0), lambda: el("div", links(4), "share social related", 0),
                    lambda: el("aside", el("p", prose(5, 30)), "promo", 0), lambda: el("form", "<input>" + prose(2, 8), "newsletter subscribe", 0),
                ]
            )()
            body.insert(rng.randint(0, len(body)), junk)
        head = el("h1", prose(3, 12)) if rng.random() < 0.9 else ""
        if head and rng.random() < 0.25:
            head = el("header", head)
        inside = head + "".join(body)
        if rng.random() < 0.3:
            inside = el("div", inside, "content body entry text")
        return el(*rng.choice([("article", inside, "article post entry story"), ("main", inside, "main content"), ("div", inside, "article content post entry story main"), ("section", inside, "content article story")]), 1)

    def comments() -> str:
        each = [el("div", el("p", prose(3, 70)) + (links(1) if rng.random() < 0.3 else ""), "comment reply") for _ in range(rng.randint(1, 6))]
        return el(rng.choice(["section", "div"]), el("h3", prose(1, 3)) + "".join(each), "comments discussion disqus reviews", 0)

    nav = lambda: el(*rng.choice([("nav", links(rng.randint(3, 9)), ""), ("nav", links(5), "nav menu navbar"), ("div", links(rng.randint(3, 9)), "nav menu navbar breadcrumbs topbar")]), 0)
    parts = {
        "top": [lambda: el("header", prose(1, 8) + (nav() if rng.random() < 0.5 else ""), "header masthead", 0), lambda: el("div", prose(1, 10), "header banner masthead logo", 0), nav, nav],
        "junk": [
            lambda: el("div", prose(2, 40), "ad ads advert advertisement sponsored promo", 0), lambda: el("div", el("p", prose(4, 40)), "cookie consent notice alert popup", 0), lambda: el("aside", links(rng.randint(2, 8)), "sidebar widget", 0),
            lambda: el("aside", "".join(paragraphs(1, 3)), "sidebar related", 0), lambda: el("div", el("h3", word()) + links(5), "sidebar side related widget trending", 0), lambda: el("form", f"<label>{prose(1, 4)}</label><input>" + el("p", prose(2, 20)), "login search newsletter", 0),
            lambda: el("div", "".join(paragraphs(1, 2)), "promo sidebar widget notice", 0),
        ],
        "end": [lambda: el("footer", f"&copy; {prose(2, 30)}", "", 0), lambda: el("footer", prose(1, 30) + links(3), "footer", 0), lambda: el("footer", "".join(paragraphs(1, 3)), "footer", 0), lambda: el("div", f"&copy; {prose(2, 20)}" + links(3), "footer legal copyright", 0)],
    }
    some = lambda key, n: [rng.choice(parts[key])() for _ in range(rng.randint(0, n))]
    main = [*some("junk", 1), article(), *([comments()] if rng.random() < 0.5 else []), *some("junk", 2)]
    middle = "".join(main)
    for _ in range(rng.randint(0, 2)):
        middle = el("div", middle, "page wrapper container content main")
    rows = [*some("top", 3), *some("junk", 2), middle, *some("junk", 1), *some("end", 2)]
    if rng.random() < 0.2:
        rng.shuffle(rows)
    body = "".join(rows)
    return f"<!DOCTYPE html><html><head><title>{prose(2, 8)}</title><script>var a='<p>';</script></head><body>{body}</body></html>"


@cache
def train(pages: int = 500, seed: int = 7) -> gbt.Trees:
    """Fits the trees on generated pages; the same pages, and so the same trees, for a seed."""
    rng = random.Random(seed)
    x, y = [], []
    for _ in range(pages):
        page = Page(sample_page(rng))
        x.append(page.features()[1:])
        y += page.labels()[1:]
    return gbt.fit(np.concatenate(x), np.array(y), MONOTONE, trees=40, depth=5, rate=0.25)


def extract_all(model: gbt.Trees, htmls: list[str | None]) -> list[str]:
    """The main text of each whole page; a null or empty page has none."""
    pages = [Page(h) if h else None for h in htmls]
    x = [p.features() for p in pages if p]
    odds = gbt.margin(model, np.concatenate(x)) if x else np.empty(0)
    out, at = [], 0
    for p in pages:
        out.append(p.decode(odds[at : at + len(p.tag)]) if p else "")
        at += len(p.tag) if p else 0
    return out


def extract(pages: DataFrame, model: gbt.Trees | None = None) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    Null and empty html give an empty text. Rows that repeat are extracted each on their own; other
    columns don't matter.
    """
    held = pages.sparkSession.sparkContext.broadcast(model or train())  # a few thousand numbers

    def run(batch: dict) -> dict:
        texts = extract_all(held.value, batch["html"])
        return {"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    return map_batches(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long", text="html")
