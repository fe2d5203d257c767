"""Main text of web pages by a tree-structured graphical model over the blocks of the page.

Every block element has a state: it belongs to the article or leads to a part of it, or it does not.  The model
is a factor per node (tag, words of class, id and role, length and punctuation of its own text, share of links)
and a factor per edge from parent to child.  Messages go once up the tree and once down; the text of a block is
kept if the product of its messages gives the article more than half.  Counts over labelled pages, taken by Spark, are the
factors; they are a few hundred numbers.  Extraction is one pass over the pages without a shuffle.

Text inside a block has its character references decoded and its white space (a line break is white space)
turned to single spaces; blocks are joined by line feeds in page order.  Null and empty pages and such without
an article give an empty text.  Pages are read whole, whatever their length; repeated rows are alike.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .labelled_pages import labelled_pages

#: Elements by how they shape text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("script style head noscript template svg iframe object select textarea button title canvas audio video".split())
IN_HEAD = frozenset("base link meta title style script noscript template".split())  # all that leaves an open head open
BREAKS = frozenset(  # start tags that end a dropped element without an end tag of its own
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label map mark meter output q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSED_BY = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
SCOPE = frozenset("table td th tr ul ol dl body html article section div main".split())

SECTIONS = frozenset("article main nav header footer aside form table ul ol".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)", re.S)
NAMES = re.compile(r"\b(class|id|role|data-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME_WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Page:
    """The blocks of a page in page order: parents before children; and the pieces of text, each with its block."""

    def __init__(self, source: str) -> None:
        self.tag, self.parent, self.names, self.label = ["#root"], [-1], [()], [None]
        self.own, self.links, self.texts = [0], [0], []
        stack: list[tuple[str, int]] = [("#root", 0)]  # open elements with the block they are in
        pieces: list[str] = []
        loose: list[int] = []  # where in the stack dropped elements without an end tag are
        places: dict[str, list[int]] = {}  # where in the stack each tag is open, so that nothing walks the stack
        last_end: dict[str, int] = {}
        linked = dropped = 0
        at, end = 0, len(source)

        def flush() -> None:
            if pieces:
                text = " ".join(html.unescape("".join(pieces)).split())
                pieces.clear()
                if text:
                    self.texts.append((stack[-1][1], text))
                    self.own[stack[-1][1]] += len(text)

        def close(to: int) -> None:
            nonlocal linked, dropped
            while len(stack) > to:
                tag, _ = stack[-1]
                if tag not in INLINE:
                    flush()
                linked -= tag == "a"
                dropped -= tag in DROPPED
                stack.pop()
                if stack:
                    places[tag].pop()
            while loose and loose[-1] >= to:
                loose.pop()

        def ended(tag: str) -> bool:
            """Whether an end tag for the element that starts before ``at`` comes before the next such element."""
            if tag not in last_end:
                last_end[tag] = max((m.start() for m in re.finditer(rf"</{re.escape(tag)}\b", source, re.I)), default=-1)
            if last_end[tag] < at:
                return False
            return re.compile(rf"<(/?){re.escape(tag)}\b", re.I).search(source, at)[1] == "/"

        while at < end:
            token = TOKEN.search(source, at)
            text = source[at:token.start() if token else end]
            if stack[-1][0] == "head" and text.strip():
                close(len(stack) - 1)
            if text and not dropped:
                pieces.append(text)
                if linked:
                    self.links[stack[-1][1]] += len(text)
            if not token:
                break
            at = token.end()
            tag = (token[2] or "").lower()
            if not tag:
                continue
            if token[1]:
                if places.get(tag):
                    close(places[tag][-1])
                continue
            if tag == "body" or (stack[-1][0] == "head" and tag not in IN_HEAD):
                if places.get("head"):
                    close(places["head"][-1])
            if loose and (tag in BREAKS or tag == stack[loose[-1]][0]):
                close(loose[-1] if tag not in BREAKS else loose[0])
            if tag in VOID:
                if tag in ("br", "hr", "img", "input", "wbr"):
                    pieces.append("" if tag == "wbr" or dropped else " ")
                continue
            if tag not in INLINE:
                self._imply(tag, places, close)
                flush()
            block = stack[-1][1]
            if tag not in INLINE and not dropped and tag not in DROPPED:
                names = {n.lower(): a or b or c for n, a, b, c in NAMES.findall(token[3])}
                words = " ".join(names.get(k, "") for k in ("class", "id", "role"))
                self.tag.append(tag)
                self.parent.append(block)
                self.names.append(tuple(set(NAME_WORD.findall(CAMEL.sub(" ", words).lower()))))
                self.label.append(names.get("data-label", self.label[block]))
                self.own.append(0)
                self.links.append(0)
                block = len(self.tag) - 1
            if tag in DROPPED and tag not in RAW and tag != "head" and dropped == 0 and not ended(tag):
                loose.append(len(stack))
            places.setdefault(tag, []).append(len(stack))
            stack.append((tag, block))
            linked += tag == "a"
            dropped += tag in DROPPED
            if tag in RAW:
                shut = re.compile(rf"</{re.escape(tag)}\b", re.I).search(source, at)
                at = shut.start() if shut else end
        close(1)
        flush()

    @staticmethod
    def _imply(tag: str, places, close) -> None:
        """Ends that a start tag implies: a paragraph before any block, a list item before the next one."""
        ends = {"p", *CLOSED_BY.get(tag, "").split()}
        while True:
            scope = max((places[n][-1] for n in SCOPE - ends if places.get(n)), default=0)
            at, name = max(((places[n][-1], n) for n in ends if places.get(n)), default=(0, ""))
            if at <= scope:
                return
            close(at)
            if name not in ("p", "td", "th"):
                return

    def features(self) -> list[tuple[str, ...]]:
        whole, linked = self.own[:], self.links[:]
        for i in range(len(whole) - 1, 0, -1):
            whole[self.parent[i]] += whole[i]
            linked[self.parent[i]] += linked[i]
        marks = [0] * len(whole)
        for block, text in self.texts:
            marks[block] += text.count(".") + text.count(",") + text.count("!") + text.count("?")
        found, within = [], ["page"] * len(whole)
        for i, tag in enumerate(self.tag):
            within[i] = tag if tag in SECTIONS else within[max(self.parent[i], 0)]
            size = f"size {min(self.own[i].bit_length(), 9)}"
            share = f"links {min(3, int(4 * linked[i] / whole[i]))}" if whole[i] else "empty"
            found.append((f"tag {tag}", f"within {within[i]}", size, share, f"marks {min(marks[i], 3)}", *[f"name {w}" for w in self.names[i]]))
        return found

    def states(self) -> list[int]:
        """The labelled states: 1 for content and all that it is in."""
        out = [int(x == "content") for x in self.label]
        for i in range(len(out) - 1, 0, -1):
            if out[i]:
                out[self.parent[i]] = 1
        return out


def count_factors(spark, pages: list[str]) -> Counter:
    """How often each feature, and each pair of parent and child states, occurs in the labelled pages."""
    def run(frames):
        for frame in frames:
            seen: Counter = Counter()
            for source in frame["html"]:
                page = Page(source)
                states = page.states()
                for i, features in enumerate(page.features()):
                    seen[("state", "", states[i])] += 1
                    for f in features:
                        seen[("node", f, states[i])] += 1
                    if i:
                        seen[("edge", str(states[page.parent[i]]), states[i])] += 1
            yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["kind", "name", "state", "n"])

    frame = spark.createDataFrame([(p,) for p in pages], "html string").mapInPandas(run, "kind string, name string, state int, n long")
    rows = frame.groupBy("kind", "name", "state").agg(F.sum("n").alias("n")).collect()
    return Counter({(r["kind"], r["name"], r["state"]): r["n"] for r in rows})


class Model:
    """``node``: log odds of a feature; ``edge[s][t]``: probability of state t in a child of state s."""

    def __init__(self, counts: Counter) -> None:
        total = [counts["state", "", s] + 1 for s in (0, 1)]
        names = {name for kind, name, _ in counts if kind == "node"}
        self.node = {n: math.log((counts["node", n, 1] + 0.5) / total[1]) - math.log((counts["node", n, 0] + 0.5) / total[0]) for n in names}
        self.edge = []
        for s in (0, 1):
            row = [counts["edge", str(s), t] + 0.01 for t in (0, 1)]
            self.edge.append([x / sum(row) for x in row])

    def marginals(self, page: Page) -> list[float]:
        """Probability of state 1 for each block, by messages up and down the tree."""
        n = len(page.tag)
        factor = []
        for features in page.features():
            odds = math.exp(max(-20.0, min(20.0, sum(self.node.get(f, 0.0) for f in features))))
            factor.append((1 / (1 + odds), odds / (1 + odds)))
        up, belief = [(1.0, 1.0)] * n, [list(f) for f in factor]
        e = self.edge
        for i in range(n - 1, 0, -1):
            b0, b1 = belief[i]
            m0, m1 = e[0][0] * b0 + e[0][1] * b1, e[1][0] * b0 + e[1][1] * b1
            total = m0 + m1
            up[i] = (m0 / total, m1 / total)
            p = belief[page.parent[i]]
            p[0] *= up[i][0]
            p[1] *= up[i][1]
            total = p[0] + p[1]
            p[0] /= total
            p[1] /= total
        for i in range(1, n):
            p, u = belief[page.parent[i]], up[i]
            c0, c1 = p[0] / u[0], p[1] / u[1]
            b0 = belief[i][0] * (c0 * e[0][0] + c1 * e[1][0])
            b1 = belief[i][1] * (c0 * e[0][1] + c1 * e[1][1])
            belief[i] = [b0 / (b0 + b1), b1 / (b0 + b1)]
        return [b[1] for b in belief]

    def text(self, source: str) -> str:
        page = Page(source)
        if not page.texts:
            return ""
        kept = self.marginals(page)
        return "\n".join(text for block, text in page.texts if kept[block] > 0.5)


def train(spark, pages: list[str] | None = None) -> Model:
    return Model(count_factors(spark, pages if pages is not None else labelled_pages()))


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of each page."""
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast(model or train(spark))

    @F.pandas_udf("string")
    def main_text(sources: pd.Series) -> pd.Series:
        return sources.map(lambda s: shared.value.text(s) if s else "")

    found = pages.select("page_id", "url", main_text(F.coalesce("html", F.lit(""))).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def query(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
