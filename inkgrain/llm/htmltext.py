"""Main text of web pages from a tree-structured graphical model over their blocks."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgrain.llm.shared import ship

#: Bound of the training sample: pages, by a hash of the row.
SAMPLE_PAGES = 4_000

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
HIDDEN = frozenset("head title script style template noscript textarea select option datalist button iframe object svg math canvas audio video map form".split())
#: Hidden elements whose content may still be the article, as pages wrap it in them or leave them open.
WRAPPERS = frozenset("form button select option datalist noscript object audio video map canvas".split())
RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.IGNORECASE) for t in ("script", "style")}
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "body": ({"head"}, set()),
}
# Names that page authors give to parts of a page, taken as observations before any page is seen.
CONTENT_TAGS = "article main".split()
CONTENT_WORDS = "article content entry main post story text body prose".split()
OTHER_TAGS = "nav header footer aside form menu dialog fieldset".split()
OTHER_WORDS = (
    "ad ads advert advertisement banner breadcrumb breadcrumbs byline comment comments consent cookie cookies disqus footer header login masthead menu "
    "modal nav navbar navigation newsletter notice notices pagination popup promo promoted promotion related replies reply respond search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar tracking widget widgets copyright legal disclaimer alert"
).split()
NAMED_TAGS, NAMED_WORDS = frozenset(CONTENT_TAGS + OTHER_TAGS), frozenset(CONTENT_WORDS + OTHER_WORDS)
PRIOR = 40.0

MARKUP = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*+)|!--|[!?/])")
ATTRIBUTE = re.compile(r"[\s/]*+([^\s/>][^\s/>=]*+)(?:\s*+=\s*+)?+")
BARE_VALUE = re.compile(r"[^\s>]*+")
NAME = re.compile(r"[a-z]+")


@dataclass
class Block:
    tag: str
    words: frozenset[str]
    parent: int
    hidden: bool
    #: Hidden by wrappers alone, so that an article inside is seen.
    wrapped: bool = False
    text: list[str] = field(default_factory=list)
    linked: int = 0
    chars: int = 0


class Blocks:
    """Block elements in page order, with parents; ``runs`` are (block, text) in page order. Inline elements belong to their block.

    ``feed`` takes any text in linear time: a quote or comment that never ends is taken to end with its tag, and ``<![`` is a comment up
    to the next ``>``, as in browsers. A tag cut off at the end is dropped.
    """

    def __init__(self):
        self.blocks = [Block("#page", frozenset(), -1, False)]
        self.open = [0]
        self.held: Counter[str] = Counter()
        self.runs: list[list] = []
        self.link = False

    def feed(self, html: str) -> None:
        last = {q: html.rfind(q) for q in ("'", '"', "-->", ">")}
        at = 0
        while m := MARKUP.search(html, at):
            if m.start() > at:
                self.handle_data(unescape(html[at : m.start()]))
            if last[">"] < m.end() - 1:
                return
            closing, tag = m.groups()
            if tag and not closing:
                attrs, at = self.attributes(html, m.end(), last)
                if at is None:
                    return
                tag = tag.lower()
                if html[at - 2] == "/":
                    self.handle_startendtag(tag, attrs)
                    continue
                self.handle_starttag(tag, attrs)
                if tag in RAW:
                    end = RAW[tag].search(html, at)
                    if not end:
                        return
                    at = end.start()
                continue
            if m.group() == "<!--":
                empty = html.startswith(">", m.end()) or html.startswith("->", m.end())
                if not empty and last["-->"] >= m.end():
                    at = html.index("-->", m.end()) + 3
                    continue
            end = html.find(">", m.end() - (m.group()[-1] == ">"))
            if end < 0:
                return
            at = end + 1
            if tag:
                self.handle_endtag(tag.lower())
        if at < len(html):
            self.handle_data(unescape(html[at:]))

    @staticmethod
    def attributes(html: str, at: int, last: dict[str, int]) -> tuple[list[tuple[str, str | None]], int | None]:
        """Names and values of a start tag from ``at`` on, and the place after its ``>`` (None if there is none)."""
        out = []
        while m := ATTRIBUTE.match(html, at):
            at, value = m.end(), None
            if html[at - 1] == "=" or html[m.end(1) : at].strip():
                quote = html[at : at + 1]
                if quote in ("'", '"') and last[quote] > at:
                    end = html.index(quote, at + 1)
                    value, at = html[at + 1 : end], end + 1
                else:
                    end = BARE_VALUE.match(html, at).end()
                    value, at = html[at:end], end
            out.append((m.group(1).lower(), value and unescape(value)))
        end = html.find(">", at)
        return out, end + 1 if end >= 0 else None

    def close(self, i: int) -> None:
        self.held.subtract(self.blocks[k].tag for k in self.open[i:])
        del self.open[i:]

    def close_to(self, tags: set[str], stop: set[str]) -> None:
        if not any(self.held[t] > 0 for t in tags):
            return
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.blocks[self.open[i]].tag
            if tag in tags:
                self.close(i)
                return
            if tag in stop:
                return

    def handle_starttag(self, tag, attrs):
        if tag in INLINE or tag in VOID:
            self.link = tag == "a" or (self.link and tag != "hr")
            if tag in ("br", "hr") and self.runs:
                self.runs.append([self.open[-1], " ", tag == "hr"])
            return
        self.link = False
        if tag in CLOSED_BY:
            self.close_to(*CLOSED_BY[tag])
        elif tag not in HIDDEN or tag == "form":
            if any(self.blocks[i].tag == "p" for i in self.open[-2:]):
                self.close_to({"p"}, {"article", "section", "div", "td", "li", "button"})
        words = frozenset(w for k, v in attrs if k in ("class", "id", "role", "itemprop") and v for w in NAME.findall(re.sub("([a-z])([A-Z])", r"\1 \2", v).lower()))
        parent = self.open[-1]
        above = self.blocks[parent]
        if above.wrapped and tag in CONTENT_TAGS:
            while self.blocks[parent].hidden:
                parent = self.blocks[parent].parent
            above = self.blocks[parent]
        hidden = above.hidden or tag in HIDDEN
        self.blocks.append(Block(tag, words, parent, hidden, hidden and tag not in HIDDEN - WRAPPERS and above.wrapped == above.hidden))
        self.open.append(len(self.blocks) - 1)
        self.held[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in INLINE and tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in INLINE or tag in VOID:
            if tag == "a":
                self.link = False
            return
        self.link = False
        if self.held[tag] <= 0:
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.blocks[self.open[i]].tag == tag:
                self.close(i)
                return

    def handle_data(self, data):
        at = self.open[-1]
        block = self.blocks[at]
        if block.hidden:
            return
        self.runs.append([at, data, False])
        n = len(data.strip())
        block.chars += n
        if self.link:
            block.linked += n


def parse(html: str | None) -> Blocks:
    out = Blocks()
    if html:
        out.feed(html)
    return out


def features(block: Block) -> list[str]:
    out = [f"tag:{block.tag}", *(f"word:{w}" for w in sorted(block.words))]
    if block.chars:
        out += [f"size:{sum(block.chars >= x for x in (40, 120, 400))}", f"link:{int(block.linked / block.chars * 2.99)}"]
    return out


def edge(parent: Block, child: Block) -> str:
    """Kind of an edge: below the page itself, to a part that its author named, or to any other part."""
    if parent.tag in ("#page", "html", "body"):
        return "root"
    return "named" if child.tag in NAMED_TAGS or child.words & NAMED_WORDS else "part"


@dataclass
class PageModel:
    """Log-potentials: ``unary[feature]`` is the log ratio content to other; ``pair[edge][parent state][child state]``."""

    unary: dict[str, float]
    pair: dict[str, tuple[tuple[float, float], tuple[float, float]]]

    def marginals(self, blocks: list[Block]) -> list[float]:
        """P(content) of every block: sums of products, first from the leaves up, then from the page down."""
        n = len(blocks)
        own = []
        for b in blocks:
            s = max(-6.0, min(6.0, sum(self.unary.get(f, 0.0) for f in features(b))))
            own.append((1.0, math.exp(s)))
        up = [list(x) for x in own]
        sent = [(1.0, 1.0)] * n
        for i in range(n - 1, 0, -1):  # a child comes after its parent
            b = blocks[i]
            t = self.pair[edge(blocks[b.parent], b)]
            total = up[i][0] + up[i][1]
            a = (up[i][0] / total, up[i][1] / total)
            sent[i] = (t[0][0] * a[0] + t[0][1] * a[1], t[1][0] * a[0] + t[1][1] * a[1])
            up[b.parent][0] *= sent[i][0]
            up[b.parent][1] *= sent[i][1]
            scale = up[b.parent][0] + up[b.parent][1]
            up[b.parent][0] /= scale
            up[b.parent][1] /= scale
        belief = [None] * n
        for i, b in enumerate(blocks):
            if i == 0:
                both = (up[0][0], up[0][1])
            else:
                p = belief[b.parent]
                out = (p[0] / sent[i][0], p[1] / sent[i][1])  # what the parent holds without this child
                t = self.pair[edge(blocks[b.parent], b)]
                down = (out[0] * t[0][0] + out[1] * t[1][0], out[0] * t[0][1] + out[1] * t[1][1])
                both = (up[i][0] * down[0], up[i][1] * down[1])
            total = both[0] + both[1]
            belief[i] = (both[0] / total, both[1] / total)
        return [b[1] for b in belief]


def weak_labels(blocks: list[Block]) -> list[int] | None:
    """1 inside an article or main element, but not in parts of it that name themselves otherwise; None if a page has neither."""
    if not any(b.tag in CONTENT_TAGS for b in blocks):
        return None
    out = []
    for b in blocks:
        above = out[b.parent] if b.parent >= 0 else 0
        other = b.hidden or b.tag in OTHER_TAGS or bool(b.words & set(OTHER_WORDS))
        inside = b.tag in CONTENT_TAGS or above == 1
        below_other = b.parent >= 0 and out[b.parent] == -1
        out.append(-1 if other or below_other else int(inside))
    return [max(0, x) for x in out]


def train_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> PageModel:
    """Potentials from counts over pages that mark their article (weak labels), at most about ``sample_pages`` of them.

    Names that authors use count as observations made before, and so do paragraphs and lists of unnamed parts, so that a page
    of another make is judged as well. Counts are summed by Spark; the sample bounds what reaches the driver.
    """
    ship(pages.sparkSession)
    total = pages.count()
    key = F.xxhash64(F.col(id_col).cast("string"), F.col(html_col), F.lit(29))
    kept = pages.select(F.col(html_col).alias("_html"), F.pmod(key, F.lit(1 << 30)).alias("h"))
    kept = kept.where(F.col("h") < int(min(1.0, sample_pages / max(1, total)) * (1 << 30))).select("_html")

    def count(batches):
        for batch in batches:
            sums: dict[str, int] = {}
            for html in batch.column("_html").to_pylist():
                blocks = parse(html).blocks
                labels = weak_labels(blocks)
                if labels is None:
                    continue
                for b, y in zip(blocks, labels):
                    keys = [f"{y}|{f}" for f in features(b)] + [f"state|{y}"]
                    if b.parent >= 0:
                        keys.append(f"pair|{edge(blocks[b.parent], b)}|{labels[b.parent]}|{y}")
                    for k in keys:
                        sums[k] = sums.get(k, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())], ["key", "n"])

    n = {r["key"]: float(r["n"]) for r in kept.mapInArrow(count, "key string, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()}
    states = [n.get("state|0", 0.0) + 1, n.get("state|1", 0.0) + 1]
    named = {f"word:{w}": (0, PRIOR) for w in OTHER_WORDS} | {f"tag:{t}": (0, PRIOR) for t in OTHER_TAGS}
    named |= {f"word:{w}": (1, PRIOR / 4) for w in CONTENT_WORDS} | {f"tag:{t}": (1, PRIOR) for t in CONTENT_TAGS}
    seen = {k.split("|", 1)[1] for k in n if k[0] in "01"} | set(named)
    unary = {}
    for f in seen:
        kind = f.split(":")[0]
        rate = [n.get(f"{y}|{f}", 0.0) / states[y] * 1000 for y in (0, 1)]
        if f in named:
            rate[named[f][0]] += named[f][1] * 5
            if kind == "word" or f"0|{f}" not in n and f"1|{f}" not in n:
                rate[1 - named[f][0]] *= 0.1
        # what is common in either state, such as p or div, is weak evidence outside the pages of the sample
        smooth = 500.0 if f not in named else 2.0
        unary[f] = max(-5.0, min(5.0, math.log((rate[1] + smooth) / (rate[0] + smooth))))
    pair = {}
    for e, base in (("root", ((30.0, 30.0), (30.0, 30.0))), ("named", ((70.0, 30.0), (50.0, 50.0))), ("part", ((97.0, 3.0), (3.0, 97.0)))):
        rows = []
        for a in (0, 1):
            c = [n.get(f"pair|{e}|{a}|{y}", 0.0) for y in (0, 1)]
            size = sum(c) or 1.0
            c = [x / size * 100 for x in c]
            rows.append(tuple((c[y] + 3 * base[a][y]) / sum(c[z] + 3 * base[a][z] for z in (0, 1)) for y in (0, 1)))
        pair[e] = tuple(rows)
    return PageModel(unary, pair)


def page_text(html: str | None, model: PageModel, least: float = 0.5) -> str:
    page = parse(html)
    if not page.runs:
        return ""
    belief = model.marginals(page.blocks)
    parts, now = [], None
    for at, data, breaks in page.runs:
        if at != now or breaks:
            parts.append((at, []))
            now = at
        parts[-1][1].append(data)
    texts = (" ".join("".join(p).split()) for at, p in parts if belief[at] >= least)
    return " ".join(t for t in texts if t)


def extract_text(pages: DataFrame, model: PageModel, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page: the texts of blocks whose marginal for content is at least one half.

    Character references are decoded, white space inside a block becomes one blank, blocks are joined by one blank in page
    order. Null and empty pages and pages without content have empty text. Elements left open end with the element around them, and those whose
    end tag HTML lets authors leave out end where the next one begins. Forms, buttons and the like are dropped, but for an article or main element inside;
    a tag cut off at the end is dropped. One pass without shuffle. Repeated rows and null ids each get a row.
    """
    ship(pages.sparkSession)
    kept = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("_html"))
    types = dict(kept.dtypes)

    def run(batches):
        for batch in batches:
            texts = [page_text(x, model) for x in batch.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return kept.mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
