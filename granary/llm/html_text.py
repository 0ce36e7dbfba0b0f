"""Main text of web pages by text-to-tag ratios of lines, smoothed and clustered.

The standard library's streaming parser turns a page into lines, one for each block of text, each with the characters outside
links and the tags met in its block. The logarithms of their ratios are smoothed by a Gaussian along the page. Lines of links and
those under an element whose name or class says menu, footer, comments and so on then lose a constant, and a threshold
between two clusters parts the page: lines above it are the core. The innermost element that holds the whole core is the
content region. Its lines are the text, but for blocks without any core line that are lists of links or say by their name that
they are no article, and for containers before and after the core that hold none of it; headings right before the region join it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import by_bytes
from .common import col, extended, fresh, map_arrow, pages

# Element names and words of class, id and role. Fixed values.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
#: What a browser doesn't show as text.
HIDDEN = frozenset("head title script style noscript template iframe object svg canvas select option textarea dialog datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("article main section div body td th aside nav form header footer ul ol dl table fieldset details".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements and words that say no article. A name of several words is judged by its last one that isn't general.
MARKS = frozenset("nav menu footer aside form button".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert sidebar comment comments respond reply replies disqus menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar share sharing social related recommended newsletter subscribe subscription popup modal login search pagination pager contentinfo complementary".split()
)
GENERAL = frozenset("area bar block body box buttons container content form group holder inner item items left link links list outer right section signup slot text thread top bottom unit widget wrap wrapper".split())
NEGATION = frozenset("no not has with without hide is".split())
#: Elements whose end the start of others implies, as long as none of those that bound the search is in between.
IMPLIED = {"p": BLOCKS - {"html", "body", "head"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
BOUNDS = CONTAINERS - {"td", "th"}
#: Lines of the Gaussian's standard deviation.
SIGMA = 1.0
#: What the smoothed logarithm of a marked line, or one of links, loses (down to 0).
MARK = 4.0
#: The ratio beyond which more text isn't more of an article.
MOST_RATIO = 100.0
#: Two clusters are told apart from this distance of their means on; else lines above FLOOR are the core.
APART = 1.0
FLOOR = 0.4
#: A mark isn't believed where all unmarked text together is less than this share of the page's.
BELIEVED = 0.1
#: (least links, most characters outside them for each link) of lines and blocks that are lists of links.
LINKED = ((2, 3), (3, 6))
_WORD = re.compile(r"[a-z]+")


def says_no_article(names: str) -> bool:
    """Whether a name of a class, id or role does: site-footer and comment-list do; side-effects, has-sidebar and entry-header don't."""
    for name in names.lower().split():
        words = _WORD.findall(name)
        while len(words) > 1 and words[-1] in GENERAL:
            words.pop()
        if words and words[-1] in WORDS and words[0] not in NEGATION and not (words[-1] == "header" and len(words) > 1 and words[0] not in ("site", "page", "main", "top", "global")):
            return True
    return False


class Block:
    """An element that breaks lines, with what its lines add up to."""

    __slots__ = ("parent", "tag", "marked", "core", "links", "outside", "lines")

    def __init__(self, parent: int, tag: str, marked: bool):
        self.parent, self.tag, self.marked = parent, tag, marked
        self.core = self.links = self.outside = self.lines = 0


class Line:
    """A block's run of text, its characters outside links, links, tags, and the block."""

    __slots__ = ("text", "outside", "links", "tags", "block", "marked", "core")

    def __init__(self, text: str, outside: int, links: int, tags: int, block: int):
        self.text, self.outside, self.links, self.tags, self.block = text, outside, links, tags, block
        self.marked = self.core = False


def linked(x: Line | Block) -> bool:
    """Whether a line or block is a list of links."""
    return any(x.links >= n and x.outside < around * x.links for n, around in LINKED)


class Lines(HTMLParser):
    """Collects the lines of a page and the tree of its blocks."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks = [Block(-1, "", False)]
        self.stack: list[tuple[str, int]] = [("", 0)]  # name, block
        self.open: dict[str, int] = {}
        self.hidden = 0
        self.parts: list[str] = []
        self.outside = self.links = self.tags = 0
        self.lines: list[Line] = []

    def end_line(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.lines.append(Line(text, self.outside, self.links, self.tags, self.stack[-1][1]))
                self.outside = self.links = self.tags = 0
            self.parts = []

    def close_from(self, k: int) -> None:
        for name, _ in self.stack[k:]:
            self.open[name] -= 1
            self.hidden -= name in HIDDEN
        del self.stack[k:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end_line()
            closed = [name for name, by in IMPLIED.items() if tag in by and self.open.get(name)]
            k = len(self.stack) - 1
            while closed and k and self.stack[k][0] not in BOUNDS:
                if self.stack[k][0] in closed:
                    self.close_from(k)
                    closed = [name for name in closed if self.open[name]]
                k -= 1
            self.tags = 0
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        self.links += tag == "a"
        if tag in VOID:
            return
        block = self.stack[-1][1]
        if tag in BLOCKS:
            marked = tag in MARKS or any(name in ("class", "id", "role") and value and says_no_article(value) for name, value in attrs)
            self.blocks.append(Block(block, tag, marked and tag not in ("html", "body", "main")))
            block = len(self.blocks) - 1
        self.stack.append((tag, block))
        self.open[tag] = self.open.get(tag, 0) + 1
        self.hidden += tag in HIDDEN

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()
            self.tags = 0
        if not self.open.get(tag):
            return
        for k in range(len(self.stack) - 1, 0, -1):
            name = self.stack[k][0]
            if name == tag:
                self.close_from(k)
                return
            if name in CONTAINERS and tag not in CONTAINERS and tag not in ("html", "body"):
                return

    def handle_data(self, data: str) -> None:
        if self.hidden:
            return
        self.parts.append(data)
        if not self.open.get("a"):
            self.outside += len(data) - data.count(" ") - data.count("\n")


def ratios(lines: list[Line]) -> list[float]:
    """The logarithm of 1 + characters outside links for each tag, of each line."""
    return [math.log1p(min(MOST_RATIO, x.outside / max(1, x.tags))) for x in lines]


def smooth(values: list[float], sigma: float = SIGMA) -> list[float]:
    """The Gaussian-weighted means along the page; at its ends over what there is."""
    reach = math.ceil(3 * sigma)
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        low, high = max(0, i - reach), min(len(values), i + reach + 1)
        weights = kernel[low - i + reach : high - i + reach]
        out.append(sum(w * v for w, v in zip(weights, values[low:high], strict=True)) / sum(weights))
    return out


def threshold(values: list[float]) -> float:
    """The midpoint of two clusters on a line (two means, from the least and the most); FLOOR if they are one."""
    low, high = min(values), max(values)
    while high > low:
        cut = (low + high) / 2
        lower, upper = [v for v in values if v <= cut], [v for v in values if v > cut]
        new = sum(lower) / len(lower), sum(upper) / len(upper) if upper else high
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2 if high - low >= APART else FLOOR


def mark(parser: Lines) -> None:
    """Says of each line whether a block around it is marked; page-wide marks aren't believed."""
    blocks, lines = parser.blocks, parser.lines
    inside, within = [False] * len(blocks), [False] * len(blocks)
    for k, b in enumerate(blocks):
        if k:
            within[k] = within[b.parent] or b.tag in ("article", "main")
            # a header that heads an article, or a part of one, is none of the page's
            if b.tag == "header" and not within[k] and blocks[b.parent].tag in ("", "html", "body"):
                b.marked = True
            inside[k] = inside[b.parent] or b.marked
    total = sum(x.outside for x in lines)
    if sum(x.outside for x in lines if not inside[x.block]) < BELIEVED * total and any(b.tag in ("form", "header") or not b.marked for b in blocks):
        wide = [0] * len(blocks)
        for x in lines:
            wide[x.block] += x.outside
        for k in range(len(blocks) - 1, 0, -1):
            wide[blocks[k].parent] += wide[k]
        for k, b in enumerate(blocks):
            if b.marked and b.tag not in ("nav", "menu", "footer", "aside") and wide[k] > total / 2:
                b.marked = False
        for k, b in enumerate(blocks):
            inside[k] = bool(k) and (inside[b.parent] or b.marked)
    for x in lines:
        x.marked = inside[x.block]


def region(parser: Lines) -> list[bool]:
    """Whether each line is in the content region; core lines are known."""
    blocks, lines = parser.blocks, parser.lines
    for x in lines:
        b = blocks[x.block]
        b.core += x.core
        b.links += x.links
        b.outside += x.outside
        b.lines += 1
    for k in range(len(blocks) - 1, 0, -1):
        b, up = blocks[k], blocks[blocks[k].parent]
        up.core, up.links, up.outside, up.lines = up.core + b.core, up.links + b.links, up.outside + b.outside, up.lines + b.lines
    cores = [i for i, x in enumerate(lines) if x.core]
    best = 0
    for k, b in enumerate(blocks):
        if b.core == len(cores) and b.tag in CONTAINERS:
            best = k
    inside, gone = [False] * len(blocks), [False] * len(blocks)
    for k, b in enumerate(blocks):
        inside[k] = k == best or (k > 0 and inside[b.parent])
        no_article = not b.core and (b.marked or linked(b))
        gone[k] = k != best and ((k > 0 and gone[b.parent]) or no_article)
    keep = [inside[x.block] and not gone[x.block] and (x.core or not linked(x)) for x in lines]
    if blocks[best].tag not in ("article", "main"):
        # containers right under the region, before and after the core, that hold none of it
        above = list(range(len(blocks)))
        for k, b in enumerate(blocks):
            above[k] = k if k == best or b.parent in (best, -1) else above[b.parent]
        for i in (*range(cores[0]), *range(cores[-1] + 1, len(lines))):
            around = blocks[above[lines[i].block]]
            if keep[i] and above[lines[i].block] != best and around.tag in CONTAINERS and not around.core and blocks[lines[i].block].tag not in HEADINGS:
                keep[i] = False
    first = keep.index(True)
    if blocks[lines[first].block].tag not in HEADINGS:
        for i in range(first - 1, -1, -1):
            x = lines[i]
            if x.marked or gone[x.block]:
                continue
            if blocks[x.block].tag not in HEADINGS:
                break
            keep[i] = True
    return keep


def extract(html: str | None) -> str:
    """The article's blocks, joined by a line feed; '' for null, empty or article-free pages."""
    parser = Lines()
    parser.feed(html or "")
    parser.close()
    parser.end_line()
    lines = parser.lines
    if not lines:
        return ""
    mark(parser)
    score: list[float] = []
    for _, run in groupby(lines, key=lambda x: x.marked):  # a menu isn't lifted by the text beside it
        part = list(run)
        score += [max(0.0, s - MARK * (x.marked or linked(x))) for s, x in zip(smooth(ratios(part)), part, strict=True)]
    least = threshold(score)
    for s, x in zip(score, lines, strict=True):
        x.core = s > least
    if not any(x.core for x in lines):  # no text worth the name: what isn't marked, if anything
        for x in lines:
            x.core = not (x.marked or linked(x))
        if not any(x.core for x in lines):
            return ""
    return "\n".join(x.text for x, kept in zip(lines, region(parser), strict=True) if kept)


def main_text(df: DataFrame, html: str = "html") -> tuple[DataFrame, str]:
    """df and the name of a new column with the main text of each page's whole html.

    Null or empty html gives ''. Memory follows the longest page; rows are independent, so repeated rows get equal texts.
    An empty table gives an empty table; other columns pass through whatever their names.
    """
    (out,) = fresh(df, "text")
    place = df.columns.index(html)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            found = whole.column(place).to_pylist()
            for first, n in by_bytes([len(h or "") for h in found]):
                yield extended(whole.slice(first, n), pa.array([extract(h) for h in found[first : first + n]], type=pa.string()))

    return map_arrow(df, run, [T.StructField(out, T.StringType())]), out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    work, text = main_text(pages(spark, sf_dir).select("page_id", "url", "html"))
    return work.select("page_id", "url", col(text).alias("text"), F.char_length(col(text)).cast("long").alias("n_chars"))
