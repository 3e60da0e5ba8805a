"""Main text of web pages from parser events and text-to-tag ratios.

The standard library's parser streams a page's events once.  Text gathers in lines, one a
block element, each with the number of tags met on its way and the characters of it that
are link text.  The ratio of characters to tags, damped where links or side elements
dominate and smoothed over neighbouring lines by a Gaussian, is split into two clusters
by their means.  Every line of the upper cluster speaks for the containers it lies in with
its length, every line of the lower one against them, and the container with the highest sum
is the content region; it is widened to a parent as long as that keeps half of the sum and adds no line of links
outside an article or main element.  Where the page has article or main elements with text outside that region, they
are the region, unless they hold little beside it.  Markup is a weak feature on the way (a line in a
menu, footer, advert and the like counts for a tenth) and decides only inside the region,
where such lines are left out; every other line of the region is kept, however short.  A name in
class, id or role counts if it is nothing but such words (site-footer, not alert-story).  Reader comments without
such a name are known by a heading or by their form, see ``remarks``.

Defined cases: null and empty html give an empty text; a page whose elements are not closed is read as far as
it goes, one whose last tag or comment never ends up to there, as in a browser; a page without markup is one line; of
containers with equal sums the first opened, that is the outer one, is taken; very long and
deeply nested pages take time in proportion to their events; repeated rows and other columns
pass through, a column named text is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "head title script style noscript template iframe object svg math canvas audio video nav header footer aside "
    "menu form button select option textarea fieldset dialog datalist".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
#: Blocks of running text: their lines belong to the container around them.
LEAVES = frozenset("address caption dd dt figcaption h1 h2 h3 h4 h5 h6 hgroup legend li p pre summary tr".split())
#: Names in class, id or role that say what an element is for.
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices alert popup modal overlay sidebar sidenav menu menubar nav navbar navigation breadcrumb "
    "breadcrumbs toolbar header masthead footer contentinfo complementary comment comments commentlist disqus reply "
    "replies respond share sharing social related recommended newsletter subscribe signup login widget pagination pager "
    "search skip".split()
)
#: Of those, the ones that count even on an article element.
FOREIGN = frozenset("ad ads advert advertisement sponsored promo comment comments reply related recommended discussion responses reactions".split())
#: What may stand beside such a word in one name (site-footer, comment-list) without making it another thing (alert-story).
PLAIN = frozenset(
    "site page main global top bottom left right upper lower header footer primary secondary list box block container wrapper "
    "wrap outer inner section area bar bars panel row col links link items item posts articles form content js the my is has".split()
)
#: Headings of reader comments, in the languages of the pages.
REMARKS = re.compile(r"(?i)^\W*(\d+\W+)?(reader )?(comments?|discussion|responses|replies|kommentare|diskussion|commentaires|réactions|comentarios)\b.{0,20}$")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup legend dt figcaption summary".split())
#: Blocks that a new one of the first kind closes where they are innermost.
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
WRAPPERS = frozenset("div section body html td".split())
SIDE = 0.1  # what the ratio and the length of a line in a side element count
SHORT = 40  # characters that a line of the lower cluster counts for at least
LINKED = 0.5  # share of link text from which a line is one of links
BACKING = 0.5  # least share of the region's votes that a wider one must keep
REFERENCES = 0.25  # most link lines, as a share of the region, that an article or main element may add
NAME = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")
LEAD = 40  # characters of a line that may name the author of a remark
TAG = re.compile(r"""<[a-zA-Z/!?](?:=\s*+(?:"[^"]*+"|'[^']*+')|[^>])*+>""")
RAW = re.compile(r"<(script|style|textarea|title|iframe|noscript)\b", re.I)


class Block:
    """An open block element, with the inline elements open in it."""

    __slots__ = ("tag", "node", "marked", "foreign", "inline", "counts", "hidden")

    def __init__(self, tag: str, node: int, marked: bool, foreign: bool):
        self.tag, self.node, self.marked, self.foreign = tag, node, marked, foreign
        self.inline: list[tuple[str, bool]] = []  # tag, marked
        self.counts: Counter = Counter()
        self.hidden = 0  # marked inline elements open in it


def side_name(value: str, words: frozenset) -> bool:
    """Whether a name of class, id or role is one of ``words``, or made of them and plain words."""
    for name in value.split():
        parts = [x.lower() for x in NAME.findall(name)]
        if any(x in words for x in parts) and all(x in words or x in NOISE or x in PLAIN or x.isdigit() for x in parts) and parts[0] not in ("has", "is"):
            return True
    return False


def finished(html: str) -> str:
    """The page up to the first tag or comment that never ends, which browsers drop with all behind it.

    Each place is looked at once, so what the parser is given has no open end to look for again and again."""
    at = 0
    while (at := html.find("<", at)) >= 0:
        following = html[at + 1 : at + 2]
        if html.startswith("<!--", at):
            end = at + 5 if html.startswith(("<!-->", "<!--->"), at) else html.find("-->", at + 4) + 3
            if end < at + 5:
                return html[:at]
            at = end
        elif following.isascii() and (following.isalpha() or following in ("/", "!", "?")):
            found = TAG.match(html, at)
            if not found:
                return html[:at]
            raw = RAW.match(html, at)
            at = found.end()
            if raw and html[at - 2] != "/":
                close = re.compile(rf"</{raw[1]}\b", re.I).search(html, at)
                if not close:
                    return html[: found.start()]
                at = close.start()
        else:
            at += 1
    return html


class Lines(HTMLParser):
    """Collects (text, tags, link characters, node, marked, element) for each line.

    Nodes are the containers by number in the order they open, the page being 0, with the
    number of their parent and the number at which they end.  All work on an event is
    constant, or paid for by the elements it closes."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, bool, str]] = []
        self.kinds, self.parents, self.ends = [""], [0], [0]
        self.open = [Block("", 0, False, False)]
        self.names: Counter = Counter()  # of open blocks
        self.marks = self.linked = 0
        self.wrappers: list[Block] = []  # open ones in which an article would be no side matter
        self.text: list[str] = []
        self.tags = self.link_chars = 0

    def flush(self) -> None:
        words = "".join(self.text).split()
        if words:
            line = " ".join(words)
            self.lines.append((line, self.tags, min(self.link_chars, len(line)), self.open[-1].node, self.marks > 0, self.open[-1].tag))
            self.tags = 0
        self.text, self.link_chars = [], 0

    def pop_inline(self) -> str:
        block = self.open[-1]
        tag, marked = block.inline.pop()
        block.counts[tag] -= 1
        self.marks -= marked
        block.hidden -= marked
        self.linked -= tag == "a"
        return tag

    def pop_block(self) -> str:
        block = self.open[-1]
        while block.inline:
            self.pop_inline()
        self.open.pop()
        self.names[block.tag] -= 1
        self.marks -= block.marked
        if self.wrappers and self.wrappers[-1] is block:
            self.wrappers.pop()
        if block.tag not in LEAVES:
            self.ends[block.node] = len(self.kinds)
        return block.tag

    def judge(self, tag: str, attrs: list) -> tuple[bool, bool]:
        """Whether markup calls an element a side one, and whether by a name that never holds the article."""
        if tag in ("html", "body", "main"):
            return False, False
        if tag in DROPPED:
            return not (tag == "header" and self.names["article"]), False  # the heading of an article is part of it
        values = []
        for key, value in attrs:
            if key == "hidden":
                return True, False
            if key in ("class", "id", "role") and value:
                values.append(value)
        if any(side_name(v, FOREIGN) for v in values):
            return True, True
        return tag != "article" and any(side_name(v, NOISE) for v in values), False

    def pardon(self) -> None:
        """A wrapper whose name sounds like a side element but that holds the article isn't one."""
        self.flush()
        for block in self.wrappers:
            block.marked = False
        self.marks -= len(self.wrappers)
        self.wrappers = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        if tag == "br":
            self.text.append(" ")
            return
        if tag not in BLOCKS:
            if tag in VOID:
                return
            marked = self.judge(tag, attrs)[0]
            self.open[-1].hidden += marked
            self.open[-1].inline.append((tag, marked))
            self.open[-1].counts[tag] += 1
            self.marks += marked
            self.linked += tag == "a"
            return
        self.flush()
        if self.open[-1].tag == "p":
            self.pop_block()
        while self.open[-1].tag in CLOSED_BY.get(tag, ()):
            self.pop_block()
        if tag in VOID:
            return
        marked, foreign = self.judge(tag, attrs)
        if tag in ("article", "main") and not marked and self.wrappers:
            self.pardon()
        around = self.open[-1].node
        self.open.append(Block(tag, around if tag in LEAVES else len(self.kinds), marked, foreign))
        if tag not in LEAVES:
            self.parents.append(around)
            self.kinds.append(tag)
            self.ends.append(0)
        self.names[tag] += 1
        self.marks += marked
        if marked and not foreign and tag in WRAPPERS:
            self.wrappers.append(self.open[-1])

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            if self.names[tag] > 0:
                self.flush()
                while self.pop_block() != tag:
                    pass
        elif self.open[-1].counts[tag] > 0:  # a stray inline end does not close blocks
            while self.pop_inline() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if self.open[-1].hidden:
            return self.text.append(" ")  # a button, say, inside a block: the block goes on behind it
        self.text.append(data)
        if self.linked > 0:
            self.link_chars += len(data)

    def close(self) -> None:
        super().close()
        self.flush()
        while len(self.open) > 1:
            self.pop_block()
        self.ends[0] = len(self.kinds)


def smooth(values: np.ndarray, sigma: float) -> np.ndarray:
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    padded = np.pad(values, reach, mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def border(values: np.ndarray) -> float:
    """The value from which the upper one of two clusters begins."""
    low, high = float(values.min()), float(values.max())
    if high - low < 1e-9:
        return low
    for _ in range(20):
        upper = values >= (low + high) / 2
        means = float(values[~upper].mean()), float(values[upper].mean())
        if means == (low, high):
            break
        low, high = means
    return (low + high) / 2


def dense(ratios: np.ndarray, sizes: np.ndarray, sigma: float) -> np.ndarray:
    """The lines of the upper cluster; a long line is not drawn out of it by its neighbours."""
    smoothed = smooth(ratios, sigma)
    least = border(smoothed)
    return (smoothed >= least) | ((ratios >= least) & (sizes >= 2 * SHORT))


def remarks(page: Lines) -> set[int]:
    """Containers of reader comments that no name gives away: one that begins with such a heading, or two or more
    containers alike, each of a short line without an end mark (an author) and longer ones, behind at least as much text."""
    sizes = np.cumsum([0] + [len(x[0]) for x in page.lines])
    starts, ends = [len(page.lines)] * len(page.kinds), [-1] * len(page.kinds)
    for i, x in enumerate(page.lines):
        starts[x[3]], ends[x[3]] = min(starts[x[3]], i), i
    for node in range(len(starts) - 1, 0, -1):  # children have higher numbers
        parent = page.parents[node]
        starts[parent], ends[parent] = min(starts[parent], starts[node]), max(ends[parent], ends[node])
    found = set()
    children: dict[int, list[int]] = {}
    for node in range(1, len(starts)):
        if ends[node] >= 0:
            children.setdefault(page.parents[node], []).append(node)

    def behind(node: int) -> bool:
        before = sizes[starts[node]]
        return before >= sizes[ends[node] + 1] - before

    def authored(node: int) -> bool:
        first, last = page.lines[starts[node]], page.lines[ends[node]]
        name = first[0]
        named = first[5] not in HEADINGS and len(name) <= LEAD and len(name.split()) <= 4 and name[-1] not in ".?!:;,"
        return named and ends[node] > starts[node] and len(last[0]) > len(name) and page.kinds[node] in ("div", "li", "section", "article", "blockquote")

    for node in range(1, len(starts)):
        if ends[node] < 0 or not behind(node):
            continue
        first = page.lines[starts[node]]
        own = children.get(node, [])
        alike = sum(authored(c) for c in own)
        if REMARKS.match(first[0]) or (alike >= 2 and alike == len(own) and len({page.kinds[c] for c in own}) == 1):
            found.add(node)
    return found


def content_region(page: Lines, upper: np.ndarray) -> int:
    """The node for which the lines of the upper cluster speak most."""
    node = np.array([x[3] for x in page.lines])
    size = np.array([len(x[0]) for x in page.lines])
    linked = np.array([x[2] >= LINKED * len(x[0]) for x in page.lines])
    side = np.array([x[4] for x in page.lines])
    parents = np.array(page.parents)

    def totals(values: np.ndarray) -> list:
        own = np.bincount(node, weights=values, minlength=len(parents)).tolist()
        for child in range(len(own) - 1, 0, -1):  # children have higher numbers
            own[page.parents[child]] += own[child]
        return own

    votes = totals(np.where(upper, size * np.where(side, SIDE, 1), -np.maximum(size, SHORT)))
    dense_in, links_in, plain_in = totals(upper), totals(size * (linked & ~side)), totals(size * (~linked & ~side))
    able = [i for i, n in enumerate(dense_in) if n]
    at = region = max(able, key=votes.__getitem__) if able else 0
    while at:  # wider as long as no menu comes in
        parent = page.parents[at]
        spare = REFERENCES * plain_in[region] if page.kinds[parent] in ("article", "main") else 0
        if links_in[parent] - links_in[at] > spare or votes[parent] < BACKING * votes[region]:
            break
        at = parent
    return at


def regions(page: Lines, upper: np.ndarray) -> list[int]:
    """The containers whose lines are the text: article and main elements that hold text, if that is not little beside
    what the clusters chose, else the region of the clusters."""
    region = content_region(page, upper)
    around = [0] * len(page.kinds)  # the innermost article or main element
    for node in range(1, len(around)):
        around[node] = node if page.kinds[node] in ("article", "main") else around[page.parents[node]]
    plain: dict[int, int] = {}
    for x in page.lines:
        if not x[4] and around[x[3]]:
            plain[around[x[3]]] = plain.get(around[x[3]], 0) + len(x[0])
    chosen = sum(len(x[0]) for x in page.lines if not x[4] and region <= x[3] < page.ends[region])
    if not plain or 5 * sum(plain.values()) < chosen or any(region <= n < page.ends[region] for n in plain):
        return [region]
    most = max(plain.values())
    return [n for n, size in plain.items() if 10 * size >= most]


def main_text(html: str | None, sigma: float = 1.0) -> str:
    page = Lines()
    page.feed(finished((html or "").replace("<![", "<!")))  # marked sections are comments to a browser
    page.close()
    hidden = remarks(page) if page.lines else set()
    if hidden:
        covered = [False] * len(page.kinds)
        for n in range(1, len(page.kinds)):  # parents come first
            covered[n] = n in hidden or covered[page.parents[n]]
        page.lines = [(*x[:4], x[4] or covered[x[3]], x[5]) for x in page.lines]
    if all(x[4] for x in page.lines):
        return ""
    ratios = np.array([np.log1p((len(x[0]) - x[2]) / max(1, x[1])) * (SIDE if x[4] else 1.0) for x in page.lines])
    within = regions(page, dense(ratios, np.array([len(x[0]) for x in page.lines]), sigma))
    inside = np.zeros(len(page.kinds) + 1, dtype=int)
    for n in within:
        inside[n] += 1
        inside[page.ends[n]] -= 1
    inside = np.cumsum(inside) > 0
    return "\n".join(x[0] for x in page.lines if not x[4] and inside[x[3]])


def extract_text(pages: DataFrame) -> DataFrame:
    """``pages`` with the column text made from html."""

    @F.pandas_udf("string")
    def read(html: pd.Series) -> pd.Series:
        return pd.Series([main_text(x) for x in html], dtype=object)

    return pages.withColumn("text", read("html"))


def op7_html_text(pages: DataFrame) -> DataFrame:
    out = extract_text(pages.select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
