"""Main text of web pages by tag-path ratios.

A page is read as a sequence of text nodes, each with its path of tags from the root; tags that
only mark up running text do not count. For every path the text length and the punctuation per
node are summed up. Both ratios are smoothed over the nodes in page order, and a node's own and
smoothed ratios are fused by their product. A path's score is the mean of its nodes; class names
and forms that speak of furniture make a path of their own and weigh on its score, where an element
holds no article or main element, and stands beside one or has less than ``SOFT_SHARE`` of the text
around it. Paths above a share of the page's best are content.

The article is the article or main element around all content, else the smallest element that
holds all of it and the title above it. Its blocks on content paths are the main text, and with
them the short ones that belong to these: whatever stands in an element that holds content (lists,
captions and quotations count as part of the element around them), and headings of what follows.
Elements within the article without any content path are left out, as are tags and roles that mark
navigation, notices, adverts or asides, and outside the article blocks that consist of links.

Parsing is forgiving: end tags may be missing, wrongly nested or cut off.
"""

from __future__ import annotations

import html as html_entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import column

SMOOTHING = (0.25, 0.5, 0.25)
PATH_SHARE = 0.2  # of the best fused ratio
LINK_SHARE = 0.5
SOFT_SHARE = 0.5  # of the text in the article or page around
NAME_WEIGHT = 0.01  # of the score of what is named like furniture

# The elements of HTML by how they are read.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style template iframe textarea title object select annotation annotation-xml".split())
# Read inside an article, left out elsewhere.
_EMBEDDED = frozenset("noscript svg math".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var wbr "
    "math semantics mrow mi mn mo ms mtext msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle mspace "
    "mpadded mphantom menclose mmultiscripts mprescripts none noscript tspan".split()
)
_FURNITURE = frozenset("head nav footer aside button dialog menu datalist".split())
_SOFT = frozenset("form fieldset".split())
_FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split()
)
_FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie "
    "cookies consent gdpr notice notices alert newsletter subscribe subscription signup sidebar aside menu "
    "nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar comment comments "
    "commentlist disqus reply replies respond share sharing social related recommended popup modal overlay "
    "widget pagination pager login search form".split()
)
# Beside these a word says how the page is laid out: no-sidebar, comments-open, content-sidebar-wrap.
_STATE_WORDS = frozenset("no has with without open closed layout content".split())
_NEVER_FURNITURE = frozenset("html body article main".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Parts of the element around them rather than elements on their own.
_PARTS = _HEADINGS | frozenset(
    "p li ul ol dl dt dd table caption colgroup thead tbody tfoot tr td th blockquote pre figure figcaption picture "
    "details summary header hgroup address center svg g text noscript".split()
)
_CLOSED_BY_BLOCK = frozenset(["p"])
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
}
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*(?:>|$)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|$)"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|$)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_PUNCTUATION = re.compile(r"[.,;:!?…。、，；：！？]")


class _Element:
    __slots__ = (
        "tag", "parent", "furniture", "link", "path", "article", "scope", "soft", "block", "size", "holds", "spoken",
        "named", "chosen", "inside",
    )

    def __init__(self, tag: str, parent: _Element | None, furniture: bool, soft: bool = False, path: int = 0) -> None:
        self.tag, self.parent = tag, parent
        self.furniture = furniture or (parent is not None and parent.furniture)
        self.link = tag == "a" or (parent is not None and parent.link)
        self.article = tag in ("article", "main") or (parent is not None and parent.article)
        self.path = path
        # The nearest article, main element or page, and the nearest element that is not running text.
        self.scope = self if parent is None or tag in ("article", "main") else parent.scope
        self.block = self if parent is None or tag not in _INLINE else parent.block
        self.soft = soft  # may be furniture
        self.size = 0  # characters held
        self.holds = self.spoken = False  # an article or main element, and one with text
        self.named = self.chosen = self.inside = False


class _Tree:
    """The elements of one page, parents first, and the one that is open."""

    def __init__(self) -> None:
        self.at = _Element("", None, False)
        self.elements = [self.at]
        self._paths: dict[tuple[int, str], int] = {}
        self._open: Counter[str] = Counter()

    def add(self, tag: str, furniture: bool, soft: bool) -> None:
        path = self.at.path
        if tag not in _INLINE:
            path = self._paths.setdefault((path, tag), len(self._paths) + 1)
        self.at = _Element(tag, self.at, furniture, soft, path)
        self.elements.append(self.at)
        self._open[tag] += 1

    def leave(self, e: _Element) -> None:
        """Close ``e`` and all that is open in it."""
        while self.at is not e.parent:
            self._open[self.at.tag] -= 1
            self.at = self.at.parent

    def close(self, names: set[str] | frozenset[str], stop: frozenset[str]) -> None:
        """Close the nearest open element of these names unless one of ``stop`` is nearer."""
        if not any(self._open[n] for n in names):
            return
        e = self.at
        while e.parent is not None and e.tag not in names:
            if e.tag in stop:
                return
            e = e.parent
        if e.parent is not None:
            self.leave(e)

    def weigh(self) -> None:
        """Sizes from the leaves up, then what is named like furniture from the root down."""
        for e in reversed(self.elements[1:]):
            above = e.parent
            above.size += e.size
            article = e.tag in ("article", "main") and not e.furniture
            above.holds |= e.holds or article
            above.spoken |= e.spoken or (article and e.size > 0)
        for e in self.elements[1:]:
            e.named = e.parent.named
            if e.soft and not e.holds:
                s = e.parent.scope
                # Beside an article an element outside it is no wrapper, whatever its share.
                e.named |= (s.parent is None and s.spoken) or e.size < SOFT_SHARE * s.size


def _is_furniture(tag: str, rest: str, parent: _Element) -> tuple[bool, bool]:
    """Whether an element is furniture for certain, and whether it may be."""
    if tag in _FURNITURE or (tag == "header" and not parent.article) or (tag in _EMBEDDED and not parent.article):
        return True, False
    soft = tag in _SOFT
    if not rest or tag in _NEVER_FURNITURE:
        return False, soft
    for name, *values in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true" and tag not in _EMBEDDED):
            return True, False
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True, False
        if name == "role" and value.strip() in _FURNITURE_ROLES:
            return True, False
        if name == "role" and value.strip() == "form":
            soft = True
        if name in ("class", "id") and not soft:
            soft = any(
                not _FURNITURE_WORDS.isdisjoint(w) and _STATE_WORDS.isdisjoint(w)
                for w in (re.findall(r"[a-z]+", token) for token in value.split())
            )
    return False, soft


def _blocks(page: str) -> tuple[_Tree, list[tuple[_Element, str, int]]]:
    """Every block outside certain furniture: its element, its text and the characters in links."""
    tree = _Tree()
    out: list[tuple[_Element, str, int]] = []
    parts: list[str] = []
    owner = tree.at
    linked = 0

    def flush() -> None:
        nonlocal parts, linked
        text = _SPACE.sub(" ", html_entities.unescape("".join(parts))).strip()
        if text:
            out.append((owner, text, linked))
            owner.size += len(text)
        parts, linked = [], 0

    def say(text: str) -> None:
        nonlocal owner, linked
        if tree.at.furniture or not text:
            return
        if not parts:
            owner = tree.at.block
        parts.append(text)
        if tree.at.link:
            linked += len(text.strip())

    position, size = 0, len(page)
    while position < size:
        begin = page.find("<", position)
        if begin < 0:
            say(page[position:])
            break
        say(page[position:begin])
        m = _TOKEN.match(page, begin)
        if m is None:
            say("<")
            position = begin + 1
            continue
        position = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        block = tag not in _INLINE
        if block:
            flush()
        if m["end"] or m["end2"]:
            if tag == "br":
                say(" ")
            elif block or tree.at.tag in _INLINE:
                tree.close({tag}, frozenset() if block else frozenset(["p", "div", "td", "li", "article", "section"]))
            continue
        rest = m["rest"] if m["tag"] else m["rest2"]
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|$)", re.I).search(page, position)
            if not (rest or "").rstrip().endswith("/"):
                position = end.end() if end else size
            continue
        if tag in _VOID:
            if tag in ("br", "wbr"):
                say(" " if tag == "br" else "")
            continue
        if block:
            # A block ends an open paragraph and the inline elements left open in it.
            e = tree.at.block
            if e.tag in _CLOSED_BY_BLOCK:
                tree.leave(e)
            if tag in _CLOSES:
                tree.close(_CLOSES[tag], frozenset(["ul", "ol", "dl", "table", "select"]))
        tree.add(tag, *_is_furniture(tag, rest or "", tree.at))
    flush()
    tree.weigh()
    return tree, out


def _around(elements: list[_Element]) -> _Element:
    """The smallest element that holds all of these."""
    chain: list[_Element] = []
    e: _Element | None = elements[0]
    while e is not None:
        chain.append(e)
        e = e.parent
    # Where the way up from an element meets the chain; ways already gone are not gone again.
    height = {id(x): k for k, x in enumerate(chain)}
    top = 0
    for e in elements[1:]:
        way = []
        while id(e) not in height:
            way.append(id(e))
            e = e.parent
        height.update(dict.fromkeys(way, height[id(e)]))
        top = max(top, height[id(e)])
    return chain[top]


def _path_scores(blocks: list[tuple[_Element, str, int]]) -> np.ndarray:
    """The score of every block's path, as a share of the best."""
    paths: dict[tuple[int, bool], int] = {}
    which = np.array([paths.setdefault((e.path, e.named), len(paths)) for e, _, _ in blocks])
    weight = np.array([NAME_WEIGHT if named else 1.0 for _, named in paths])
    length = np.array([len(t) for _, t, _ in blocks], float)
    marks = np.array([len(_PUNCTUATION.findall(t)) for _, t, _ in blocks], float)
    nodes = np.bincount(which)
    fused = np.ones(len(blocks))
    for values in (length, marks + 1):
        own = (np.bincount(which, weights=values) / nodes)[which]
        series = np.pad(own, 1, mode="edge")
        smooth = sum(w * series[k : k + len(blocks)] for k, w in enumerate(SMOOTHING))
        fused *= np.sqrt(own * smooth)
    score = weight * np.bincount(which, weights=fused) / nodes
    return (score / score.max())[which]


def main_text(page: str | None) -> str:
    """The article of one page as text; empty if there is none."""
    tree, found = _blocks(page or "")
    blocks = [b for b in found if b[2] <= LINK_SHARE * len(b[1])]
    blocks = blocks or [b for b in found if b[0].article]
    if not blocks:
        return ""
    content = _path_scores(blocks) >= PATH_SHARE
    chosen = [e for (e, _, _), c in zip(blocks, content) if c]
    for e in chosen:
        e.chosen = True
    article = _around(chosen)
    first = int(np.flatnonzero(content)[0])
    title = next((e for e, _, _ in reversed(blocks[:first]) if e.tag == "h1" and not e.named), None)
    whole = article
    while whole is not None and whole.tag not in ("article", "main"):
        whole = whole.parent
    if whole is not None:
        article = whole
    elif title is not None:
        with_title = _around([article, title])
        if with_title.tag not in ("", "html", "body"):
            article = with_title
    while article.tag in _PARTS and article.parent is not None:
        article = article.parent

    passed = {id(b) for b, c in zip(blocks, content) if c}
    taken = {id(b) for b in blocks}
    for e in reversed(tree.elements[1:]):
        e.parent.chosen |= e.chosen
    for e in tree.elements:
        e.inside = e is article or (e.parent is not None and e.parent.inside)
    links = article.tag not in ("", "html", "body")
    kept: list[str] = []
    ahead = False  # the block that a heading stands above is content
    for b in reversed(found):
        e, text, _ = b
        heading = e.tag in _HEADINGS
        keep = id(b) in passed
        if not keep and not e.named and (links or id(b) in taken):
            around = e
            while around.tag in _PARTS and around.parent is not None:
                around = around.parent
            keep = around.chosen or (heading and ahead)
        if not heading and e.inside:
            ahead = id(b) in passed
        if (keep and e.inside) or e is title:
            kept.append(text)
    return " ".join(reversed(kept))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row; n_chars counts code points.

    A null or empty page, and one without text outside furniture, has an empty text. Long and
    deeply nested pages are read whole, in time and memory that grow with their length. Repeated
    rows stay; null ids and addresses are passed on; other columns are left out; of equal scores
    all paths count.
    """
    narrow = pages.select(F.col(id_col), F.col(url_col), F.col(html_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py()) for p in column(batch, html_col)]
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, id_col),
                    column(batch, url_col),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=[id_col, url_col, "text", "n_chars"],
            )

    schema = T.StructType(
        [*narrow.schema[:2], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )
    return narrow.mapInArrow(run, schema)
