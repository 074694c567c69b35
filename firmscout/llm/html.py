"""Main text of web pages by tree scoring.

Paragraphs give points for their length and commas to the containers around them, less the farther away these are;
a container's points are discounted by its share of link text. The container with most points is kept, or the whole
article (``article``, else ``main``) it lies in, and those of its siblings that hold enough of their own. Menus, forms,
adverts, notices, comments and the like are cut from the tree before, by tag, role, class and id. Class and id also
name states (``has-sidebar``, ``comments-open``) and stand at containers of the whole page: they cut no element that
holds the article.

One page is one small Python job inside a column function; a page is read once, in time linear in its length.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from itertools import count

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscout.llm.common import picked

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*)|[^=>])*+)(?:>|\Z)"
    r"|</(?![a-zA-Z])[^>]*(?:>|\Z)",  # not a closing tag: a comment
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noframes xmp template".split())
DROPPED = frozenset(
    "head nav footer aside form button select option label fieldset svg math object audio video canvas dialog menu".split()
)
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr br img".split()
)
PARAGRAPHS = frozenset("p pre td blockquote li dd div section article".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
#: Words in a class or id that mark a part as not belonging to the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices popup modal overlay newsletter subscribe subscription sidebar widget menu nav navbar "
    "navigation breadcrumb breadcrumbs footer comment comments commentlist disqus respond share sharing social related "
    "recommended recommendations login signup paywall pagination pager toolbar skip hidden".split()
)
#: These mark it only outside an article.
OUTER_MARKS = frozenset("header masthead".split())
#: Words beside a mark that leave the name one of such a part; with others (has-sidebar) it may tell a state.
PLAIN = frozenset(
    "area areas body box wrap wrapper container section block inner outer list post posts link links item items button "
    "buttons icon icons form text title header heading head group panel column col holder slot unit top bottom left right "
    "main primary secondary site page global bar row section sections content thread node entry".split()
)
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
SCOPES = frozenset("ul ol table dl select article section div body main".split())
CONTENT = {"article": 25.0, "main": 20.0, "section": 3.0, "blockquote": 3.0, "pre": 3.0, "td": 3.0, "div": 5.0}


class Node:
    __slots__ = ("tag", "parent", "children", "dropped", "mark", "within", "points", "mass", "chars", "links")

    def __init__(self, tag: str, parent: Node | None, dropped: bool, mark: int, within: bool):
        self.tag, self.parent, self.dropped, self.mark, self.within = tag, parent, dropped, mark, within
        self.children: list[Node] = []
        self.points = self.mass = 0.0
        self.chars = self.links = 0
        if parent is not None:
            parent.children.append(self)


#: What class and id say of an element.
HINTED, NAMED = 1, 2


def unwanted(tag: str, attributes: str, within: bool) -> tuple[bool, int]:
    """Whether an element is cut from the tree, and its mark; ``within``: it is inside an article."""
    if tag in DROPPED or tag == "header" and not within:
        return True, 0
    if tag in ("html", "body") or not attributes.strip():
        return False, 0
    mark = 0
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id"):
            for token in value.split():
                words = {x.lower() for x in _NAME.findall(token)}
                marks = words & MARKS if within else words & MARKS | words & OUTER_MARKS
                if marks:
                    rest = (x for x in words - marks - PLAIN if not x.isdigit())
                    mark = max(mark, HINTED if any(rest) else NAMED)
        elif name == "role" and value.lower() in ROLES or name == "hidden":
            return True, 0
        elif name == "aria-hidden" and value.lower() == "true":
            return True, 0
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return True, 0
    return False, mark


def read(page: str) -> tuple[Node, list[tuple[Node, str, int]], list[Node]]:
    """The tree of a page, its blocks of text (innermost block element, text, characters in links) and marked elements."""
    root = Node("html", None, False, 0, False)
    open_nodes, here, blocks, marked = [root], root, [], []
    text: list[str] = []
    linked, links = 0, 0

    def end_block() -> None:
        nonlocal links
        if text:
            joined = _SPACE.sub(" ", "".join(text)).strip()
            if joined and not here.dropped:
                blocks.append((here, joined, links))
            text.clear()
        links = 0

    def add(raw: str) -> None:
        nonlocal links
        if raw and not here.dropped:
            plain = entities.unescape(raw)
            text.append(plain)
            if linked:
                links += len(_SPACE.sub(" ", plain).strip())

    at, n = 0, len(page)
    while at < n:
        found = _TOKEN.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            if tag == "a":
                linked = max(0, linked - 1)
            if tag in INLINE:
                continue
            end_block()
            if tag == "p" and not any(x.tag == "p" for x in open_nodes):
                continue
            for i in range(len(open_nodes) - 1, 0, -1):
                if open_nodes[i].tag == tag:
                    del open_nodes[i:]
                    linked = 0
                    break
            here = open_nodes[-1]
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
            at = close.end() if close else n
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                linked += 1
            continue
        end_block()
        if tag in VOID:
            continue
        while len(open_nodes) > 1 and open_nodes[-1].tag == "p":  # a block closes an open paragraph
            open_nodes.pop()
            linked = 0
        shut = CLOSED_BY.get(tag)
        if shut:
            for i in range(len(open_nodes) - 1, 0, -1):
                if open_nodes[i].tag in shut:
                    del open_nodes[i:]
                    break
                if open_nodes[i].tag in SCOPES:
                    break
        above = open_nodes[-1]
        if tag == "body":
            open_nodes[1:], above = [], root  # what an unclosed head holds does not hide the body
        cut, mark = (True, 0) if above.dropped else unwanted(tag, found[3], above.within)
        here = Node(tag, above, cut, mark, above.within or tag in ("article", "main"))
        open_nodes.append(here)
        if mark:
            marked.append(here)
    end_block()
    return root, blocks, marked


def worth(node: Node, text: str) -> float:
    """Points of a block of text, 0 if it is no paragraph of any length."""
    return 1 + text.count(",") + min(len(text) / 100, 3) if node.tag in PARAGRAPHS and len(text) >= 25 else 0.0


def without_marked(blocks: list[tuple[Node, str, int]], marked: list[Node]) -> list[tuple[Node, str, int]]:
    """``blocks`` without those in marked elements, but for elements that hold the article.

    A ``main`` is never cut, an ``article`` only if it is named as such a part (a comment). A hinted element stays if it
    holds an article that is not much smaller than the largest, or more than half of the paragraph points outside named
    ones; a named one if no article is outside named ones, and it is or holds one with more points than are there.
    """
    frames: list[Node] = []
    rest = 0.0
    for node, text, _ in blocks:
        points = worth(node, text) + 1e-6 * len(text)
        for up in _up(node):
            if up.tag in ("article", "main") and not up.mass:
                frames.append(up)
            up.mass += points
        if not any(x.mark == NAMED and x.tag != "main" for x in _up(node)):
            rest += points
    clean = [x for x in frames if not any(y.mark == NAMED and y.tag != "main" for y in _up(x))]
    own = clean or [x for x in frames if x.mass > rest]
    articles = [x for x in own if x.tag == "article"] or own
    least = max((x.mass for x in articles), default=0.0) / 2
    holding = {y for x in articles if x.mass >= least for y in _up(x)}
    cut = set()
    for node in marked:
        if node.tag == "main" or node in holding and (node.mark == HINTED or not clean):
            continue
        if node.mark == HINTED and (node.tag == "article" or 2 * node.mass > rest):
            continue
        cut.add(node)
    return [block for block in blocks if not any(x in cut for x in _up(block[0]))]


def main_text(page: str | None) -> str:
    """Blocks of the article in page order, one per line; empty if there are none."""
    if not page:
        return ""
    root, blocks, marked = read(page)
    if marked:
        blocks = without_marked(blocks, marked)
    if not blocks:
        return ""
    scored: list[Node] = []
    for node, text, links in blocks:
        up = node
        while up is not None:
            up.chars += len(text)
            up.links += links
            up = up.parent
        points = worth(node, text)
        if points:
            # Containers of a paragraph: its parent, then one above at half, farther ones by distance.
            up = node.parent if node.tag in ("p", "pre", "td", "blockquote", "li", "dd") else node
            for distance in count():
                if up is None:
                    break
                share = 1.0 if distance == 0 else 0.5 if distance == 1 else 1 / (3 * distance)
                if not up.points:
                    scored.append(up)
                    up.points = CONTENT.get(up.tag, 0.0) + 1e-9
                up.points += points * share
                up = up.parent
    value = lambda x: x.points * (1 - x.links / max(1, x.chars))
    if scored:
        best = max(scored, key=value)
    else:  # no paragraph of any length: the semantic container, else the whole page
        nodes = {node: None for block in blocks for node in _up(block[0])}
        best = next((x for tag in ("article", "main", "body", "html") for x in nodes if x.tag == tag), root)
    # A long section outdoes its own article, which is kept whole.
    frames = list(_up(best))
    frame = next((x for tag in ("article", "main") for x in reversed(frames) if x.tag == tag), best)
    kept = {frame}
    if frame.parent is not None:
        least = max(10.0, 0.2 * value(best))
        kept |= {x for x in frame.parent.children if x.points and value(x) >= least}
        kept |= {x for x in frame.parent.children if x.tag == "p" and x.chars > 80 and x.links < 0.25 * x.chars}
        kept |= {x for x in frame.parent.children if x.tag == "h1"}
    return "\n".join(text for node, text, _ in blocks if any(x in kept for x in _up(node)))


def _up(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (``page_id, url, html``).

    A null or empty page, or one without any text outside boilerplate, has an empty text. Ids and urls pass as they
    are, nulls included; repeated rows are extracted each; other columns are ignored; no rows give no rows.
    """

    @F.pandas_udf("string")
    def body(html: pd.Series) -> pd.Series:
        return html.map(main_text, na_action=None)

    out = picked(pages, "page_id", "url", "html").select("page_id", "url", body(F.coalesce("html", F.lit(""))).alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
