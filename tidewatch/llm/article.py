"""Operator 3: main text of web pages by tree scoring.

A page is cut into tags and text and built into a tree. Paragraphs earn points for length
and commas and pass them on to their ancestors, less at each step up; every container is discounted by its
link density. From the best container the way goes up to the ancestor that holds every block of running text
of the page, so an article in several wrapped sections stays whole. That ancestor is kept with its siblings; beside the best
container, only blocks that are mostly links are left out. Menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and comments of readers are left out everywhere; names of classes and ids
count as furniture only as whole tokens (``sidebar``, ``site-header``, but not ``has-sidebar``).

Pages are independent: one pass of bounded Arrow batches, no shuffle.

Defined results: a null or empty page, and one without any text, gives the empty text; without any paragraph
worth points the whole body counts as the container; unclosed, crossed and unknown tags are closed where their parent ends; ties
between containers go to the first in page order, the inner one of a nest; repeated rows and null ids are treated like any other;
columns beyond id, url and html are ignored.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
from pyspark.sql import DataFrame

from .common import table

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title|svg|iframe|select)\b.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)|[^<]+|<", re.S | re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr b bdi bdo big cite code del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split())
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_DROPPED = frozenset("nav aside footer form header button dialog menu object".split())
_POINTED = frozenset("p td pre blockquote li dd dt h1 h2 h3 h4 h5 h6 figcaption".split())
_BAD_WORD = re.compile(
    r"ads?|advert\w*|banner|breadcrumbs?|comments?|respond|disqus|cookies?|consent|notice|notices|gdpr|popup|modal|newsletter|subscribe"
    r"|sidebar|side|nav|navbar|navigation|menu|footer|header|masthead|related|share|sharing|social|sponsor\w*|promo|promoted|widget|login|signup|toolbar", re.I)
#: What a furniture name may have beside furniture words.
_PLAIN_WORD = re.compile(
    r"\d*|site|page|main|global|top|bottom|left|right|upper|lower|primary|secondary|mobile|desktop|sticky|fixed|container|wrapper|wrap|outer|inner|box|area|bar|block"
    r"|section|panel|region|row|col|column|list|item|items|links?|buttons?|icons?|media|policy|message|text|form|posts|articles|stories|slot|unit|content", re.I)
_BAD_ROLE = re.compile(r"role\s*=\s*[\"']?(?:navigation|banner|contentinfo|complementary|search|dialog|alert|form|menu)", re.I)
_NAME = re.compile(r"(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_GOOD_TAGS = {"article": 1.5, "main": 1.3}
#: Beside the best container, a block with this share of its text in links is no running text.
LINKED = 0.5


class Node:
    __slots__ = ("tag", "parent", "children", "text", "links", "points", "bad", "order", "held")

    def __init__(self, tag, parent, bad=False, order=0):
        self.tag, self.parent, self.bad, self.order = tag, parent, bad, order
        self.children, self.text, self.links, self.points, self.held = [], 0, 0, 0.0, 0


def furniture(names: str) -> bool:
    """Whether one of the class names and ids consists of furniture words only, beside plain ones."""
    for name in names.split():
        words = re.split("[_-]+", name)
        bad = [bool(_BAD_WORD.fullmatch(w)) for w in words]
        if any(bad) and all(b or _PLAIN_WORD.fullmatch(w) for b, w in zip(bad, words)):
            return True
    return False


def is_bad(tag: str, attributes: str) -> bool:
    """Whether an element is page furniture by its tag, name, role or by being hidden."""
    if tag in _DROPPED:
        return True
    if not attributes or tag in ("body", "html", "article", "main"):
        return False
    names = " ".join(a or b or c for a, b, c in _NAME.findall(attributes))
    return bool(furniture(names) or _BAD_ROLE.search(attributes) or _HIDDEN.search(attributes))


def tree(page: str) -> Node:
    """Elements and text of a page; a child is a Node or a string."""
    root = at = Node("#root", None)
    depth, order = {}, 0
    for m in _TOKEN.finditer(page):
        tag = m[3]
        if tag is None:
            piece = m[0]
            if piece[0] != "<" or piece == "<":
                at.children.append(piece)
            continue
        tag = tag.lower()
        if m[2]:
            if depth.get(tag):
                while at.tag != tag:
                    depth[at.tag] -= 1
                    at = at.parent
                depth[tag] -= 1
                at = at.parent
            continue
        if tag in _VOID:
            at.children.append(" " if tag == "br" else Node(tag, at) if tag == "hr" else "")
            continue
        if tag in _CLOSES_P and depth.get("p"):
            _close(at, "p", depth)
            at = _to(at, "p")
        elif tag in ("li", "dd", "dt", "tr", "td", "th", "option"):
            stop = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}.get(tag, ())
            same = ("td", "th") if tag in ("td", "th") else ("dd", "dt") if tag in ("dd", "dt") else (tag,)
            up = at
            while up.parent is not None and up.tag not in stop and up.tag not in same:
                up = up.parent
            if up.tag in same:
                while at is not up.parent:
                    depth[at.tag] -= 1
                    at = at.parent
        order += 1
        node = Node(tag, at, is_bad(tag, m[4]), order)
        at.children.append(node)
        if not m[4].endswith("/"):
            at, depth[tag] = node, depth.get(tag, 0) + 1
    return root


def _close(at, tag, depth):
    while at.tag != tag:
        depth[at.tag] -= 1
        at = at.parent
    depth[tag] -= 1


def _to(at, tag):
    while at.tag != tag:
        at = at.parent
    return at.parent


def flat(text: str) -> str:
    return " ".join(entities.unescape(text).split())


def blocks(node: Node, keep_bad: bool = False) -> list[str]:
    """Texts of the blocks under a node in page order, white space folded; furniture is left out."""
    out, line = [], []

    def end():
        text = flat("".join(line))
        line.clear()
        if text:
            out.append(text)

    stack = [(node, 0)]
    while stack:
        at, i = stack.pop()
        if i == 0 and at is not node and at.tag not in _INLINE:
            end()
        children = at.children
        while i < len(children):
            child = children[i]
            i += 1
            if isinstance(child, str):
                line.append(child)
            elif keep_bad or not child.bad:
                stack.append((at, i))
                stack.append((child, 0))
                break
            elif child.tag not in _INLINE:
                end()
        else:
            if at.tag not in _INLINE:
                end()
    end()
    return out


def measured(root: Node) -> list[Node]:
    """All nodes that aren't furniture, children after parents, with text and link lengths, their points
    and how many blocks of running text they hold."""
    order, stack = [], [root]
    while stack:
        at = stack.pop()
        order.append(at)
        stack.extend(c for c in reversed(at.children) if not isinstance(c, str) and not c.bad)
    for at in reversed(order):
        texts = [c for c in at.children if isinstance(c, str)]
        own = len(" ".join("".join(texts).split())) if texts else 0
        good = [c for c in at.children if not isinstance(c, str) and not c.bad]
        at.text = own + sum(c.text for c in good)
        at.links = at.text if at.tag == "a" else sum(c.links for c in good)
    for at in order:
        loose = at.tag not in _INLINE and any(isinstance(c, str) and c.strip() for c in at.children)
        if at.tag in _POINTED or loose:
            if at.text >= 10:
                commas = sum(c.count(",") + c.count("،") + c.count("、") for c in at.children if isinstance(c, str))
                at.held = int(at.links < LINKED * at.text)
                points = (1 + commas + min(at.text / 100, 3)) * (1 - at.links / at.text)
                up, share = (at.parent or at) if at.tag in _POINTED else at, 1.0
                while up is not None and share > 0.05:
                    up.points += points * share
                    up, share = up.parent, share / 2
    for at in reversed(order):
        if at.parent is not None:
            at.parent.held += at.held
    return order


def thin(node: Node, kept: Node | None) -> None:
    """Take blocks that are mostly links out of a node, but nothing out of ``kept`` and no running text."""
    stack = [node]
    while stack:
        at = stack.pop()
        children, line = [], []

        def end():
            nodes = [c for c in line if not isinstance(c, str)]
            text = len(" ".join("".join(c for c in line if isinstance(c, str)).split())) + sum(c.text for c in nodes)
            if not text or sum(c.links for c in nodes) < LINKED * text or any(c.held for c in nodes):
                children.extend(line)
            line.clear()

        for c in at.children:
            if c is not kept and (isinstance(c, str) or c.tag in _INLINE):
                line.append(c)
                continue
            end()
            children.append(c)
            if c is not kept and not c.bad and c.text and c.links >= LINKED * c.text:
                if c.held:
                    stack.append(c)
                else:
                    c.bad = True
        end()
        at.children = children


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = tree(page)
    order = measured(root)
    best, most = None, 0.0
    for at in order:
        score = at.points * _GOOD_TAGS.get(at.tag, 1.0) * (1 - at.links / at.text if at.text else 0)
        if score > most or (score == most and best is not None and score > 0 and at.parent is best):
            best, most = at, score
    if best is None:
        return "\n".join(blocks(root))
    while best.tag in _INLINE and best.parent is not None:
        best = best.parent
    up = best
    while up is not None:  # an article is taken as a whole
        if up.tag == "article":
            best = up
        up = up.parent
    whole = best
    while whole.parent is not None and whole.held < root.held:
        whole = whole.parent
    if whole.parent is not None:
        whole = whole.parent  # its siblings belong to it
    at = best
    while at is not whole:
        thin(at.parent, at)
        at = at.parent
    return "\n".join(blocks(whole))


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(np.array([len(t) for t in texts], np.int64)),
            ], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def op3_tree_scoring(spark, sf_dir):
    return extracted(table(spark, sf_dir, "pages"))


QUERIES = {"op3_tree_scoring": op3_tree_scoring}
ORACLES = {}
