"""Main text of web pages from flat text blocks.

A page is cut into blocks at block-level tags. Each block has its word count
and link density, those of its neighbours, and what its containers say
(semantic tags, words of their class, id and role). A container that says
furniture counts by its share of the page's words, and only if it does not hold
the page's article: a wrapper with such a word loses nothing. A decision tree
trained on the small labelled table below decides which blocks are main text.

Edge cases: null or empty html, and a page without main text, give the empty
string; broken markup is read as far as it goes; repeated rows give equal
texts; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Names of HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head noscript template svg math object canvas select option button datalist audio video map dialog".split())
CHROME = frozenset("nav footer aside form menu header fieldset".split())
MAIN = frozenset("article main".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words that name page furniture in class, id and role.
FURNITURE = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
                      "notice notices alert warning disclaimer popup modal overlay newsletter subscribe subscription signup login search "
                      "sidebar side aside rail widget related recommended recommendations more trending popular teaser menu nav navigation "
                      "navbar breadcrumb breadcrumbs toc pager pagination header masthead topbar footer bottom copyright legal imprint share sharing social "
                      "comment comments commentlist reply replies respond discussion disqus feedback reviews hidden skip toolbar contentinfo complementary".split())
CONTENT = frozenset("article content main post entry story body text prose".split())

# A quote opens a value only behind the equals sign of an attribute; anywhere else it is a character.
VALUE = r"""(?:"[^"]*"|'[^']*'|(?!["'])[^\s>]+)"""
TOKEN = re.compile(rf"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]+|=?[^\s=>/]+(?:\s*=\s*{VALUE})?|=)*+)>""", re.S)
# A tag whose end the page lacks, and the rest of the page with it.
CUT_TAG = re.compile(r"</?[a-zA-Z].*", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
PARTS = re.compile(r"[^a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    within: set[int] = field(default_factory=set)
    hidden: int = 0
    heading: int = 0
    share: float = 1.0
    beside: int = 0
    main: int = 0


@dataclass
class Container:
    """An element that says furniture or content, by tag or by words; the first one is the page."""
    parent: int
    furniture: bool = False
    semantic: bool = False
    content: bool = False
    words: int = 0


def _says(attributes: str) -> tuple[int, int, int]:
    """Whether class, id or role name page furniture, or content, and whether the element is hidden."""
    furniture, content, hidden = 0, 0, 0
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("hidden", "aria-hidden"):
            hidden |= name == "hidden" or value.lower() == "true"
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        else:
            said = set(PARTS.split(CAMEL.sub(" ", value).lower()))
            furniture |= not said.isdisjoint(FURNITURE)
            content |= not said.isdisjoint(CONTENT)
    return int(furniture), int(content), int(hidden)


def article_path(held: list[Container]) -> list[int]:
    """The page's article, from the outside in: of the elements that say content the
    one with the most words, and so on within it. Words of a container that says
    furniture between count in part, and an element that says both must hold a third of what is around it."""
    n = len(held)
    words, said, end = np.array([c.words for c in held]), np.zeros(n, int), np.arange(1, n + 1)
    for i in range(1, n):
        said[i] = said[held[i].parent] + held[i].furniture
    for i in range(n - 1, 0, -1):
        end[held[i].parent] = max(end[held[i].parent], end[i])
    furniture, semantic = (np.array([getattr(c, k) for c in held]) for k in ("furniture", "semantic"))
    can = np.array([(c.semantic or c.content) and c.words > 0 for c in held])
    path, scope = [], 0
    while True:
        i = np.arange(scope + 1, end[scope])
        between = said[i] - said[scope]
        least = np.where(furniture[i] & ~(semantic[i] & (scope == 0)), 1 / 3, np.where((between > 0) | (scope > 0), 0.2, 0.0))
        keep = can[i] & (words[i] >= least * words[scope])
        if not keep.any():
            return path
        i, weight = i[keep], (words[i] / (1 + between))[keep]
        scope = int(i[np.flatnonzero(weight == weight.max())[-1]])
        path.append(scope)


def judge(found: list[tuple[str, Block]], held: list[Container]) -> None:
    """Sets ``share``, ``beside`` and ``main`` of the blocks."""
    for c in reversed(held[1:]):
        held[c.parent].words += c.words
    path = article_path(held)
    around = {0, *path}
    for i in path:
        while i:
            i = held[i].parent
            around.add(i)
    total = max(held[0].words, 1)
    share, main = [1.0] * len(held), [0] * len(held)
    for i, c in enumerate(held[1:], 1):  # parents come first
        own = c.words / total if c.furniture and i not in around else 1.0
        share[i] = min(share[c.parent], own)
        main[i] = int(main[c.parent] or c.semantic or (c.content and not c.furniture) or i in path)
    for _, block in found:
        least = min((share[i] for i in block.within), default=1.0)
        block.share = 0.0 if block.hidden else least
        block.beside = int(bool(path) and least < 1)
        block.main = max((main[i] for i in block.within), default=0)


def blocks(page: str) -> list[tuple[str, Block]]:
    """Flat text blocks in page order, with white space turned into one space."""
    out: list[tuple[str, Block]] = []
    stack: list[tuple[str, int, int, int, int]] = []  # tag, unseen, hidden, main, container
    held = [Container(0)]
    block, links = Block(), 0

    def close() -> None:
        nonlocal block
        text = " ".join("".join(block.parts).split())
        if text:
            out.append((text, block))
        block = Block()

    def add(raw: str) -> None:
        if not raw or (stack and stack[-1][1]):
            return
        text = html.unescape(raw) if "&" in raw else raw
        block.parts.append(text)
        if text.strip():
            if links:
                block.linked.append(text)
            if stack:
                block.hidden |= stack[-1][2]
            inner = stack[-1][4] if stack else 0
            block.within.add(inner)
            held[inner].words += len(text.split())
            block.heading |= any(s[0] in HEADING for s in stack[-4:])

    # Nothing closes a tag behind the last ``>``, so none is looked for there.
    at, size, last = 0, len(page), page.rfind(">") + 1
    while at < size:
        m = TOKEN.search(page, at, last)
        if m is None:
            add(CUT_TAG.sub("", page[at:]))
            break
        add(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            if at == last and not m[0].endswith(">"):      # a comment that nothing closes
                break
            continue
        end, tag, attributes = m[1], m[2].lower(), m[3] or ""
        if tag not in INLINE:
            if tag == "br":
                add(" ")
                continue
            close()
        if end:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if depth is not None:
                links -= sum(s[0] == "a" for s in stack[depth:])
                del stack[depth:]
            continue
        if tag in VOID or attributes.endswith("/") and tag not in INLINE and tag not in RAW:
            continue
        if tag in RAW:
            found = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = found.end() if found else size
            continue
        if tag == "p" and stack:  # an open paragraph and what is inline in it ends
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] not in INLINE), None)
            if depth is not None and stack[depth][0] == "p":
                links -= sum(s[0] == "a" for s in stack[depth:])
                del stack[depth:]
        if tag in ("li", "td", "th", "tr", "dt", "dd") and stack and stack[-1][0] == tag:
            stack.pop()
        _, unseen, hidden, main, inner = stack[-1] if stack else ("", 0, 0, 0, 0)
        says_furniture, says_content, says_hidden = _says(attributes) if attributes else (0, 0, 0)
        if tag in ("html", "body"):
            says_furniture = says_hidden = 0
        chrome = tag in CHROME and not (tag == "header" and main and not says_furniture)
        if chrome or says_furniture or says_content or tag in MAIN:
            held.append(Container(inner, bool(chrome or says_furniture), tag in MAIN, bool(says_content)))
            inner = len(held) - 1
        stack.append((tag, unseen | (tag in UNSEEN), int(hidden | says_hidden),
                      int(main | (tag in MAIN) | (says_content and not says_furniture)), inner))
        links += tag == "a"
    close()
    judge(out, held)
    return out


# Columns: words, link density, words before, link density before, words after,
# link density after, share of the page's words in the least container that says
# furniture and does not hold the article (1: in none, 0: hidden), in main
# container, heading, whether the page has an article beside that container; then the label.
FEATURES = 10
LABELLED = np.array([
    # link lists and links within an article
    [25, .60, 40, .0, 40, .0, 0, 1, 0, 1], [12, 1.0, 40, .0, 35, .0, 0, 1, 0, 1], [2, 1.0, 30, .0, 25, .0, 0, 1, 0, 1],
    [2, 1.0, 3, 1., 2, 1., 0, 1, 0, 0], [3, 1.0, 2, 1., 0, .0, 0, 1, 0, 0], [4, 1.0, 3, 1., 4, 1., 0, 1, 0, 0],
    # menus and headers that no container names
    [3, 1.0, 2, 1., 2, 1., 0, 0, 0, 0], [2, 1.0, 1, 1., 2, 1., 0, 0, 0, 0], [1, 1.0, 0, .0, 1, 1., 0, 0, 0, 0],
    [3, .00, 0, .0, 2, 1., 0, 0, 0, 0], [5, .00, 3, 1., 2, 1., 0, 0, 0, 0], [12, 1.0, 10, 1., 9, 1., 0, 0, 0, 0],
    # pages without any such container: long blocks of plain words
    [50, .00, 8, .0, 60, .0, 0, 0, 0, 1], [35, .10, 2, .0, 30, .0, 0, 0, 0, 1], [18, .00, 40, .0, 50, .0, 0, 0, 0, 1],
    [6, .00, 45, .0, 38, .0, 0, 0, 0, 1], [90, .20, 3, 1., 70, .0, 0, 0, 0, 1], [25, .00, 4, 1., 2, 1., 0, 0, 0, 1],
    [7, .00, 3, 1., 60, .0, 0, 0, 1, 1], [4, .00, 2, .0, 3, .0, 0, 0, 0, 0], [2, .00, 50, .0, 2, 1., 0, 0, 0, 0],
    [9, .40, 50, .0, 6, .5, 0, 0, 0, 0], [5, .00, 1, 1., 6, .0, 0, 0, 0, 0], [30, .80, 20, .9, 25, .8, 0, 0, 0, 0],
    [16, .55, 14, .6, 15, .7, 0, 0, 0, 0],
])
# Plain blocks of every length between neighbours of every length, with and
# without links: main text in an article, none in furniture, be it in the article or not.
LABELLED = np.vstack([LABELLED] + [
    [n, .0, before, linked_before, after, linked_after, furniture, main, 0, int(main and not furniture)]
    for n, before, after, linked_before, linked_after in product((1, 6, 18, 70), (0, 2, 15, 60), (0, 2, 15, 60), (.0, 1.), (.0, 1.))
    for furniture, main in ((0, 1), (1, 0), (1, 1))] + [
    # Blocks of an article with links in them; all link is only a list where its neighbours are.
    [n, density, before, linked, after, linked, 0, 1, 0, int(density < 1 or not linked)]
    for n, before, after, density, linked in product((2, 6, 18, 70), (2, 15, 60), (2, 15, 60), (.35, .7, 1.), (.0, 1.))])


def _shares(rows: np.ndarray) -> np.ndarray:
    """The rows above by share. Little of the page in a furniture container is
    furniture; so is much of it where the article is beside; without an article a
    container of most words is a wrapper, whose blocks are judged as if it said nothing."""
    def with_share(x, share, beside):
        return np.column_stack([x[:, :6], np.full(len(x), share), x[:, 7:9], np.full(len(x), beside), x[:, 9]])
    inside, outside = rows[rows[:, 6] == 1], rows[rows[:, 6] == 0]
    bare = outside[outside[:, 7] == 0]
    # In furniture neither the block nor its main container changes the answer.
    moved = np.vstack([np.column_stack([outside[:, :6], np.tile([1, main, heading, 0], (len(outside), 1))]) for main, heading in product((0, 1), (0, 1))])
    return np.vstack([with_share(outside, 1.0, 0), with_share(inside, .03, 0)] + [with_share(moved, share, beside) for share, beside in
                     ((.0, 0), (.0, 1), (.45, 0), (.45, 1), (.98, 1))]
                     + [with_share(bare, share, 0) for share in (.6, .8, .98)])


LABELLED = _shares(LABELLED)


def grow(x: np.ndarray, y: np.ndarray, least: int = 1):
    """Decision tree by Gini impurity: a leaf is a probability, a node (feature, cut, low, high)."""
    p = y.mean()
    if p in (0.0, 1.0) or len(y) < 2 * least:
        return float(p)
    best = (p * (1 - p) * len(y) - 1e-12, None, None)
    for k in range(x.shape[1]):
        values = np.unique(x[:, k])
        for c in (values[1:] + values[:-1]) / 2:
            low = x[:, k] <= c
            a, b = y[low], y[~low]
            impurity = a.mean() * (1 - a.mean()) * len(a) + b.mean() * (1 - b.mean()) * len(b)
            if min(len(a), len(b)) >= least and impurity < best[0]:
                best = (impurity, k, c)
    if best[1] is None:
        return float(p)
    low = x[:, best[1]] <= best[2]
    return (best[1], float(best[2]), grow(x[low], y[low], least), grow(x[~low], y[~low], least))


def decide(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree >= 0.5)
    k, c, low, high = tree
    out, below = np.empty(len(x), bool), x[:, k] <= c
    out[below], out[~below] = decide(low, x[below]), decide(high, x[~below])
    return out


TREE = grow(LABELLED[:, :FEATURES], LABELLED[:, FEATURES])


def features(found: list[tuple[str, Block]]) -> np.ndarray:
    n = np.array([len(t.split()) for t, _ in found], float)
    linked = np.array([len(" ".join(b.linked).split()) if b.linked else 0 for _, b in found], float)
    density = np.minimum(linked / n, 1.0)
    own = np.array([(b.share, b.main, b.heading, b.beside) for _, b in found], float)
    z = [0.0]
    return np.column_stack([n, density, np.r_[z, n[:-1]], np.r_[z, density[:-1]], np.r_[n[1:], z], np.r_[density[1:], z], own])


def main_text(page: str | None, tree=TREE) -> str:
    found = blocks(page) if page else []
    if not found:
        return ""
    keep = decide(tree, features(found))
    return " ".join(t for (t, _), k in zip(found, keep) if k)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    d = pages.select("page_id", "url", "html")
    spec = f"page_id {d.schema['page_id'].dataType.simpleString()}, url {d.schema['url'].dataType.simpleString()}, text string, n_chars bigint"

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                piece = batch.slice(first, 256)
                texts = [main_text(p) for p in piece.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return d.mapInArrow(run, spec)
