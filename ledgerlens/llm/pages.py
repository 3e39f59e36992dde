"""Main text of web pages: flat text blocks, their word count and link density and those of their neighbours, a trained decision tree."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_SPACE = re.compile(r"\s+")
#: Elements whose content is no text, elements that never end a block, elements without content, containers by use.
SILENT = frozenset("script style noscript template head title svg math iframe object canvas select option datalist textarea button".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Content of these is text whatever it holds, up to their end tag. What may stand in a head. Open elements that a start tag ends, where HTML lets their end tag be left out.
RAW = frozenset("script style title iframe textarea".split())
IN_HEAD = frozenset("html head base basefont bgsound link meta title style script noscript noframes template".split())
_ENDS_P = "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul"
_ENDED = {
    "li": "li", "dt": "dt dd", "dd": "dt dd", "option": "option", "optgroup": "option optgroup", "td": "td th", "th": "td th", "tr": "td th tr",
    **dict.fromkeys(("thead", "tbody", "tfoot"), "td th tr thead tbody tfoot caption colgroup"), **dict.fromkeys(_ENDS_P.split(), "p"),
}
ENDED = {name: frozenset(ended.split()) for name, ended in _ENDED.items()}
OUTSIDE = frozenset("nav header footer aside menu dialog".split())
INSIDE = frozenset("article main".split())
#: Class names of parts around the text; those of readers' parts; what may stand beside such a name in a hyphenated one (`site-footer`, but not
#: `has-sidebar` or `no-comments`); class names of elements that hold the text.
READERS = frozenset("comment comments reply replies respond disqus".split())
FURNITURE = READERS | frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs footer header masthead sidebar side widget "
    "related cookie cookies consent notice popup modal overlay newsletter subscribe signup social share sharing tags pagination pager login search".split()
)
BESIDE = frozenset(
    "site main top bottom left right primary secondary global page post posts entry article articles story stories blog list box bar area block wrap wrapper container inner "
    "outer section item items panel link links form button buttons icon icons text title body content row slot unit group 1 2 3 4".split()
)
HOLDS_TEXT = re.compile(r"(?:^|[\s_-])(?:content|article|entry|post|story|page|layout|hentry)(?:$|\s)", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "place", "heading")


@dataclass
class Block:
    """A run of text between block borders: its text, its words and words inside links, and where it stands."""

    text: str
    words: int
    linked: int
    outside: bool
    inside: bool
    heading: bool


@dataclass
class Mark:
    """An element that its class, id or form marks as no text: its blocks, and whether it is a readers' part, stands in an article, is named as holding text, has a heading."""

    first: int
    readers: bool
    inside: bool
    named: bool
    last: int = -1
    heading: bool = False


def _kind(value: str) -> str:
    """`readers` or `around` if a whole class name, or all parts of a hyphenated one, say so; else empty."""
    found = ""
    for name in value.lower().split():
        parts = [p for p in re.split("[_-]+", name) if p]
        known = FURNITURE.intersection(parts)
        if known and all(p in FURNITURE or p in BESIDE for p in parts):
            if READERS & known:
                return "readers"
            found = "around"
    return found


def _names(attributes: str) -> tuple[str, bool, bool, bool]:
    """The kind of part that class and id name, whether the role marks a part outside the text, whether it is hidden, whether it is named as holding text."""
    kind, off, hidden, named = "", False, False, False
    for name, value in _ATTRIBUTE.findall(attributes):
        value = value.strip("\"'")
        name = name.lower()
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            hidden = True
        elif name == "role":
            off = off or value.lower() in ROLES
        elif name in ("class", "id"):
            found = _kind(value)
            kind = found if found == "readers" else kind or found
            named = named or bool(HOLDS_TEXT.search(value))
    return kind, off, hidden, named


def _settle(out: list[Block], marks: list[Mark], articles: list[tuple[int, int]]) -> None:
    """Set `outside` below the marks that hold. Names mislead on wrappers: a mark falls if the page's longest article stands below it, or most of the page's
    prose with a heading, with three blocks or under a name for text. Readers' parts fall only if they hold every article, and their words do not count."""
    change = np.zeros(len(out) + 1, int)

    def hold(found: list[Mark]) -> np.ndarray:
        for m in found:
            change[m.first] += 1
            change[m.last] -= 1
        return np.cumsum(change) > 0

    plain = np.array([b.words - b.linked for b in out] + [0])
    full = np.concatenate([[0], np.cumsum(plain)])
    articles = [(a, b) for a, b in articles if full[b] > full[a]]
    every = lambda m: bool(articles) and not m.inside and m.first <= articles[0][0] and articles[-1][1] <= m.last
    said = hold([m for m in marks if m.readers and not every(m)])
    prose = np.concatenate([[0], np.cumsum(np.where(said, 0, plain))])
    longest = max(articles, key=lambda r: prose[r[1]] - prose[r[0]], default=None)

    def misleads(m: Mark) -> bool:
        most = 2 * (prose[m.last] - prose[m.first]) > prose[-1] and (m.heading or m.named or m.last - m.first >= 3)
        return bool(most) or longest is not None and not m.inside and m.first <= longest[0] and longest[1] <= m.last

    off = hold([m for m in marks if not m.readers and not misleads(m)])
    for block, below in zip(out, off):
        block.outside = block.outside or bool(below)


def blocks(page: str) -> list[Block]:
    """Flat blocks in page order. Unclosed elements end with the element around them; stray end tags are ignored. Work is linear in the page at any nesting."""
    out: list[Block] = []
    marks: list[Mark] = []
    articles: list[tuple[int, int]] = []
    stack: list[tuple] = []  # name, outside, hidden, inside, mark
    blocked: list[int] = []  # where block elements stand in the stack
    near: list[dict] = [{}]  # open inline elements since each block element, by name
    opened: dict = {}  # open elements by name
    heads: list[int] = []
    seen: list[int] = []  # blocks that first headings begin
    parts: list[tuple[str, bool]] = []
    at = links = off = hidden = main = heading = began = 0

    def flush() -> None:
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(p for p, _ in parts))).strip()
            if text:
                linked = len(html.unescape(" ".join(p for p, linked in parts if linked)).split())
                words = len(text.split())
                out.append(Block(text, words, min(linked, words), off > 0, main > 0, heading > 0))
            parts.clear()

    def push(entry: tuple) -> None:
        nonlocal links, off, hidden, main, heading, began
        name, was_off, was_hidden, inside, _ = entry
        if name == "head":
            heads.append(len(stack))
        if name in INLINE:
            near[-1][name] = near[-1].get(name, 0) + 1
        else:
            blocked.append(len(stack))
            near.append({})
        opened[name] = opened.get(name, 0) + 1
        stack.append(entry)
        if inside and not main:
            began = len(out)
        links += name == "a"
        main += inside
        heading += name in HEADINGS
        off += was_off
        hidden += was_hidden

    def close() -> None:
        nonlocal links, off, hidden, main, heading
        name, was_off, was_hidden, inside, mark = stack.pop()
        if name == "head":
            heads.pop()
        if name in INLINE:
            near[-1][name] -= 1
        else:
            blocked.pop()
            near.pop()
        opened[name] -= 1
        links -= name == "a"
        main -= inside
        heading -= name in HEADINGS
        off -= was_off
        hidden -= was_hidden
        if mark is not None:
            mark.last = len(out)
        if inside and not main and not off:
            articles.append((began, len(out)))

    def cut(depth: int) -> None:
        while len(stack) > depth:
            close()

    while at < len(page):
        tag = _TAG.search(page, at)
        text = page[at : tag.start() if tag else len(page)]
        if stack and stack[-1][0] == "head" and text.strip():
            cut(len(stack) - 1)
        if text and not hidden:
            parts.append((text, links > 0))
        if not tag:
            break
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if not tag[1] and heads and name not in IN_HEAD and (name == "body" or heads[0] == len(stack) - 1):
            # what may not stand in a head ends it; a body does so from any depth
            cut(heads[0])
        if name in RAW:
            if not tag[1] and not tag[3].rstrip().endswith("/"):
                # raw content: nothing inside it is a tag
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name not in INLINE:
            flush()
        elif name == "br" and not hidden:
            parts.append((" ", False))
        if name in VOID:
            continue
        if tag[1]:
            # an inline end tag never ends a block element
            if near[-1].get(name) if name in INLINE else opened.get(name):
                while stack[-1][0] != name:
                    close()
                close()
        else:
            while name in ENDED and blocked and stack[blocked[-1]][0] in ENDED[name]:
                cut(blocked[-1])  # with the inline elements left open in it
            if not tag[3].rstrip().endswith("/"):
                kind, was_off, was_hidden, named = _names(tag[3]) if tag[3] else ("", False, False, False)
                if name in ("html", "body", "main") or name == "article" and kind != "readers":
                    kind, was_off = "", False
                was_off = was_off or name in OUTSIDE
                if name == "header" and main > 0:
                    kind, was_off = "", False  # a heading part of the article itself
                mark = Mark(len(out), kind == "readers", main > 0, named) if kind or name == "form" else None
                if mark:
                    marks.append(mark)
                if name in ("h1", "h2"):
                    seen.append(len(out))
                push((name, was_off, was_hidden or name in SILENT, name in INSIDE and not kind, mark))
    flush()
    cut(0)
    for m in marks:
        k = bisect_left(seen, m.first)
        m.heading = k < len(seen) and seen[k] < m.last
    _settle(out, marks, articles)
    return out


def features(page: list[Block]) -> np.ndarray:
    """One row of FEATURES for each block; beyond the ends of the page stand blocks without words."""
    n = len(page)
    words = np.array([0] + [b.words for b in page] + [0], float)
    dense = np.array([0.0] + [b.linked / b.words for b in page] + [0.0])
    # in a part outside the text, beside an article, on a page without one, in an article
    beside = 0 if any(b.inside and not b.outside for b in page) else 1
    flags = np.array([[-1 if b.outside else 2 if b.inside else beside, b.heading] for b in page], float).reshape(n, 2)
    return np.column_stack([words[1:-1], dense[1:-1], words[:-2], dense[:-2], words[2:], dense[2:], flags])


#: The labelled table: blocks as they stand on pages (words, words in links, outside?, inside article?, heading?) and whether they are main text.
#: One line a page: articles with short and long paragraphs, pages without article element, a link list, a discussion, a short note. `prose_pages` adds more.
LABELLED = (
    ((5, 5, 1, 0, 0, 0), (14, 0, 1, 0, 0, 0), (11, 0, 0, 1, 1, 1), (2, 0, 0, 1, 0, 1), (500, 0, 0, 1, 0, 1), (1, 0, 0, 1, 0, 1), (900, 12, 0, 1, 0, 1), (3, 0, 0, 1, 0, 1), (300, 0, 0, 1, 0, 1), (15, 0, 0, 1, 0, 1), (10, 0, 1, 0, 0, 0)),
    ((400, 0, 0, 1, 0, 1), (4, 0, 0, 1, 0, 1), (280, 3, 0, 1, 0, 1), (90, 80, 1, 1, 0, 0), (150, 0, 1, 1, 0, 0), (6, 0, 0, 1, 0, 1), (60, 0, 1, 0, 0, 0), (320, 20, 1, 0, 0, 0), (45, 0, 1, 0, 0, 0)),
    ((8, 8, 1, 0, 0, 0), (6, 0, 0, 1, 1, 1), (9, 0, 0, 1, 0, 1), (1, 0, 0, 1, 0, 1), (2, 2, 0, 1, 0, 1), (5, 0, 1, 0, 0, 0), (250, 0, 1, 0, 0, 0), (33, 1, 1, 0, 0, 0)),
    ((3, 3, 0, 0, 0, 0), (4, 4, 0, 0, 0, 0), (5, 0, 0, 0, 1, 1), (60, 0, 0, 0, 0, 1), (50, 2, 0, 0, 0, 1), (70, 0, 0, 0, 0, 1), (2, 2, 0, 0, 0, 0), (1, 1, 0, 0, 0, 0)),
    ((2, 2, 0, 0, 0, 0), (35, 1, 0, 0, 0, 1), (80, 0, 0, 0, 0, 1), (6, 6, 0, 0, 0, 0), (45, 0, 0, 0, 0, 1), (3, 3, 0, 0, 0, 0), (4, 4, 0, 0, 0, 0)),
    ((12, 0, 0, 0, 1, 1), (310, 4, 0, 0, 0, 1), (40, 0, 0, 0, 0, 1), (620, 0, 0, 0, 0, 1), (18, 0, 0, 0, 0, 1), (270, 0, 0, 0, 0, 1), (7, 7, 0, 0, 0, 0), (3, 3, 0, 0, 0, 0)),
    ((6, 6, 1, 0, 0, 0), (12, 0, 1, 0, 0, 0), (9, 0, 0, 1, 1, 1), (120, 2, 0, 1, 0, 1), (1, 0, 0, 1, 0, 1), (45, 0, 0, 1, 0, 1), (8, 1, 1, 0, 0, 0)),
    ((1, 1, 1, 0, 0, 0), (1, 1, 1, 0, 0, 0), (2, 0, 0, 1, 1, 1), (2, 0, 0, 1, 0, 1), (3, 3, 0, 1, 0, 1), (9, 0, 1, 1, 0, 0), (400, 9, 0, 1, 0, 1), (15, 0, 1, 0, 0, 0)),
    ((3, 3, 0, 0, 0, 0), (2, 2, 0, 0, 0, 0), (7, 0, 0, 0, 1, 1), (80, 1, 0, 0, 0, 1), (64, 3, 0, 0, 0, 1), (25, 0, 0, 0, 0, 1), (150, 0, 0, 0, 0, 1), (5, 5, 0, 0, 0, 0), (4, 1, 0, 0, 0, 0)),
    ((4, 4, 0, 0, 0, 0), (6, 6, 0, 0, 0, 0), (3, 3, 0, 0, 0, 0), (5, 0, 0, 0, 0, 0), (8, 8, 0, 0, 0, 0), (2, 2, 0, 0, 0, 0)),
    ((10, 0, 0, 0, 1, 1), (55, 0, 0, 0, 0, 1), (34, 0, 1, 0, 0, 0), (40, 2, 1, 0, 0, 0), (28, 0, 1, 0, 0, 0), (6, 0, 1, 0, 0, 0)),
    ((30, 0, 1, 0, 0, 0), (70, 10, 1, 0, 0, 0), (18, 0, 0, 1, 0, 1), (5, 0, 0, 1, 0, 1), (60, 0, 1, 0, 0, 0)),
    ((9, 9, 0, 0, 0, 0), (26, 0, 0, 0, 0, 1), (31, 2, 0, 0, 0, 1), (22, 0, 0, 0, 0, 1), (3, 0, 0, 0, 0, 0), (4, 4, 0, 0, 0, 0)),
    ((2, 0, 0, 0, 0, 0), (3, 3, 0, 0, 0, 0), (12, 0, 0, 1, 0, 1), (11, 9, 0, 1, 0, 1), (16, 0, 0, 1, 0, 1), (20, 0, 0, 0, 0, 0), (50, 4, 0, 0, 0, 0)),
)


def prose_pages() -> Iterator[tuple]:
    """More labelled pages by a rule: prose of 12 to 300 words of which 0 to 35 % are links, with and without an article element, between short paragraphs,
    headings, link lists and notes. Prose is main text whatever its length and links; outside an article that stands on the page nothing is."""
    nav = [(k, k, 0, 0, 0, 0) for k in (1, 2, 4)]
    for words in (12, 20, 30, 40, 60, 80, 120, 200, 300):
        for turn, share in enumerate((0.0, 0.05, 0.1, 0.2, 0.35)):
            size = lambda f: (max(8, int(words * f)), int(max(8, int(words * f)) * share))
            note = 3 + (words + 5 * turn) % 9
            foot = [(3, 3, 0, 0, 0, 0), (2, 2, 0, 0, 0, 0), (note, note % 2, 0, 0, 0, 0)] if turn % 2 else [(5, 5, 0, 0, 0, 0), (note, 0, 1, 0, 0, 0)]
            foot = [] if turn > 2 else foot
            for inside in (0, 1):
                text = [(2 + note, 0, 0, inside, 1, 1), (*size(1), 0, inside, 0, 1), (2, 0, 0, inside, 0, 1), (*size(1.5), 0, inside, 0, 1)]
                text += [(1 + turn, 0, 0, inside, 1, 1), (*size(0.8), 0, inside, 0, 1), (*size(1.2), 0, inside, 0, 1), (note, turn % 2, 0, inside, 0, 1), (*size(0.7), 0, inside, 0, 1)]
                if inside:
                    text += [(3, 3, 0, 1, 0, 1), (*size(0.5), 1, 1, 0, 0)]
                near = [(*size(0.7), 1, 0, 0, 0)] + ([(*size(0.9), 0, 0, 0, 0)] if inside else [])
                yield (*nav, *near, *text, *foot)


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    rows, labels = [], []
    for page in (*LABELLED, *prose_pages()):
        rows.append(features([Block("", w, linked, bool(o), bool(i), bool(h)) for w, linked, o, i, h, _ in page]))
        labels += [b[5] for b in page]
    return np.vstack(rows), np.array(labels)


def train_tree(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 5) -> tuple:
    """Decision tree by Gini impurity: (feature, cut, left, right), or the label's share at a leaf of at least `least` rows."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0):
        return (share,)
    best, chosen = 2 * share * (1 - share) * len(y) - 1e-9, None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        n = np.arange(1, len(y))
        p, q = ones[:-1] / n, (ones[-1] - ones[:-1]) / (len(y) - n)
        cost = 2 * p * (1 - p) * n + 2 * q * (1 - q) * (len(y) - n)
        cost[(v[1:] == v[:-1]) | (n < least) | (len(y) - n < least)] = np.inf
        k = int(np.argmin(cost))
        if cost[k] < best - 1e-12:
            best, chosen = cost[k], (f, float((v[k] + v[k + 1]) / 2))
    if chosen is None:
        return (share,)
    f, cut = chosen
    low = x[:, f] <= cut
    return f, cut, train_tree(x[low], y[low], depth - 1, least), train_tree(x[~low], y[~low], depth - 1, least)


def is_main(tree: tuple, row: np.ndarray) -> bool:
    while len(tree) > 1:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[0] >= 0.5


def main_text(page: str, tree: tuple) -> str:
    found = blocks(page)
    return "\n\n".join(b.text for b, row in zip(found, features(found)) if is_main(tree, row)) if found else ""


def extract_pages(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """Adds `text` and `n_chars` (code points) to every page: its main blocks in page order, joined by an empty line.

    Null and empty pages, and pages without a main block, give an empty text. Other columns are kept; columns named like the results are replaced.
    """
    tree = train_tree(*labelled_table())
    kept = [f for f in pages.schema.fields if f.name not in ("text", "n_chars")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["text string", "n_chars long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(p, tree) if p else "" for p in part.column(html_column).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(f.name) for f in kept] + [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                    names=[f.name for f in kept] + ["text", "n_chars"],
                )

    return pages.mapInArrow(run, schema)
