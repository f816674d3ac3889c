"""Main text of web pages from flat text blocks and a decision tree.

A page is read as a flat list of text blocks: runs of text between block-level tags. For each block
the tree sees its number of words and its link density (share of words inside links), the same of the
block before and after, whether it is a heading, and what its innermost telling ancestor says: part of
an article (1), nothing (0), or furniture (-1) such as navigation, footers, asides, forms, and boxes
whose class, id or role names an advert, a notice, comments and the like. `nav`, `aside`, `footer` and
the like say -1 for everything inside them but `main`; a form, a fieldset or a class name gives way to
an article inside it, unless it stands in an article itself. Class names of `html` and `body`, and those
that say what a box has or lacks (`has-sidebar`), tell nothing; an article is furniture by its class only inside another one, or where the class is
one word such as `related`, or begins with `comment` or `reply`. On a page whose articles hold no text but
headings, a form, fieldset or named box with more than half of the page's words outside links tells
nothing either: it is the frame of the text.

The tree is grown by Gini impurity on `LABELLED`, a small table of blocks judged by hand.

Character references are decoded, white space inside a block becomes one space, blocks are trimmed
and joined in page order by one line feed. `br` is white space. Scripts, styles, titles, text areas
and comments are no text; HTML ends them only at their own end tag, so one that is not closed runs to
the end of the page. Drawings, choices, templates and what stands in for media are no text either, up to
their end tag or that of what holds them, and do not end the block around them; a self-closed one is
empty, and an open `svg` ends where HTML elements begin. Formulas are text of the block they stand in.
Other unclosed or badly nested tags are tolerated. Null and empty pages give the empty text. Each input
row gives one row, also if rows repeat; an empty table gives none.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefare.llm.common import slices

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^<>]*+\Z",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)|(?=[\s/>]|$))""", re.IGNORECASE)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Element names by their role in HTML.
RAW = frozenset("script style title textarea".split())
SKIPPED = frozenset("noscript template select option svg iframe object canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math q s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
#: HTML elements that end an open drawing or formula, and parts of a drawing that hold HTML.
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre "
    "ruby s small span strong strike sub sup table tt u ul var".split()
)
HOLDS_HTML = frozenset("foreignobject desc title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FURNITURE = frozenset("nav footer aside menu dialog button".split())
FORMS = frozenset("form fieldset".split())
ARTICLE = frozenset("article main".split())
ROLES = {"navigation": -1, "banner": -1, "contentinfo": -1, "complementary": -1, "search": -1, "form": -1, "dialog": -1,
         "alert": -1, "alertdialog": -1, "menu": -1, "menubar": -1, "main": 1, "article": 1}
FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup login paywall nav navbar navigation menu menubar "
    "breadcrumb breadcrumbs sidebar sidenav aside widget related recommended trending share sharing social comment comments reply "
    "replies respond response responses disqus discussion footer copyright legal pagination pager masthead toolbar search".split()
)
#: Of these, what an `article` element can be by its class: a reader's comment, an advert, a teaser.
FURNITURE_ARTICLES = frozenset(
    "ad ads advert advertisement sponsored promo related recommended comment comments reply replies response responses".split()
)
#: First words of class names that say what a box has or lacks, not what it is.
HAS_OR_LACKS = frozenset("has with without no".split())
#: How firmly a place holds: it gives way to an article inside, to `main` only, or to nothing.
SOFT, FIRM, FIXED = range(3)

#: Pages judged by hand: (place, heading, words, words in links, is main text) of their blocks, in page order.
LABELLED = (
    # an article page with menus, an advert and a footer
    ((-1, 0, 1, 1, 0), (-1, 0, 1, 1, 0), (-1, 0, 2, 2, 0), (-1, 0, 8, 0, 0), (1, 1, 9, 0, 1), (1, 0, 64, 0, 1), (1, 0, 31, 2, 1), (1, 0, 3, 0, 1), (-1, 0, 14, 0, 0)),
    # a short one with an advert inside and reader comments
    ((-1, 0, 3, 3, 0), (1, 1, 6, 0, 1), (1, 0, 1, 0, 1), (1, 0, 22, 0, 1), (-1, 0, 12, 3, 0), (1, 0, 9, 0, 1), (-1, 0, 25, 0, 0), (-1, 0, 40, 0, 0)),
    # an article with a list of links at its end: inside an article links are its text
    ((1, 1, 5, 0, 1), (1, 0, 80, 6, 1), (1, 0, 2, 0, 1), (1, 0, 45, 0, 1), (1, 0, 6, 6, 1), (1, 0, 7, 7, 1), (1, 0, 5, 5, 1), (-1, 0, 20, 4, 0)),
    # a page without an article element
    ((0, 0, 1, 1, 0), (0, 0, 2, 2, 0), (0, 0, 1, 1, 0), (0, 1, 7, 0, 1), (0, 0, 55, 1, 1), (0, 0, 72, 5, 1), (0, 0, 18, 0, 1), (0, 0, 38, 0, 1), (0, 0, 5, 2, 0), (0, 0, 4, 3, 0)),
    # another, with short paragraphs between long ones
    ((0, 0, 6, 6, 0), (0, 0, 3, 0, 0), (0, 1, 8, 0, 1), (0, 0, 41, 0, 1), (0, 0, 6, 0, 1), (0, 0, 60, 3, 1), (0, 0, 9, 0, 1), (0, 0, 33, 0, 1), (0, 0, 12, 11, 0), (0, 0, 9, 8, 0)),
    # a list of teasers: no main text
    ((-1, 0, 2, 2, 0), (0, 0, 9, 9, 0), (0, 0, 8, 8, 0), (0, 0, 11, 10, 0), (0, 0, 7, 7, 0), (0, 0, 4, 0, 0), (0, 0, 3, 3, 0)),
    # notices and forms around one paragraph
    ((-1, 0, 30, 2, 0), (-1, 0, 5, 0, 0), (1, 1, 4, 0, 1), (1, 0, 28, 0, 1), (-1, 0, 16, 0, 0), (-1, 0, 2, 0, 0), (-1, 0, 11, 6, 0)),
    # articles whose short paragraphs stand beside lists of links
    ((-1, 0, 1, 1, 0), (1, 1, 2, 0, 1), (1, 0, 4, 0, 1), (1, 0, 3, 3, 1), (1, 0, 2, 0, 1), (1, 0, 5, 5, 1), (1, 0, 11, 0, 1), (1, 0, 4, 4, 1), (1, 0, 1, 0, 1), (-1, 0, 6, 6, 0)),
    ((-1, 0, 4, 4, 0), (1, 0, 2, 0, 1), (1, 0, 17, 0, 1), (1, 0, 9, 9, 1), (1, 0, 8, 8, 1), (1, 0, 20, 0, 1), (1, 0, 3, 3, 1), (1, 0, 1, 0, 1), (1, 0, 2, 2, 1), (-1, 0, 2, 0, 0)),
    # articles with many references in the running text
    ((1, 1, 4, 0, 1), (1, 0, 30, 9, 1), (1, 0, 52, 15, 1), (1, 0, 12, 4, 1), (1, 0, 25, 7, 1), (1, 0, 9, 5, 1), (-1, 0, 8, 2, 0)),
    ((0, 0, 2, 2, 0), (0, 1, 6, 0, 1), (0, 0, 60, 18, 1), (0, 0, 44, 12, 1), (0, 0, 35, 11, 1), (0, 0, 7, 4, 0), (0, 0, 3, 2, 0)),
    # pages that end with their text
    ((-1, 0, 2, 2, 0), (1, 1, 5, 0, 1), (1, 0, 30, 0, 1), (1, 0, 12, 0, 1)), ((-1, 0, 3, 3, 0), (1, 0, 40, 0, 1)),
    ((1, 1, 3, 0, 1), (1, 0, 2, 0, 1)), ((0, 1, 4, 0, 1), (0, 0, 22, 0, 1), (0, 0, 31, 1, 1)), ((0, 0, 25, 0, 1), (0, 0, 14, 0, 1)),
    # plain pages that end in, or begin with, lists of links
    ((0, 0, 1, 1, 0), (0, 0, 1, 1, 0), (0, 0, 26, 0, 1), (0, 0, 19, 0, 1), (0, 0, 15, 0, 1), (0, 0, 1, 1, 0), (0, 0, 1, 1, 0), (0, 0, 2, 0, 0)),
    ((0, 0, 2, 2, 0), (0, 1, 3, 0, 1), (0, 0, 16, 1, 1), (0, 0, 12, 0, 1), (0, 0, 3, 3, 0), (0, 0, 2, 2, 0), (0, 0, 3, 0, 0)),
    # one paragraph alone, and pages of single blocks
    ((0, 0, 48, 0, 1),), ((0, 0, 2, 2, 0),), ((1, 0, 2, 0, 1),), ((-1, 0, 50, 0, 0),),
    # related stories and copyright after plain text
    ((0, 1, 5, 0, 1), (0, 0, 90, 4, 1), (0, 0, 24, 0, 1), (0, 1, 2, 0, 0), (0, 0, 8, 8, 0), (0, 0, 10, 10, 0), (0, 0, 6, 1, 0)),
)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    heading: int
    place: int


@dataclass
class Told:
    """What the attributes of an element say of it."""

    hidden: bool = False
    role: str = ""
    furniture: bool = False  # by class or id
    teaser: bool = False  # by a class or id of one word, or that begins with `comment` or `reply`


def _told(name: str, attributes: str) -> Told:
    told = Told()
    for key, value in ATTRIBUTE.findall(attributes) if attributes else ():
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            told.hidden = True
        elif key == "role" and value.lower() in ROLES:
            told.role = value.lower()
        elif key in ("class", "id") and name not in ("html", "body"):
            for token in value.split():
                words = [word.lower() for word in NAME.findall(token)]
                if words and words[0] not in HAS_OR_LACKS and not FURNITURE_NAMES.isdisjoint(words):
                    told.furniture = True
                    told.teaser |= words[0] in ("comment", "reply") or len(words) == 1 and words[0] in FURNITURE_ARTICLES
    return told


def _place(name: str, told: Told, frame: bool, inherited: tuple[int, int]) -> tuple[int, int]:
    """(place, firmness) of what an element holds, from those of what holds it; a frame is no furniture by form or class."""
    place, firm = inherited
    if firm == FIXED:
        return inherited
    if told.hidden:
        return -1, FIXED
    says = ROLES.get(told.role, 0) or -int(told.furniture and not frame)
    if firm == FIRM:
        return (1, SOFT) if says >= 0 and "main" in (name, told.role) else inherited
    if name in FURNITURE or name == "header" and place < 1:
        return -1, FIXED if place == 1 else FIRM
    if name in FORMS and not frame and says < 1:
        return -1, FIXED if place == 1 else SOFT
    if name in ARTICLE:
        # A class says little of an article: what is filed under `format-aside` is one all the same.
        own = says < 0 and (place == 1 or told.teaser or ROLES.get(told.role, 0) < 0)
        return (-1, FIXED if place == 1 else FIRM) if own else (1, SOFT)
    return (says, FIXED if place == 1 else SOFT) if says else inherited


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in order."""
    found, boxes = _read(page)
    if boxes and not any(block.place == 1 and not block.heading and block.words > block.linked for block in found):
        half = sum(block.words - block.linked for block in found) / 2
        frames = frozenset(start for start, words in boxes if words > half)
        if frames:
            return _read(page, frames)[0]
    return found


def _read(page: str, frames: frozenset[int] = frozenset()) -> tuple[list[Block], list[tuple[int, int]]]:
    """The blocks, and where each form, fieldset or box named as furniture begins and how many words outside links it holds."""
    found: list[Block] = []
    boxes: list[tuple[int, int]] = []
    parts: list[str] = []
    linked = heading = in_link = unlinked = 0
    stack: list[tuple[str, tuple[int, int], tuple[int, int] | None]] = []  # with the box that begins there, and the words before it
    inherited = (0, SOFT)
    skipped: int | None = None  # where the outermost skipped element stands in the stack
    in_math = False
    around, within = Counter(), Counter()  # open inline elements outside and inside of it
    at, n = 0, len(page)

    def close() -> None:
        nonlocal linked, unlinked
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                count = text.count(" ") + 1
                found.append(Block(text, count, min(linked, count), int(heading > 0), inherited[0]))
                unlinked += count - found[-1].linked
        linked = 0

    def leave(depth: int) -> None:
        """Ends the open elements from this depth on; what is skipped sets neither place nor heading."""
        nonlocal inherited, heading, skipped
        inherited = stack[depth][1]
        heading -= sum(open_name in HEADINGS for open_name, _, _ in stack[depth:skipped])
        boxes.extend((box[0], unlinked - box[1]) for _, _, box in stack[depth:] if box)
        del stack[depth:]
        if skipped is not None and skipped >= depth:
            skipped = None
            within.clear()

    while at < n:
        match = MARKUP.search(page, at)
        piece = page[at:match.start() if match else n]
        if piece and skipped is None:
            if "&" in piece:
                piece = html.unescape(piece)
            parts.append(piece)
            if in_link:
                linked += len(piece.split())
        if not match:
            break
        at = match.end()
        name = match.group(2)
        if not name:
            continue
        name, closing, empty = name.lower(), match.group(1), match.group(3).endswith("/")
        if skipped is not None and not closing and name in ENDS_FOREIGN and stack[skipped][0] == "svg":
            if HOLDS_HTML.isdisjoint(open_name for open_name, _, _ in stack[skipped:]):
                leave(skipped)
        inline = name in INLINE
        if in_math and not inline and skipped is None and name not in RAW and name not in SKIPPED:
            in_math = inline = not any(open_name == name for open_name, _, _ in stack) if closing else name not in ENDS_FOREIGN
        if inline:
            if skipped is not None:
                if not closing:
                    within[name] += not empty
                    continue
                if within[name] or not around[name]:
                    within[name] -= within[name] > 0
                    continue
                leave(skipped)  # the end of what holds the skipped element
            if closing:
                around[name] -= around[name] > 0
            else:
                around[name] += not empty
            if name == "a":
                in_link = 0 if closing else 1
            elif name == "math":
                in_math = not closing and not empty
            elif name in ("br", "mtd"):
                parts.append(" ")
            continue
        if closing:
            depth = next((depth for depth in range(len(stack) - 1, -1, -1) if stack[depth][0] == name), None)
            if name not in RAW and name not in SKIPPED and (skipped is None or depth is not None and depth < skipped):
                close()
                in_link = 0
            if depth is not None:
                leave(depth)
            continue
        if name in RAW and (skipped is None or all(open_name != "svg" for open_name, _, _ in stack[skipped:])):
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else at if empty else n
            continue
        if skipped is None and name not in SKIPPED:
            close()
            in_link = 0
        if name not in VOID and not empty:
            if name in ("p", "option") and stack and stack[-1][0] == name:  # it ends where the next begins
                leave(len(stack) - 1)
            if skipped is None and name not in SKIPPED:
                told = _told(name, match.group(3))
                box = (match.start(), unlinked) if told.furniture or name in FORMS else None
                stack.append((name, inherited, box))
                heading += name in HEADINGS
                inherited = _place(name, told, match.start() in frames, inherited)
            else:
                stack.append((name, inherited, None))
                if skipped is None:
                    skipped = len(stack) - 1
    close()
    if stack:
        leave(0)
    return found, boxes


def features(words: np.ndarray, links: np.ndarray, heading: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A row for each block of one page; outside the page are empty blocks."""
    density = links / np.maximum(1, words)
    before = lambda values: np.r_[0, values[:-1]]
    after = lambda values: np.r_[values[1:], 0]
    return np.column_stack([words, density, before(words), before(density), after(words), after(density), heading, place]).astype(float)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 6) -> tuple | int:
    """(feature, threshold, low side, high side), or the label of a leaf."""
    if depth == 0 or labels.min() == labels.max():
        return int(2 * labels.sum() > len(labels))
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for threshold in (values[1:] + values[:-1]) / 2:
            low = rows[:, feature] < threshold
            impurity = sum(side.size * side.mean() * (1 - side.mean()) for side in (labels[low], labels[~low]))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, feature, threshold, low)
    if best is None:
        return int(2 * labels.sum() > len(labels))
    _, feature, threshold, low = best
    return feature, float(threshold), grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1)


def trained_tree(labelled: tuple = LABELLED) -> tuple | int:
    pages = [np.array(page, float) for page in labelled]
    rows = np.concatenate([features(page[:, 2], page[:, 3], page[:, 1], page[:, 0]) for page in pages])
    return grow(rows, np.concatenate([page[:, 4] for page in pages]))


def decided(tree: tuple | int, row: list[float]) -> int:
    while not isinstance(tree, int):
        feature, threshold, low, high = tree
        tree = low if row[feature] < threshold else high
    return tree


def main_text(page: str, tree: tuple | int) -> tuple[str, int]:
    """The page's main text and its number of blocks."""
    found = blocks(page)
    if not found:
        return "", 0
    told = np.array([(block.words, block.linked, block.heading, block.place) for block in found], float).T
    kept = [block.text for block, row in zip(found, features(*told).tolist()) if decided(tree, row)]
    return "\n".join(kept), len(found)


TEXTS = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    T.StructField("n_blocks", T.LongType()),
])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars and n_blocks of every page."""
    tree = trained_tree()
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    schema = pa.schema(list(zip(TEXTS.names, kinds)))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            results = [main_text(page or "", tree) for page in batch.column("html").to_pylist()]
            texts = [text for text, _ in results]
            columns = [
                batch.column("page_id"), batch.column("url").cast(pa.string()), pa.array(texts, pa.string()),
                pa.array(map(len, texts), pa.int64()), pa.array((count for _, count in results), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(tasks, TEXTS)
