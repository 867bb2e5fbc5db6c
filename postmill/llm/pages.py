"""Main text of web pages by the maximum-scoring subsequence.

A page is a row of words and tags. Words score above zero, tags below; how much is learned from
labelled pages, those that mark their content by exactly one ``article`` (or ``main``) element: a
word in a given context (in a link or not, the element around it, within the marked element or not)
scores the share of such words that lie in content, a tag the more below zero the more often it lies
outside. Each is learned once more without the mark, for pages that have none. One linear scan finds the
contiguous region of the largest sum. The region grows to the element that holds its likely words, so that
short blocks at its ends stay; on marked pages it grows on, up to the marked element, to the ancestor whose
words speak most for content. It loses what lies in menus, forms, notices and the like. Class and id count
by the parts of their names: those of adverts, comments and the like at any place; those that articles use
too (``related``, ``notice``) only as the last part, on elements other than paragraphs, and unless labelled
pages hold more such words within content than without. Elements that only their names call so are kept if
they hold most words of the best region.

Blocks are the text between block-level tags, in page order, joined by a line feed; character
references are decoded and white space in a block becomes one space. A null or empty page, and one
without text, gives an empty text. Equal rows give equal texts. Unclosed tags and pages that end in
the middle are read as far as they go. Pages of any length and nesting take time in line with their length;
of regions with equal sums the first counts, of equal ancestors the innermost. An empty table gives no rows, and
columns beside the three read are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches
from .words import named, slices

SAMPLE = 2000
SEED = 3
TAG_COST = 4.0
LEAST_WORD, LEAST_TAG = 0.05, 0.1

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S
)
ATTRIBUTE = re.compile(r"""([A-Za-z_:-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")

# Fixed values of HTML: elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe textarea template svg title object video audio canvas noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr ul".split()
)
CELL = frozenset(("td", "th", "br"))
HOLDER = frozenset("article main section div body td html table".split())
CLOSES_P = BLOCK - {"html", "head", "body"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
FENCES = frozenset("ul ol dl table body html article main section div nav aside footer header form".split())

BOILERPLATE = frozenset("nav aside footer form button select menu dialog head".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored cookie cookies consent gdpr newsletter signup sidebar nav "
    "navbar navigation breadcrumb breadcrumbs footer comment comments commentlist disqus popup modal pagination pager masthead".split()
)
AMBIGUOUS = frozenset(
    "banner login menu notice notices overlay promo promotion recommended related replies respond share sharing social subscribe subscription toolbar "
    "widget".split()
)
# Last parts of a name that say nothing, and first parts that describe a page, not an element.
FILLERS = frozenset(
    "area articles bar block box button buttons container content icons inner items links list media outer panel posts section stories top wrap "
    "wrapper".split()
)
STATES = frozenset("has no with without".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre figcaption caption span a b i em strong".split())
PAGE_HEADER = frozenset(("header", "topbar"))


class Page:
    """The elements of a page in the order of their opening, and whether one marks the content."""

    __slots__ = ("elements", "marked")

    def __init__(self):
        self.elements: list[Element] = []
        self.marked = False


class Element:
    """``number`` to ``last`` are the numbers of the elements within; ``fence`` is the depth of the nearest one that tags don't close through."""

    __slots__ = ("page", "name", "parent", "depth", "number", "last", "fence", "around", "dropped", "named", "ambiguous", "in_article")

    def __init__(self, page: Page, name: str, parent: Element | None, dropped: bool, in_article: bool):
        self.page, self.name, self.parent, self.dropped, self.in_article = page, name, parent, dropped, in_article
        self.named, self.ambiguous = False, ""
        self.depth = parent.depth + 1 if parent else 0
        self.fence = self.depth if parent is None or name in FENCES else parent.fence
        self.around = name if parent is None or name in BLOCK or name in ("td", "th") else parent.around
        self.number = self.last = len(page.elements)
        page.elements.append(self)
        page.marked = page.marked or in_article


class Token:
    """A word group or a tag: ``text`` is None for tags; ``block`` counts the blocks of the page."""

    __slots__ = ("name", "text", "element", "block", "link")

    def __init__(self, name: str, text: str | None, element: Element, block: int, link: bool):
        self.name, self.text, self.element, self.block, self.link = name, text, element, block, link


def _attributes(attributes: str) -> dict[str, str]:
    return {k.lower(): (v or "").strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}


def _boilerplate(name: str, attributes: str, parent: Element) -> bool:
    if name in BOILERPLATE:
        return True
    if name == "header":
        return not parent.in_article
    if name in ("html", "body", "main") or not attributes:
        return False
    found = _attributes(attributes)
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True
    return found.get("role", "").lower() in ROLES


def _named(name: str, attributes: str, parent: Element) -> tuple[bool, str]:
    """Whether class or id call an element boilerplate, and the ambiguous name that may do so."""
    if name in ("html", "body", "main") or not attributes:
        return False, ""
    found = _attributes(attributes)
    sure = NAMES if parent.in_article or name == "article" else NAMES | PAGE_HEADER
    ambiguous = ""
    for label in f"{found.get('class', '')} {found.get('id', '')}".split():
        parts = [x.lower() for x in SPLIT.split(label) if x and not x.isdigit()]
        if not parts or parts[0] in STATES:
            continue
        if not sure.isdisjoint(parts):
            return True, ""
        while len(parts) > 1 and parts[-1] in FILLERS:
            parts.pop()
        if parts[-1] in AMBIGUOUS and name not in PARAGRAPHS:
            ambiguous = parts[-1]
    return False, ambiguous


def tokens(source: str) -> list[Token]:
    """The page's words and tags with the elements around them."""
    page = Page()
    root = Element(page, "", None, False, False)
    top, block, links, out = root, 0, 0, []
    opened: dict[str, list[Element]] = {}
    unended: set[str] = set()
    at, end = 0, len(source)

    def text(piece: str) -> None:
        if piece:
            out.append(Token("", html.unescape(piece), top, block, links > 0))

    def close(element: Element) -> None:
        nonlocal top, links
        while top is not element.parent:
            links -= top.name == "a"
            opened[top.name].pop()
            top = top.parent

    while at < end:
        m = TOKEN.search(source, at)
        if m is None:
            text(source[at:])
            break
        text(source[at : m.start()])
        at = m.end()
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if name in BLOCK:
            block += 1
        elif name in CELL:
            out.append(Token("", " ", top, block, False))
        if closing:
            if opened.get(name):
                close(opened[name][-1])
            out.append(Token("/" + name, None, top, block, False))
            continue
        if name in RAW:
            # Its content is no text; it ends at its own end tag only.
            if not attributes.rstrip().endswith("/") or name in ("script", "style"):
                stop = None if name in unended else re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(source, at)
                if stop is None:
                    unended.add(name)
                at = stop.end() if stop else (end if name in ("script", "style", "textarea") else at)
            out.append(Token(name, None, top, block, False))
            continue
        ends = SIBLINGS.get(name, set()) | ({"p"} if name in CLOSES_P else set())
        fence = top.fence
        for ended in ends:
            # Of several open ones beyond the fence the outermost is closed, and the others with it.
            while opened.get(ended) and opened[ended][-1].depth > fence:
                close(opened[ended][-1])
        if name == "a" and links:  # links don't nest
            close(opened["a"][-1])
        if name not in VOID:
            parent = top
            dropped = parent.dropped or _boilerplate(name, attributes, parent)
            top = Element(page, name, parent, dropped, parent.in_article or (name in ("article", "main") and not dropped))
            if not dropped:
                top.named, top.ambiguous = _named(name, attributes, parent)
            opened.setdefault(name, []).append(top)
            links += name == "a"
        out.append(Token(name, None, top, block, False))
    for element in reversed(page.elements[1:]):
        element.parent.last = max(element.parent.last, element.last)
    return out


def _event(token: Token, mark: bool = True) -> str:
    """What a token counts as; ``mark`` tells words and tags of the marked element from the others."""
    element = token.element
    place = " -" if element.dropped else (" in" if element.in_article else " out") if mark and element.page.marked else ""
    if token.text is None:
        return f"<{token.name}>{place if place != ' -' else ''}"
    return f"{'link' if token.link else 'word'} {element.around}{place}"


def _size(token: Token) -> int:
    return len(token.text.split()) if token.text is not None else 1


def _share(token: Token, weights: dict[str, float]) -> float:
    event = _event(token)
    share = weights.get(event, -1.0)
    return _default(event) if share < 0 else share


def labelled(row: list[Token]) -> list[bool] | None:
    """Which tokens are content, if the page says so by one article or main element."""
    for name in ("article", "main"):
        if sum(t.name == name for t in row) == 1:
            inside, marks = False, []
            for t in row:
                inside = (inside or t.name == name) and t.name != "/" + name
                marks.append(inside and not t.element.dropped)
            return marks
    return None


def _ambiguous_words(row: list[Token], marks: list[bool]) -> Iterator[tuple[str, int]]:
    """The ambiguous names of the nearest element that has one, with the words in it; below zero outside of content."""
    nearest = [""] * len(row[0].element.page.elements) if row else []
    for element in row[0].element.page.elements[1:] if row else []:
        nearest[element.number] = element.ambiguous or nearest[element.parent.number]
    for token, content in zip(row, marks, strict=True):
        if token.text is not None and nearest[token.element.number]:
            yield nearest[token.element.number], _size(token) * (1 if content else -1)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    inside: Counter[str] = Counter()
    outside: Counter[str] = Counter()
    for batch in batches:
        for page in named(batch, "html").to_pylist():
            row = tokens(page)
            marks = labelled(row)
            if marks is None:
                continue
            for name, size in _ambiguous_words(row, marks):
                (inside if size > 0 else outside)[f"name {name}"] += abs(size)
            judged(row, {})
            for token, content in zip(row, marks, strict=True):
                content = content and not token.element.dropped
                for event in {_event(token), _event(token, False)}:
                    (inside if content else outside)[event] += _size(token)
    names = sorted(inside.keys() | outside.keys())
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array([inside[n] for n in names], pa.int64()), pa.array([outside[n] for n in names], pa.int64())],
        names=["event", "inside", "outside"],
    )


def learned(pages: DataFrame, sample: int = SAMPLE) -> dict[str, float]:
    """The share of each event that lies in content, from about ``sample`` pages at most."""
    known = pages.where(F.col("html").isNotNull())
    count = known.count()
    share = int(1_000_000 * min(1.0, sample / max(count, 1))) + 1
    picked = known.where(F.pmod(F.xxhash64(F.lit(SEED), "html"), F.lit(1_000_000)) < share).select("html")
    counts = picked.mapInArrow(_counted, "event string, inside long, outside long").groupBy("event").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o"))
    frequent = counts.where(F.col("i") + F.col("o") >= 5).orderBy(F.desc(F.col("i") + F.col("o")), "event").limit(5000)
    return {r.event: (r.i + 1) / (r.i + r.o + 2) for r in frequent.collect()}


def _default(event: str) -> float:
    """For events that no labelled page shows."""
    kind, _, place = event.partition(">") if event[0] == "<" else (event, "", event.rpartition(" ")[2])
    place = place.strip()
    if place == "-":
        return 0.0
    if place == "out":
        return 0.1
    if event[0] != "<":
        return (0.6 if event.startswith("link") else 0.9) if place == "in" else 0.2 if event.startswith("link") else 0.8
    return 0.8 if kind.strip("</>") in ("p", "b", "i", "em", "strong", "br", "h1", "h2", "h3", "blockquote", "pre", "code", "span", "a", "sup", "sub", "li", "ul", "ol", "img") else 0.3


def region(row: list[Token], weights: dict[str, float]) -> tuple[int, int]:
    """First and last token of the contiguous tokens with the largest sum; (0, -1) if none is above zero."""
    best, first, last, total, begin = 0.0, 0, -1, 0.0, 0
    for k, token in enumerate(row):
        share = _share(token, weights)
        if token.text is not None:
            score = max(share, LEAST_WORD) * _size(token)
        else:
            score = -max(TAG_COST * (1 - share), LEAST_TAG)
        if total <= 0:
            total, begin = 0.0, k
        total += score
        if total > best:
            best, first, last = total, begin, k
    return first, last


def judged(row: list[Token], weights: dict[str, float]) -> list[Token]:
    """Drop the elements that are boilerplate by name, but none that holds most words of the best region."""
    elements = row[0].element.page.elements if row else []
    for node in elements:
        node.named = node.named or (bool(node.ambiguous) and weights.get(f"name {node.ambiguous}", 0.0) < 0.5)
    if not any(node.named for node in elements):
        return row
    first, last = region(row, weights)
    held = [0] * len(elements)
    for token in row[first : last + 1]:
        if token.text is not None and not token.element.dropped:
            held[token.element.number] += _size(token)
    for node in reversed(elements[1:]):
        held[node.parent.number] += held[node.number]
    for node in elements:  # an element comes before those inside it
        node.named = node.named and 2 * held[node.number] <= held[0]
        node.dropped = node.dropped or node.named or (node.parent is not None and node.parent.dropped)
    return row


def _holder(row: list[Token], first: int, last: int, weights: dict[str, float]) -> Element | None:
    """The element that the region grows to."""
    held = [t for t in row[first : last + 1] if t.text is not None and t.text.strip() and not t.element.dropped]
    held = [t.element for t in held if _share(t, weights) >= 0.5] or [t.element for t in held]
    if not held:
        return None
    low, high = min(e.number for e in held), max(e.number for e in held)
    holder = held[0]
    while not holder.number <= low <= high <= holder.last:
        holder = holder.parent
    while holder.parent is not None and holder.name not in HOLDER:
        holder = holder.parent
    if not holder.in_article:
        return holder
    speaks = [0.0] * len(holder.page.elements)
    for token in row:
        if token.text is not None and not token.element.dropped:
            speaks[token.element.number] += (_share(token, weights) - 0.5) * _size(token)
    for node in reversed(holder.page.elements[1:]):
        speaks[node.parent.number] += speaks[node.number]
    best = node = holder
    while node.name not in ("article", "main"):
        node = node.parent
        if speaks[node.number] > speaks[best.number]:
            best = node
    return best


def main_text(page: str | None, weights: dict[str, float]) -> str:
    row = judged(tokens(page or ""), weights)
    first, last = region(row, weights)
    holder = _holder(row, first, last, weights)
    if holder is None:
        return ""
    whole = holder.name in ("", "html", "body")

    def inside(token: Token) -> bool:
        if whole and not (row[first].block <= token.block <= row[last].block):
            return False
        return holder.number <= token.element.number <= holder.last and not token.element.dropped

    blocks: dict[int, list[str]] = {}
    for token in row:
        if token.text is not None and inside(token):
            blocks.setdefault(token.block, []).append(token.text)
    lines = (" ".join("".join(parts).split()) for _, parts in sorted(blocks.items()))
    return "\n".join(line for line in lines if line)


def _extracted(weights):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(page, weights.value) for page in named(part, "html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [named(part, "page_id"), named(part, "url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return extract


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    bounded_batches(pages.sparkSession)
    rows = pages.select("page_id", "url", "html")
    weights = pages.sparkSession.sparkContext.broadcast(learned(rows))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:2])
    return rows.mapInArrow(_extracted(weights), f"{kinds}, text string, n_chars long")


def op7(pages: DataFrame) -> DataFrame:
    return extracted(pages)
