"""Main text of web pages by tree scoring.

A page is read into a tree by a tolerant tokenizer. Every block of text passes points to the elements
above it: one, one for each comma, and one for each hundred characters up to three, in full to its
parent, half of it to the next, and so on; links take their share away. The container with the best
score, less its link density, is kept, with those siblings that score a fifth of it, read like prose, or are
plain blocks of sentences or headings beside it. Elements that are no article by their kind (menus, headers,
footers, forms, scripts ...) are left out before that.

An element with a word such as `sidebar` in its class, id or role is left out too, unless it is a wrapper: it holds over half
of the page's points, and an article, a main element, a first heading or a name that speaks for it. Names that only mention such a part
(`has-sidebar`, `no-nav`, `hidden-xs`) say nothing. Reader comments are left out in any case.

Time and memory grow with the page's length only: open elements are found by their places, points are added up from the
leaves, and a tag that cannot end makes the tokenizer go on without regard to quotes.

Defined results: a null page or one without a block has the text ''. An element that is never closed
ends with its parent; what is no valid tag is text. Repeated pages have their text each, an empty table gives no rows, and
other columns pass through whatever their names are (one named as the output is replaced)."""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Element names of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody "
    "td tfoot th thead tr ul".split()
)
LEFT_OUT = frozenset(
    "head nav header footer aside form script style noscript template iframe svg math canvas object button select textarea input dialog menu "
    "title audio video map fieldset search datalist progress meter noembed noframes xmp".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class, id and role that tell what an element is.
COMMENTS = re.compile(r"comments?|comment-?(?:list|form|area|section|body|thread)|disqus|replies|respond")
BAD = re.compile(
    r"ads?|advert\w*|advertis\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|side-?bar\w*|footer|header|masthead|cookies?|consent|gdpr|notices?|"
    r"alert|popup|modal|overlay|newsletter|subscri\w*|sign-?up|login|share|sharing|social|related|recommend\w*|breadcrumbs?|"
    r"widget\w*|toolbar|pagination|pager|search\w*|skip\w*|hidden|complementary|contentinfo|navigation|form"
)
GOOD = re.compile(r"article\w*|main|content|post|entry|story|body|text")
#: Words that turn a name into one about the page: it has or lacks such a part, or shows it on some screens only.
ABOUT = frozenset("has no not with without is layout page xs sm md lg xl result results enabled active".split())
#: Elements whose class or id is not held against them.
ROOTS = frozenset("html body main article".split())
#: An open element of the second kind ends when one of the first kind begins.
ENDS = {k: frozenset(v.split()) for k, v in {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option", "tbody": "thead tbody tr td th", "tfoot": "tbody tr td th"}.items()}
SCOPE = frozenset("ul ol dl table tr tbody thead tfoot div article section main body select".split())

NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>", re.S)
QUOTED = re.compile(r">|=\s*([\"'])")
ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
SENTENCE = re.compile(r"[.!?\u2026:;][\"'\u201d\u2019)\]]*\Z")
PARAGRAPH_ENDS = ("p", "article", "section", "div", "td", "li", "body", "button")
INSIDE = frozenset("p li td th dd dt pre blockquote span".split()) | HEADINGS


class Node:
    __slots__ = ("tag", "parent", "out", "score", "points", "chars", "linked", "good", "plain", "suspect", "holds", "last", "order", "kept")

    def __init__(self, tag, parent, out, names, order):
        self.tag, self.parent, self.out, self.order = tag, parent, out, order
        self.good, self.suspect, self.plain = names
        self.score = self.points = 0.0
        self.chars = self.linked = 0
        self.holds, self.kept, self.last = tag in ("article", "main", "h1"), False, ""


def judged(tag: str, attributes: str) -> tuple[bool, tuple[bool, int, bool]]:
    """Whether an element is left out, and whether its names speak for it, against it (1; 2: reader comments), or are none."""
    good, suspect, plain, off = tag in ("article", "main"), 0, True, tag in LEFT_OUT
    for key, value in ATTRIBUTE.findall(attributes) if attributes else ():
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id", "role"):
            plain = plain and not value
            for name in value.replace("_", "-").split():
                parts = re.split(r"[^a-z0-9]+", name)
                good = good or any(map(GOOD.fullmatch, parts))
                if tag not in ROOTS and ABOUT.isdisjoint(parts):
                    if COMMENTS.fullmatch(name) or any(map(COMMENTS.fullmatch, parts)):
                        suspect = 2
                    elif not suspect and (BAD.fullmatch(name) or any(map(BAD.fullmatch, parts))):
                        suspect = 1
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
            off = True
    return off, (good, suspect, plain)


class Page:
    """Reads a page: blocks (element, text, characters in links) in page order, and all elements, parents first."""

    def __init__(self, page: str):
        self.page, self.blocks = page, []
        self.at = Node("", None, False, (False, 0, True), 0)
        self.nodes, self.stack, self.where, self.outer = [self.at], [], {}, []
        self.part, self.chars, self.links = [], 0, 0
        self.last_end, self.quotes = page.rfind(">"), True

    def close_block(self):
        if self.part:
            text = " ".join(html.unescape("".join(self.part)).split())
            if text:
                self.blocks.append((self.stack[self.outer[-1]] if self.outer else self.nodes[0], text, min(self.chars, len(text))))
            self.part, self.chars = [], 0

    def add(self, text):
        if not self.at.out:
            self.part.append(text)
            if self.links:
                self.chars += len(text)

    def top(self, tags) -> int:
        """The place of the innermost open element of these tags; -1: none."""
        return max((self.where[t][-1] for t in tags if self.where.get(t)), default=-1)

    def cut(self, depth):
        """End the open elements from a place on."""
        while len(self.stack) > depth:
            node = self.stack.pop()
            self.where[node.tag].pop()
            if self.outer and self.outer[-1] == len(self.stack):
                self.outer.pop()
        self.at = self.stack[-1] if self.stack else self.nodes[0]

    def open(self, tag, off, names):
        self.at = Node(tag, self.at, self.at.out or off, names, len(self.nodes))
        self.nodes.append(self.at)
        self.where.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCK or tag == ARTICLE_HEADER:
            self.outer.append(len(self.stack))
        self.stack.append(self.at)
        if tag == "a" and not self.at.out:
            self.links += 1

    def tag_end(self, place: int) -> int:
        """Where the tag ends that is open at a place; -1: nowhere. A > inside a quoted value doesn't end it, until a quote
        is found that never closes: from there on quotes are characters as any other."""
        at = place
        while self.quotes:
            m = QUOTED.search(self.page, at)
            if m is None or m[1] is None:
                return -1 if m is None else m.start()
            at = self.page.find(m[1], m.end()) + 1
            if not at:
                self.quotes = False
        return self.page.find(">", place)

    def read(self):
        page, place, n = self.page, 0, len(self.page)
        while place < n:
            start = page.find("<", place)
            if start < 0 or start > self.last_end:
                start = n
            if start > place:
                self.add(page[place:start])
            if start == n:
                break
            if (m := COMMENT.match(page, start)) is not None:
                place = m.end()
            elif (m := NAME.match(page, start)) is None or (end := self.tag_end(m.end())) < 0:
                self.add("<")
                place = start + 1
            else:
                place = self.close_tag(m[2].lower(), end + 1) if m[1] else self.open_tag(m[2].lower(), page[m.end() : end], end + 1)
        self.close_block()
        return self.blocks, self.nodes

    def close_tag(self, tag, place):
        if tag == "a" and self.links:
            self.links -= 1
        if tag == "p" and not self.where.get("p"):
            self.close_block()
            return place
        if tag in BLOCK:
            self.close_block()
        if tag == "header" and self.top((ARTICLE_HEADER,)) > self.top(("header",)):
            tag = ARTICLE_HEADER
        depth = self.top((tag,))
        if depth >= 0 and (tag in BLOCK or tag == ARTICLE_HEADER or not self.outer or self.outer[-1] <= depth):
            self.cut(depth)
        return place

    def open_tag(self, tag, attributes, place):
        if tag == "br":
            self.add(" ")
            return place
        if tag in BLOCK:
            self.close_block()
            found = self.top(PARAGRAPH_ENDS)
            if found >= 0 and self.stack[found].tag == "p":  # a block ends an open paragraph
                self.cut(found)
            if tag in ENDS and (found := self.top(ENDS[tag])) >= 0 and found >= self.top(SCOPE):
                self.cut(found)
        if tag in VOID:
            return place
        if tag == "body":  # an unclosed head ends here
            self.cut(self.top(("html",)) + 1)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(self.page, place)
            return end.end() if end else len(self.page)
        off, names = judged(tag, attributes)
        if off and tag == "header" and self.where.get("article"):
            off, tag = False, ARTICLE_HEADER
        elif any(x.tag == ARTICLE_HEADER for x in self.stack[-3:]) and tag in BLOCK and tag not in HEADINGS and tag not in ("div", "hgroup"):
            off = True
        if not (attributes.endswith("/") and tag in ("svg", "math", "path", "g", "use")):
            self.open(tag, off, names)
        return place


ARTICLE_HEADER = "header-of-article"


def blocks_of(page: str) -> tuple[list[tuple[Node, str, int]], list[Node]]:
    return Page(page).read()


def rated(x: Node) -> float:
    return x.score * (1 - x.linked / max(1, x.chars)) * (2 if x.good else 1)


def add_up(found, nodes) -> None:
    """Scores, characters and points of all elements; half of an element's score goes to its parent."""
    for x in nodes:
        x.score = x.points = 0.0
        x.chars = x.linked = 0
    for holder, text, linked in found:
        points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - linked / len(text))
        node = holder.parent if holder.tag in INSIDE and holder.parent is not None else holder
        node.score += points
        holder.points += points
        holder.chars += len(text)
        holder.linked += linked
        holder.last = text
    for x in reversed(nodes[1:]):
        up = x.parent
        up.points += x.points
        up.chars += x.chars
        up.linked += x.linked
        up.last = up.last or x.last
        up.holds = up.holds or (x.holds and not x.out)
        if up.parent is not None:
            up.score += x.score / 2


def without_parts(found, nodes):
    """The blocks that stand in no element that its names speak against; where none is left, all wrappers count."""
    total, was = nodes[0].points, [x.out for x in nodes]
    for strict in (True, False):
        for x, out in zip(nodes[1:], was[1:], strict=True):
            wrapper = 2 * x.points > total and (x.holds or x.good or not strict)
            x.out = out or x.parent.out or x.suspect == 2 or (x.suspect == 1 and not wrapper)
        if kept := [b for b in found if not b[0].out]:
            return kept
    return []


def extract(page: str) -> str:
    """The main text of a page."""
    found, nodes = blocks_of(page)
    add_up(found, nodes)
    if any(x.suspect for x in nodes):
        found = without_parts(found, nodes)
        add_up(found, nodes)
    scored = [x for x in nodes if x.score > 0 and x.tag not in ("html", "")]
    if not scored:
        return "\n".join(t for h, t, linked in found if linked < len(t)) if not any(x.tag == "body" for x in nodes) else ""
    top = max(scored, key=lambda x: (rated(x), -x.order))
    wrap = top.parent
    while wrap is not None and wrap.tag not in ("html", "body", ""):  # an article or main element around it is the container
        if wrap.tag in ("article", "main"):
            top = wrap
        wrap = wrap.parent
    least = max(2.0, rated(top) / 5)
    top.kept = True
    if top.tag not in ("body", "main"):
        for x in nodes:
            if x.parent is top.parent and x is not top and not x.out and x.chars and x.linked / x.chars < 0.25:
                prose = x.tag == "p" and x.chars >= 80
                beside = x.tag in HEADINGS or (x.plain and x.tag in BLOCK and bool(SENTENCE.search(x.last or "")))
                if (x.tag in ("article", "section", "div", "p") and rated(x) >= least) or prose or (beside and top.tag not in ("article", "main")):
                    x.kept = True
    for x in nodes[1:]:
        x.kept = x.kept or x.parent.kept
    return "\n".join(text for holder, text, _ in found if holder.kept)


def main_text(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """pages without the html, with the main text in column `out`."""
    kept = [c for c in pages.columns if c not in (html_col, out)]
    schema = T.StructType([pages.schema[c] for c in kept] + [T.StructField(out, T.StringType())])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [extract(p or "") for p in part.column(part.schema.get_field_index(html_col)).to_pylist()]
                texts = [t.encode("utf-8", "replace").decode() for t in texts]  # a reference may name a lone surrogate
                cols = [part.column(part.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(texts, pa.string())], names=[*kept, out])

    return pages.select(*kept, html_col).mapInArrow(run, schema)
