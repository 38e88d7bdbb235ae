"""Main text of web pages by tag-path ratios.

Every text node has a tag path, the tags of its open elements from the root
(ids and classes are no part of it: they tell like elements apart).  Per path of
a page: text length per node, punctuation per node and the share of text in
links.  The ratios are smoothed over the page's sequence of nodes (a node's
neighbours speak for it), fused into one score per path, doubled inside an
article or main element, and paths above a share of the best score are
content.  Every element that holds content paths is taken, with its blocks in
page order: the article and main elements that have any, or else the deepest
element with nine tenths of the content paths' text; and whatever content paths
lie outside these, with the element around them.  Inside a taken element the
threshold is low (a heading or a short line is content), but blocks of a path
whose text is links, a menu in the article, are below it.  Left out are blocks
in an element whose tag or role says menu, header, footer, notice or form.

A class or id that says reader comments, however it is spelled
(``user-comments``, ``disqus_thread``, ``commentList``) and whatever its size,
leaves its element out, unless that is nearly all of the page and shows none of
the like children that comments are.  One that says sidebar, advert, share or
the like only lowers the scores of the paths in its element: much if the name
says nothing else, less if it is part of a longer one.  Such a name does not
count on an element that holds most of the content paths' text, nor on a page
where the elements so named hold most of it between them.  Of an element whose
name counts blocks are taken only if one of its paths is content still.

The work is row-local: one scan, no shuffle.  A page is read once from left to
right; elements and paths are numbered and know their parents, so time and
memory grow with the page's length, whatever its depth or its faults.  A quote
matters only right after an attribute's ``=``; a tag that would run to the end
of the page ends at the next ``>`` instead, as do all after it, and without one
the rest is text.

Edge cases: null or empty pages give an empty text; pages without tags are one
block; unclosed and stray tags are closed as a browser would, roughly; other
columns are ignored and repeated rows stay.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import small_batches

#: A path is content from this share of the best fused score.
THRESHOLD = 0.2
#: In a taken element a path is left out from this share of its text in links.
MENU = 0.95
#: Paths inside an article or main element score so many times more.
ARTICLE = 2.0
#: An element named as comments may be the article where less than this share of the text,
#: and fewer characters than this, are outside.
BESIDE, FEW = 0.1, 200
#: Gaussian weights of a node and of its neighbours at distance 1 and 2.
SMOOTH = np.exp(-0.5 * (np.arange(-2, 3) / 1.0) ** 2)

TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"""[\s/]*(?:(>)|([^\s/>][^\s/>=]*)(?:\s*=\s*(?:(["'])|([^\s>]*)))?)""")
SPACE = re.compile(r"\s+")
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？]")
PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: Elements whose content is no text of the page.
RAW = {
    tag: re.compile(rf"</{tag}\s*>", re.I)
    for tag in "script style noscript template svg math textarea iframe object canvas select".split()
}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements that an opening tag of the same row closes.
CLOSES = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LEFT_OUT = frozenset("head title nav footer aside form button menu dialog label".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
WORDS = (
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|notification|popup|modal|overlay|side-?bar|nav(?:bar|igation)?"
    r"|menu|breadcrumbs?|footer|masthead|site-?header|page-?header|comments?|comment-?list|disqus|replies|reply|respond|share|sharing|social"
    r"|related|recommend\w*|newsletter|subscribe|signup|login|pagination|pager|widget|toolbar)"
)
#: A word in a class or id, and a class or id of such words alone; what a path's score is multiplied by.
NAMES = re.compile(rf"(?:^|[\s_-])({WORDS})(?=$|[\s_-])", re.I)
ONLY = re.compile(rf"{WORDS}(?:[_-]+{WORDS})*", re.I)
PARTLY, WHOLLY = 0.3, 0.1
#: Words that say reader comments, and those beside them that say something about comments instead.
COMMENTS = frozenset("comment comments commentlist commentform disqus livefyre reply replies respond responses".split())
ABOUT = frozenset("no has with without open opened closed off on enabled disabled allow allowed count counter link links number num total hide show".split())
#: Elements of running text: any number of them alike says nothing.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 ul ol table tr td th tbody thead blockquote pre figure hr dl dt dd".split())


class Element:
    __slots__ = ("above", "alike", "article", "block", "comments", "in_link", "kind", "left_out", "lowers", "names", "number", "said", "tag")

    def __init__(self, number: int, tag: str, above: Element | None):
        self.number, self.tag, self.above = number, tag, above
        self.block = self if tag in BLOCKS else above.block if above else None
        self.article = (above.article if above else False) or tag in ("article", "main")
        self.in_link = tag == "a" or (above.in_link if above else False)
        self.left_out = above.left_out if above else False
        self.names: frozenset[str] = frozenset()
        self.said: frozenset[str] = above.said if above else frozenset()
        self.lowers, self.comments, self.alike, self.kind = 1.0, False, None, ""


class Node:
    __slots__ = ("block", "inside", "size", "text")

    def __init__(self, inside: Element, block: int, text: str):
        self.inside, self.block, self.text, self.size = inside, block, text, len(text.strip())


def says_comments(name: str) -> bool:
    pieces = {x.lower() for x in PIECES.findall(name)}
    return not pieces.isdisjoint(COMMENTS) and pieces.isdisjoint(ABOUT)


def _describe(e: Element, attributes: list[tuple[str, str]]) -> None:
    """What the tag, role and names of an element say of it."""
    e.left_out |= e.tag in LEFT_OUT or (e.tag == "header" and not (e.above and e.above.article))
    names, named = set(), []
    for key, value in attributes:
        if key in ("class", "id"):
            named += value.split()
        elif key == "role":
            e.left_out |= value.lower() in ROLES
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
            e.left_out = True
    if named:
        e.kind = " ".join(x for x in named if not any(c.isdigit() for c in x))
        e.comments = e.tag not in ("html", "body", "main") and any(map(says_comments, named))
        if e.tag not in ("html", "body", "article", "main"):
            for name in named:
                if said := NAMES.findall(name):
                    names.update(x.lower()[:6] for x in said)
                    e.lowers = min(e.lowers, WHOLLY if ONLY.fullmatch(name) else PARTLY)
            if names:
                e.names, e.said = frozenset(names), e.said | names


class Page:
    """The elements and text nodes of a page, in order."""

    def __init__(self, page: str):
        self.page, self.nodes, self.elements = page, [], []
        self.root = Element(0, "", None)
        self.elements.append(self.root)
        self.stack, self.open, self.block = [self.root], Counter(), 0
        self.loose, self.no_data = False, False
        self._read()

    def _take(self, text: str) -> None:
        if text:
            self.nodes.append(Node(self.stack[-1], self.block, text))

    def _attributes(self, at: int) -> tuple[int, list[tuple[str, str]]]:
        """Where the tag ends whose name ended at ``at``, and its attributes;
        -1 if it never ends."""
        page, found = self.page, []
        end = page.find(">", at)
        if end < 0:
            return -1, []
        quotes = not self.loose and (page.find('"', at, end) >= 0 or page.find("'", at, end) >= 0)
        pos, stop = at, len(page) if quotes else end + 1
        while (m := ATTRIBUTE.match(page, pos, stop)) is not None:
            if m[1]:
                return m.end(), found
            pos, value = m.end(), m[4] or ""
            if m[3]:
                close = page.find(m[3], pos, stop)
                if close < 0 and quotes:
                    break
                close = min(x for x in (close, stop - 1) if x >= 0)
                value, pos = page[pos:close], close + (close < stop - 1)
            found.append((m[2].lower(), value))
        if not quotes:
            return end + 1, found
        self.loose = True  # a quote that never closes: from here on tags end at the next ">"
        return self._attributes(at)

    def _pop(self, size: int) -> None:
        for e in self.stack[size:]:
            self.open[e.tag] -= 1
        del self.stack[size:]

    def _close(self, element: Element) -> None:
        size = len(self.stack) - 1
        while self.stack[size] is not element:
            size -= 1
        self._pop(size)

    def _read(self) -> None:
        page, at, start = self.page, 0, 0
        while (at := page.find("<", at)) >= 0:
            following = page[at + 1 : at + 2]
            if following in ("!", "?"):
                end = self._declaration(at)
                self._take(page[start:at])
                at = start = end
                continue
            closing = following == "/"
            name = TAG_NAME.match(page, at + 1 + closing)
            if name is None:
                at += 1
                continue
            end, attributes = self._attributes(name.end())
            if end < 0:
                break  # no ">" from here on: text
            self._take(page[start:at])
            at = start = self._tag(name[0].lower(), closing, attributes, end)
        self._take(page[start:])

    def _declaration(self, at: int) -> int:
        page = self.page
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            return len(page) if end < 0 else end + 3
        if page.startswith("<![CDATA[", at) and not self.no_data:
            end = page.find("]]>", at)
            if end >= 0:
                return end + 3
            self.no_data = True
        end = page.find(">", at)
        return len(page) if end < 0 else end + 1

    def _tag(self, tag: str, closing: bool, attributes: list[tuple[str, str]], end: int) -> int:
        """Takes in a tag; where reading goes on."""
        shut = self.page[end - 2] == "/"
        if tag in RAW and not closing:
            self._take(" ")
            if shut and tag in ("svg", "math"):
                return end
            stop = RAW[tag].search(self.page, end)
            return stop.end() if stop else len(self.page)
        if tag in BLOCKS:
            self.block += 1
        elif tag in ("br", "wbr"):
            self._take(" ")
        if closing:
            if self.open[tag]:
                size = len(self.stack) - 1
                while self.stack[size].tag != tag:
                    size -= 1
                self._pop(size)
            return end
        if tag in VOID or shut:
            return end
        around = self.stack[-1].block
        if tag in BLOCKS and around is not None and (around.tag == "p" or around.tag in CLOSES.get(tag, ())):
            self._close(around)
        above = self.stack[-1]
        e = Element(len(self.elements), tag, above)
        _describe(e, attributes)
        if tag not in PROSE and (tag != "li" or e.kind) and e.block is e:
            above.alike = above.alike or Counter()
            above.alike[tag, e.kind] += 1
        self.elements.append(e)
        self.stack.append(e)
        self.open[tag] += 1
        return end


def sums_inside(elements: list[Element], own: dict[int, int]) -> list[int]:
    """A figure of every element with all inside it, from the elements' own."""
    total = [own.get(e.number, 0) for e in elements]
    for e in reversed(elements):
        if e.above is not None:
            total[e.above.number] += total[e.number]
    return total


def leave_out_comments(page: Page) -> None:
    """Marks what is inside elements of reader comments as left out."""
    outer, within = [], [False] * len(page.elements)
    for e in page.elements:
        above = e.above is not None and within[e.above.number]
        within[e.number] = above or e.comments
        if e.comments and not above:
            outer.append(e)
    if not outer:
        return
    own: dict[int, int] = defaultdict(int)
    for n in page.nodes:
        own[n.inside.number] += n.size * (not n.inside.left_out)
    size = sums_inside(page.elements, own)
    alike = sums_inside(page.elements, {e.number: 1 for e in page.elements if e.alike and max(e.alike.values()) > 1})
    beside = size[0] - sum(size[e.number] for e in outer)
    article = any(e.tag in ("article", "main") and not within[e.number] and size[e.number] for e in page.elements)
    if len(outer) == 1 and not alike[outer[0].number] and not article and beside < min(BESIDE * size[0], FEW):
        return
    for e in page.elements:
        e.left_out |= within[e.number]


class Paths:
    """Tag paths as numbers: a path's step, the path above, and what follows from them."""

    def __init__(self, elements: list[Element], marks: dict[int, str]):
        self.above, self.step, self.depth = [-1], [""], [0]
        self.article, self.mark, self.block = [-1], [-1], [0]
        known: dict[tuple[int, str], int] = {}
        self.of = [0] * len(elements)
        for e in elements[1:]:
            above, step = self.of[e.above.number], e.tag + marks.get(e.number, "")
            path = known.get((above, step))
            if path is None:
                path = known[above, step] = len(self.above)
                self.above.append(above)
                self.step.append(step)
                self.depth.append(self.depth[above] + 1)
                # the outermost article or main element, the innermost mark, the innermost block
                self.article.append(self.article[above] if self.article[above] >= 0 else path if e.tag in ("article", "main") else -1)
                self.mark.append(path if step[-1] in "!?" else self.mark[above])
                self.block.append(path if self._is_block(path) else self.block[above])
            self.of[e.number] = path

    def _is_block(self, path: int) -> bool:
        return self.step[path].rstrip("!?") in BLOCKS - {"p"}

    def lowered(self, path: int) -> float:
        """What the names on the path multiply its score by (the lowest counts)."""
        least, path = 1.0, self.mark[path]
        while path >= 0:
            if self.step[path][-1] == "!":
                return WHOLLY
            least, path = PARTLY, self.mark[self.above[path]]
        return least


def path_scores(nodes: list[Node], paths: Paths) -> dict[int, float]:
    """The fused, smoothed tag-path ratio of every path that has text."""
    length, points, linked, count = (defaultdict(float) for _ in range(4))
    order = []
    for n in nodes:
        path = paths.of[n.inside.number]
        points[path] += len(PUNCTUATION.findall(n.text))
        if n.size:
            order.append(path)
            count[path] += 1
            length[path] += n.size
            linked[path] += n.size * n.inside.in_link
    text_ratio = np.array([length[p] / count[p] for p in order])
    point_ratio = np.array([points[p] / count[p] for p in order])
    smooth = lambda x: np.convolve(x, SMOOTH)[2 : len(x) + 2]
    weights = smooth(np.ones(len(order)))
    smooth_text, smooth_points = (smooth(x) / weights for x in (text_ratio, point_ratio))
    sums: dict[int, float] = defaultdict(float)
    for p, t, u in zip(order, smooth_text, smooth_points, strict=True):
        sums[p] += math.log1p(t) * (1 + math.log1p(u))
    return {p: s / count[p] * (1 - linked[p] / length[p]) * (ARTICLE if paths.article[p] >= 0 else 1) * paths.lowered(p) for p, s in sums.items()}


def counting_names(page: Page, nodes: list[Node]) -> dict[int, str]:
    """Marks of the elements whose names count: "!" for a whole name, "?" for a part."""
    if not any(e.names for e in page.elements):
        return {}
    paths = Paths(page.elements, {})
    scores = path_scores(nodes, paths)
    least = THRESHOLD * max(scores.values())
    own, said, total = defaultdict(int), defaultdict(int), 0
    for n in nodes:
        if n.size and scores[paths.of[n.inside.number]] >= least:
            total += n.size
            own[n.inside.number] += n.size
            for name in n.inside.said:
                said[name] += n.size
    size = sums_inside(page.elements, own)
    return {
        e.number: "!" if e.lowers == WHOLLY else "?"
        for e in page.elements
        if e.names and 2 * size[e.number] <= total and any(2 * said[x] <= total for x in e.names)
    }


def menus(nodes: list[Node], paths: Paths) -> set[int]:
    """Block paths whose text is links."""
    length, linked = defaultdict(int), defaultdict(int)
    for n in nodes:
        path = paths.of[n.inside.block.number] if n.inside.block else 0
        length[path] += n.size
        linked[path] += n.size * n.inside.in_link
    return {p for p, x in length.items() if x and linked[p] >= MENU * x}


def main_text(text: str) -> str:
    if not text or not text.strip():
        return ""
    page = Page(text)
    leave_out_comments(page)
    nodes = [n for n in page.nodes if not n.inside.left_out]
    if not any(n.size for n in nodes):
        return ""
    paths = Paths(page.elements, counting_names(page, nodes))
    scores = path_scores(nodes, paths)
    least = THRESHOLD * max(scores.values())
    content: dict[int, int] = defaultdict(int)
    for n in nodes:
        path = paths.of[n.inside.number]
        if n.size and scores[path] >= least:
            content[path] += n.size
    roots = _roots(paths, content)
    held = [False] * len(paths.above)
    for path, above in enumerate(paths.above):
        held[path] = path in roots or (above >= 0 and held[above])
    spoken = {-1, *(paths.mark[p] for p in content)}
    listed = menus(nodes, paths)
    blocks: dict[int, list[str]] = defaultdict(list)
    for n in nodes:
        path = paths.of[n.inside.number]
        around = paths.of[n.inside.block.number] if n.inside.block else 0
        if path in content or (held[path] and paths.mark[path] in spoken and around not in listed):
            blocks[n.block].append(n.text)
    texts = (SPACE.sub(" ", html.unescape("".join(parts))).strip() for parts in blocks.values())
    return " ".join(t for t in texts if t)


def _roots(paths: Paths, content: dict[int, int]) -> set[int]:
    """The elements that hold the content paths (with their text's length):
    article and main elements, else the deepest element that holds nine tenths
    of the text; then those around the content paths that lie outside."""
    roots = {paths.article[p] for p in content if paths.article[p] >= 0}
    if not roots:
        under = [content.get(p, 0) for p in range(len(paths.above))]
        for p in range(len(under) - 1, 0, -1):
            under[paths.above[p]] += under[p]
        most = 0.9 * sum(content.values())
        roots = {max((p for p, size in enumerate(under) if size >= most and paths.block[p] == p), key=lambda p: paths.depth[p])}
    above, inside = set(), [False] * len(paths.above)
    for r in roots:
        while r >= 0 and r not in above:
            above.add(r)
            r = paths.above[r]
    for p, up in enumerate(paths.above):
        inside[p] = p in roots or (up >= 0 and inside[up])
    for p in content:
        if not inside[p]:
            around = paths.block[p]
            roots = roots | ({p if around in above else around} - above)
    return roots


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch.column("html")]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points)."""
    small_batches(pages.sparkSession)
    kind = pages.schema["page_id"].dataType.simpleString()
    out = pages.select("page_id", "url", "html").mapInArrow(_extract, f"page_id {kind}, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
