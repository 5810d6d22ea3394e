"""Main text of web pages from parser events.

The standard library's parser streams a page into lines (one per block element) with the number of tags in
them. Each line's text-to-tag ratio is smoothed by a Gaussian; lines over the page's threshold form clusters.
If articles and mains together hold most of the clustered text, the content is theirs: each one with clusters of its
own gives all its lines, the others what lies between clusters. Otherwise it is the run from the page's first
cluster to its last. Lines in menus, adverts and other furniture have ratio zero and are left out. A form or an
element with a furniture class counts as content all the same if the page would keep next to nothing without it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from trailkeep.llm.common import map_arrow

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are never content.
FURNITURE = frozenset(
    "aside button canvas datalist dialog footer form head iframe input label menu nav noscript object option script select style svg template "
    "textarea title".split())
#: Words of class, id or role that mark furniture; those of the second kind only outside an article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner navbar nav navigation menu "
    "breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social related recommended comment comments commentlist disqus respond reply replies pagination pager toolbar widget "
    "search contentinfo complementary disclaimer skip".split())
OUTSIDE = frozenset("header masthead topbar".split())
#: Beginnings of class names that tell of the page and not of the element, as in ``has-sidebar``.
ABOUT = ("has", "no", "with")
#: Marks of reader comments: only an element with a main heading or the page's main part outweighs them.
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies".split())
#: Whole class names of content; an element with one is not taken for comments alone.
CONTENT = frozenset("article content entry main post story".split())
#: Open elements are followed to this depth; deeper ones belong to the last one.
DEEPEST = 512
_OPENING = re.compile(r"<[A-Za-z/!?]")
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACE = re.compile(r"\s+")
SIGMA, RADIUS = 1.0, 2
_WEIGHTS = [math.exp(-(i * i) / (2 * SIGMA * SIGMA)) for i in range(-RADIUS, RADIUS + 1)]


def _own_words(name: str) -> list[str]:
    """The words of a class name that say what its element is."""
    words = _NAMES.findall(name)
    return [] if len(words) > 1 and words[0].lower() in ABOUT else words


class _Lines(HTMLParser):
    """Collects ``(text, tags, mark, container, heading)`` per line; container is the enclosing article or main.

    ``marks`` lists the elements that look like furniture, number 0 standing for none:
    ``[enclosing mark, may be content, is of comments, text in it and in no inner mark, landmarks, main parts and headings]``.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, bool]] = []
        self.open: list[tuple[str, int, int]] = []
        self.marks: list[list] = [[0, True, False, 0, 0, 0]]
        self.deeper: Counter = Counter()
        self.parts: list[str] = []
        self.tags = 0
        self.outermost = [0]

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Sections such as ``<![if ...]>`` are skipped, whatever their keyword."""
        end = "]]>" if self.rawdata.startswith("<![CDATA[", i) else ">"
        at = self.rawdata.find(end, i)
        return at + len(end) if at >= 0 else -1

    def _state(self) -> tuple[int, int]:
        return (self.open[-1][1], self.open[-1][2]) if self.open else (0, 0)

    def _flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            mark, container = self._state()
            heading = any(t in ("h1", "h2", "h3") for t, _, _ in self.open[-4:])
            self.lines.append((text, self.tags, mark, container, heading))
            self.marks[mark][3] += len(text)
        self.parts, self.tags = [], 0

    def _marked(self, tag: str, attributes: list, container: int) -> tuple[bool, bool] | None:
        """Whether a furniture element may be content after all, and whether it is of comments; None for other elements."""
        if tag in FURNITURE or (tag == "header" and not container):
            return tag == "form", False
        if tag in ("html", "body", "article", "main"):
            return None
        for name, value in attributes:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return False, False
            if value and name in ("class", "id", "role"):
                words = {w.lower() for whole in value.split() for w in _own_words(whole)}
                if words & MARKS or (not container and words & OUTSIDE):
                    return True, bool(words & COMMENTS) and not CONTENT & set(value.lower().split())
        return None

    def _close(self, count: int) -> None:
        self._flush()
        del self.open[len(self.open) - count:]

    def handle_starttag(self, tag: str, attributes: list) -> None:
        if tag in BLOCKS:
            self._flush()
            names = [t for t, _, _ in self.open]
            if "head" in names and tag != "head":
                self._close(len(names) - names.index("head"))
            elif "p" in names and not set(names[len(names) - names[::-1].index("p"):]) & BLOCKS:
                # a block ends an open paragraph, but inline elements left open in it stay harmless
                self._close(names[::-1].index("p") + 1)
            elif tag in ("li", "tr", "td", "th", "dt", "dd", "option") and names and names[-1] == tag:
                self._close(1)
        self.tags += 1
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        if len(self.open) >= DEEPEST:
            self.deeper[tag] += 1
            return
        mark, container = self._state()
        inner = mark
        if tag in ("article", "main") and not mark:
            self.outermost.append(self.outermost[container] or len(self.outermost))
            container = len(self.outermost) - 1
        elif (found := self._marked(tag, attributes, container)) and (not mark or self.marks[mark][1]):
            self.marks.append([mark, *found, 0, 0, 0])
            inner = len(self.marks) - 1
            self._flush()
        if tag in ("article", "main", "h1"):
            self.marks[inner][4] += 1
            self.marks[inner][5] += tag != "article"
        self.open.append((tag, inner, container))

    def handle_startendtag(self, tag: str, attributes: list) -> None:
        self.handle_starttag(tag, attributes)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if self.deeper[tag]:
            self.deeper[tag] -= 1
            if tag in BLOCKS:
                self._flush()
            return
        for depth, (name, furniture, _) in enumerate(reversed(self.open), 1):
            if name == tag:
                outer = len(self.open) > depth and self.open[-depth - 1][1]
                if tag in BLOCKS or furniture != outer:
                    self._close(depth)
                else:
                    del self.open[len(self.open) - depth]
                return
            if name in ("article", "main", "td", "table", "body") and tag not in BLOCKS:
                return

    def handle_data(self, data: str) -> None:
        self.parts.append(data)

    def read(self, html: str) -> list[tuple[str, int, bool, int, bool]]:
        """The lines of a page, furniture told from content. What stands behind the last tag is text up to an unfinished tag."""
        end = html.rfind(">") + 1
        self.feed(html[:end])
        self.close()
        rest = html[end:]
        unfinished = _OPENING.search(rest)
        if not self.cdata_elem:
            self.handle_data(unescape(rest[:unfinished.start()] if unfinished else rest))
        self._flush()
        furniture = self._furniture()
        return [(text, tags, furniture[mark], container, heading) for text, tags, mark, container, heading in self.lines]

    def _furniture(self) -> list[bool]:
        """For each mark, outer ones first, whether its lines are furniture.

        An element that may be content is if it holds more than half of the text that may be, and what is content
        without it either makes up less than a tenth or lacks an article, main part or main heading while it has one.
        """
        size, marked = [m[3] for m in self.marks], [m[4] for m in self.marks]
        for i in range(len(self.marks) - 1, 0, -1):
            outer, maybe = self.marks[i][:2]
            if maybe:
                size[outer] += size[i]
                marked[outer] += marked[i]
        mains = [m[5] for m in self.marks]
        for i in range(len(self.marks) - 1, 0, -1):
            mains[self.marks[i][0]] += mains[i]
        total, plain, landmarks = size[0], self.marks[0][3], self.marks[0][4]
        out = [False]
        for i, (outer, maybe, comments, own, landed, _) in enumerate(self.marks[1:], 1):
            lacking = 10 * plain < total or (marked[i] and not landmarks)
            content = maybe and not out[outer] and lacking and 2 * size[i] > total and (not comments or mains[i])
            out.append(not content)
            if content:
                plain += own
                landmarks += landed
        return out


def _smoothed(ratios: list[float]) -> list[float]:
    out = []
    for i in range(len(ratios)):
        near = [(w, ratios[j]) for w, j in zip(_WEIGHTS, range(i - RADIUS, i + RADIUS + 1)) if 0 <= j < len(ratios)]
        out.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
    return out


def _of_containers(lines: list, at: list[int], outermost: list[int]) -> list[int]:
    """The lines of containers that hold some of the clustered lines ``at``, and those between such lines of one outermost container."""
    holding = {lines[i][3] for i in at}
    first: dict[int, int] = {}
    last: dict[int, int] = {}
    for i in at:
        root = outermost[lines[i][3]]
        first.setdefault(root, i)
        last[root] = i
    picked = []
    for i, line in enumerate(lines):
        root = outermost[line[3]]
        if not line[2] and root in first and (line[3] in holding or first[root] <= i <= last[root]):
            picked.append(i)
    return picked


def main_text(html: str | None) -> str:
    """The article's blocks joined by empty lines; empty if there is none."""
    parser = _Lines()
    lines = parser.read(html or "")
    if all(line[2] for line in lines):
        return ""
    ratios = [0.0 if line[2] else len(line[0]) / max(1, line[1]) for line in lines]
    smooth = _smoothed(ratios)
    mean = sum(smooth) / len(smooth)
    threshold = math.sqrt(sum((s - mean) ** 2 for s in smooth) / len(smooth))
    chosen = [not line[2] and s >= threshold for line, s in zip(lines, smooth)]
    if not any(chosen):
        chosen = [not line[2] for line in lines]
    # smoothing carries weight over a container's border, so its own lines must reach the threshold once
    own = {line[3] for line, ratio in zip(lines, ratios) if not line[2] and ratio >= threshold} | {0}
    at = [i for i, good in enumerate(chosen) if good and lines[i][3] in own] or [i for i, good in enumerate(chosen) if good]
    inside = sum(len(lines[i][0]) for i in at if lines[i][3])
    if inside and 2 * inside >= sum(len(lines[i][0]) for i in at):
        picked = _of_containers(lines, [i for i in at if lines[i][3]], parser.outermost)
        titled = any(lines[i][4] for i in picked)
        picked = ([] if titled else [i for i, line in enumerate(lines[:picked[0]]) if line[4] and not line[2]][-1:]) + picked
    else:
        low = at[0]
        while low and lines[low - 1][4] and not lines[low - 1][2]:
            low -= 1
        picked = [i for i in range(low, at[-1] + 1) if not lines[i][2]]
    return "\n\n".join(lines[i][0] for i in picked)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(html.as_py()) for html in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """Columns ``page_id, url, text, n_chars`` for each row of ``pages(page_id, url, html)``.

    Null or empty html, and pages of furniture alone, give the empty text. Every page is read whole and by
    itself; ties between regions go to the earlier one; repeated rows repeat; other columns are ignored.
    """
    slim = pages.selectExpr("CAST(page_id AS long) AS page_id", "CAST(url AS string) AS url", "CAST(html AS string) AS html")
    return map_arrow(slim, _extract, "page_id long, url string, text string, n_chars long")
