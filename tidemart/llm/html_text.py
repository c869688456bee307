"""Main text of web pages by text-to-tag ratios over streamed parser events."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import documents

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol
    option p pre section summary table tbody td tfoot th thead title tr ul""".split())
# Elements whose text is never shown or never part of an article; they make no line at all.
UNSEEN = frozenset("""script style noscript template svg math iframe object canvas audio video button
    select textarea head title datalist""".split())
# Elements and words of class, id and role that mark what stands around an article.
AROUND = frozenset("nav footer aside menu dialog".split())
AROUND_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs
    comment comments complementary consent contentinfo cookie cookies disqus footer masthead menu modal nav
    navbar navigation newsletter notice notices notification popup promo promoted related share sharing
    sidebar social sponsor sponsored subscribe toolbar widget""".split())
# Parts that leave a name with a word of the above what it is: `comment-list` is one, `has-sidebar` is not.
NEUTRAL_WORDS = frozenset("""area bar block body bottom box container entry global inner item left links list
    main page panel post primary right secondary section signup site slot thread top wrap wrapper""".split())
ARTICLE = frozenset(("article", "main"))
REGION = frozenset(("div", "body", "html", ""))  # may stand for a missing article; lists, tables, sections are parts
# An open element of the second set ends when one of the first starts.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table article main section div body html nav aside footer header".split())
# Elements that a form has when a whole page stands in it.
PAGE_PARTS = frozenset("article main nav header footer section h1".split())
DEEPEST = 512  # open elements that a line remembers, the depth at which browsers stop to nest
SHARE = 0.8  # of the selected text that the dense region holds
SIGMA = 1.5  # of the smoothing, in lines
_NAME_PARTS = re.compile(r"[^a-z0-9]+")
SURE, NAMED, HINTED = 3, 2, 1  # marks of what stands around: by tag or hidden, by a name, by a part of a name


class _Open(NamedTuple):
    """An open element with what it and those around it say."""
    tag: str
    path: tuple[int, ...]  # numbers of the open elements, at most `DEEPEST`
    unseen: bool
    sure: bool  # around articles for sure
    article: bool
    form: int  # number of the outermost form, 0 without


class _Line(NamedTuple):
    text: str
    tags: int
    linked: int  # characters in links
    path: tuple[int, ...]
    sure: bool
    words: bool  # any outside links
    form: int


class _Lines(HTMLParser):
    """Cuts a page into lines at block elements. `marks` has the elements that a name marks as
    around, `named` articles of such a name, `pages` forms that hold parts of a page. Work per event does not depend on how
    many elements are open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [_Open("", (0,), False, False, False, 0)]
        self.places: dict[str, list[int]] = defaultdict(list)  # places of each tag in the stack
        self.marks: dict[int, int] = {}
        self.named: set[int] = set()
        self.pages: set[int] = set()
        self.names: list[str] = [""]
        self.lines: list[_Line] = []
        self.text: list[str] = []
        self.tags = self.linked = 0
        self.words = False

    def line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            top = self.stack[-1]
            self.lines.append(_Line(text, self.tags, self.linked, top.path, top.sure, self.words, top.form))
            self.tags = 0
        self.text, self.linked, self.words = [], 0, False

    def _mark(self, tag: str, attrs: list[tuple[str, str | None]]) -> int:
        if tag in AROUND or tag == "header" and not self.stack[-1].article:
            return SURE
        if tag in ("html", "body"):
            return 0
        mark = 0
        for name, value in attrs:
            if tag not in ARTICLE and (name == "hidden" or name == "aria-hidden" and value == "true"):
                return SURE
            if name in ("class", "id", "role") and value:
                for word in value.lower().split():
                    parts = [p for p in _NAME_PARTS.split(word) if p]
                    if not AROUND_WORDS.isdisjoint(parts):
                        whole = all(p in AROUND_WORDS or p in NEUTRAL_WORDS or p.isdigit() for p in parts)
                        mark = max(mark, NAMED if whole else HINTED)
        return mark

    def _close(self, at: int) -> None:
        if any(e.tag in BLOCK for e in self.stack[at:]):
            self.line()
        for e in self.stack[at:]:
            self.places[e.tag].pop()
        del self.stack[at:]

    def _place(self, tags: Iterable[str]) -> int:
        """Place of the innermost open element of some tags, 0 without."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _implied(self, tag: str) -> None:
        """End what the start of `tag` ends: a paragraph by any block, an item by the next one."""
        at = self._place({"p", *ENDS.get(tag, ())})
        if at > self._place(SCOPE):
            self._close(at)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCK:
            self.line()
            self._implied(tag)
        if tag in VOID:
            self.text.append(" ")
            return
        self.names.append(tag)
        top, number, mark = self.stack[-1], len(self.names) - 1, self._mark(tag, attrs)
        if tag in ARTICLE:  # may be a comment or a teaser, but is not marked itself
            if mark == NAMED:
                self.named.add(number)
        elif mark in (NAMED, HINTED):
            self.marks[number] = mark
        if tag in PAGE_PARTS and top.form:
            self.pages.add(top.form)
        self.places[tag].append(len(self.stack))
        self.stack.append(_Open(
            tag, (*top.path, number) if len(top.path) < DEEPEST else top.path, top.unseen or tag in UNSEEN,
            top.sure or mark == SURE, top.article or tag in ARTICLE,
            top.form or (number if tag == "form" else 0)))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if self.places.get(tag):
            self._close(self.places[tag][-1])

    def handle_data(self, data: str) -> None:
        if self.stack[-1].unseen:
            return
        self.text.append(data)
        if self.places.get("a"):
            self.linked += len(data)
        elif not self.words:
            self.words = any(map(str.isalnum, data))

    def shown(self) -> list[_Line]:
        """The lines without those of forms, unless a whole page stands in a form; their tags count for the next line."""
        out, tags = [], 0
        for line in self.lines:
            if line.form and line.form not in self.pages:
                tags += line.tags
            else:
                out.append(line._replace(tags=line.tags + tags))
                tags = 0
        return out


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; at the ends the weights inside the page are rescaled."""
    reach = min(math.ceil(3 * sigma), max(len(values) - 1, 0))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel, "full")[reach:reach + len(values)]
    return np.convolve(values, kernel, "full")[reach:reach + len(values)] / weight


def threshold(values: np.ndarray) -> float:
    """Border between two clusters of values: two means until they stay. One value: that value."""
    low, high = float(values.min()), float(values.max())
    while True:
        border = (low + high) / 2
        upper = values >= border
        if upper.all():
            return border
        now = float(values[~upper].mean()), float(values[upper].mean())
        if now == (low, high):
            return border
        low, high = now


def _asides(parser: _Lines, lines: list[_Line], seen: list[int], smoothed: np.ndarray) -> set[int]:
    """Articles that their name marks as around, comments for one, when there is another article: an `article` with text
    outside them, or a `main` with dense text outside them."""
    if not parser.named:
        return set()
    border, names = threshold(smoothed[seen]), parser.names
    for i in seen:
        if parser.named.isdisjoint(lines[i].path):
            tags = {names[e] for e in lines[i].path}
            if "article" in tags or "main" in tags and smoothed[i] >= border:
                return parser.named
    return set()


def _marked(parser: _Lines, lines: list[_Line], seen: list[int], smoothed: np.ndarray) -> dict[int, list[int]]:
    """The elements that mark each of the lines `seen` as around by their names, for lines that have any.

    A `main` takes off the marks above it, and so does an outermost article when there is none without marks,
    unless it has such a name itself. A part of a name marks a block only when its own ratio of text to tags is
    below the border of the lines without marks. Of the others, the one with most dense text first, those lose
    their mark that hold `SHARE` of the dense text of theirs and of what is not marked; with an unmarked article
    beside them, only those that hold an article.
    """
    names, named = parser.names, parser.named
    if not parser.marks:
        return {}
    paths = {lines[i].path for i in seen}  # lines beside each other share one
    marks_of = {p: [e for e in p if e in parser.marks] for p in paths}
    articles_of = {p: [e for e in p if names[e] in ARTICLE] for p in paths}
    marks = {i: list(marks_of[lines[i].path]) for i in seen}
    articles = {i: articles_of[lines[i].path] for i in seen}
    clear = any(names[e] == "article" and e not in named for i in seen if not marks[i] for e in articles[i])
    holders: set[int] = set()
    for i in seen:
        if marks[i] and articles[i]:
            first = {names[e]: e for e in reversed(articles[i]) if e not in named}
            bound = max(first.get("main", 0), 0 if clear else first.get("article", 0))
            marks[i] = [e for e in marks[i] if e > bound]
            holders.update(e for e in marks[i] if e < max(first.values(), default=0))
    border = threshold(smoothed[[i for i in seen if not marks[i]] or seen])
    dense = {i for i in seen if smoothed[i] >= border}
    inside: dict[int, list[int]] = defaultdict(list)
    for i, elements in marks.items():
        for e in elements:
            inside[e].append(i)
    for e in [e for e in inside if parser.marks[e] == HINTED]:
        plain = sum(max(len(lines[i].text) - lines[i].linked, 0) for i in inside[e])
        if math.log1p(plain / max(sum(lines[i].tags for i in inside[e]), 1)) >= border:
            for i in inside.pop(e):
                marks[i].remove(e)
    mass = {e: sum(len(lines[i].text) for i in inside[e] if i in dense) for e in inside}
    free = sum(len(lines[i].text) for i in dense if not marks[i])
    of_article = Counter(articles[i][0] for i in seen if articles[i] and not marks[i])
    unmarked = sum(of_article.values())
    for e in sorted(inside, key=lambda e: (-mass[e], e)):
        own = articles[inside[e][0]]
        alone = e in holders or unmarked == (of_article[own[0]] if own and own[0] < e else 0)
        if mass[e] and alone and mass[e] >= SHARE * (mass[e] + free):
            for i in inside[e]:
                marks[i].remove(e)
                if i in dense and not marks[i]:
                    free += len(lines[i].text)
    return {i: elements for i, elements in marks.items() if elements}


def main_text(html: str | None) -> str:
    """The article of a page, its blocks joined by an empty line; empty when there is no text.

    Every line has the ratio of its text outside links to its tags. Ratios are smoothed over the page and split in
    two clusters; lines of the upper one, unless they stand in an element known to be around articles (by its
    tag, or by its name where `_marked` agrees), are content. The dense region is the innermost element that holds
    `SHARE` of their text. Its outermost `article` or `main` is the article; without one, the smallest element that
    holds all content lines and first-level headings. All its lines belong to the article, short ones and links as
    well; only without `article` or `main`, containers before the first or after the last content line with words
    of its own are left out when all their words are links. Broken markup is read as browsers do: unclosed elements
    end with their parent. Forms count only if they hold parts of a page such as its article or header. A page is read
    whole, however long; below `DEEPEST` elements text belongs to the deepest of them.
    """
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.line()
    lines = parser.shown()
    seen = [i for i, x in enumerate(lines) if not x.sure]
    if not seen:
        return ""
    ratio = np.array([(len(t) - min(linked, len(t))) / max(tags, 1) for t, tags, linked, *_ in lines])
    smoothed = np.log1p(smooth(ratio))
    asides = _asides(parser, lines, seen, smoothed)
    seen = [i for i in seen if asides.isdisjoint(lines[i].path)]
    marked = _marked(parser, lines, seen, smoothed)
    own = [i for i in seen if i not in marked]
    border = threshold(smoothed[own])
    content = [i for i in own if smoothed[i] >= border]
    of_path: dict[tuple[int, ...], int] = defaultdict(int)
    for i in content:
        of_path[lines[i].path] += len(lines[i].text)
    mass: dict[int, int] = defaultdict(int)
    for path, size in of_path.items():
        for element in path:
            mass[element] += size
    dense = max(e for e in mass if mass[e] >= SHARE * mass[0])  # inner elements have larger numbers
    names = parser.names
    path = next(lines[i].path for i in content if dense in lines[i].path)
    region = next((e for e in path[:path.index(dense) + 1] if names[e] in ARTICLE), None)
    if region is not None:
        return "\n\n".join(lines[i].text for i in own if region in lines[i].path)
    held = [lines[i].path for i in content]
    held += [p for p in {lines[i].path for i in own} if any(names[e] == "h1" for e in p)]
    # The paths' common part is that of the first and the last in order.
    common = [a for a, b in zip(min(held), max(held), strict=False) if a == b]
    region = [e for e in common if names[e] in REGION][-1]
    inside = [i for i in own if region in lines[i].path]

    def part(i: int) -> int | None:
        """The container next below the region that a line stands in."""
        path = lines[i].path
        return next((e for e in path[path.index(region) + 1:] if names[e] in SCOPE), None)

    worded = {part(i) for i in inside if lines[i].words} | {None}
    said = [i for i in content if lines[i].words] or content
    return "\n\n".join(lines[i].text for i in inside if said[0] <= i <= said[-1] or part(i) in worded)


def extract(html: Column) -> Column:
    """Column function of `main_text`, page by page in Arrow batches; null pages give empty text, other
    columns and repeated rows do not matter."""

    def run(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in pages:
            yield pd.Series([main_text(p) for p in batch], dtype=object)

    run.__annotations__ = {"pages": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "string")(html)


def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = documents(spark, folder, "page_id", "url", "html", table="pages")
    return pages.select("page_id", "url", extract(F.col("html")).alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long"))
