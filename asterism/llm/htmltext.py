"""The main text of a web page, by the distribution of text over its lines.

Markup is stripped first: block elements and line breaks end a line, inline elements do not. What an
element marks as page furniture has no length, and neither has what stands in links. Lengths are summed over
windows of lines; a surge point is where the sum passes a threshold, and a passage reaches from where the
sum rose from zero to where it dives to zero again.

The passages that have a surge choose, on every page, the element that holds the article: an article or main
element that has one, else the innermost element with most of their text. All lines of
that element are kept, in page order, but for page furniture, and for lists of links before its first text or after its last.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import beside, small_batches

#: Lines on either side that a window has, and the characters in a window that make a surge.
REACH = 1
SURGE = 80
#: Share of the passages' text that the element which holds the article has at least, and share of a
#: main element's text with which an article in it is the article.
MOST = 0.7
HALF = 0.5

# Names of HTML elements.
BLOCKS = set(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript "
    "ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = set("iframe math noembed noframes noscript object script style svg template textarea title xmp".split())
FURNITURE = set("aside button dialog fieldset footer form head menu nav search select".split())
ARTICLES = set("article main".split())
#: Elements that hold text and no other blocks: what they are is less often said by their class.
TEXT_LEVEL = set("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figcaption b i em strong span a".split())

#: What a class, id or role calls page furniture, by the words of our own reading of pages: a name of words joined by hyphens
#: is furniture if it has one of these, but for names that say what a page has (``has-sidebar``).
FURNITURE_WORDS = set(
    "ad ads advert adverts advertisement banner breadcrumbs comment comments complementary consent contentinfo cookie cookies "
    "copyright footer form login masthead menu modal nav navbar navigation newsletter notice popup promo recommended related "
    "replies reply respond search share sidebar social sponsored subscribe toolbar widget".split()
)
#: Of these, what is furniture as the class of a paragraph too.
NOTICES = set("ad ads advert advertisement comment cookie cookies notice sponsored".split())
#: A header is the article's own if its name says so, or if it stands in the article.
OWN = set("article entry post story".split())
DESCRIBED = set("has no with without is not".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))",
    re.S,
)
_MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/>]|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_NOT_WORD = re.compile(r"[^a-z0-9]+")


def _is_furniture(name: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is page furniture, by what it is, or what its names say."""
    if name in FURNITURE or name == "header" and not in_article or name == "article" and in_article:
        # An article in an article is a comment or a teaser.
        return True
    if "=" not in attributes and "hidden" not in attributes.lower():
        return False
    if _HIDDEN.search(attributes):
        return True
    if name in ("html", "body", "main"):
        return False
    wanted = NOTICES if name in TEXT_LEVEL else FURNITURE_WORDS
    for found in _MARKS.finditer(attributes):
        for one in (found[1] or found[2] or found[3] or "").lower().split():
            words = [word for word in _NOT_WORD.split(one) if word]
            if not words or DESCRIBED & set(words):
                continue
            if wanted & set(words) or name not in TEXT_LEVEL and "header" in words and not in_article and not OWN & set(words):
                return True
    return False


class Line(NamedTuple):
    """A line of a page: its text, empty in page furniture; the length that counts; the elements it is in."""

    text: str
    size: int
    within: tuple[int, ...]


class _Lines:
    """The lines of a page, and the names of its elements by their numbers."""

    def __init__(self) -> None:
        self.rows: list[Line] = []
        self.names: list[str] = []
        self.parts: list[str] = []
        self.within: tuple[int, ...] = ()
        self.linked = 0

    def add(self, raw: str, in_link: bool, within: list[int]) -> None:
        if not self.parts:
            self.within = tuple(within)
        self.parts.append(raw)
        if in_link:
            self.linked += len(raw)

    def end(self, dropped: bool) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text:
                all_linked = self.linked >= sum(len(part) for part in self.parts if not part.isspace())
                self.rows.append(Line("", 0, self.within) if dropped else Line(text, 0 if all_linked else len(text), self.within))
            self.parts, self.linked = [], 0


def _end_raw(page: str, name: str, at: int) -> int:
    """Where an element whose content is not markup ends."""
    found = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
    return found.end() if found else len(page)


def lines_of(page: str) -> _Lines:
    """The lines of a page; those of page furniture are empty."""
    lines, stack, numbers, at = _Lines(), [], [], 0
    drop_from: int | None = None
    articles = links = 0

    def pop_to(size: int) -> None:
        nonlocal drop_from, articles, links
        for name in stack[size:]:
            articles -= name in ARTICLES
            links -= name == "a"
        del stack[size:], numbers[size:]
        if drop_from is not None and size <= drop_from:
            drop_from = None

    while True:
        found = _MARKUP.search(page, at)
        text = page[at : found.start() if found else len(page)]
        if text:
            lines.add(text, links > 0, numbers)
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        name = found[2].lower()
        if name in BLOCKS:
            lines.end(drop_from is not None)
        if found[1]:
            if name in stack:
                pop_to(len(stack) - 1 - stack[::-1].index(name))
            continue
        if name in UNREAD:
            if not found[3].endswith("/>"):
                at = _end_raw(page, name, at)
            continue
        if name in VOID:
            continue
        if name in BLOCKS and "p" in stack:
            pop_to(len(stack) - 1 - stack[::-1].index("p"))
        if name == "li" and "li" in stack and not {"ul", "ol", "menu"} & set(stack[len(stack) - stack[::-1].index("li") :]):
            pop_to(len(stack) - 1 - stack[::-1].index("li"))
        if drop_from is None and _is_furniture(name, found[3], "article" in stack if name == "article" else articles > 0):
            drop_from = len(stack)
        stack.append(name)
        numbers.append(len(lines.names))
        lines.names.append(name)
        articles += name in ARTICLES
        links += name == "a"
    lines.end(drop_from is not None)
    return lines


def passages(sizes: list[int]) -> list[tuple[int, int, int]]:
    """From where the window sums rise to where they dive to zero again: first line, end, and highest sum."""
    sums = [sum(sizes[max(0, i - REACH) : i + REACH + 1]) for i in range(len(sizes))]
    found, start = [], None
    for i, value in enumerate([*sums, 0]):
        if value and start is None:
            start = i
        elif not value and start is not None:
            found.append((start, i, max(sums[start:i])))
            start = None
    return found


def _held(rows: list[Line], names: list[str]) -> tuple[set[int], bool]:
    """Numbers of the elements that hold the article, and whether their names say that they do; none if there is no text."""
    found = passages([row.size for row in rows])
    surging = [p for p in found if p[2] >= SURGE] or sorted(found, key=lambda p: (-p[2], p[0]))[:1]
    text: dict[int, int] = defaultdict(int)
    for a, b, _ in surging:
        for row in rows[a:b]:
            for number in row.within:
                text[number] += row.size
    total = sum(row.size for a, b, _ in surging for row in rows[a:b])
    named = [number for number in text if names[number] in ARTICLES and text[number]]
    # An article or main element is not chosen for a few words, where a passage elsewhere has a surge.
    if named and max(text[number] for number in named) >= min(SURGE, HALF * total):
        inside = {number: [m for m in named if m != number and any(number in row.within and m in row.within for row in rows)] for number in named}
        tops = [number for number in named if not any(number in inside[m] and names[m] == "main" for m in named)]
        chosen: set[int] = set()
        for number in tops:
            best = max(inside[number], key=lambda m: text[m], default=None) if names[number] == "main" else None
            chosen.add(best if best is not None and text[best] > HALF * text[number] else number)
        return chosen, True
    if not total:
        return set(), False
    count: dict[int, int] = defaultdict(int)
    for row in rows:
        for number in row.within if row.text else ():
            count[number] += 1
    # The innermost that has more than a line. It comes last: elements are numbered in the order they open.
    holding = [number for number in text if text[number] >= MOST * total and count[number] > 1 and names[number] not in TEXT_LEVEL]
    return {max(holding, default=-1)}, False


def main_text(page: str | None) -> str:
    """The main text of one page; empty if it has none."""
    lines = lines_of(page or "")
    held, named = _held(lines.rows, lines.names)
    rows = [row for row in lines.rows if -1 in held or held & set(row.within)]
    if not named:
        sized = [i for i, row in enumerate(rows) if row.size]
        rows = rows[sized[0] : sized[-1] + 1] if sized else []
    else:
        rows = _title(lines, held) + rows
    return " ".join(row.text for row in rows if row.text)


def _title(lines: _Lines, held: set[int]) -> list[Line]:
    """The main heading that stands before an article in the same main element."""
    first = next((i for i, row in enumerate(lines.rows) if held & set(row.within)), 0)
    mains = {number for number in lines.rows[first].within if lines.names[number] == "main"} - held if lines.rows else set()
    return [row for row in lines.rows[:first] if mains & set(row.within) and any(lines.names[number] == "h1" for number in row.within)]


def with_main_text(df: DataFrame, page: str = "html", out: str = "text") -> DataFrame:
    """``df`` with the main text of the column ``page``, and its code points as ``n_chars``.

    Whole pages. Null and pages without text give an empty text; on a page where no window reaches the
    threshold, the fullest passage chooses. Each row stands by itself: repeated rows give equal
    results, an empty table an empty one. Columns with the new names are replaced. No shuffle.
    """
    small_batches(df.sparkSession)
    extract = F.pandas_udf(lambda pages: pd.Series([main_text(p) for p in pages], dtype=object), "string")
    found = beside(df, F.struct(extract(F.col(page)).alias(out)), [out])
    return beside(found, F.struct(F.char_length(out).cast("long").alias("n_chars")), ["n_chars"])
