"""Main text of web pages by line-block distribution.

A page is stripped to lines, one per block of markup; what stands in menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles or reader comments leaves empty lines. The
lengths of the lines are summed over a sliding window. The text begins at the line with which that sum
first surges above a share of the page's fullest window and ends with the last line before it dives
below for good; in between, only what is recognised as no text goes. Of the lines outside, headings
and whole sentences stay, and paragraphs that share a window with the text. A run of lines that are mostly links is text if the windows around it hold
as much prose. Inside an article its element sets the bounds; there the windows decide on what only
a doubtful name says is no text: it stays if it surges like the article's own prose. Repeated and
equal lines are lines of their own. Pages are read one by one, in time linear in their length; Spark
deals them out and nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfwright.llm.common import packed, query, table, unpacked
from shelfwright.session import ship_package

#: Lines in a window; the share of the page's fullest window that a sum must exceed to surge.
WINDOW, SURGE = 3, 0.25

# Element names of HTML
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript template iframe object svg canvas audio video".split())
BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol "
    "optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
ASIDE = set("nav footer aside form button select menu dialog head search fieldset datalist".split())
# Words in class, id or role that name what is not the article
ASIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies dialog disqus feedback footer gdpr header login masthead "
    "menu modal nav navbar navigation newsletter notice notices notification pagination pager popup promo "
    "promotion related reply replies respond search share sharing sidebar signup skip social sponsor sponsored "
    "subscribe toolbar widget widgets adsbygoogle commentlist".split()
)
# Those of them that leave no doubt, also before a word for what holds them
SURE = set(
    "ad ads adv advert adverts advertisement advertising adsbygoogle breadcrumb breadcrumbs comment commentlist comments "
    "complementary consent contentinfo cookie cookies disqus footer gdpr masthead menu nav navbar navigation newsletter "
    "pager pagination sidebar sponsor sponsored subscribe".split()
)
HOLDS = set(
    "area banner bar block bottom box column container inner left list notice outer panel right section slot thread top "
    "unit wrap wrapper".split()
)
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_NAME = re.compile(r"[a-zA-Z][^\s/>\"'<]*")
_STOP = re.compile(r"[\"'>]")
_MARK = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_PART = re.compile(r"[a-z]+")
# First parts of a class token that only says something about another element, and what a heading heads
ABOUT = set("has with without no not is show hide hides".split())
HEADED = set("article entry post story content section main title".split())
_NOTICE = re.compile(r"(?:copyright\s*)?(?:©|\(c\))|copyright\s+\d{4}|.*\ball rights reserved\W*$", re.I)
#: A line that ends like a sentence.
_SENTENCE = re.compile(r".*[.!?…]['\"”’»)\]]*$", re.S)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def _pieces(page: str):
    """``(None, text)`` and ``(name, attributes)`` in page order; a closing tag's name starts with a slash."""
    low, at, n = page.lower(), 0, len(page)
    gone: set[str] = set()  # what is known not to occur any more
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield None, page[at:]
            return
        if lt > at:
            yield None, page[at:lt]
        if page.startswith("<!--", lt):
            end = -1 if "-->" in gone else page.find("-->", lt + 4)
            if end < 0:
                gone.add("-->")
            at = end + 3 if end >= 0 else n
            continue
        if page[lt + 1 : lt + 2] in ("!", "?"):
            end = page.find(">", lt)
            at = end + 1 if end >= 0 else n
            continue
        close = page[lt + 1 : lt + 2] == "/"
        m = _NAME.match(page, lt + 1 + close)
        if not m:
            yield None, "<"
            at = lt + 1
            continue
        pos = m.end()
        while (s := _STOP.search(page, pos)) and s[0] != ">":
            end = -1 if s[0] in gone else page.find(s[0], s.end())
            if end < 0:  # a stray quote
                gone.add(s[0])
            pos = end + 1 if end >= 0 else s.end()
        if s is None:  # never closed: what follows is no tag
            return
        name = m[0].lower()
        yield ("/" if close else "") + name, page[m.end() : s.start()]
        at = s.end()
        if name in RAW and not close and not page[m.end() : s.start()].endswith("/"):
            mark = "</" + name
            end = -1 if mark in gone else low.find(mark, at)
            if end < 0:
                gone.add(mark)
                continue
            gt = page.find(">", end)
            at = gt + 1 if gt >= 0 else n


def _names_aside(token: str, inside: bool) -> int:
    """2 if a class token, id or role names what is not the article, 1 if it may, by its last part, else 0."""
    parts = _PART.findall(token)
    if not parts or len(parts) > 1 and parts[0] in ABOUT:
        return 0
    if parts[-1] in SURE or parts[-1] in HOLDS and not SURE.isdisjoint(parts):
        return 2
    if parts[-1] not in ASIDE_WORDS:
        return 0
    return 1 if parts[-1] != "header" or not inside and HEADED.isdisjoint(parts) else 0


def _is_aside(name: str, attributes: str, inside: bool) -> int:
    """2 if the element is not the article, 1 if only a doubtful name says so."""
    if name in ASIDE or name == "header" and not inside:
        return 2
    if name in ("html", "body", "main") or not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return 0
    named = 0
    for key, value in _MARK.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and _HIDDEN.search(value):
            return 2
        if key in ("class", "id", "role"):
            named = max([named, *(_names_aside(t, inside) for t in value.split())])
    return named


def _elements(page: str):
    """The page as (kind, value, number): text, br, line (a block's edge), open (tag, attributes) and close of an element.

    Elements are numbered as they open, from 0; what closes several of them gives a close for each, innermost first.
    """
    stack: list[tuple[str, int]] = []
    depth: dict[str, int] = {}
    count = 0

    def pop_to(height: int):
        while len(stack) > height:
            tag, number = stack.pop()
            depth[tag] -= 1
            yield "close", tag, number

    for name, value in _pieces(page):
        if name is None:
            yield "text", value, -1
            continue
        tag = name.lstrip("/")
        block = tag in BLOCK
        if block:
            yield "line", tag, -1
        elif tag == "br":
            yield "br", tag, -1
        if tag in VOID or tag in RAW:
            continue
        if name[0] == "/":
            if depth.get(tag):
                height = len(stack) - 1
                while stack[height][0] != tag:
                    height -= 1
                yield from pop_to(height)
            continue
        if tag == "body":
            yield from pop_to(0)
        if block and depth.get("p"):  # an open paragraph ends where a block begins
            height = len(stack)
            while height and stack[height - 1][0] not in BLOCK:
                height -= 1
            if height and stack[height - 1][0] == "p":
                yield from pop_to(height - 1)
        if not value.endswith("/") or tag not in ("span", "a", "i", "b"):
            stack.append((tag, count))
            depth[tag] = depth.get(tag, 0) + 1
            yield "open", (tag, value), count
            count += 1


def _holders(elements: list) -> set[int]:
    """Numbers of the elements that are never left out: article or main, and what holds it.

    Of several outermost ones it is the one with the most text; if that is a main, also the article
    with the most text in it. Others are read as what they say they are: teasers, reader comments.
    """
    parent: dict[int, int] = {}
    size: dict[int, int] = {}  # of every article and main, by number
    tags: dict[int, str] = {}
    above: dict[int, int] = {}  # the article or main around it, or -1
    stack, marks = [-1], [-1]
    for kind, value, number in elements:
        if kind == "open":
            parent[number] = stack[-1]
            stack.append(number)
            if value[0] in ("article", "main"):
                size[number], tags[number], above[number] = 0, value[0], marks[-1]
                marks.append(number)
        elif kind == "close":
            stack.pop()
            if number == marks[-1]:
                marks.pop()
                if marks[-1] >= 0:
                    size[marks[-1]] += size[number]
        elif kind == "text" and marks[-1] >= 0:
            size[marks[-1]] += len(value.strip())
    while len(marks) > 2:  # never closed
        size[marks[-2]] += size[marks.pop()]
    at = max((n for n in size if above[n] < 0), key=size.__getitem__, default=-1)
    if at >= 0 and tags[at] == "main":
        at = max((n for n in size if above[n] == at), key=size.__getitem__, default=at)
    found = set()
    while at >= 0:
        found.add(at)
        at = parent[at]
    return found


class Line(NamedTuple):
    text: str
    linked: int  # characters in links
    article: int  # which one, from 1, or 0
    main: bool
    heading: bool
    paragraph: bool
    doubt: int  # number of the doubtfully named element around it, or -1
    doubted: str  # that element's tag


def lines_of(page: str) -> list[Line]:
    """The page's blocks; those left out are empty, and of a longer run of empty ones a window's worth is kept."""
    out: list[Line] = []
    articles = 0
    depth = {"article": 0, "main": 0, "a": 0}
    skip, doubt, doubted = -1, -1, ""  # numbers of the elements that are left out or doubted; the latter's tag
    text: list[str] = []
    linked, heading, paragraph, empty = 0, False, False, 0

    def end_line():
        nonlocal text, linked, empty, heading, paragraph
        line = " ".join(html.unescape("".join(text)).split())
        inside = articles if depth["article"] else 0
        empty = 0 if line else empty + 1
        if empty <= WINDOW:
            out.append(Line(line, min(linked, len(line)), inside, depth["main"] > 0, heading, paragraph, doubt, doubted))
        text, linked, heading, paragraph = [], 0, False, False

    elements = list(_elements(page))
    holders = _holders(elements)
    for kind, value, number in elements:
        if kind == "text":
            if skip < 0:
                text.append(value)
                if depth["a"]:
                    linked += len(value)
        elif kind == "line":
            end_line()
        elif kind == "br":
            text.append(" ")
        elif kind == "close":
            if value in depth:
                depth[value] -= 1
            if number == skip:
                skip = -1
            if number == doubt:
                end_line()
                doubt, doubted = -1, ""
        else:
            tag, attributes = value
            if skip < 0 and number not in holders:
                inside = bool(depth["article"] or depth["main"])
                aside = _is_aside(tag, attributes, inside)
                if aside == 2 or aside and not inside:
                    end_line()
                    skip = number
                elif aside and doubt < 0:
                    end_line()
                    doubt, doubted = number, tag
            heading, paragraph = heading or tag in _HEADINGS, paragraph or tag == "p"
            if tag == "article" and not depth["article"]:
                articles += 1
            if tag in depth:
                depth[tag] += 1
    end_line()
    return out


def windows(lengths: list[int], window: int = WINDOW) -> list[int]:
    """The sum of each line and those before it that share its window."""
    out, total = [], 0
    for i, n in enumerate(lengths):
        total += n - (lengths[i - window] if i >= window else 0)
        out.append(total)
    return out


def passages(lengths: list[int], window: int = WINDOW, floor: float | None = None) -> list[tuple[int, int]]:
    """[surge, dive) of every stretch over which the windowed sum stays above ``floor``.

    The floor is a share of the fullest window, if none is given. A stretch begins with the line
    that lifts the sum of the lines up to it above the floor, and ends with the line that does so
    for the lines from it on: short neighbours do not pass for text because a long line is near.
    """
    before, after = windows(lengths, window), windows(lengths[::-1], window)[::-1]
    if floor is None:
        floor = SURGE * max(before, default=0)
    out, start, end = [], None, 0
    for i, n in enumerate(lengths):
        if before[i] <= floor:
            if start is not None:
                out.append((start, end))
            start = None
        elif n and start is None:
            start, end = i, i + 1
        elif n and after[i] > floor:
            end = i + 1
    if start is not None:
        out.append((start, end))
    return out


def _doubts(lines: list[Line], lengths: list[int]) -> set[int]:
    """Lines of doubtfully named elements that do not read like the prose around them.

    A paragraph must hold a sentence; any other element must besides surge above the floor of the
    lines that are not in doubt, and be no list of links.
    """
    if all(line.doubt < 0 for line in lines):
        return set()
    floor = SURGE * max(windows([0 if line.doubt >= 0 else n for line, n in zip(lines, lengths)]), default=0)
    members: dict[int, list[int]] = {}
    for i, line in enumerate(lines):
        if line.doubt >= 0 and lengths[i]:
            members.setdefault(line.doubt, []).append(i)
    out: set[int] = set()
    for at in members.values():
        told = any(_SENTENCE.match(lines[i].text) for i in at)
        size, linked = sum(lengths[i] for i in at), sum(lines[i].linked for i in at)
        if lines[at[0]].doubted != "p":
            told = told and 2 * linked <= size and bool(passages([lengths[i] for i in at], floor=floor))
        if not told:
            out.update(at)
    return out


def _menus(lines: list[Line]) -> set[int]:
    """Lines that are mostly links, unless the windows before and after their run each hold as much that is not."""
    at = [i for i, line in enumerate(lines) if line[0]]
    menu = [2 * lines[i][1] > len(lines[i][0]) for i in at]
    out: set[int] = set()
    i = 0
    while i < len(at):
        j = i + 1
        while j < len(at) and menu[j] == menu[i]:
            j += 1
        if menu[i]:
            size = sum(len(lines[k][0]) for k in at[i:j])
            windows = (at[max(i - WINDOW, 0) : i], at[j : j + WINDOW])
            if any(sum(len(lines[k][0]) - lines[k][1] for k in w) < size for w in windows):
                out.update(at[i:j])
        i = j
    return out


def main_text(page: str | None) -> str:
    """The article of a page: its blocks in page order, joined by one space; empty if there is none.

    White space in a block is one space. Within article elements every line counts but those of
    elements in doubt that are no prose, and so it is within main if there is no article or if main
    has more text outside its articles than the largest of them. On a page that has neither, the
    text runs from the first surge to the last dive, with headings, sentences and near paragraphs
    outside, but without menus and the copyright notices at the end.
    """
    lines = lines_of(page or "")
    size: dict[int, int] = {}  # by article; 0 is what stands in main and in no article
    for line in lines:
        if line.text and (line.article or line.main):
            size[line.article] = size.get(line.article, 0) + len(line.text)
    if size:
        outside = size.pop(0, 0)
        in_main = outside > max(size.values(), default=0)
        lengths = [len(line.text) if (line.main if in_main else line.article) else 0 for line in lines]
        gone = _doubts(lines, lengths)
        return " ".join(lines[i].text for i, n in enumerate(lengths) if n and i not in gone)
    menus = _menus(lines)
    lengths = [0 if i in menus else len(line.text) for i, line in enumerate(lines)]
    for i in range(len(lines) - 1, -1, -1):
        if lengths[i] and not _NOTICE.match(lines[i].text):
            break
        lengths[i] = 0
    found = passages(lengths)
    if not found:
        return ""
    surge, dive = found[0][0], found[-1][1]
    near = range(surge + 1 - WINDOW, dive + WINDOW - 1)  # lines that share a window with those

    def stays(i: int) -> bool:
        line = lines[i]
        return surge <= i < dive or line.heading or line.paragraph and i in near or bool(_SENTENCE.match(line.text))

    return " ".join(lines[i].text for i, n in enumerate(lengths) if n and stays(i))


def _extracted(batches):
    for b in batches:
        texts = [main_text(p) for p in b.column("__html").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("__row"), pa.array(texts, pa.string())], ["__row", "__text"])


def extract_main_text(pages: DataFrame, source: str = "html", into: str = "text") -> DataFrame:
    """``pages`` without ``source``, with ``into`` (never null) and n_chars, its code points.

    A null or empty page gives an empty text. Every row gives one row; columns of the same name
    as the new ones are replaced, all others are carried.
    """
    ship_package(pages.sparkSession)
    rest = [c for c in pages.columns if c != source]
    frame = pages.select(packed(pages.select(*[F.col(f"`{c}`") for c in rest])), F.col(f"`{source}`").alias("__html"))
    out = frame.mapInArrow(_extracted, StructType([frame.schema["__row"], StructField("__text", StringType())]))
    new = {into: F.col("__text"), "n_chars": F.length("__text").cast("bigint")}
    return out.select(*unpacked(rest, new))


@query(
    "op4_main_text",
    r"""
WITH a AS (SELECT page_id, url, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) t FROM pages),
b AS (SELECT page_id, url, regexp_replace(t, '</?(p|h1|br)>', ' ', 'g') t FROM a),
c AS (SELECT page_id, url, regexp_replace(t, '</?b>', '', 'g') t FROM b),
d AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(t, '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g') t FROM c),
e AS (SELECT page_id, url, regexp_replace(replace(t, '&#x27;', ''''), '&amp;?', '&', 'g') t FROM d),
f AS (SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS "text" FROM e)
SELECT page_id, url, "text", length("text")::BIGINT n_chars FROM f
""",
)
def op4_main_text(spark, folder):
    return extract_main_text(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")
