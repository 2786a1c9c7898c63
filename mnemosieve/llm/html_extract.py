"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines, and every border of a block element ends one, so markup between two texts leaves empty lines. A line's length counts its
text; a line that is links has length 0. Sums of lengths over windows of WINDOW lines make the distribution: text surges where a window reaches SURGE
characters and dives where a whole window is empty, which parts the page into stretches. The largest stretch is main text, and its usual line is
the level that another stretch must surge to in order to count as well. These stretches tell the container: all article and main elements if the largest
stands in one, else the innermost element around them. From the container's outermost surge to its outermost dive every line is kept, whatever its
length, if it stands in an article or main, or under the same kinds of boxes as the stretches do (a paragraph after an aside, but no box of its own).
Menus show by windows full of links: runs of at least LINKS lines that are links go, shorter ones stay beside kept text.

What HTML itself sets apart is never main text: scripts, styles, forms, nav, aside, footer, dialog, a header outside of article and main, hidden elements.
Class, id and role are a second hint for boxes (div, section, lists, tables) inside the container, such as an advert in an article: a box so marked goes,
unless it holds most of the page's text or the article itself. Paragraphs and headings are never judged by their class, ids that are phrases not at all.

Defined results: null or empty html, and html without text, give an empty text; broken and unclosed markup is read as far as it goes, in linear time; a
page whose only text HTML sets apart gives an empty text; repeated rows give repeated results; further columns are ignored.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemosieve.llm.common import arrow_map, read_table

#: Lines of a window; characters in a window at a surge; lines that are links in a menu; share of a line's text in links that makes it one.
WINDOW, SURGE, LINKS, LINKED = 2, 40, 3, 0.8

# Elements of HTML by their role.
DROPPED = {"script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "head", "title", "textarea", "select", "button"}
APART = {"nav", "footer", "aside", "form", "menu", "dialog"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "input", "ins", "kbd", "label", "mark",
    "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
FLOW = {
    "address", "blockquote", "caption", "center", "dd", "dl", "dt", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "li", "ol", "p", "pre", "table", "tbody", "td",
    "tfoot", "th", "thead", "tr", "ul",
}
SELF_CLOSING = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
#: Boxes that class, id and role may mark, and how the marks begin.
BOXES = {"div", "section", "ul", "ol", "dl", "table", "header", "figure", "details", "center"}
MARKS = re.compile(
    r"(?:^|\s)(ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|newsletter|subscribe|popup|modal|sidebar|widget|related|recommend\w*|share|social|"
    r"breadcrumbs?|menu|nav|navbar|navigation|footer|masthead|topbar|header|comments?|replies|respond|disqus|pagination|pager|toc|search|login|complementary|contentinfo|alert|dialog)(?=$|[\s_-])", re.I,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
COMMENTS = re.compile(r"comment|replies|respond|disqus", re.I)
QUOTED = re.compile(r"""(?<==)\s*(?:"[^"]*"|'[^']*')""")
HIDDEN = re.compile(r"""\shidden(?:[\s=/>]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
NAME = re.compile(r"[A-Za-z][A-Za-z0-9:-]*")
STOP = re.compile(r"""=\s*["']|>""")
RAW_END = {x: re.compile(rf"</{x}\s*>", re.I) for x in ("script", "style", "textarea", "title", "noscript", "template", "svg", "iframe")}


#: An id made of a phrase, as headings get it for links to them, and marks that count on a figure.
PHRASE = re.compile(r"^\w+(?:-\w+)*-(?:%s)-\w" % "|".join("a an and as at by for from in is of on or our that the to with".split()), re.I)
ADVERTS = re.compile(r"ads?$|advert|sponsor|promo|banner", re.I)


def marked(attributes: str, name: str = "div") -> int:
    """2 if class, id or role mark the element, 4 if they mark it as comments, else 0. An id that is a phrase marks nothing, and a figure is marked as an
    advert or not at all: what it shows may well be to share."""
    values = [(kind.lower(), a or b or c) for kind, a, b, c in ATTRIBUTE.findall(attributes)]
    found = [x[1] for kind, value in values if not (kind == "id" and PHRASE.match(value)) for x in MARKS.finditer(value)]
    if name == "figure":
        found = [x for x in found if ADVERTS.match(x)]
    return 0 if not found else 4 if any(COMMENTS.match(x) for x in found) else 2


def keep_style(value: re.Match) -> str:
    """A quoted value, but for words that are no declaration and no value of aria-hidden."""
    return value[0] if ":" in value[0] or value[0][1:-1].strip().lower() == "true" else value[0][0] * 2


class Line(NamedTuple):
    text: str
    length: int  # 0 for links and for what HTML sets apart
    apart: bool  # by HTML or by a mark
    element: int  # number of the innermost element around it
    explicit: bool  # in an article or main
    empty: int  # empty lines before it


class Elements:
    """Elements of a page by number, 0 for the page; a parent's number is less than its children's."""

    def __init__(self) -> None:
        self.parent, self.name, self.role = [0], [""], [0]  # role: 1 an inline element, 2 marked, 4 marked as comments, 8 an article or main

    def sums(self, own: list[int]) -> list[int]:
        """For each element, the sum over it and all that it holds."""
        out = list(own)
        for e in range(len(out) - 1, 0, -1):
            out[self.parent[e]] += out[e]
        return out

    def denied(self, text: list[int]) -> list[bool]:
        """Which elements stand in a marked one. text: characters outside links directly in each element. A mark counts for nothing on an element
        that holds most of the page's text while no article or main stands beside it, and not for an article or main inside; on comments, both only
        where no article or main stands elsewhere."""
        if not any(x & 6 for x in self.role):
            return [False] * len(self.parent)
        held = self.sums(text)
        commented = [False] * len(self.parent)
        for e in range(1, len(commented)):
            commented[e] = commented[self.parent[e]] or bool(self.role[e] & 4)
        apart = any(self.role[e] & 8 and held[e] and not commented[e] for e in range(len(commented)))
        main = [int(bool(x & 8 and n)) for x, n in zip(self.role, held, strict=True)]
        below, around, total = self.sums(main), [0] * len(main), sum(main)
        out = [False] * len(self.parent)
        for e in range(1, len(out)):
            role, around[e] = self.role[e], around[self.parent[e]] + main[self.parent[e]]
            beside = below[e] + around[e] < total
            above = out[self.parent[e]] and not (role & 8 and not role & 4 and not (commented[e] and apart))
            own = role & 8 == 0 and (role & 2 and (beside or held[e] * 2 <= held[0]) or role & 4 and (apart or held[e] * 10 <= 9 * held[0]))
            out[e] = above or bool(own)
        return out


class Scanner:
    """Tags of a page in one pass: every character is looked at a bounded number of times, whatever the markup."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.missing: set[str] = set()  # quotes and closing tags that don't occur any more

    def tag_end(self, at: int) -> int:
        """Where the tag ends that begins before `at`, minding quoted values; -1 if it never does."""
        while m := STOP.search(self.page, at):
            if m[0] == ">":
                return m.end()
            quote = m[0][-1]
            end = -1 if quote in self.missing else self.page.find(quote, m.end())
            if end < 0:
                self.missing.add(quote)
                return self.page.find(">", m.end()) + 1 or -1
            at = end + 1
        return -1

    def raw_end(self, name: str, at: int) -> int:
        """Where the text of an element ends that has no markup inside; -1 if it never does."""
        if name in self.missing:
            return -1
        if m := RAW_END[name].search(self.page, at):
            return m.end()
        self.missing.add(name)
        return -1


def lines(page: str, marks: bool = True) -> tuple[list[Line], Elements]:
    """Lines of the page in order, and its elements. marks: whether class, id and role are minded."""
    out: list[Line] = []
    elements, scanner = Elements(), Scanner(page)
    pieces: list[str] = []
    linked = at = empty = 0
    open_tags: list[tuple[str, int, int]] = []  # name, number, state: 1 drops its text, 2 sets it apart, 4 makes it a link, 8 is in an article or main
    count: dict[str, int] = {}

    def state() -> int:
        return open_tags[-1][2] if open_tags else 0

    def around() -> int:
        return open_tags[-1][1] if open_tags else 0

    def close() -> str:
        name = open_tags.pop()[0]
        count[name] -= 1
        return name

    def put(text: str) -> None:
        nonlocal linked
        if text and not state() & 1:
            pieces.append(text)
            if state() & 4:
                linked += len(text)

    def end_line() -> None:
        nonlocal linked, empty
        text = " ".join(html.unescape("".join(pieces)).split()) if pieces else ""
        if text:
            apart = bool(state() & 2)
            out.append(Line(text, 0 if apart or linked and linked >= LINKED * len(text) else len(text), apart, around(), bool(state() & 8), empty))
        empty = 0 if text else empty + 1
        pieces.clear()
        linked = 0

    while at < len(page):
        begin = page.find("<", at)
        if begin < 0:
            break
        put(page[at:begin])
        closing = page.startswith("/", begin + 1)
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = end + 3 if end >= 0 else len(page)
            continue
        m = NAME.match(page, begin + 1 + closing)
        if not m:
            if page[begin + 1 : begin + 2] in ("!", "?"):
                at = page.find(">", begin) + 1 or len(page)
            else:
                put("<")
                at = begin + 1
            continue
        at = scanner.tag_end(m.end())
        if at < 0:  # no tag any more
            put(page[begin:])
            at = len(page)
            break
        name, attributes = m[0].lower(), page[m.end() : at - 1]
        if name not in INLINE:
            end_line()
        if closing:
            if count.get(name):
                while close() != name:
                    pass
            continue
        if name in RAW_END:
            end = scanner.raw_end(name, at)
            if end >= 0 or name in ("script", "style"):
                at = end if end >= 0 else len(page)
                continue
        if name in VOID or attributes.endswith("/"):
            continue
        if name in SELF_CLOSING and open_tags and open_tags[-1][0] == name:
            close()
        now = state()
        if name in DROPPED:
            now |= 1
        if name in APART or name == "header" and not now & 8:
            now |= 2
        elif attributes and name not in ("html", "body", "article", "main") and HIDDEN.search(QUOTED.sub(keep_style, attributes)):
            now |= 2
        if name == "a":
            now |= 4
        own = 8 if name in ("article", "main") else 0
        elements.parent.append(around())
        elements.name.append(name)
        elements.role.append((1 if name in INLINE else 0) | own | (marked(attributes, name) if marks and attributes and (name in BOXES or own) else 0))
        open_tags.append((name, len(elements.parent) - 1, now | own))
        count[name] = count.get(name, 0) + 1
    put(page[at:])
    end_line()
    text = [0] * len(elements.parent)
    for x in out:
        text[x.element] += x.length
    denied = elements.denied(text)
    return [x._replace(apart=True) if denied[x.element] else x for x in out], elements


def windows(length: np.ndarray, window: int) -> np.ndarray:
    """Sums over the window that begins at each line."""
    total = np.concatenate([[0], np.cumsum(length)])
    return total[window:] - total[: len(total) - window]


def stretches(found: list[Line], window: int = WINDOW, surge: int = SURGE) -> list[tuple[int, int, int]]:
    """From, to (lines) and largest window of each stretch between dives that surges."""
    place, last = [], -1  # of each line among all lines, empty ones included; more than a window of them make no difference
    for x in found:
        last += 1 + min(x.empty, window)
        place.append(last)
    length = np.zeros(last + 1 + window, np.int64)
    length[place] = [x.length for x in found]
    block = windows(length, window)
    length[[at for at, x in zip(place, found, strict=True) if x.apart]] = 0
    threshold = min(surge, int(windows(length, window).max(initial=0)))
    if not threshold:
        return []
    begins = np.flatnonzero(block == 0)  # dives
    out, at = [], 0
    for end in [*begins.tolist(), len(block)]:
        if end > at and block[at:end].max() >= threshold:
            some = [int(i) for i in np.searchsorted(place, [at, end + window - 1])]
            out.append((*some, int(block[at:end].max())))
        at = end + 1
    return out


def main_text(page: str, window: int = WINDOW, surge: int = SURGE, marks: bool = True) -> str:
    found, elements = lines(page, marks)
    parts = stretches(found, window, surge)
    if not parts:
        return ""
    texts = [[i for i in range(begin, end) if found[i].length and not found[i].apart] for begin, end, _ in parts]
    of_main = max(texts, key=lambda some: sum(found[i].length for i in some))
    if not of_main:
        return ""
    explicit = any(found[i].explicit for i in of_main)
    if explicit:
        inside = np.array([x.explicit for x in found])
        keep = inside & np.array([x.length > 0 and not x.apart for x in found])
    else:
        level = sorted(found[i].length for i in of_main)[len(of_main) // 2]
        some = [i for (*_, most), mine in zip(parts, texts, strict=True) if most >= level for i in mine]
        container = around_all(found, elements, some)
        inside, boxes = within(found, elements, container)
        usual = {boxes[i] for i in some}
        keep = np.array([x.length > 0 and not x.apart and bool(inside[i]) and boxes[i] in usual for i, x in enumerate(found)])
        keep[some] = True
    return " ".join(found[i].text for i in np.flatnonzero(keep | links_among(found, keep, inside, explicit)))


def around_all(found: list[Line], elements: Elements, some: list[int]) -> int:
    """The innermost element around all of some lines; a single line's own element is not around it."""
    count = [0] * len(elements.parent)
    for i in some:
        count[found[i].element] += 1
    container = max(e for e, n in enumerate(elements.sums(count)) if n == len(some))
    while container and elements.role[container] & 1:
        container = elements.parent[container]
    return elements.parent[container] if len(some) == 1 else container


def within(found: list[Line], elements: Elements, container: int) -> tuple[np.ndarray, list[int]]:
    """Which lines stand in the container, and for each line a number for the kinds of boxes between the container and it."""
    under, kind, numbers = [False] * len(elements.parent), [0] * len(elements.parent), {}
    for e in range(len(under)):
        parent, name = elements.parent[e], elements.name[e]
        under[e] = e == container or under[parent]
        if e != container and under[e]:
            kind[e] = kind[parent] if name in FLOW or name in INLINE else numbers.setdefault((kind[parent], name), len(numbers) + 1)
    return np.array([under[x.element] for x in found]), [kind[x.element] for x in found]


def links_among(found: list[Line], keep: np.ndarray, inside: np.ndarray, explicit: bool) -> np.ndarray:
    """Lines of the container that are links, in runs of fewer than LINKS between kept lines; in an article or main, beside one."""
    out = np.zeros(len(found), bool)
    link = [bool(inside[i]) and not keep[i] and not x.apart and not x.length for i, x in enumerate(found)]
    at = 0
    while at < len(found):
        if not link[at]:
            at += 1
            continue
        end = at
        while end < len(found) and link[end]:
            end += 1
        beside = (at > 0 and bool(keep[at - 1])) + (end < len(found) and bool(keep[end]))
        out[at:end] = end - at < LINKS and beside >= (1 if explicit else 2)
        at = end
    return out


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each page."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(x) for x in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return arrow_map(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html"), run, "page_id long, url string, text string, n_chars long", "html")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(read_table(spark, sf_dir, "pages"))
