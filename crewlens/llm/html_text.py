"""HTML extraction by line-block distribution.

Stripping the markup turns a page into lines, one per text block. What tags and names say weighs
lines, and the distribution of the weights decides what is kept:

* lines of menus, headers, footers, sidebars, notices, adverts, forms and comments weigh nothing;
* where the page marks its article or main part, the lines in it weigh their whole length, links and
  all, and the others nothing, unless these hold MARK_WEIGHT times as much text as the marked ones;
* elsewhere a line weighs the length of its text that is not in links, or nothing if half of it is.

Sums of the weights over a sliding window of lines are the distribution (lines of menus and the like
are passed over). The main text surges where the sum rises above nothing and dives where a whole
window has fallen to nothing. The text between surge and dive points is kept, however short.

A class, id or role says nothing about an element that the page's text stands in: where almost all
of the page is inside one (WRAPS) and little would be left without it (LEFT), it counts as a wrapper.
So does a form, but not what is called an advert or comments. An article or main part inside a
wrapper counts by itself.

Defined cases: a null, empty or text-free page gives an empty text; broken or unclosed markup is
read as far as it goes, attributes as browsers read them (a quote only counts after the sign of
equality; one without an end is part of a value without quotes); repeated rows are repeated; an empty
table gives an empty result; a page of any length is read whole in one pass; columns besides page_id,
url and html are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

from crewlens.llm.tables import python_ready

WINDOW = 4
MARK_WEIGHT = 4
WRAPS, LEFT = 0.8, 0.1

# Elements without text of their own, elements around the main text, and elements
# that begin and end a block.
SILENT = {"script", "style", "noscript", "template", "svg", "math", "head", "title", "iframe", "object",
          "select", "option", "button", "textarea", "canvas", "audio", "video", "map", "datalist"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "xmp"}
AROUND = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"}
BLOCKS = {"address", "article", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "figcaption",
          "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "hr", "html", "legend", "li", "main", "ol", "p",
          "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "caption",
          "optgroup"} | AROUND | SILENT
EMPTY = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
WRAPPERS = {"form", "fieldset"}
NO_MAIN, MAIN_PART, ARTICLE = 0, 1, 2
MAIN = {"article": ARTICLE, "main": MAIN_PART}
CLOSED_BY_BLOCK = {"p"}
SAME = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
INLINE_CLOSED = {"a", "abbr", "b", "big", "cite", "code", "em", "font", "i", "q", "s", "small", "span", "strong", "sub",
                 "sup", "tt", "u"}
COMMON_NAMES = (
    r"ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu\w*|breadcrumbs?|footer|"
    r"sidebar|widget\w*|related|recommend\w*|comments?|commentlist|disqus|replies|respond|cookies?|consent|gdpr|"
    r"notices?|notification\w*|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|share|"
    r"sharing|social|toolbar|pagination|pager|skip|copyright|disclaimer")


def _word(names: str) -> re.Pattern:
    return re.compile(rf"(?:^|[^a-z])(?:{names})(?:$|[^a-z])")


NAMES, NAMES_IN_MAIN = _word(COMMON_NAMES + "|header|masthead|side|legal"), _word(COMMON_NAMES)
ASIDE_NAMES = _word(r"ads?|advert\w*|sponsor\w*|promo\w*|related|recommend\w*|comments?|replies|teasers?")
ABOUT = re.compile(r"(?:has|with|without|no|is|show|hide)[-_]")  # of a class that says what is inside or beside
# Lines that name an owner before or after the text: a sign with a year or another sign, or the phrase.
OWNERS = re.compile(r"©|(?:\(c\)|copyright)(?:\s|©|\(c\)|by\b)*\d{4}\b|copyright\s*(?:©|\(c\))|all rights reserved", re.I)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog",
         "menu", "menubar", "toolbar"}

_VALUE = r"\"[^\"]*+\"|'[^']*+'|[^\s>]*+"
_ATTRIBUTE = rf"[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?>{_VALUE}))?+"
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                 rf"<(/?)([a-zA-Z][^\s/>]*)((?>[\s/]++|{_ATTRIBUTE})*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(rf"([^\s/>][^\s/>=]*)(?:\s*=\s*({_VALUE}))?")
SPACE = re.compile(r"\s+")


@dataclass
class Element:
    name: str
    marks: tuple[int, ...]  # numbers of the elements around it, itself included, that are not main text
    silent: bool
    main: int  # ARTICLE, MAIN or 0: how surely the page calls it main text
    link: bool


@dataclass
class Line:
    text: str
    linked: int
    marks: tuple[int, ...]
    main: int


@dataclass
class Lines:
    """The page's lines that hold text."""

    found: list[Line] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    beside: list[Line] = field(default_factory=list)
    linked: int = 0
    marks: tuple[int, ...] = ()
    main: int = 0

    def add(self, text: str, element: Element) -> None:
        if self.parts and element.marks != self.marks:
            if len(element.marks) > len(self.marks):  # a mark or link inside a line that is none itself
                self.beside.append(Line(text, len(text.strip()) if element.link else 0, element.marks, element.main))
                return
            self.beside.append(Line("".join(self.parts), self.linked, self.marks, self.main))
            self.parts, self.linked = [], 0
        if not self.parts:
            self.marks, self.main = element.marks, element.main
        self.parts.append(text)
        if element.link:
            self.linked += len(text.strip())

    def end(self) -> None:
        for line in [Line("".join(self.parts), self.linked, self.marks, self.main), *self.beside]:
            line.text = SPACE.sub(" ", entities.unescape(line.text)).strip()
            if line.text:
                self.found.append(line)
        self.parts, self.beside, self.linked = [], [], 0


def _calls_main(name: str, attributes: str) -> int:
    found = MAIN.get(name, NO_MAIN)
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "role" and value in ("main", "article") or key == "itemprop" and value == "articlebody":
            found = max(found, MAIN_PART if value == "main" else ARTICLE)
    return found


def _named_around(name: str, attributes: str, main: int) -> bool:
    """Whether its class, id, role or style sets an element apart from the main text."""
    if name in ("html", "body") or not attributes:
        return False
    names = ASIDE_NAMES if name in MAIN else NAMES_IN_MAIN if main == ARTICLE else NAMES
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id") and any(names.search(x) and not ABOUT.match(x) for x in value.split()):
            return True
        if key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _named_beside(attributes: str) -> bool:
    """Whether its class or id calls an element an advert, comments or the like, which wrap no page."""
    return any(key.lower() in ("class", "id") and any(ASIDE_NAMES.search(x) for x in value.strip("\"'").lower().split())
               for key, value in ATTRIBUTE.findall(attributes))


def page_lines(page: str) -> tuple[list[Line], set[int]]:
    """Strip the markup; also the marks that stand for names and forms. Elements are closed as
    browsers do: a block ends an open paragraph, an end tag closes what is still open inside its
    element."""
    lines, at, marks = Lines(), 0, 0
    stack, soft = [Element("", (), False, NO_MAIN, False)], set()

    def close(upto: int) -> None:
        del stack[upto:]

    while at < len(page):
        tag = TAG.search(page, at)
        upto = tag.start() if tag else len(page)
        if upto > at and not stack[-1].silent:
            lines.add(page[at:upto], stack[-1])
        if not tag:
            break
        at = tag.end()
        if tag[2] is None:
            if tag[0].startswith("<![CDATA[") and not stack[-1].silent:
                lines.add(entities.escape(tag[0][9:].removesuffix("]]>")), stack[-1])
            continue
        name, ending = tag[2].lower(), bool(tag[1])
        if name in BLOCKS:
            lines.end()
        elif name == "br":
            lines.add(" ", stack[-1])
        if ending:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    close(k)
                    break
                if name in INLINE_CLOSED and stack[k].name in BLOCKS:
                    break
            continue
        if name in BLOCKS:
            # A new block closes an open paragraph, and the sibling it follows.
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name in CLOSED_BY_BLOCK or stack[k].name in SAME.get(name, ()):
                    close(k)
                    break
                if stack[k].name in BLOCKS:
                    break
        if name in EMPTY or (tag[3] or "").endswith("/") and name not in BLOCKS:
            continue
        up = stack[-1]
        # The header of an article is part of it; a header of the page is not. An article or main
        # element counts also below an element with a name like "with-sidebar".
        attributes = tag[3] or ""
        main = max(up.main, _calls_main(name, attributes))
        own = up.marks if main == up.main else tuple(m for m in up.marks if m not in soft)
        around = name in AROUND and not (name == "header" and up.main == ARTICLE)
        if around or _named_around(name, attributes, up.main):
            marks += 1
            own = (*own, marks)
            if name in WRAPPERS or not around and not _named_beside(attributes):
                soft.add(marks)
        stack.append(Element(name, own, up.silent or name in SILENT, main, up.link or name == "a"))
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
    lines.end()
    return lines.found, soft


def _wrappers(lines: list[Line], soft: set[int]) -> set[int]:
    """Marks of the elements that almost the whole page stands in."""
    covered: Counter[int] = Counter()
    for x in lines:
        covered.update(dict.fromkeys(soft.intersection(x.marks), len(x.text)))
    least = WRAPS * sum(len(x.text) for x in lines)
    wraps = {m for m, chars in covered.items() if chars >= least}
    kept = sum(len(x.text) for x in lines if not x.marks)
    freed = [x for x in lines if x.marks and wraps.issuperset(x.marks)]
    own = sum(len(x.text) for x in freed)
    return wraps if kept <= LEFT * own and 2 * sum(x.linked for x in freed) < own else set()


def _weights(lines: list[Line]) -> tuple[list[int], int]:
    """Weight of each line, and how surely the page calls its lines of weight main text."""
    plain = [0 if 2 * x.linked >= len(x.text) else len(x.text) - x.linked for x in lines]
    level = max((x.main for x in lines), default=NO_MAIN)
    inside = sum(len(x.text) for x in lines if x.main == level)
    outside = sum(w for w, x in zip(plain, lines, strict=True) if x.main < level)
    if level and MARK_WEIGHT * inside >= outside:
        return [len(x.text) if x.main == level else 0 for x in lines], level
    return plain, NO_MAIN


def _stretches(weights: list[int]) -> list[tuple[int, int]]:
    """From surge to dive: the first line of weight after a window of none, and the last one before
    a whole window holds none again. Sums are over windows that end at a line."""
    found, start, total = [], None, 0
    for i, weight in enumerate(weights):
        total += weight - (weights[i - WINDOW] if i >= WINDOW else 0)
        if start is None and weight:
            start = i
        elif start is not None and total == 0:
            found.append((start, i - WINDOW))
            start = None
    if start is not None:
        found.append((start, max(i for i, w in enumerate(weights) if w)))
    return found


def main_text(page: str | None) -> str:
    if not page:
        return ""
    lines, soft = page_lines(page)
    wrappers = _wrappers(lines, soft)
    lines = [x for x in lines if wrappers.issuperset(x.marks)]
    weights, level = _weights(lines)
    if not level:
        owners = [bool(OWNERS.match(x.text)) and len(x.text) < 200 for x in lines]
        own = [i for i, w in enumerate(weights) if w and not owners[i]]
        stay = [i for i in range(len(lines)) if not owners[i] or own and own[0] < i < own[-1]]
        lines, weights = [lines[i] for i in stay], [weights[i] for i in stay]
    return "\n\n".join(x.text for a, b in _stretches(weights) for x in lines[a:b + 1] if x.main >= level)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per input row."""

    def texts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            text = [main_text(x) for x in frame["html"]]
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": text,
                                "n_chars": [len(x) for x in text]})

    python_ready(pages.sparkSession)
    schema = "page_id bigint, url string, text string, n_chars bigint"
    return pages.select("page_id", "url", "html").mapInPandas(texts, schema)
