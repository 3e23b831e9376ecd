"""Tags and blocks of web pages, in time linear in their length.

A batch of pages is searched for tag beginnings, ends, quotes and names at once
with numpy; a walk over each page's tags then settles what numpy can't see: ends
hidden in quoted attribute values, comments, and elements whose content is no
markup.  A quote counts where a value begins and only if it is closed; a tag
without an end reaches to the end of the page and is no text.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter

import numpy as np

# Elements whose text is never the article's.
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "xmp"}
_ASIDE = {
    "head", "nav", "aside", "footer", "form", "menu", "dialog", "button", "select", "fieldset", "object", "canvas", "audio", "video",
}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "li", "main",
    "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
}
#: Blocks that hold running text, lists or tables: what stands in them is content, however often it repeats.
_CONTENT = {
    "address", "blockquote", "caption", "dd", "dt", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "li", "p", "pre", "summary", "td", "th",
}
_REPEATS = {"p", "li", "dt", "dd", "tr", "td", "th"}
# Words in class, id and role that mark what is not the article.
_MARKS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promotion",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "footer", "header", "masthead", "contentinfo",
    "complementary", "dialog", "comment", "comments", "disqus", "reply", "replies", "cookie", "cookies", "consent", "gdpr", "notice", "notices",
    "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "signup", "login", "search", "share", "social", "related", "widget",
}
# Parts of names that tell how a page is laid out, and elements that only a whole name makes an aside.
_STATES = {"no", "not", "has", "with", "without", "layout"}
_TEXT = {"h1", "h2", "h3", "h4", "h5", "h6", "p"}
# Of the marks, and of tags, those that a page may leave open before its article.
_LEFT_OPEN = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promotion",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "head", "form",
}
_MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORDS = re.compile(r"[^a-z0-9]+")
_VALUE = re.compile(rb"""=[ \t\r\n\f]*(["'])|>""")

#: Bytes of a tag's name that tell it from others.
_NAME_BYTES = 16
_NAME_END = np.zeros(256, bool)
_NAME_END[[0, 9, 10, 12, 13, 32, 47, 62]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_PRIME = np.uint64(0x100000001B3)

_PLAIN, _QUOTED, _COMMENT, _DECLARATION = 0, 1, 2, 3

#: A tag of a page: start, end, name (a number), whether it closes.  Comments and declarations have name 0.
Tag = tuple[int, int, int, bool]


def _name(text: str) -> int:
    code = 0
    for byte in text.encode()[:_NAME_BYTES]:
        code = (code * int(_PRIME) + byte + 1) & 0xFFFFFFFFFFFFFFFF
    return code


_KNOWN = {_name(tag): tag for tag in _RAW | _ASIDE | _VOID | _BLOCK | {"br", "article", "main", "header"}}
_RAW_NAMES = {_name(tag): b"</" + tag.encode() for tag in _RAW}
_BLOCK_NAMES = {_name(tag): number for number, tag in enumerate(sorted(_BLOCK), 1)}
_REPEAT_NAMES, _VOID_NAMES, _CONTENT_NAMES = ({_name(tag) for tag in some} for some in (_REPEATS, _VOID, _CONTENT))
_HR, _BR = _name("hr"), _name("br")
_MENUS = {_name(tag) for tag in ("nav", "menu", "header")}


def tags(data: np.ndarray, offsets: np.ndarray) -> list[list[Tag]]:
    """The tags of pages laid end to end in ``data`` (``offsets`` from 0); places count from each page's front."""
    n = len(data)
    lt = np.flatnonzero(data == 0x3C)
    owner = np.searchsorted(offsets, lt, side="right") - 1
    stop = offsets[owner + 1]
    padded = np.concatenate([data, np.zeros(_NAME_BYTES + 4, np.uint8)])
    closing = padded[lt + 1] == 0x2F
    first = lt + 1 + closing
    letter = _LETTER[padded[first]]
    declares = (padded[lt + 1] == 0x21) | (padded[lt + 1] == 0x3F)
    kept = (letter | declares) & (first < stop)
    lt, owner, stop, closing, first, letter = (x[kept] for x in (lt, owner, stop, closing, first, letter))
    ends = np.append(np.flatnonzero(data == 0x3E) + 1, n + 1)
    end = np.minimum(ends[np.searchsorted(ends, lt + 1)], stop)
    kind = np.where(letter, _PLAIN, _DECLARATION)
    kind[~letter & (padded[lt + 2] == 0x2D) & (padded[lt + 3] == 0x2D) & (lt + 4 <= stop)] = _COMMENT
    for quote in (0x22, 0x27):
        quotes = np.flatnonzero(data == quote)
        odd = (np.searchsorted(quotes, end) - np.searchsorted(quotes, lt)) % 2 == 1
        kind[(kind == _PLAIN) & odd] = _QUOTED
    name, inside = np.zeros(len(lt), np.uint64), letter.copy()
    for k in range(_NAME_BYTES):
        byte = padded[first + k]
        inside &= ~_NAME_END[byte] & (first + k < stop)
        if not inside.any():
            break
        name = np.where(inside, name * _PRIME + _LOWER[byte] + np.uint64(1), name)
    begin = offsets[owner]
    columns = [x.tolist() for x in (lt - begin, end - begin, kind, name, closing)]
    bounds = np.searchsorted(owner, np.arange(len(offsets))).tolist()
    out = []
    for i in range(len(offsets) - 1):
        a, b = bounds[i], bounds[i + 1]
        page = data[offsets[i] : offsets[i + 1]].tobytes() if b > a else b""
        out.append(_walk(page, *(c[a:b] for c in columns)))
    return out


def _walk(page: bytes, starts: list[int], ends: list[int], kinds: list[int], names: list[int], closings: list[bool]) -> list[Tag]:
    """The tags that are none inside another, a comment or an element without markup."""
    found: list[Tag] = []
    at, size = 0, len(page)
    lower = None
    open_quotes: set[bytes] = set()  # quotes that are not closed any more
    for start, end, kind, name, closing in zip(starts, ends, kinds, names, closings):
        if start < at:
            continue
        if kind == _COMMENT:
            end = page.find(b"-->", start + 4)
            end = size if end < 0 else end + 3
        elif kind == _QUOTED:
            end = _quoted_end(page, start, open_quotes)
        found.append((start, end, name, closing))
        at = end
        if name in _RAW_NAMES and not closing and page[end - 2 : end] != b"/>":
            if lower is None:
                lower = page.lower()
            mark = _RAW_NAMES[name]
            close = lower.find(mark, end)
            while close >= 0 and lower[close + len(mark) : close + len(mark) + 1].isalnum():
                close = lower.find(mark, close + 1)
            close = page.find(b">", close) if close >= 0 else -1
            at = close + 1 if close >= 0 else size
            found[-1] = (start, end, name, closing)
            found.append((end, at, 0, False))  # the content, with what closes it
    return found


def _quoted_end(page: bytes, start: int, open_quotes: set[bytes]) -> int:
    at = start
    while True:
        found = _VALUE.search(page, at)
        if found is None:
            return len(page)
        quote = found.group(1)
        if quote is None:
            return found.end()
        at = found.end()
        if quote not in open_quotes:
            close = page.find(quote, at)
            if close < 0:
                open_quotes.add(quote)
            else:
                at = close + 1


def paths(found: list[Tag], first: int, out: list[tuple[int, int, bool, int]]) -> None:
    """Adds ``(start, end, block, path)`` of a page's tags; ``path`` is a hash of the blocks open after the tag."""
    out.append((first, first, True, 0))
    stack: list[tuple[int, int]] = []
    held: Counter[int] = Counter()
    path = 0
    for start, end, name, closing in found:
        number = _BLOCK_NAMES.get(name, 0)
        if number and closing:
            if held[name]:
                while True:
                    last, path = stack.pop()
                    held[last] -= 1
                    if last == name:
                        break
        elif number and name != _HR:
            if name in _REPEAT_NAMES and stack and stack[-1][0] == name:  # <p> ends an open <p>
                path = stack.pop()[1]
                held[name] -= 1
            stack.append((name, path))
            held[name] += 1
            path = (path * 1000003 + number) & 0xFFFFFFFFFFFF
        out.append((first + start, first + end, number > 0, path))


def _aside(tag: str, attributes: str, in_article: bool) -> int:
    """0: no aside, 1: a menu, header or advert, which may be left open, 2: another."""
    if tag in _ASIDE or tag == "header" and not in_article:
        return 1 if tag in _LEFT_OPEN else 2
    if not attributes or tag in ("html", "body"):
        return 0
    if _HIDDEN.search(attributes):
        return 2
    names = [name for value in _MARKED.findall(attributes) for name in value.strip("\"'").lower().split()]
    if in_article or tag in _TEXT:
        marks = [{name} for name in names if name in _MARKS]
    else:
        parts = [set(_WORDS.split(name)) for name in names]
        marks = [m for p in parts if _STATES.isdisjoint(p) and (m := _MARKS & p)]
    return 0 if not marks else 1 if all(m <= _LEFT_OPEN for m in marks) else 2


class _Closings:
    """Whether an element that is open at a tag is closed later: prefix sums of a name's tags and their later minimum."""

    def __init__(self, found: list[Tag]):
        self.found, self.known = found, {}

    def later(self, place: int, name: int) -> bool:
        if name not in self.known:
            at = [i for i, tag in enumerate(self.found) if tag[2] == name]
            depth = np.cumsum([-1 if self.found[i][3] else 1 for i in at], dtype=np.int64)
            self.known[name] = at, depth, np.minimum.accumulate(depth[::-1])[::-1]
        at, depth, least = self.known[name]
        k = bisect_left(at, place + 1)
        return k < len(at) and least[k] < (depth[k - 1] if k else 0)


class Template:
    """Byte offsets of a page's words and of those that belong to its host's template, sorted."""

    def __init__(self, words: list[int], known: list[int]):
        self.words, self.known = words, known

    def count(self, pieces: list[tuple[int, int]]) -> tuple[int, int]:
        """Words of the template, and words, in pieces of the page."""
        within = lambda at: sum(bisect_left(at, b) - bisect_left(at, a) for a, b in pieces)
        known = within(self.known)
        return known, within(self.words) if known else 0

    def without(self, page: bytes, start: int, end: int) -> bytes:
        """A piece of the page less its template words."""
        out, at = [], start
        for word in self.known[bisect_left(self.known, start) : bisect_left(self.known, end)]:
            out.append(page[at:word])
            at = word
            while at < end and page[at] not in b" \t\n\v\f\r":
                at += 1
        out.append(page[at:end])
        return b"".join(out)


def blocks(page: bytes, found: list[Tag], template: Template | None = None) -> list[str]:
    """The blocks of the article of one page."""
    out, shut_in = _blocks(page, found, template, False)
    return _blocks(page, found, template, True)[0] if shut_in and not out else out


def page_blocks(page: str) -> list[str]:
    """The blocks of the article of a page that is read by itself."""
    data = page.encode()
    return blocks(data, tags(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0])


def _blocks(page: bytes, found: list[Tag], template: Template | None, any_aside: bool) -> tuple[list[str], bool]:
    """The blocks, and whether an article lies in an aside; ``any_aside`` takes the first such article as the page's."""
    inside: list[str] = []
    outside: list[str] = []  # blocks elsewhere, used if the page marks no article
    stack: list[tuple[int, int, bool]] = []  # name, aside here, within an article
    held: Counter[int] = Counter()
    pieces: list[tuple[int, int]] = []
    marked, aside, article, shut_in, at = False, 0, False, False, 0
    closings = _Closings(found)

    def close_block() -> None:
        if not pieces:
            return
        known, words = template.count(pieces) if template else (0, 0)
        holder = next((name for name, _, _ in reversed(stack) if name in _BLOCK_NAMES), 0) if known and article else 0
        # In the article only a whole block outside running text goes; elsewhere one that is mostly template.
        if known and (known == words and holder not in _CONTENT_NAMES if article else 2 * known > words):
            pieces.clear()
            return
        drop = known and not article
        text = b"".join(b" " if a < 0 else template.without(page, a, b) if drop else page[a:b] for a, b in pieces)
        pieces.clear()
        block = " ".join(entities.unescape(text.decode("utf-8", "replace")).split())
        if block:
            (inside if article else outside).append(block)

    for place, (start, end, name, closing) in enumerate(found):
        if at < start and not aside:
            pieces.append((at, start))
        at = end
        if not name:
            continue
        if name in _BLOCK_NAMES:
            close_block()
        elif name == _BR and not aside:
            pieces.append((-1, -1))
        if closing:
            if held[name]:
                while True:
                    last, aside, article = stack.pop()
                    held[last] -= 1
                    if last == name:
                        break
            continue
        if name in _VOID_NAMES or name in _RAW_NAMES or page[end - 2 : end] == b"/>" and name not in _BLOCK_NAMES:
            continue
        tag = _KNOWN.get(name, "")
        head = page[start + 1 : end - 1]
        attributes = head[len(tag) :].decode("utf-8", "replace") if tag else head.decode("utf-8", "replace") if b"=" in head or b" " in head else ""
        mark = _aside(tag, attributes, article)
        if tag in ("article", "main") and not mark:
            if aside and not marked:
                # The first article lies in no menu, header or advert left open: that has ended. Other asides hold comments and teasers.
                opened = {open_ for open_, _, _ in stack if open_ in _MENUS} if aside == 1 and not any_aside else ()
                if any_aside or aside == 1 and not any(closings.later(place, open_) for open_ in opened):
                    while stack and aside:
                        last, aside, article = stack.pop()
                        held[last] -= 1
                else:
                    shut_in = True
            stack.append((name, aside, article))
            held[name] += 1
            if not aside:
                article = marked = True
            continue
        stack.append((name, aside, article))
        held[name] += 1
        aside = max(aside, mark)
    if at < len(page) and not aside:
        pieces.append((at, len(page)))
    close_block()
    return inside if marked else outside, shut_in
