"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block. Text in links does not count. Over sliding windows of
lines the text lengths are summed; where the sum surges from nothing a run of text begins, where it
dives to nothing the run ends, so a list of links cuts runs and a single line of links does not.
Blocks of menus, notices and the like become blank lines where they stand between containers; between
siblings they leave nothing. An ``article`` or ``main`` element that outweighs the longest run outside
is the text of the page, less its lists of links; without one, runs that are short against the
longest are left out, unless they lie in the container of a long one.

Class and id words are no verdict. What they name is left out at first; but a subtree that holds the
head of the page or most of its text, or reads as prose inside an article, is taken back, and the
lines are drawn anew with it. Where nothing would be left, class words do not count at all.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, SHORT = 3, 0.25
SOFT = "soft"

# Names of elements, roles and class words.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea xmp iframe noembed noframes".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = set(
    "nav footer aside form noscript template object svg canvas button select dialog menu audio "
    "video applet datalist".split()
)
ROLES = set(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar "
    "toolbar tablist status tooltip".split()
)
WORDS = set(
    "ad ads adsbygoogle adbox adslot advert adverts advertisement advertising adsense banner billboard breadcrumb "
    "breadcrumbs cookie cookies consent gdpr notice notices notification alert disclaimer nav navbar "
    "navigation menu menus sidebar widget widgets related recommended recommendations recirculation "
    "share sharing social sponsor sponsored promo promotion promoted outbrain taboola comment comments "
    "commentlist disqus respond reply replies newsletter subscribe subscription signup login popup "
    "modal overlay pagination pager toolbar footer masthead topbar copyright search skip".split()
)
HEADERS = {"header", "head"}
# Of these, the words of what is prose but no part of the article, whatever its lines look like.
COMMENTS = set("comment comments commentlist disqus respond reply replies".split())
SELLING = set(
    "ad ads adsbygoogle adbox adslot advert adverts advertisement advertising adsense banner "
    "billboard cookie cookies consent gdpr sponsor sponsored promo promotion promoted outbrain "
    "taboola newsletter subscribe subscription signup".split()
)
# Beginnings of classes that say what a text is about or how it is filed.
FILED = re.compile(r"(?:tag|category|cat|topic|section|subject|keyword|author|type|format|post)-")
# Shares of all text: of a subtree with the head of the page, of any other, of one with comments. A
# line of prose, the share of such lines that a subtree needs, and their length together.
HEADED, MOST, NEARLY_ALL = 0.3, 0.5, 0.9
PROSE_LINE, PROSE_SHARE, PROSE = 80, 0.6, 300
SENTENCE = re.compile(r"[.!?…。！？।۔]")
AFTER_TEXT = re.compile(
    r"(?:\d+\s+)?(?:comments?|responses?|replies|reader comments|leave a (?:comment|reply)|"
    r"join the (?:conversation|discussion))(?:\s*\(\d+\))?:?", re.I
)
NEUTRAL = set("has with without no is not".split())
KEPT = {"html", "body", "article", "main"}

TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*+)>"
    r"|<[!?/][^>]*+>"
    r"|<[a-zA-Z/!?][^>]*+\Z",
    re.S,
)
ATTRIBUTE = re.compile(
    r"""(?<![^\s"'/])(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""",
    re.I,
)


def _boilerplate(name: str, rest: str, in_article: bool) -> tuple[bool, set[str]]:
    """Whether an element is no part of an article by its name or role, and the class words that say
    so otherwise."""
    if name in KEPT and name != "article":
        return False, set()
    if name in DROPPED or name == "header" and not in_article:
        return True, set()
    named: set[str] = set()
    for attribute, value in ATTRIBUTE.findall(rest):
        attribute, value = attribute.lower(), value.strip("\"'").lower()
        if attribute == "hidden" or attribute == "aria-hidden" and value == "true":
            return True, set()
        if attribute == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, set()
        if attribute == "role" and value in ROLES:
            return True, set()
        if attribute in ("class", "id"):
            for word in value.split():
                parts = set(re.findall(r"[a-z]+", word))
                if parts & NEUTRAL or FILED.match(word):
                    continue
                named |= parts & WORDS
                if not in_article:
                    named |= parts & HEADERS
    return False, named


@dataclass
class _Suspect:
    """A subtree that class words name: text, prose and heads in it, after those before it."""

    words: set[str]
    in_article: bool
    text: int
    prose: int
    heads: int

    def taken_back(self, text: int, heads: int) -> bool:
        """Whether it belongs to the page's text; ``text`` and ``heads`` are those of the page."""
        share = self.text / text if text else 0
        if self.heads and share >= HEADED:
            return True
        if self.heads == heads and share >= (NEARLY_ALL if self.words & (COMMENTS | SELLING) else MOST):
            return True
        reads = self.prose >= PROSE and self.prose >= PROSE_SHARE * self.text
        return self.in_article and reads and not self.words & (COMMENTS | SELLING)


class _Page:
    """Lines of one page: text, characters in links, and whether they lie in an article."""

    def __init__(self, taken_back: frozenset[int] = frozenset()) -> None:
        self.lines: list[tuple[str, int, bool]] = []
        self.pieces: list[str] = []
        self.in_links = 0
        # Open elements: name, whether dropped (SOFT by class words), outermost article (number or
        # 0), in a link, container, suspect (number or None).
        self.open: list[tuple] = [("", False, 0, False, 0, None)]
        self.opened: Counter[str] = Counter()
        # The container around each container; containers of the whole page.
        self.around, self.names, self.page = [0], [""], {0}
        # Subtrees named by class words, those taken back, and what there was of text so far.
        self.suspects: list[_Suspect] = []
        self.taken_back = taken_back
        self.chars = self.prose = self.heads = 0

    def text(self, raw: str) -> None:
        _, dropped, _, linked, *_ = self.open[-1]
        if raw and dropped in (False, SOFT):
            plain = html.unescape(raw) if "&" in raw else raw
            self.pieces.append(plain)
            if linked:
                self.in_links += len("".join(plain.split()))

    def end_line(self) -> None:
        if self.pieces:
            line = " ".join("".join(self.pieces).split())
            if line:
                weight = _weight(line, self.in_links)
                self.chars += weight
                if weight >= PROSE_LINE and SENTENCE.search(line):
                    self.prose += weight
                if not self.open[-1][1]:
                    self.lines.append((line, self.in_links, self.open[-1][2], self.open[-1][4]))
        self.pieces, self.in_links = [], 0

    def close(self, at: int) -> None:
        """Take the open elements from a place on off the stack."""
        for name, *_, suspect in self.open[at:]:
            self.opened[name] -= 1
            if suspect is not None:
                self.settle(suspect)
        del self.open[at:]

    def settle(self, number: int) -> None:
        """What a suspect holds, from the counts at its start and now."""
        one = self.suspects[number]
        one.text, one.prose = self.chars - one.text, self.prose - one.prose
        one.heads = self.heads - one.heads

    def blank(self) -> None:
        """Blank lines, with the container in which something was dropped."""
        if not self.lines or self.lines[-1][0] or self.lines[-1][3] != self.open[-1][4]:
            self.lines += [("", 0, 0, self.open[-1][4])] * WINDOW

    def start(self, name: str, rest: str) -> None:
        if name == "br":
            self.text(" ")
        if name not in INLINE:
            self.end_line()
            self._close_paragraph()
        if name in VOID or rest.endswith("/") and name in ("path", "rect", "circle", "use"):
            return
        _, dropped, article, linked, inside, _ = self.open[-1]
        suspect = None
        if dropped in (False, SOFT):
            surely, words = _boilerplate(name, rest, article)
            surely = surely or bool(words) and name in INLINE
            self.heads += not surely and (name == "h1" or not words and name in ("article", "main"))
            if words and not surely:
                suspect = len(self.suspects)
                self.suspects.append(
                    _Suspect(words, bool(article), self.chars, self.prose, self.heads)
                )
            softly = suspect is not None and suspect not in self.taken_back
            if (surely or softly) and name not in INLINE and not dropped:
                self.blank()
            dropped = True if surely else dropped or (SOFT if softly else False)
        if name not in INLINE:
            self.around.append(inside)
            self.names.append(name)
            inside = len(self.around) - 1
            if name in ("html", "body"):
                self.page.add(inside)
            if name in ("article", "main") and not dropped:
                article = article or inside
        self.opened[name] += 1
        self.open.append((name, dropped, article, linked or name == "a", inside, suspect))

    def _close_paragraph(self) -> None:
        """A block ends an open paragraph and the inline elements left open in it."""
        if not self.opened["p"]:
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == "p":
                self.close(at)
                return
            if self.open[at][0] not in INLINE:
                return

    def end(self, name: str) -> None:
        if name not in INLINE:
            self.end_line()
        if not self.opened[name]:
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == name:
                was = self.open[at][1]
                self.close(at)
                if was and not self.open[-1][1]:
                    self.blank()
                return
            if name in INLINE and self.open[at][0] not in INLINE:
                return


def page_lines(page: str, taken_back: frozenset[int] = frozenset()) -> _Page:
    """Lines of a page (text, characters in links, article, container) and its containers.

    ``taken_back`` are the numbers of the subtrees that class words name and that stay nevertheless.
    """
    found, at, n = _Page(taken_back), 0, len(page)
    while at < n:
        match = TAG.search(page, at)
        if match is None:
            found.text(page[at:])
            break
        found.text(page[at : match.start()])
        at = match.end()
        name = (match["name"] or match["name2"] or "").lower()
        if not name:
            continue
        if match["end"] or match["end2"]:
            found.end(name)
        elif name in RAW:
            found.end_line()
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = close.end() if close else n
        else:
            found.start(name, match["rest"] or match["rest2"] or "")
    found.end_line()
    found.close(1)
    return found


def _without_responses(found: _Page) -> None:
    """Drop what follows a heading over comments, as far as the container of the heading goes."""
    lines, at = found.lines, 0
    while at < len(lines):
        text, _, _, inside = lines[at]
        if re.fullmatch(r"h[2-6]", found.names[inside]) and AFTER_TEXT.fullmatch(text):
            home, end = found.around[inside], at + 1
            while end < len(lines) and _within(found, lines[end][3], home):
                end += 1
            lines[at:end] = [("", 0, 0, home)] * WINDOW
            at += WINDOW
        else:
            at += 1


def _runs(weights: np.ndarray) -> list[tuple[int, int]]:
    """Surge and dive points: line ranges over which the window sums are not zero."""
    if not len(weights):
        return []
    total = np.concatenate(([0], np.cumsum(weights)))
    places = np.arange(len(weights))
    sums = total[np.minimum(places + WINDOW, len(weights))] - total[places]
    rising = np.diff(np.concatenate(([0], (sums > 0).astype(int), [0])))
    return list(zip(np.flatnonzero(rising == 1), np.flatnonzero(rising == -1)))


def _weight(text: str, links: int) -> int:
    """Characters outside links; none where links are nearly all of the line."""
    outside = len("".join(text.split())) - links
    return outside if 4 * outside > links else 0


def _beside(found: _Page, inside: int, container: int) -> bool:
    """Whether a line is a block of a container, or lies in a section of it."""
    while inside > container and found.around[inside] != container:
        inside = found.around[inside]
        if found.names[inside] != "section":
            return inside == container
    return inside >= container


def _within(found: _Page, inside: int, container: int) -> bool:
    while inside > container:  # a container is numbered after those around it
        inside = found.around[inside]
    return inside == container


def _joined(found: _Page) -> list[tuple[str, int, int, int]]:
    """Lines without the blank ones that have the same container on both sides."""
    lines, out = found.lines, []
    at = 0
    while at < len(lines):
        end = at
        while end < len(lines) and not lines[end][0]:
            end += 1
        if end > at:
            beside = [lines[k][3] for k in (at - 1, end) if 0 <= k < len(lines)]
            spot = min(line[3] for line in lines[at:end])
            apart = not all(_beside(found, x, spot) for x in beside)
            if apart:
                out += [("", 0, 0, spot)] * WINDOW
        else:
            out.append(lines[at])
        at = max(end, at + 1)
    return out


def _apart(lines: list[tuple[str, int, int, int]]) -> list[tuple[str, int, int, int]]:
    """Lines with blank ones wherever an article begins or ends."""
    out = []
    for k, line in enumerate(lines):
        if k and line[2] != lines[k - 1][2]:
            out += [("", 0, 0, 0)] * WINDOW
        out.append(line)
    return out


def _without_link_lists(lines: list[tuple[str, int, int, int]]) -> list[str]:
    """Texts of lines, less those in windows of links alone."""
    weights = np.array([_weight(t, n) for t, n, *_ in lines])
    if not (weights > 0).any():
        return []
    bare = np.diff(np.concatenate(([0], (weights == 0).astype(int), [0])))
    for a, b in zip(np.flatnonzero(bare == 1), np.flatnonzero(bare == -1)):
        if b - a >= WINDOW:
            lines[a:b] = [("", 0, 0, 0)] * (b - a)
    return [t for t, *_ in lines if t]


def main_text(page: str | None) -> str:
    """Text of the article, one block per line; empty for NULL or where there is no text."""
    if not page:
        return ""
    found = page_lines(page)
    back = {k for k, one in enumerate(found.suspects) if one.taken_back(found.chars, found.heads)}
    if back:
        found = page_lines(page, frozenset(back))
    text = _text_of(found)
    if not text and found.chars:
        # Class words leave nothing: they do not count here.
        found = page_lines(page, frozenset(range(len(found.suspects))))
        text = _text_of(found)
    if not text:
        # Nothing but links: those of the article, or else of the page.
        lines = [line for line in found.lines if line[2]] or found.lines
        text = "\n".join(line[0] for line in lines if line[0])
    return text


def _text_of(found: _Page) -> str:
    _without_responses(found)
    lines = _apart(_joined(found))
    weights = np.array([_weight(t, n) for t, n, *_ in lines], dtype=np.int64)
    articles = np.array([article for _, _, article, _ in lines], dtype=np.int64)
    largest = np.bincount(articles, weights)[1:].max(initial=0)
    outside = np.where(articles == 0, weights, 0)
    if largest and largest >= max((outside[a:b].sum() for a, b in _runs(outside)), default=0):
        return "\n".join(_without_link_lists([line for line in lines if line[2]]))

    runs = []
    for a, b in _runs(weights):
        heavy = a + np.flatnonzero(weights[a:b])
        # Lines of links beside text in one container belong to it.
        first, last = heavy[0], heavy[-1]
        spot = {k: found.around[lines[k][3]] for k in (first, last)}
        a, b = first, last + 1
        while a and lines[a - 1][0] and first - a < WINDOW and (
            found.around[lines[a - 1][3]] == spot[first] not in found.page
        ):
            a -= 1
        while b < len(lines) and lines[b][0] and b - last <= WINDOW and not weights[b] and (
            found.around[lines[b][3]] == spot[last] not in found.page
        ):
            b += 1
        runs.append((a if first - a < WINDOW else first, b if b - last <= WINDOW else last + 1))
    sizes = [weights[a:b].sum() for a, b in runs]
    homes, kept = set(), []
    for (a, b), size in zip(runs, sizes):
        if long := size >= SHORT * max(sizes):
            top = a + int(weights[a:b].argmax())
            homes.add((found.around[lines[top][3]], lines[top][2]))
        kept.append(long)
    homes = {(home, article) for home, article in homes if home not in found.page}
    for k, (a, b) in enumerate(runs):
        kept[k] = kept[k] or any(
            lines[i][2] == article and _within(found, lines[i][3], home)
            for home, article in homes for i in range(a, b) if lines[i][0]
        )
    texts = []
    for (a, b), keep in zip(runs, kept):
        heavy = a + np.flatnonzero(weights[a:b])
        for i in range(a, b) if keep else ():
            # Within a run, links between blocks of text stay if they are blocks of the same element.
            at = int(np.searchsorted(heavy, i))
            near = {found.around[lines[k][3]] for k in heavy[max(0, at - 1) : at + 1]}
            if lines[i][0] and (weights[i] or found.around[lines[i][3]] in near):
                texts.append(lines[i][0])
    return "\n".join(texts)


def extract(html_page: Column) -> Column:
    """The main text of a page."""

    @F.pandas_udf("string")
    def texts(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in pages], dtype=object)

    return texts(html_page.cast("string"))


def extract_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points).

    A NULL or empty page, and one without text, gives an empty text. Pages cut off in the middle of
    a tag lose that tag; elements that are never closed end with their parent. Repeated rows give
    repeated rows; other columns are not looked at. Nothing is shuffled.
    """
    found = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
        extract(F.col(html_col)).alias("text"),
    )
    return found.select("*", F.length("text").cast("long").alias("n_chars"))
