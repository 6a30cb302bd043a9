"""Main text of a page by line-block distribution.

Markup is stripped to lines: one per block of the page, an inline tag leaves no trace and a line
break is white space. What the standard's elements, roles or styles say is never article text (scripts, menus,
forms, hidden parts, ...) has no lines. A line's mass is its text outside links; a paragraph that reads as prose
counts whole, and inside a marked article every line counts whole and ARTICLE times.

The distribution is the mass in a sliding window of lines: text surges where it rises from zero and dives where it
falls back to zero. Text between a surge and its dive is kept if its densest window comes near that of the page's
densest. Empty lines part the text at the edge of a marked article and around removed elements, unless these stand
between blocks of one parent or inside the article.

A class or id that names boilerplate, or a heading over reader comments, takes the mass from the lines of its element;
not if the densest window there is BELIEF times that of all else on the page. Names decide by their head word:
``related-links`` marks, ``related-work`` does not. A heading of comments directly in the body marks nothing.

A null or empty page, or one without such text, gives empty text. A repeated row gets its own
result; an empty table gives an empty one. Nothing is cut off: very long pages are read whole.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from forecourt.llm.common import only, slices

WINDOW = 3
#: A stretch is kept if its densest window has at least this share of the mass of the page's densest one.
SHARE = 0.25
#: Mass of a marked article's lines against that of others.
ARTICLE = 4
#: Names of elements are not believed if the text in them is so many times as dense as the rest.
BELIEF = 8
#: A linked paragraph of that many characters, or with a sentence's end, is prose and no menu entry.
LONG_LINK = 40

# Elements of the HTML standard, by what they mean here.
_RAW = "script|style|noscript|template|svg|math|iframe|object|textarea|title|select|canvas|audio|video"
# Raw elements that may close themselves; the others of HTML are open whatever their tag says.
_EMPTY = "svg|math|object|canvas|audio|video"
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
_NEVER = frozenset("nav footer aside form head menu dialog button label fieldset datalist".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog toolbar".split())
# Words of class and id names that mark what is no article text.
_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar topbar masthead header "
    "footer copyright legal sidebar aside related recommended widget widgets teaser "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "login search share sharing social comment comments reply replies respond disqus discussion".split()
)
# Words that say which part of the named thing an element is.
_PARTS = frozenset(
    "slot box container wrapper wrap holder section area block list item items bar unit panel region zone inner outer "
    "content body row col column left right top bottom main site page form button buttons icon icons image img title "
    "label text meta author date link links post posts article articles story stories news reading entry".split()
)
_STORY = frozenset(("post", "article", "entry", "story"))
_ABOUT = frozenset(("has", "with", "without", "no", "show", "hide"))
_FRAME = frozenset(("html", "body", "main"))
_ARTICLE = frozenset(("article", "main"))
_HEADINGS = frozenset(("h1", "h2"))  # what follows one belongs to it
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote".split())
_SENTENCE_ENDS = tuple(".!?\u2026:;\"\u201d")
_TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote ul ol dl li dt dd figcaption address".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<empty>{_EMPTY})(?:/|\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?<=[\s\"']/))>"
    rf"|<(?P<raw>{_RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"(?:^|\s)(class|id|role|style|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_COMMENTS = re.compile(
    r"(?:\d+ )?(?:reader |user )?(?:comments?|replies|responses|kommentare?|commentaires?|comentarios?)(?: ?\(\d+\))? ?:?"
    r"|leave a (?:comment|reply)",
    re.I,
)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _marks(name: str, in_article: bool) -> bool:
    """Whether a class or id names boilerplate by its head word; not if it says what the element has or lacks."""
    words = [word.lower() for word in _WORD.findall(name)]
    if not words or words[0] in _ABOUT:
        return False
    head = next((word for word in reversed(words) if word not in _PARTS), "")
    if head == "header" and (in_article or words[0] in _STORY):
        return False
    return head in _WORDS


def _evidence(tag: str, attributes: str, in_article: bool) -> int:
    """What an element's tag and attributes say: never article text (2), named as boilerplate (1), nothing (0)."""
    if tag in _NEVER or (tag == "header" and not in_article):
        return 2
    if not attributes or tag in _FRAME:
        return 0
    named = 0
    for name, *values in _NAMES.findall(attributes):
        value, name = "".join(values), name.lower()
        if name in ("class", "id"):
            named |= any(_marks(one, in_article) for one in value.split())
        elif name == "role":
            if value.lower() in _ROLES:
                return 2
        elif name == "style":
            if _HIDDEN.search(value):
                return 2
        elif name == "hidden" or value.lower() == "true":
            return 2
    return int(named)


class _Lines:
    """Lines of one page, filled token by token.

    ``ignored`` holds the places in the page of names that are not believed; without it, all are ignored.
    ``named`` has the lines from and to which each name holds, by its place.
    """

    def __init__(self, ignored: frozenset[int] | None) -> None:
        self._ignored = ignored
        self.named: dict[int, list[int]] = {}
        self._naming: dict[int, list[int]] = {}  # by depth of open elements, the places of names that end there
        self.texts: list[str] = []
        self.unread = 0  # characters of skipped elements
        self.masses: list[int] = []
        self._parts: list[str] = []
        self._linked = 0
        self._open: list[tuple[str, bool]] = []  # element, whether it is boilerplate
        self._blocks: list[str] = []  # the open elements that are blocks
        self._articles = self._skipped = self._links = 0
        # The last line's block and depth, and the depth of the innermost open block around it.
        self._last, self._depth, self._common = "", 0, 0
        # Whether boilerplate, or the edge of a marked article, came after the last line.
        self._removed = self._crossed = False

    def add(self, text: str) -> None:
        if self._skipped:
            self.unread += len(text)
            return
        self._parts.append(text)
        if self._links:
            self._linked += len(text.strip())

    def end_line(self, edge: bool = False) -> None:
        """Close the line being filled; ``edge`` says that a marked article begins or ends after it."""
        text = " ".join(html.unescape("".join(self._parts)).split()) if self._parts else ""
        if text:
            cut = self._removed and not self._articles and not self._one_parent()
            if cut or (self._crossed and self._last not in _HEADINGS):
                self._silence()
            self._removed = self._crossed = False
            self._last, self._depth = self._blocks[-1] if self._blocks else "", len(self._blocks)
            self._common = self._depth
            self.texts.append(text)
            if self._articles:
                mass = ARTICLE * len(text)
            elif self._last in _PROSE and (len(text) >= LONG_LINK or text.endswith(_SENTENCE_ENDS)):
                mass = len(text)
            else:
                mass = max(0, len(text) - self._linked)
            self.masses.append(mass)
        self._crossed |= edge
        self._parts, self._linked = [], 0

    def _silence(self) -> None:
        for _ in range(WINDOW):
            self.texts.append("")
            self.masses.append(0)

    def _one_parent(self) -> bool:
        """Whether the line being filled and the last one are blocks of one parent.

        The parent is the innermost block around both. Its own text and its paragraphs belong to it, and
        then the other line may lie deeper in it; at the top of the page both have to be of that kind.
        """
        ends = [(self._last, self._depth - self._common)]
        ends.append((self._blocks[-1] if self._blocks else "", len(self._blocks) - self._common))
        near = [below == 0 or (below == 1 and tag in _TEXT_BLOCKS) for tag, below in ends]
        if not self._common or self._blocks[self._common - 1] in ("html", "body"):
            return all(near)
        return any(near) or all(below == 1 for _, below in ends)

    def _pop(self) -> None:
        for place in self._naming.pop(len(self._open), ()):
            self.named[place].append(len(self.texts))
        tag, boilerplate = self._open.pop()
        if tag not in _INLINE:
            self._blocks.pop()
            self._common = min(self._common, len(self._blocks))
        self._skipped -= boilerplate
        self._links -= tag == "a"
        if not boilerplate:
            self._articles -= tag in _ARTICLE

    def _believes(self, place: int) -> bool:
        return self._ignored is not None and place not in self._ignored

    def _name(self, place: int) -> None:
        """A name holds from here to the end of the innermost open element."""
        self.named[place] = [len(self.texts)]
        self._naming.setdefault(len(self._open), []).append(place)

    def start(self, tag: str, attributes: str, place: int) -> None:
        if tag == "br":
            self.add(" ")
            return
        block = tag not in _INLINE
        if block:
            if tag in _ARTICLE and self._skipped:
                # A menu that was never closed cannot hold the article.
                self.end_line(edge=True)
                while self._skipped:
                    self._pop()
            elif self._open and self._closes_paragraph(tag):
                self._pop_to(("p",))
        if tag in _VOID:
            if block:
                self.end_line()
            return
        evidence = _evidence(tag, attributes, self._articles > 0)
        boilerplate = evidence == 2 or (evidence == 1 and self._believes(place))
        if block or evidence:
            self.end_line(edge=tag in _ARTICLE)
        self._removed |= boilerplate
        self._open.append((tag, boilerplate))
        if evidence == 1 and not self._skipped:
            self._name(place)
        if block:
            self._blocks.append(tag)
        self._skipped += boilerplate
        self._links += tag == "a"
        if not boilerplate:
            self._articles += tag in _ARTICLE

    def _closes_paragraph(self, tag: str) -> bool:
        """Whether a paragraph is open that this block ends."""
        for open_tag, _ in reversed(self._open):
            if open_tag == "p":
                return True
            if open_tag not in _INLINE:
                return False
        return False

    def _pop_to(self, tags: tuple[str, ...]) -> None:
        while self._open:
            tag = self._open[-1][0]
            self._pop()
            if tag in tags:
                return

    def _comments_follow(self, place: int) -> None:
        """Reader comments, if the last line is a heading that says so, reach to the end of what is around it."""
        if not self._open or self._open[-1][0] in ("html", "body") or not _COMMENTS.fullmatch(self.texts[-1]):
            return
        self._name(place)
        if self._believes(place):
            self.texts.pop()
            self.masses.pop()
            self.named[place][0] -= 1
            tag, boilerplate = self._open[-1]
            if not boilerplate:
                self._open[-1] = (tag, True)
                self._skipped += 1
                self._articles -= tag in _ARTICLE
            self._removed = True

    def end(self, tag: str, place: int) -> None:
        if tag in _VOID:
            return
        at = next((i for i in range(len(self._open) - 1, -1, -1) if self._open[i][0] == tag), None)
        if at is None:
            if tag not in _INLINE:
                self.end_line()
            return
        if tag in _INLINE and any(open_tag not in _INLINE for open_tag, _ in self._open[at + 1 :]):
            return  # an inline tag does not end the blocks opened inside it
        leaves = any(t in _ARTICLE for t, _ in self._open[at:])
        if tag not in _INLINE or any(b for _, b in self._open[at:]):
            self.end_line(edge=leaves)
        heading = tag in _PROSE and tag[0] == "h" and not self._skipped and self.texts and self._last == tag
        while len(self._open) > at:
            self._pop()
        if heading:
            self._comments_follow(place)

    def finish(self) -> None:
        self.end_line()
        while self._open:
            self._pop()


def lines_of(page: str, ignored: frozenset[int] | None = frozenset()) -> _Lines:
    """The page's lines; names of boilerplate at the places in ``ignored``, or all for None, are not believed."""
    lines, at = _Lines(ignored), 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            lines.add(page[at : token.start()])
        at = token.end()
        tag = token["tag"]
        if tag is None:
            if token["raw"] or token["empty"]:
                lines.add(" ")
        elif token["close"]:
            lines.end(tag.lower(), token.start())
        else:
            lines.start(tag.lower(), token["attributes"], token.start())
    lines.add(page[at:])
    lines.finish()
    return lines


def window_sums(masses: list[int]) -> np.ndarray:
    """The distribution: mass of the lines from i to i + WINDOW, for i from 1 - WINDOW to the last line."""
    return np.convolve(np.asarray(masses, np.int64), np.ones(WINDOW, np.int64)) if masses else np.zeros(0, np.int64)


def stretches(masses: list[int]) -> list[tuple[int, int, int]]:
    """(surge, dive, mass) of every run of windows with mass, without empty lines at its ends; dive is exclusive."""
    loud = np.concatenate(([False], window_sums(masses) > 0, [False]))
    rises, falls = np.flatnonzero(~loud[:-1] & loud[1:]), np.flatnonzero(loud[:-1] & ~loud[1:])
    with_mass = np.flatnonzero(masses)
    found = []
    for rise, fall in zip(rises, falls):
        # Windows rise to fall - 1 cover the lines from rise + 1 - WINDOW to fall - 1.
        first, last = np.searchsorted(with_mass, (rise + 1 - WINDOW, fall))
        start, end = int(with_mass[first]), int(with_mass[last - 1]) + 1
        found.append((start, end, sum(masses[start:end])))
    return found


def densest(masses: list[int]) -> int:
    """The largest mass of a window of lines."""
    return int(window_sums(masses).max(initial=0))


class _Densest:
    """The largest mass of a window inside any range of lines, by maxima over ranges of powers of two."""

    def __init__(self, masses: list[int]) -> None:
        self._before = np.concatenate(([0], np.cumsum(np.asarray(masses, np.int64))))
        self._levels = [self._before[WINDOW:] - self._before[:-WINDOW]] if len(masses) >= WINDOW else []
        width = 1
        while self._levels and len(self._levels[-1]) > width:
            self._levels.append(np.maximum(self._levels[-1][:-width], self._levels[-1][width:]))
            width *= 2

    def within(self, start: int, end: int) -> int:
        if end - start <= WINDOW:
            return int(self._before[end] - self._before[start])
        n = end - start - WINDOW + 1
        level = n.bit_length() - 1
        found = self._levels[level]
        return int(max(found[start], found[start + n - (1 << level)]))


def _not_believed(page: str, lines: _Lines) -> frozenset[int]:
    """Places of names whose elements hold far denser text than what is left without all named ones."""
    rest = max(1, densest(lines.masses))
    if ARTICLE * lines.unread < BELIEF * rest:
        return frozenset()  # all skipped text in one window would not do
    every = lines_of(page, None)
    inside = _Densest(every.masses)
    return frozenset(place for place, (start, end) in every.named.items() if inside.within(start, end) >= BELIEF * rest)


def main_text(page: str | None) -> str:
    """The article of a page: its kept blocks, joined by one space."""
    lines = lines_of(page or "")
    if lines.named:
        ignored = _not_believed(page, lines)
        lines = lines_of(page, ignored) if ignored else lines
    found = stretches(lines.masses)
    inside, enough = _Densest(lines.masses), SHARE * densest(lines.masses)
    kept = [(start, end) for start, end, _ in found if inside.within(start, end) >= enough]
    return " ".join(text for start, end in kept for text in lines.texts[start:end] if text)


_TEXT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [main_text(page) for page in batch.column("html").to_pylist()]
        lengths = pa.array(list(map(len, texts)), pa.int64())
        columns = [batch.column("page_id").cast(pa.int64()), batch.column("url").cast(pa.string()), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays([*columns, lengths], schema=_TEXT)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) per row of ``pages`` (page_id, url, html)."""
    return only(pages, "page_id", "url", "html").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
