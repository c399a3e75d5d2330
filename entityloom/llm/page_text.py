"""Main text of web pages by differencing pages whose addresses are nearest.

**Lines.** A page becomes a sequence of lines: the text of its blocks in page
order, character references decoded, white space turned into single blanks.
Scripts, styles and other elements that show no text have no lines. Each line
carries what the markup says of it: it stands in an element that frames pages
(``FRAME``: menus, forms, footers, adverts ...), in an element for content
(``CONTENT``: ``article``, ``main`` ...), or neither (``PLAIN``).

**Pairs.** Pages are numbered in the order of host and URL path. The neighbours
on both sides, ``NEAR`` each, are looked at from the longest common beginning of
the path on; the first of the same host that has lines and is no copy of the page is its
partner. The lines of both are aligned by a longest common subsequence, and the
shared lines go. Only hashes of lines are moved for that.

**What the markup decides.** Framing text that differs from page to page (an
advert, a menu of recent titles) is not shared, and two articles may quote the
same paragraph. So lines of framing elements always go; on pages with a content
element all lines outside go too, and of the lines inside only shared ones that
are links from end to end. Differencing alone decides about pages that mark no
content.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entityloom.llm.common import map_slices, stored, text_or_empty
from entityloom.operators.ordering import number_rows

PLAIN, CONTENT, FRAME, LINK = 0, 1, 2, 4
# Neighbours by address on each side among which a page's partner is chosen.
NEAR = 3
# Share of a page's text in common lines from which two pages are copies, which tell nothing about a frame.
COPY_SHARE = 0.8
# Pages of a window of neighbours; each window also holds its neighbours' edges.
_WINDOW = 512
# Bits of an alignment's table held at once; larger ones are split in halves.
_TABLE_BITS = 1 << 28

# Elements of the HTML standard by what they do.
_SILENT = frozenset("head script style noscript template iframe object svg math canvas audio video map select datalist textarea".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead "
    "title tr ul".split()
)
_FRAMING = frozenset("nav header footer aside form dialog menu button fieldset search".split())
_CONTENT = frozenset("article main".split())
_FRAMING_ROLES = frozenset("navigation banner contentinfo complementary dialog alertdialog alert search menu menubar toolbar form".split())
_CONTENT_ROLES = frozenset("main article".split())
# an open p ends where one of these begins
_ENDS_P = _BLOCKS - frozenset("body html br button caption dd dt legend li option summary tbody td tfoot th thead title tr".split())
_SAME_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_LISTS = frozenset("ul ol dl menu table div section article main nav aside header footer body".split())
# words of class and id names that mark a frame, and those that mark content
_FRAME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "disqus footer gdpr header login menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promotion "
    "recommended related replies respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar "
    "widget widgets".split()
)
_CONTENT_WORDS = frozenset("article articlebody entry post story content maincontent".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_WORD = re.compile(r"[a-z]+", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _mark(name: str, attributes: str) -> int:
    """What an element says of its text."""
    mark = FRAME if name in _FRAMING else CONTENT if name in _CONTENT else PLAIN
    if not attributes.strip():
        return mark
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), next((v for v in values if v), "")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return FRAME
        if key == "style" and "display:none" in value.replace(" ", "").lower():
            return FRAME
        if key == "role":
            role = value.lower()
            mark = FRAME if role in _FRAMING_ROLES else CONTENT if role in _CONTENT_ROLES else mark
        elif key == "itemprop" and value.lower() == "articlebody":
            mark = CONTENT if mark == PLAIN else mark
        elif key in ("class", "id") and name not in ("html", "body"):
            words = {w.lower() for w in _NAME_WORD.findall(_CAMEL.sub(" ", value))}
            if words & _FRAME_WORDS and name not in ("main", "h1"):
                return FRAME
            if mark == PLAIN and words & _CONTENT_WORDS and name in ("div", "section", "td"):
                mark = CONTENT
    return mark


class _Page:
    """Reads one page; elements are closed as far as the standard's rules for missing end tags matter here."""

    def __init__(self) -> None:
        self.lines: list[tuple[str, int]] = []
        self._text: list[str] = []
        self._linked = self._unlinked = False
        self._open: list[tuple[str, int]] = []
        self._count: Counter = Counter()
        self._marks = {PLAIN: 0, CONTENT: 0, FRAME: 0}
        self._links = 0

    def _line(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                mark = FRAME if self._marks[FRAME] else CONTENT if self._marks[CONTENT] else PLAIN
                self.lines.append((text, mark | (LINK if self._linked and not self._unlinked else 0)))
            self._text = []
        self._linked = self._unlinked = False

    def _push(self, name: str, mark: int) -> None:
        self._open.append((name, mark))
        self._count[name] += 1
        self._marks[mark] += 1
        self._links += name == "a"

    def _pop(self) -> str:
        name, mark = self._open.pop()
        self._count[name] -= 1
        self._marks[mark] -= 1
        self._links -= name == "a"
        return name

    def _close(self, names: Sequence[str], within: frozenset = frozenset()) -> None:
        """Close the innermost of the elements, if it is open inside the nearest of ``within``."""
        if not any(self._count[n] for n in names):
            return
        for place in range(len(self._open) - 1, -1, -1):
            name = self._open[place][0]
            if name in names:
                while len(self._open) > place:
                    self._pop()
                return
            if name in within:
                return

    def start(self, name: str, attributes: str) -> None:
        if name in _BLOCKS:
            self._line()
        if name in _ENDS_P and self._count["p"]:
            self._close(("p",), frozenset(("button", "td", "th", "caption", "article", "main", "section", "div", "aside", "nav", "footer", "header", "li", "blockquote")))
        if name in _SAME_ENDS:
            self._close(_SAME_ENDS[name], _LISTS)
        if name not in _VOID and not attributes.rstrip().endswith("/"):
            self._push(name, _mark(name, attributes))

    def end(self, name: str) -> None:
        if name in _BLOCKS:
            self._line()
        if name in ("body", "html"):
            return
        # an end tag of inline text does not close a block
        self._close((name,), frozenset() if name in _BLOCKS else _BLOCKS)

    def text(self, text: str) -> None:
        self._text.append(text)
        if not text.isspace():
            if self._links:
                self._linked = True
            else:
                self._unlinked = True


def page_lines(source: str) -> list[tuple[str, int]]:
    """The lines of a page with their marks; ``LINK`` is added to lines that are links from end to end."""
    page, place, size = _Page(), 0, len(source)
    while place < size:
        token = _TOKEN.match(source, place)
        if token is None:  # a tag without end
            page.text("<")
            place += 1
            continue
        place = token.end()
        closing, name, attributes, text = token.groups()
        if text is not None:
            page.text(html.unescape(text) if "&" in text else text)
        elif name:
            name = name.lower()
            if closing:
                page.end(name)
            elif name in _SILENT and not attributes.rstrip().endswith("/"):
                if name == "head":
                    # as browsers do, also where its end tag is missing
                    over = re.compile(r"</head\s*>|(?=<body[\s>])", re.I).search(source, place)
                else:
                    over = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, place)
                if name == "head" and over is None:
                    continue
                place = over.end() if over else size
            else:
                page.start(name, attributes)
    page._line()
    return page.lines


def _line_hash(line: str) -> int:
    return int.from_bytes(blake2b(line.encode(), digest_size=8).digest(), "little", signed=True)


def _lcs_rows(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """Bit rows of the alignment's table, one for each line of ``a``: a 0 bit tells that the length grows there."""
    at: dict[int, int] = {}
    for j, x in enumerate(b):
        at[x] = at.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for x in a:
        met = row & at.get(x, 0)
        row = (row + met | row - met) & full
        rows.append(row)
    return rows


def common_lines(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """The places in ``a`` of a longest common subsequence of both."""
    in_b, in_a = set(b), set(a)
    # lines that the other page lacks cannot be aligned
    of_a = [i for i, x in enumerate(a) if x in in_b]
    xs, ys = [a[i] for i in of_a], [x for x in b if x in in_a]
    return [of_a[i] for i in _aligned(xs, ys, 0)]


def _aligned(a: Sequence[int], b: Sequence[int], offset: int) -> list[int]:
    if not a or not b:
        return []
    if len(a) == 1:
        return [offset] if a[0] in b else []
    if len(a) * len(b) > _TABLE_BITS:
        # split where both halves together are longest
        half = len(a) // 2
        grows = lambda rows, n: [0, *np.cumsum([1 - (rows[-1] >> j & 1) for j in range(n)]).tolist()]
        before = grows(_last_row(a[:half], b), len(b))
        after = grows(_last_row(a[half:][::-1], b[::-1]), len(b))[::-1]
        cut = max(range(len(b) + 1), key=lambda j: before[j] + after[j])
        return _aligned(a[:half], b[:cut], offset) + _aligned(a[half:], b[cut:], offset + half)
    rows, found = _lcs_rows(a, b), []
    i, j = len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        if rows[i] >> j & 1:
            j -= 1
        elif i and not rows[i - 1] >> j & 1:
            i -= 1
        else:
            found.append(offset + i)
            i, j = i - 1, j - 1
    return found[::-1]


def _last_row(a: Sequence[int], b: Sequence[int]) -> list[int]:
    at: dict[int, int] = {}
    for j, x in enumerate(b):
        at[x] = at.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        met = row & at.get(x, 0)
        row = (row + met | row - met) & full
    return [row]


def main_lines(lines: Sequence[tuple[str, int]], shared: Sequence[int] = ()) -> list[str]:
    """The lines of the main text, when those at the places ``shared`` stand on the partner page, too."""
    marked = any(mark & 3 == CONTENT for _, mark in lines)
    gone = set(shared)
    out = []
    for place, (text, mark) in enumerate(lines):
        kind = mark & 3
        if kind == FRAME or marked and kind == PLAIN:
            continue
        if place in gone and (kind == PLAIN or mark & LINK):
            continue
        out.append(text)
    return out


def _undecided(lines: Sequence[tuple[str, int]]) -> bool:
    """Whether shared lines could change the text: without a content element, or with links inside it."""
    marked = any(mark & 3 == CONTENT for _, mark in lines)
    return any(mark & 3 == PLAIN and not marked or mark & 3 == CONTENT and mark & LINK for _, mark in lines)


def _shared_with_partner(mine: tuple, others: list[tuple]) -> list[int]:
    """The places of the lines shared with the partner; ``others`` come from the nearest on."""
    host, path, lines, sizes = mine
    total = sum(sizes)
    ranked = sorted((o for o in others if o[0] == host), key=lambda o: -_common_beginning(path, o[1]))
    for _, _, theirs, _ in ranked:
        if not theirs:
            continue
        found = common_lines(lines, theirs)
        if sum(sizes[i] for i in found) < COPY_SHARE * total:
            return found
    return []


def _common_beginning(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def shared_lines(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``h1, h2, gone``: for distinct pages whose text depends on it, the places of the lines shared with the partner.

    ``h1`` and ``h2`` are hashes of address and source.
    """
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    bare = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    rows = pages.select(
        *page_key(url_col, html_col),
        F.lower(F.regexp_extract(bare, r"^[^/?#]*", 0)).alias("host"),
        # numbers in their order, not by their first digit; the rest of the address decides among equal paths
        F.regexp_extract(bare, r"^[^/?#]*([^?#]*)", 1).alias("path"),
        F.regexp_extract(bare, r"[?#].*$", 0).alias("rest"),
        text_or_empty(html_col).alias("html"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, sizes, undecided = [], [], []
            for source in batch.column("html").to_pylist():
                lines = page_lines(source)
                # framing lines go in any case, so they need no partner; the places count all lines
                hashes.append([_line_hash(text) for text, _ in lines])
                sizes.append([0 if mark & 3 == FRAME else len(text) for text, mark in lines])
                undecided.append(_undecided(lines))
            kept = [batch.column(c) for c in ("h1", "h2", "host", "path", "rest")]
            columns = [*kept, pa.array(hashes, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32())), pa.array(undecided, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "host", "path", "rest", "lines", "sizes", "undecided"])

    schema = "h1 bigint, h2 bigint, host string, path string, rest string, lines array<bigint>, sizes array<int>, undecided boolean"
    parsed = stored(map_slices(rows, run, schema)).dropDuplicates(["h1", "h2"])
    numbers = number_rows(parsed, [F.col("host"), F.col("path"), F.col("rest"), "h1", "h2"], "place")
    # every window of neighbouring pages also gets the edges of the windows beside it
    window = F.expr(f"place div {_WINDOW}")
    edges = F.array_distinct(F.array(window, F.expr(f"greatest(0, place - {NEAR}) div {_WINDOW}"), F.expr(f"(place + {NEAR}) div {_WINDOW}")))
    dealt = numbers.select("*", window.alias("own"), F.explode(edges).alias("window"))
    along = Window.partitionBy("window").orderBy("place")
    page = F.struct("host", "path", "lines", "sizes")
    steps = [s for n in range(1, NEAR + 1) for s in (-n, n)]  # the nearest first
    near = dealt.select("h1", "h2", "own", "window", "undecided", page.alias("page"), *[F.lag(page, -s).over(along).alias(f"near{i}") for i, s in enumerate(steps)])
    asked = near.filter("own = window AND undecided").drop("own", "window", "undecided")

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = []
            for row in batch.select(["page", *[f"near{i}" for i in range(len(steps))]]).to_pylist():
                pages_ = [(p["host"], p["path"], p["lines"], p["sizes"]) for p in row.values() if p is not None]
                gone.append(_shared_with_partner(pages_[0], pages_[1:]))
            yield pa.RecordBatch.from_arrays([batch.column("h1"), batch.column("h2"), pa.array(gone, pa.list_(pa.int32()))], ["h1", "h2", "gone"])

    return stored(map_slices(asked, pair, "h1 bigint, h2 bigint, gone array<int>").filter(F.size("gone") > 0))


def page_key(url_col: str, html_col: str) -> list:
    """Two hashes that name a page by its address and source."""
    return [F.xxhash64(F.col(url_col), F.col(html_col)).alias("h1"), F.xxhash64(F.lit(3041), F.col(html_col), F.col(url_col)).alias("h2")]


def main_text(
    pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), url_col: str = "url", html_col: str = "html", out: str = "text"
) -> DataFrame:
    """The ``keep`` columns and the main text of every page, blocks joined by a blank.

    Missing and empty sources have an empty text. Pages alike in address and
    source are one page with one text, and every row is returned; other copies
    on the same host are never each other's partner. A page whose host has no
    other page, or only copies of it, has no partner, and nothing is taken from
    it but frames; a missing address is a host of its own. A kept column named
    like ``out`` is an error. An empty table gives an empty result.
    """
    if out in keep:
        raise ValueError(f"{out} is a kept column")
    found = shared_lines(pages, url_col, html_col)
    names = [f"__keep{i}" for i in range(len(keep))]
    rows = pages.select(
        F.struct(*[F.col(c).alias(n) for c, n in zip(keep, names)]).alias("kept"), *page_key(url_col, html_col), text_or_empty(html_col).alias("html")
    )
    rows = rows.join(found, ["h1", "h2"], "left").select("kept", "html", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                " ".join(main_lines(page_lines(source), gone or ()))
                for source, gone in zip(batch.column("html").to_pylist(), batch.column("gone").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(texts, pa.string())], ["kept", "text"])

    kept = rows.schema["kept"].dataType.simpleString()
    return map_slices(rows, run, f"kept {kept}, text string").select(
        *[F.col("kept")[n].alias(c) for c, n in zip(keep, names)], F.col("text").alias(out)
    )
