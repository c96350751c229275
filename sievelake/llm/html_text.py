"""Main text of pages by nearest-URL page differencing.

Pages of a host are put in the order of their URL paths. The text lines of each page are
aligned with those of its neighbours by longest common subsequence; lines that both have
belong to the template. What the markup itself names (navigation, footers, adverts) is
deleted in any case, and an article is never cut by the comparison, since copies of an
article share their lines, too.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievelake.llm.common import on_workers, stored
from sievelake.llm.url_filter import host, path

PAGES_PER_BLOCK = 256
# Lines compared by a table have so many pairs at most; places of a line that occurs so
# often are kept as bits.
TABLE_CELLS, KEPT_PLACES = 1 << 14, 16

# Elements whose text is never main text.
DROPPED = frozenset(
    "aside button dialog fieldset footer form header iframe input label menu nav noscript object option "
    "script select style svg template textarea title head".split()
)
# Elements whose content is not markup.
RAW = frozenset("script style textarea title iframe noscript".split())
# Elements that break a line of text.
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
# Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words of class, id or role that mark what is not main text, where they are
# the head word of a name.
MARKS = frozenset(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice pagination popup "
    "promo promotion related replies reply respond share sharing sidebar signup social sponsor sponsored "
    "subscribe toolbar widget complementary contentinfo search alert".split()
)
# Words behind the head word that only say what it is made of, and words that
# make a name tell of a property.
CONTAINERS = frozenset(
    "area bar block body bottom box button buttons column columns container content form group holder icon icons "
    "inner item items left link links list outer panel placeholder region right row section slot strip title top "
    "unit widget wrap wrapper zone".split()
)
PROPERTIES = frozenset("after before has hide is js no not show under with without".split())
ROLES_KEPT = frozenset({"main", "article"})
# Marks that inside an article name its own heading, and marks of what holds
# articles of others.
HEADINGS = frozenset({"header", "masthead"})
OF_OTHERS = frozenset(
    "ad ads adv advert advertisement advertising comment comments disqus promo promotion related replies reply "
    "respond sponsor sponsored".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # A quote opens a value only right after the equals sign.
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# One pass per kind of raw element: from its start tag to its end tag.
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in RAW}

# MARKED is dropped for its names only, so that the page's main text may stand below it.
KEEP, OPEN, DROP, MARKED = "keep", "open", "drop", "marked"


def head_word(name: str) -> str:
    """What a name of several words names: ``footer`` for site-footer, ``ad`` for adBox.

    The last word does, but for containers: cookie-bar, menu-item and comments-list are
    named by the word before. A name such as with-sidebar tells of a property and names nothing.
    """
    words = [w.lower() for w in WORDS.findall(name)]
    if not words or (words[0] in PROPERTIES and len(words) > 1):
        return ""
    while len(words) > 1 and words[-1] in CONTAINERS:
        words.pop()
    return words[-1]


def _kind(tag: str, attrs: str, above: str) -> str | None:
    if tag in DROPPED:
        # A heading inside an article may stand in a <header>; the article's own is kept.
        return DROP
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attrs)} if "=" in attrs or "hidden" in attrs else {}
    if "hidden" in found or found.get("aria-hidden") == "true":
        return DROP
    names = " ".join(found.get(k, "") for k in ("class", "id", "role")).split()
    marks = MARKS - HEADINGS if above == KEEP else MARKS
    sure = marks.intersection(map(head_word, names))
    if sure and tag not in ("html", "body"):
        return DROP if sure & OF_OTHERS else MARKED
    if tag in ("article", "main"):
        return KEEP
    named = {w.lower() for name in names for w in WORDS.findall(name)}
    if named & marks and tag not in ("html", "body"):
        return None if above in (DROP, MARKED) else OPEN
    if named & ROLES_KEPT:
        return KEEP if above != MARKED or found.get("role", "").lower() in ROLES_KEPT else None
    return None


def lines(page: str | None) -> list[tuple[str, str]]:
    """``(kind, text)`` of each line of text in page order, white space made single."""
    out: list[tuple[str, str]] = []
    text: list[str] = []
    stack: list[tuple[str, str]] = [("", OPEN)]
    # How many elements of each tag are open, so that nothing is looked for in vain.
    opened: Counter = Counter()
    page = page or ""

    def end_line() -> None:
        if text:
            line = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if line and stack[-1][1] not in (DROP, MARKED):
                out.append((stack[-1][1], line))

    at = 0
    while at < len(page):
        token = TOKEN.search(page, at)
        if token is None:
            text.append(page[at:])
            break
        if token.start() > at:
            text.append(page[at : token.start()])
        at = token.end()
        if token["cdata"] is not None:
            text.append(token["cdata"].replace("&", "&amp;"))
            continue
        if token["tag"] is None:
            continue
        tag = token["tag"].lower()
        if tag in BLOCKS:
            end_line()
        if token["close"]:
            if opened[tag]:
                depth = next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag)
                if any(t in BLOCKS for t, _ in stack[depth:]) or stack[depth][1] != stack[depth - 1][1]:
                    end_line()
                opened.subtract(t for t, _ in stack[depth:])
                del stack[depth:]
            continue
        if tag in VOID:
            continue
        if tag == "p" or tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            _close_implied(stack, opened, tag)
        kind = _kind(tag, token["attrs"], stack[-1][1])
        if tag == "header" and stack[-1][1] == KEEP:
            kind = None
        above = stack[-1][1]
        now = DROP if above == DROP or kind == DROP else kind or above
        if now != above:
            end_line()
        if token["attrs"].rstrip().endswith("/") and tag not in BLOCKS | DROPPED:
            continue
        stack.append((tag, now))
        opened[tag] += 1
        if tag in RAW:
            end = RAW_END[tag].search(page, at)
            if now not in (DROP, MARKED):
                text.append(page[at : end.start() if end else len(page)])
            at = end.start() if end else len(page)
    end_line()
    return out


# An open element of the key ends where one of its values begins.
IMPLIED = {
    "p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
FENCES = frozenset("article aside body div footer form header html main nav ol section table ul dl".split())


def _close_implied(stack: list[tuple[str, str]], opened: Counter, tag: str) -> None:
    if not any(opened[t] for t in IMPLIED[tag]):
        return
    for i in range(len(stack) - 1, 0, -1):
        if stack[i][0] in IMPLIED[tag]:
            opened.subtract(t for t, _ in stack[i:])
            del stack[i:]
            return
        if stack[i][0] in FENCES:
            return


def common_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which lines of ``a`` are in a longest common subsequence with ``b``.

    Equal beginnings and ends are matched first; they are part of some longest one. The
    memory that the rest takes grows with the number of lines, not with its square.
    """
    shared = np.zeros(len(a), bool)
    least = min(len(a), len(b))
    head = int(np.argmin(np.append(a[:least] == b[:least], False)))
    tail = int(np.argmin(np.append(a[::-1][: least - head] == b[::-1][: least - head], False)))
    shared[:head] = True
    if tail:
        shared[len(a) - tail :] = True
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    rows = np.flatnonzero(np.isin(x, y))
    x, y = x[rows], y[np.isin(y, x)]
    # Halves of the lines, each against its part of the others; small ones by a table.
    pending = [(0, len(x), 0, len(y))]
    while pending:
        top, bottom, left, right = pending.pop()
        if top == bottom or left == right:
            continue
        if (bottom - top) * (right - left) <= TABLE_CELLS or bottom - top == 1:
            shared[head + rows[top:bottom][_by_table(x[top:bottom], y[left:right])]] = True
            continue
        middle = (top + bottom) // 2
        before = _common_lengths(x[top:middle], y[left:right])
        after = _common_lengths(x[middle:bottom][::-1], y[left:right][::-1])[::-1]
        cut = left + int(np.argmax(before + after))
        pending += [(top, middle, left, cut), (middle, bottom, cut, right)]
    return shared


def _common_lengths(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Length of a longest common subsequence of ``x`` and each beginning of ``y``.

    A line of ``x`` at a time, over all of ``y`` at once as the bits of one number: a bit
    that is not set is a place where the length grows.
    """
    order = np.argsort(y, kind="stable")
    values, starts = np.unique(y[order], return_index=True)
    places = dict(zip(values.tolist(), np.split(order, starts[1:]), strict=True))
    every = (1 << len(y)) - 1
    often: dict[int, int] = {}
    row = every
    for value in x.tolist():
        here = places.get(value)
        if here is None:
            continue
        bits = often.get(value)
        if bits is None and len(here) < KEPT_PLACES:
            bits = 0
            for place in here.tolist():
                bits |= 1 << place
        elif bits is None:
            flags = np.zeros(len(y), np.uint8)
            flags[here] = 1
            bits = often[value] = int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")
        met = row & bits
        row = ((row + met) | (row - met)) & every
    flags = np.unpackbits(np.frombuffer(row.to_bytes(-(-len(y) // 8), "little"), np.uint8), bitorder="little")
    return np.concatenate([[0], np.cumsum(flags[: len(y)] == 0)])


def _by_table(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The same as ``common_lines`` for few lines."""
    shared = np.zeros(len(x), bool)
    # length[i, j]: of x[i:] and y[j:]; a running maximum fills a row at once.
    length = np.zeros((len(x) + 1, len(y) + 1), np.int32)
    for i in range(len(x) - 1, -1, -1):
        hit = np.where(y == x[i], length[i + 1, 1:] + 1, length[i + 1, :-1])
        length[i, :-1] = np.maximum.accumulate(hit[::-1])[::-1]
    i = j = 0
    while i < len(x) and j < len(y):
        if x[i] == y[j]:
            shared[i] = True
            i, j = i + 1, j + 1
        elif length[i + 1, j] >= length[i, j + 1]:
            i += 1
        else:
            j += 1
    return shared


def _parsed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        kinds, texts, hashes = [], [], []
        for page in frame.pop("html"):
            found = lines(page)
            numbers = count()
            kinds.append([next(numbers) if k == OPEN else None for k, _ in found])
            texts.append([t for _, t in found])
            hashes.append([xxhash.xxh64_intdigest(t) - 2**63 for k, t in found if k == OPEN])
        yield frame.assign(place=kinds, lines=texts, hashes=hashes)


def _differenced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks in the order of rank: each page against the page before and after it."""
    before = None
    pending = None

    def told(row, *others) -> dict:
        own = np.asarray(row.hashes, np.int64)
        shared = np.zeros(len(own), bool)
        for other in others:
            if other is not None and other.host == row.host and other.block == row.block:
                lines_there = np.asarray(other.hashes, np.int64)
                # Without an article, a page with the very same lines is a copy and tells nothing.
                if not (row.all_open and np.array_equal(own, lines_there)):
                    shared |= common_lines(own, lines_there)
        return {"host": row.host, "path": row.path, "print": row.print, "shared": shared.tolist()}

    for frame in frames:
        out = []
        for row in frame.itertuples(index=False):
            if pending is not None:
                if not pending.guest:
                    out.append(told(pending, before, row))
                before = pending
            pending = row
        if out:
            yield pd.DataFrame(out)
    if pending is not None and not pending.guest:
        yield pd.DataFrame([told(pending, before, None)])


def main_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for each row of ``pages (page_id, url, html)``.

    Lines inside an article or main element are main text and elements that are named by
    navigation, headers, footers, sidebars, notices, adverts, forms or comments (``head_word``) are not. An article or main element counts below one dropped for
    its name, unless that names adverts, comments or related texts.
    Lines that the markup leaves open are main text unless they are shared, in order, with
    the page before or after by path on the same host. Pages with the same lines at the same
    path are one page there, and a page without an article is not compared with a neighbour
    that has the very same lines. A null html counts as empty and gives an empty text; null and odd URLs have an empty host.
    Repeated rows are kept; other columns are ignored.

    Only hashes of open lines travel to the neighbours. The global order is cut in blocks
    of 256 pages, each with one guest before and after it, so a host of any size is spread
    over many tasks.
    """
    on_workers(pages.sparkSession)
    rows = stored(
        pages.select("page_id", "url", "html", F.monotonically_increasing_id().alias("row_id")).mapInPandas(
            _parsed,
            "page_id long, url string, row_id long, place array<int>, lines array<string>, hashes array<long>",
        )
    )
    place = ["host", "path", "print"]
    unsure = rows.filter(F.size("hashes") > 0).select(
        "row_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), F.xxhash64("hashes").alias("print"), "hashes", F.forall("place", lambda o: o.isNotNull()).alias("all_open")
    )
    different = unsure.groupBy(*place).agg(F.any_value("hashes").alias("hashes"), F.min("all_open").alias("all_open"))
    ranged = stored(
        different.repartitionByRange(*place)
        .sortWithinPartitions(*place)
        .withColumn("range", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id())
    )
    # One row per range of the sort.
    start = ranged.groupBy("range").agg(F.count("*").alias("n"))
    start = start.withColumn("start", F.sum("n").over(W.orderBy("range")) - F.col("n"))
    rank = F.col("start") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    ranked = ranged.join(F.broadcast(start), "range").withColumn("rank", rank)
    block = F.floor(F.col("rank") / PAGES_PER_BLOCK)
    seats = F.array(
        F.struct(block.alias("block"), F.lit(False).alias("guest")),
        F.when(F.col("rank") % PAGES_PER_BLOCK == 0, F.struct((block - 1).alias("block"), F.lit(True).alias("guest"))),
        F.when((F.col("rank") + 1) % PAGES_PER_BLOCK == 0, F.struct((block + 1).alias("block"), F.lit(True).alias("guest"))),
    )
    seated = ranked.select(*place, "hashes", "all_open", "rank", F.explode(F.filter(seats, lambda s: s.isNotNull())).alias("s"))
    judged = (
        seated.select(*place, "hashes", "all_open", "rank", "s.block", "s.guest")
        .repartition("block")
        .sortWithinPartitions("block", "rank")
        .mapInPandas(_differenced, "host string, path string, print long, shared array<boolean>")
    )
    judged = unsure.select("row_id", *place).join(judged, place).select("row_id", "shared")
    # An open line is dropped where the flag at its place among open lines says so.
    kept = F.transform(
        F.arrays_zip(F.col("lines").alias("line"), F.col("place").alias("place")),
        lambda z: F.when(z["place"].isNull() | ~F.coalesce(F.get(F.col("shared"), z["place"]), F.lit(False)), z["line"]),
    )
    text = F.when(F.col("shared").isNull(), F.array_join("lines", " ")).otherwise(
        F.array_join(F.filter(kept, lambda x: x.isNotNull()), " ")
    )
    # A page without open lines is whole as parsed and does not travel.
    sure = rows.filter(F.size("hashes") == 0).select("page_id", "url", F.array_join("lines", " ").alias("text"))
    compared = rows.filter(F.size("hashes") > 0).join(judged, "row_id", "left").select("page_id", "url", text.alias("text"))
    return sure.unionByName(compared).withColumn("n_chars", F.length("text").cast("long"))
