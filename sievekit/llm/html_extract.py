"""Main text of web pages by differencing pages with near urls.

Pages of a host are ordered by url path; each page is compared with the nearest
page before and after it that has other lines. Two alignments by a longest
common subsequence decide what belongs to the site's template:

* text lines that a page shares with a neighbour (of other lines, so never
  between copies) are deleted;
* regions (neighbouring lines in one container) carry the tag paths of their
  lines; a region that stands with the same paths on both neighbours is template
  even when its words differ (menus, adverts, footers), if its lines are short
  and it is small beside the page's main region.

Element names break the ties: lines inside the page's own article element are
content by the page's word and stay, shared or not; lines in elements that are
never content (menus, asides, forms, adverts, comments, ... by element, role or
class of a block) go even when no neighbour shares them. Inline elements, and
the text of formulas, objects and noscript, are never dropped by name. A class
names a region only if all its parts do ("related" and "related-links" do,
"related-work" does not).

A host of more than ``HOST_PAGES`` pages is cut into ranges of (path, id) of
about that many, at places sampled by a hash, so no host is gathered in one
task (a host of over ``HOST_PAGES * MAX_RANGES`` pages has that many ranges,
of more pages each). The first and last two different pages of each range meet
those of the adjacent ranges, so neighbours are the same wherever a host is
cut, and whether it is. The comparison needs only hashes of the neighbours.

Defined results
    null or empty html      empty text
    null url                host and path empty, compared with each other
    lone page of a host     nothing to compare; its elements alone decide
    equal paths             ordered by page id, then line hashes
    repeated rows, copies   pages of equal lines are not compared with each
                            other but with the same neighbours
    cut-off or broken html  elements left open end with the page; an article
                            ends an open non-content element before it; after
                            the last tag, text goes from the first "<" on that
                            begins a tag, none otherwise
    very long pages         whole; alignment takes memory in proportion to lines
    empty table             empty result
    extra columns           ignored
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievekit.llm.common import hinted, prepare_python, stage
from sievekit.llm.urlfilter import host_of, path_of

HOST_PAGES = 2_000
MAX_RANGES = 1_000
SAMPLES = 8  # sampled places for each cut, about

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template|textarea|svg|iframe|select)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.S | re.I)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_TAG_START = re.compile(r"<[a-zA-Z/!?]")
_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")

# fixed values: element and attribute names of HTML
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search
    section summary table tbody tfoot thead title tr ul caption""".split())
NEVER = frozenset("nav aside footer form button head menu dialog search title label input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
NAMES = frozenset("""ad ads advert advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav
    navbar navigation breadcrumb breadcrumbs footer masthead comment comments disqus replies cookie cookies consent notice
    notification gdpr popup modal overlay newsletter subscribe subscription share sharing social related recommended
    widget toolbar pagination pager skip login signup""".split())
#: words that say nothing about what a region is, so that "cookie-box" is a notice
GENERIC = frozenset("""area bar block bottom box button buttons container inner item items left link links list outer panel right row
    section site slot top unit wrap wrapper""".split())
#: elements that hold a line of a region, not a region
LINE = frozenset("p li h1 h2 h3 h4 h5 h6 dt dd tr caption figcaption summary legend pre blockquote center address".split())
LINE_WORDS = 15  # words of a template region's lines, on average at most
SMALLER = 4  # times that the main region is larger than a template region that differs in words
BITS = 1 << 28  # cells of an alignment that are held at once
VOICES = frozenset("comment comments disqus replies".split())  # an article inside these is a reader's


def _marks(attributes: str) -> set[str]:
    """Names that class, id and role give an element."""
    out: set[str] = set()
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values)
        if name.lower() in ("class", "id"):
            for token in value.split():
                parts = {x.lower() for x in _PART.findall(token)}
                if parts <= NAMES | GENERIC:
                    out |= parts & NAMES
        elif name.lower() == "role" and value.lower() in ROLES:
            out.add("nav")
        elif name.lower() == "hidden" or value.lower() == "true":
            out.add("overlay")
    return out


def placed_lines(html: str | None) -> list[tuple[str, bool, bool, str, int]]:
    """The text lines (blocks) of a page: (line, in an article, in an element
    that is never content, tag path, number of its region)."""
    if not html:
        return []
    out: list[tuple[str, bool, bool, str, int]] = []
    held: list[str] = []
    depth = 0  # open article elements
    off: list[list] = []  # open never-content elements: [element, how many of that name are open, a reader's]
    open_blocks: list[tuple[str, str, int]] = [("", "", 0)]  # (element, tag path, number of its region)
    opened = 0

    def flush() -> None:
        if held:
            line = " ".join(unescape("".join(held)).split())
            held.clear()
            if line:
                out.append((line, depth > 0 and not off, bool(off), *open_blocks[-1][1:]))

    at = 0
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            held.append(html[at : m.start()])
        at = m.end()
        if m[3] is None:  # a comment, a script, a declaration
            continue
        name, closes = m[3].lower(), bool(m[2])
        if name == "br" or name in ("td", "th"):
            held.append(" ")
            continue
        if name not in BLOCKS and name not in NEVER and not off:
            continue  # inline markup
        if name in BLOCKS:
            flush()
            if closes:
                if open_blocks[-1][0] == name:
                    open_blocks.pop()
                elif any(e[0] == name for e in open_blocks):
                    while open_blocks.pop()[0] != name:
                        pass
            elif name not in VOID:
                if open_blocks[-1][0] in LINE and (name in LINE or open_blocks[-1][0] == "p"):
                    open_blocks.pop()  # left open by the page
                opened += 1
                _, path, region = open_blocks[-1]
                open_blocks.append((name, f"{path}/{name}", region if name in LINE else opened))
        if closes:
            if off and off[-1][0] == name:
                off[-1][1] -= 1
                if not off[-1][1]:
                    flush()
                    off.pop()
            elif name in CONTENT and not off:
                depth = max(0, depth - 1)
            continue
        if name in VOID or m[4].endswith("/") and name not in BLOCKS:
            continue
        if off and off[-1][0] == name:
            off[-1][1] += 1
            continue
        marks = _marks(m[4]) if m[4] and name in BLOCKS and name not in ("html", "body") else set()
        if name in CONTENT:
            if not any(o[2] for o in off) and not marks & VOICES:
                flush()
                off.clear()
                depth += 1
                continue
            flush()
            off.append([name, 1, True])
        elif name in NEVER or name == "header" and not depth or marks & NAMES:
            flush()
            off.append([name, 1, bool(marks & VOICES)])
    cut = _TAG_START.search(html, at)
    held.append(html[at : cut.start() if cut else len(html)])
    flush()
    return out


def lines_of(html: str | None) -> list[tuple[str, bool, bool]]:
    """The text lines of a page: (line, in an article, in an element that is never content)."""
    return [x[:3] for x in placed_lines(html)]


def _rows(a: list[int], masks: dict[int, int], width: int) -> Iterator[int]:
    """Row after row of the alignment table as bits: a 0 where the common length grows."""
    full = (1 << width) - 1
    row = full
    for x in a:
        if (at := masks.get(x)) is not None:
            hit = row & at
            row = ((row + hit) | (row - hit)) & full
        yield row


def _masks(b: list[int]) -> dict[int, int]:
    places: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    out = {}
    for x, at in places.items():
        bits = bytearray(len(b) // 8 + 1)
        for j in at:
            bits[j >> 3] |= 1 << (j & 7)
        out[x] = int.from_bytes(bits, "little")
    return out


def _growth(row: int, width: int) -> np.ndarray:
    """Common length with each prefix, from a row's bits."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes(width // 8 + 1, "little"), dtype=np.uint8), bitorder="little")[:width]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def _aligned(a: list[int], b: list[int], start: int, out: list[int]) -> None:
    """Appends the positions (from ``start``) in ``a`` of a longest common subsequence with ``b``."""
    if not a or not b:
        return
    if len(a) * len(b) > BITS and len(a) > 1:  # halves meet where the sum of both lengths is largest: linear space
        mid, row = len(a) // 2, 0
        for row in _rows(a[:mid], _masks(b), len(b)):
            pass
        ahead = _growth(row, len(b))
        for row in _rows(a[mid:][::-1], _masks(b[::-1]), len(b)):
            pass
        cut = int((ahead + _growth(row, len(b))[::-1]).argmax())
        _aligned(a[:mid], b[:cut], start, out)
        _aligned(a[mid:], b[cut:], start + mid, out)
        return
    rows = list(_rows(a, _masks(b), len(b)))
    i, j, found = len(a), len(b), []
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if not i or rows[i - 1] >> (j - 1) & 1:
            j -= 1
            found.append(start + i)
    out += reversed(found)


def common_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions in ``a`` of a longest common subsequence with ``b``.

    Equal ends first; lines that the other side lacks are left out; the rest is
    aligned with a row of bits a line (so time follows lines times words of
    bits, however often a line repeats), in halves where the table is large."""
    lo, end = 0, 0
    short = min(len(a), len(b))
    while lo < short and a[lo] == b[lo]:
        lo += 1
    while end < short - lo and a[len(a) - 1 - end] == b[len(b) - 1 - end]:
        end += 1
    inner_a, inner_b = a[lo : len(a) - end], b[lo : len(b) - end]
    if not len(inner_a) or not len(inner_b):
        return np.concatenate([np.arange(lo), np.arange(len(a) - end, len(a))]).astype(np.int64)
    at = np.flatnonzero(np.isin(inner_a, inner_b))
    found: list[int] = []
    _aligned(inner_a[at].tolist(), inner_b[np.isin(inner_b, inner_a)].tolist(), 0, found)
    return np.concatenate([np.arange(lo), lo + at[found], np.arange(len(a) - end, len(a))]).astype(np.int64)


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


def regions_of(found: list[tuple[str, bool, bool, str, int]]) -> tuple[list[int], list[int]]:
    """(region of each line, hash of each region's tag paths)."""
    of, paths = [], []
    last = None
    for _, own, off, path, region in found:
        if (region, own, off) != last:
            last = (region, own, off)
            paths.append([])
        paths[-1].append(path)
        of.append(len(paths) - 1)
    return of, [_hash("\n".join(p)) for p in paths]


_PARSED = "_id long, _url string, lines array<string>, kinds binary, of binary, hashes array<long>, regions array<long>"


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def _parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lines, kinds, of, hashes, regions = [], [], [], [], []
        for html in b.column("_html").to_pylist():
            found = placed_lines(html)
            hashes.append(_signed([_hash(x[0]) for x in found]))
            kinds.append(bytes(2 if off else int(own) for _, own, off, *_ in found))
            lines.append(["" if x[2] else x[0] for x in found])
            region, paths = regions_of(found)
            of.append(np.array(region, dtype="<i4").tobytes())
            regions.append(_signed(paths))
        yield pa.record_batch(
            [b.column("_id"), b.column("_url"), pa.array(lines, pa.list_(pa.string())), pa.array(kinds, pa.binary()), pa.array(of, pa.binary()),
             pa.array(hashes, pa.list_(pa.int64())), pa.array(regions, pa.list_(pa.int64()))],
            names=["_id", "_url", "lines", "kinds", "of", "hashes", "regions"])


def template_regions(lines: list[str], kinds: bytes, of: np.ndarray, shared: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Which regions are template by their paths alone (``common``: they stand on
    all neighbours): short lines, small beside the main region."""
    kind = np.frombuffer(kinds, dtype=np.uint8)
    size = np.array([len(x) for x in lines], dtype=np.int64)
    words = np.array([x.count(" ") + 1 for x in lines], dtype=np.int64)
    n = len(common)
    text = np.bincount(of, size, n)
    main = int(size[kind == 1].sum()) or int(np.bincount(of, size * ~shared * (kind == 0), n).max(initial=0))
    open_lines = np.bincount(of, kind == 0, n)
    short = np.bincount(of, words, n) <= LINE_WORDS * np.bincount(of, minlength=n)
    return common & (open_lines > 0) & short & (text * SMALLER <= main)


def _difference(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, counts = [], []
        columns = (b.column(c).to_pylist() for c in ("lines", "kinds", "of", "hashes", "regions", "before", "after"))
        for lines, kinds, of, hashes, regions, *near in zip(*columns, strict=True):
            own = np.array(hashes, dtype=np.int64)
            template = shared = np.zeros(len(own), dtype=bool)
            for other in filter(None, near):
                shared[common_lines(own, np.array(other["hashes"], dtype=np.int64))] = True
            if 0 in kinds and any(near):  # else elements alone have decided
                paths, region = np.array(regions, dtype=np.int64), np.frombuffer(of, dtype="<i4").astype(np.int64)
                common = np.ones(len(paths), dtype=bool)
                for other in filter(None, near):
                    here = np.zeros(len(paths), dtype=bool)
                    here[common_lines(paths, np.array(other["regions"], dtype=np.int64))] = True
                    common &= here
                template = shared | template_regions(lines, kinds, region, shared, common)[region]
            counts.append(int(shared.sum()))
            texts.append("\n".join(x for x, kind, t in zip(lines, kinds, template, strict=True) if kind == 1 or kind == 0 and not t))
        yield pa.record_batch([b.column("_id"), b.column("_url"), pa.array(texts, pa.string()), pa.array(counts, pa.int32())],
                              names=["_id", "_url", "text", "shared_lines"])


def with_nearest(df: DataFrame, group: list[str]) -> DataFrame:
    """Add ``before`` and ``after``: the hashes of lines and regions of the nearest
    page on either side, by (path, id, hashes) in its group, that has other lines."""
    key = ["_path", "_id", "hashes"]
    up = Window.partitionBy(*group).orderBy(*key)
    down = Window.partitionBy(*group).orderBy(*[F.desc(c) for c in key])
    for side, order in (("before", up), ("after", down)):
        last = F.lag(F.struct("hashes", "regions")).over(order)
        # the page before the first of a run of equal ones holds for the whole run
        df = df.withColumn("_last", last).withColumn(side, F.last(
            F.when(F.col("_last.hashes") != F.col("hashes"), F.col("_last")), ignorenulls=True).over(
            order.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_last")
    return df


def cuts_of(places: DataFrame, host_pages: int) -> DataFrame:
    """(_host, _cuts): for hosts of more than ``host_pages`` pages, the places
    (path, id) at which its ranges begin, the first one's aside. Narrow rows of
    large hosts only; one in ``step`` is sampled, every ``SAMPLES``-th of those
    is a cut."""
    sizes = places.groupBy("_host").agg(F.count("*").alias("n")).filter(F.col("n") > host_pages)
    sizes = stage(sizes.select("_host", F.greatest(F.lit(host_pages), F.col("n") / MAX_RANGES).alias("_pages")), "html-hosts")
    step = F.greatest(F.lit(1), F.floor(F.col("_pages") / SAMPLES))
    some = places.join(hinted(sizes), "_host").filter(F.pmod(F.xxhash64("_path", "_id"), step) == 0)
    some = some.groupBy("_host", "_path", "_id").agg(F.max(F.least(F.lit(SAMPLES), F.ceil("_pages"))).alias("_every"))
    nth = F.row_number().over(Window.partitionBy("_host").orderBy("_path", "_id"))
    cuts = some.withColumn("_nth", nth).filter(F.pmod("_nth", "_every") == 0)
    return cuts.groupBy("_host").agg(F.sort_array(F.collect_list(F.struct("_path", "_id"))).alias("_cuts"))


def seams_of(ranged: DataFrame) -> DataFrame:
    """(_host, _range, _before, _after): for each range of a host that is cut,
    the nearest other lines before its first page and after its last one.

    Of a range, the first and last page and the nearest ones with other lines
    than these are enough to tell the neighbours of the adjacent ranges."""
    group = ["_host", "_range"]
    place = F.struct("_path", "_id")
    lists = ranged.groupBy(*group, "hashes").agg(F.min(place).alias("_a"), F.max(place).alias("_z"),
                                                 F.min_by("regions", place).alias("_ra"), F.max_by("regions", place).alias("_rz"))
    ends = lists.withColumns({
        "_nth": F.row_number().over(Window.partitionBy(*group).orderBy("_a", "hashes")),
        "_back": F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("_z"), F.desc("hashes")))})
    ends = stage(ends.filter("_nth <= 2 or _back <= 2"), "html-ends")
    pick = lambda rows, at, regions, first, last: rows.select(
        *group, F.col(f"{at}._path").alias("_path"), F.col(f"{at}._id").alias("_id"), "hashes", F.col(regions).alias("regions"),
        first.alias("_first"), last.alias("_end"))
    never = F.lit(False)
    pages = pick(ends.filter("_nth <= 2"), "_a", "_ra", F.col("_nth") == 1, never).unionByName(
        pick(ends.filter("_back <= 2"), "_z", "_rz", never, F.col("_back") == 1))
    # at most four rows a range
    near = with_nearest(pages, ["_host"])
    return near.groupBy(*group).agg(F.max(F.when(F.col("_first"), F.col("before"))).alias("_before"),
                                    F.max(F.when(F.col("_end"), F.col("after"))).alias("_after"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              host_pages: int = HOST_PAGES) -> DataFrame:
    """One row per input row: id, url, text, n_chars, shared_lines."""
    prepare_python(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"))
    host, path = host_of(F.col("_url")), path_of(F.col("_url"))
    cuts = stage(cuts_of(rows.select(host.alias("_host"), path.alias("_path"), "_id"), host_pages), "html-cuts")

    def ranged(some: DataFrame, how: str) -> DataFrame:
        """Parsed pages with host, path and range."""
        parsed = some.mapInArrow(_parse, _PARSED)
        parsed = parsed.withColumn("_host", host).withColumn("_path", path).join(hinted(cuts), "_host", how)
        here = F.struct("_path", "_id")
        return parsed.withColumn("_range", F.coalesce(F.size(F.filter("_cuts", lambda c: c <= here)), F.lit(0))).drop("_cuts")

    placed = with_nearest(ranged(rows, "left"), ["_host", "_range"])
    if not cuts.isEmpty():
        large = rows.withColumn("_host", host).join(hinted(cuts.select("_host")), "_host", "left_semi").drop("_host")
        seams = stage(seams_of(ranged(large, "inner").select("_host", "_range", "_path", "_id", "hashes", "regions")), "html-seams")
        placed = placed.join(hinted(seams), ["_host", "_range"], "left").withColumns({
            "before": F.coalesce("before", "_before"), "after": F.coalesce("after", "_after")})
    out = placed.select("_id", "_url", "lines", "kinds", "of", "hashes", "regions", "before", "after").mapInArrow(
        _difference, "_id long, _url string, text string, shared_lines int")
    return out.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text",
                      F.length("text").cast("long").alias("n_chars"), "shared_lines")
