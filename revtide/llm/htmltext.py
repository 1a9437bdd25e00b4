"""Main text of pages by nearest-URL page differencing.

A page is cut into text lines, one for each block. Pages are ordered by host and URL path, and each
is aligned with its neighbours of the same host by the longest common subsequence of lines; the
shared lines belong to the site, not to the page, and are deleted. A neighbour that shares every
line is a mirror copy and deletes nothing.

Differencing alone deletes sentences that a site repeats inside its articles and keeps menus that
change from page to page, so the markup has the first word where it speaks: lines in menus, headers,
footers, sidebars, notices, adverts, forms and comments go, and lines inside an ``article`` or
``main`` element stay. Where such elements hold at least half of the page's own text, lines outside
them go as well. Class names of ``html`` and ``body`` and those that say what a page has or lacks
(``has-sidebar``) mark nothing.

The order is dealt out by ranges of (host, path), so a large host spreads over many tasks; the pages
on both sides of a range's border are aligned in a step of their own, and the result does not
depend on where the borders fall. Only line hashes are ordered, not pages.

Cases: a NULL or empty html gives an empty text. A NULL url is one without host or path. Repeated
rows give one result each. An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.llm.common import slices, stored
from revtide.llm.urlfilter import with_host_and_path

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>",
    re.S,
)

# HTML element names by what they do to text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead "
    "title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style title textarea template noscript svg iframe object select button".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog search".split())
CONTENT = frozenset(("article", "main"))
ROLES = "navigation|banner|contentinfo|complementary|search|form|menu|menubar|alert|dialog"
NAMES = re.compile(
    r"ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|consent|disqus|footer|gdpr|masthead|menu|"
    r"modal|nav|navbar|navigation|newsletter|notices?|popup|promo\w*|related|replies|share|sharing|sidebar|"
    r"social|sponsor\w*|subscribe|toolbar|widget",
    re.I,
)
#: Names that say what a page has or lacks, as in ``has-sidebar``.
ABOUT = re.compile(r"(?:has|no|non|with|without|is|show|hide|hidden|layout)[-_]", re.I)
#: Headers of the site; others, as ``entry-header``, hold titles.
SITE_HEADER = re.compile(r"(?:(?:site|top|global)[-_]?)?header", re.I)
NAMED = re.compile(r"(?<![\w-])(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
ROLE = re.compile(rf"(?<![\w-])role\s*=\s*[\"']?(?:{ROLES})\b", re.I)


def _marked(rest: str, in_content: bool) -> bool:
    """Whether an element's attributes name it as page furniture."""
    for found in NAMED.finditer(rest):
        for word in (found[1] or found[2] or found[3] or "").split():
            if SITE_HEADER.fullmatch(word) and not in_content:
                return True
            if not ABOUT.match(word) and any(map(NAMES.fullmatch, re.split("[-_]", word))):
                return True
    return bool(ROLE.search(rest))


OPEN, INSIDE, OUTSIDE = range(3)  # a line's zone: no word from the markup, in an article, boilerplate


def _class_of(name: str, rest: str, in_content: bool) -> int | None:
    if name in CONTENT:
        return INSIDE
    if name in ("html", "body"):
        return None
    if name in BOILERPLATE or (name == "header" and not in_content) or (rest and _marked(rest, in_content)):
        return OUTSIDE
    return None


def page_lines(page: str) -> list[tuple[int, str]]:
    """Zone and text of every block of a page, in order; scripts, styles and the like left out."""
    lines: list[tuple[int, str]] = []
    held: list[str] = []
    content = boiler = 0
    boiler_name = ""
    at, end = 0, len(page)

    def flush() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                lines.append((OUTSIDE if boiler else INSIDE if content else OPEN, text))

    while at < end:
        found = TAG.search(page, at)
        if found is None:
            held.append(page[at:])
            break
        if found.start() > at:
            held.append(page[at : found.start()])
        at = found.end()
        name = found["name"]
        if name is None:
            continue
        name, closing = name.lower(), bool(found["close"])
        if name in HIDDEN:
            if not closing and not found["rest"].endswith("/"):
                close = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                at = close.end() if close else end
            if name not in ("button", "select"):
                continue
        if name == "br":
            held.append(" ")
            continue
        kind = None if closing or name in VOID else _class_of(name, found["rest"] or "", content > 0)
        if name in BLOCKS or name in CONTENT or kind is not None:
            flush()
        if closing:
            if boiler and name == boiler_name:
                boiler -= 1
            elif content and name in CONTENT:
                content -= 1
        elif name in VOID:
            continue
        elif kind == INSIDE:
            # An article never stands in a menu: one that opens there shows an end tag was left out.
            boiler = 0
            content += 1
        elif boiler:
            boiler += name == boiler_name
        elif kind == OUTSIDE:
            boiler, boiler_name = 1, name
    flush()
    return lines


def main_text(lines: list[tuple[int, str]], shared: set[int]) -> str:
    """The text of a page of whose ``lines`` those numbered in ``shared`` belong to its site."""
    own = [(zone, text) for i, (zone, text) in enumerate(lines) if zone == INSIDE or (zone == OPEN and i not in shared)]
    inside = [text for zone, text in own if zone == INSIDE]
    # An article that holds the lesser part of what is the page's own is a teaser, not its main text.
    if sum(map(len, inside)) * 2 >= sum(len(text) for _, text in own):
        return "\n".join(inside)
    return "\n".join(text for _, text in own)


def common_lines(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Positions in ``a`` and in ``b`` of a longest common subsequence."""
    both = set(a) & set(b)
    left = [i for i, x in enumerate(a) if x in both]
    right = [j for j, x in enumerate(b) if x in both]
    pairs = _subsequence([a[i] for i in left], [b[j] for j in right])
    return [left[i] for i, _ in pairs], [right[j] for _, j in pairs]


#: Bits of the alignment that are held at once; longer pages are halved first.
HELD = 1 << 26


def _rows(a: list[int], b: list[int]) -> list[int]:
    """For each prefix of ``a`` a number whose zero bits mark where its subsequence with ``b`` grows."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for x in a:
        hits = row & places.get(x, 0)
        row = ((row + hits) | (row - hits)) & full
        rows.append(row)
    return rows


def _lengths(row: int, n: int) -> list[int]:
    grown = [0]
    for bit in bin(row | 1 << n)[:2:-1]:
        grown.append(grown[-1] + (bit == "0"))
    return grown


def _subsequence(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    if not a or not b:
        return []
    if len(a) * len(b) > HELD and len(a) > 1:
        half = len(a) // 2
        ahead = _lengths(_rows(a[:half], b)[-1], len(b))
        behind = _lengths(_rows(a[half:][::-1], b[::-1])[-1], len(b))
        cut = max(range(len(b) + 1), key=lambda j: ahead[j] + behind[len(b) - j])
        rest = _subsequence(a[half:], b[cut:])
        return _subsequence(a[:half], b[:cut]) + [(i + half, j + cut) for i, j in rest]
    rows, pairs = _rows(a, b), []
    i, j = len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        if rows[i] >> j & 1:
            j -= 1
        elif i and not rows[i - 1] >> j & 1:
            i -= 1
        else:
            pairs.append((i, j))
            i, j = i - 1, j - 1
    return pairs[::-1]


def _shared(a: tuple, b: tuple) -> list[tuple[int, list[int]]]:
    """Key and shared lines of two neighbours, each (key, host, hashes); nothing across hosts or from mirrors."""
    if a[1] != b[1]:
        return []
    own, other = common_lines(a[2], b[2])
    found = []
    if own and len(own) < len(a[2]):
        found.append((a[0], own))
    if other and len(other) < len(b[2]):
        found.append((b[0], other))
    return found


def _hashed(batches):
    import pyarrow as pa
    import xxhash

    for batch in slices(batches):
        columns = batch.to_pydict()
        hashes = [
            [xxhash.xxh64_intdigest(t.encode()) - (1 << 63) for _, t in page_lines(h)] for h in columns.pop("html")
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in range(4)] + [pa.array(hashes, pa.list_(pa.int64()))],
            names=["key", "host", "path", "page_id", "hashes"],
        )


def _found_batch(found: list):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict(
        {
            "key": pa.array([k for k, _ in found], pa.int64()),
            "shared": pa.array([s for _, s in found], pa.list_(pa.int32())),
        }
    )


def _rows_of(batch):
    return zip(*(batch.column(n).to_pylist() for n in ("key", "host", "hashes")), strict=True)


def _within(batches):
    before = None
    for batch in batches:
        found = []
        for row in _rows_of(batch):
            if before is not None:
                found += _shared(before, row)
            before = row
        yield _found_batch(found)


def _borders(batches):
    import pyarrow as pa
    from pyspark import TaskContext

    first = last = None
    for batch in batches:
        for row in _rows_of(batch):
            first, last = first or row, row
    if first is not None:
        names = ("key", "host", "hashes")
        columns = {"part": pa.array([TaskContext.get().partitionId()], pa.int64())}
        for side, row in (("first", first), ("last", last)):
            for name, value in zip(names, row, strict=True):
                kind = pa.list_(pa.int64()) if name == "hashes" else pa.string() if name == "host" else pa.int64()
                columns[f"{side}_{name}"] = pa.array([value], kind)
        yield pa.RecordBatch.from_pydict(columns)


BORDERS = "part long, " + ", ".join(
    f"{side}_key long, {side}_host string, {side}_hashes array<long>" for side in ("first", "last")
)


def _across(batches):
    before = None
    for batch in batches:
        found = []
        for row in sorted(batch.to_pylist(), key=lambda r: r["part"]):
            own = tuple(row[f"first_{n}"] for n in ("key", "host", "hashes"))
            if before is not None:
                found += _shared(before, own)
            before = tuple(row[f"last_{n}"] for n in ("key", "host", "hashes"))
        yield _found_batch(found)


def site_lines(keyed: DataFrame) -> DataFrame:
    """``key, shared``: numbers of the lines that a page shares with its neighbours by URL."""
    lines = keyed.select("key", "host", "path", "page_id", "html").mapInArrow(
        _hashed, "key long, host string, path string, page_id long, hashes array<long>"
    )
    order = ("host", "path", "page_id", "key")
    dealt = stored(lines.repartitionByRange(*order).sortWithinPartitions(*order))
    # One row for each range: few, and in order.
    borders = dealt.mapInArrow(_borders, BORDERS).coalesce(1).sortWithinPartitions("part")
    found = dealt.mapInArrow(_within, "key long, shared array<int>").unionAll(
        borders.mapInArrow(_across, "key long, shared array<int>")
    )
    return found.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_set("shared"))).alias("shared"))


def _extracted(batches):
    import pyarrow as pa

    for batch in slices(batches):
        pages, shared = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        texts = [main_text(page_lines(p), set(s or ())) for p, s in zip(pages, shared, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (``page_id``, ``url``, ``html``)."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    keyed = with_host_and_path(rows).withColumn("key", F.xxhash64("page_id", "url", "html"))
    shared = site_lines(keyed)
    return (
        keyed.join(shared, "key", "left")
        .select("page_id", "url", "html", "shared")
        .mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
    )
