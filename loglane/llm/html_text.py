"""Main text of web pages by nearest-URL page differencing.

1. Pages with one host, path and html are one page, differenced once. All pages
   are ordered by host, path and html hash. A page is paired with the page before
   or after on its host whose path shares more leading parts (ties: before).
   Before: the nearest of the ``NEAR`` pages before of the same path that tells
   something; if none does, the last page of the path before; after likewise.
   Pages with the same lines, or of the same path with nine tenths of their text
   in common (crawled again), tell nothing.
2. A page becomes text lines, one for each block, with the place where it
   stands: in a boilerplate container (menu, header, footer, sidebar, notice,
   advert, form, comments), in the marked article, or elsewhere.
3. The two pages' lines are aligned by their longest common subsequence. Lines
   in the alignment are the site's template: they are deleted where they stand
   outside a marked article.
4. The text is the article's lines; where no article is marked, the lines
   outside boilerplate containers that no alignment deleted.

On Spark: names (host, path, hash) are numbered in their order without the html.
That gives the first name of each part of about ``PART_BYTES`` and the few names
that a part needs from its neighbours, at most ``MAX_PARTS`` times ten. Pages
find their part by search in this list, so the html is shuffled once and the
result does not depend on how many parts or tasks there are. Copies travel
without html. A page with more than a hundred-thousandth of all rows as copies
(at least ``HOT_COPIES``; so there are fewer than 100,000 of them) is not dealt row by row:
its text is joined to its rows by hash.

A marked article keeps lines that the neighbour shares, as a sentence two
articles have in common is still text. Whole pages are read; nothing is capped.
Parsing is linear in the page. The alignment takes n*m/64 steps on machine words
after equal ends are cut off, and memory for about sqrt(n) rows of m bits.

Defined results: null and empty html give an empty text; a page alone on its
host, or with pages that tell nothing, loses no line to differencing; repeated
rows give equal texts; null urls share one (empty) host; broken markup is read as
far as it goes (an unclosed container ends with its parent or where an article
begins; from the first attribute quote that never ends, quotes count as text);
extra columns are ignored.
"""

from __future__ import annotations

import bisect
import html
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from .common import pieces, read_table, ship_package
from .merkle import numbered
from .url_filter import with_host_path

BOILERPLATE, OTHER, MAIN = 0, 1, 2
#: Elements of HTML and the part they play here.
RAW = {"script", "style", "noscript", "template", "textarea", "svg", "iframe", "object", "title", "math", "canvas"}
SKIPPED = {"nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "datalist"}
MAIN_TAGS = {"article", "main"}
CONTAINERS = {"body", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "ul", "ol",
              "table", "blockquote", "figure", "details", "dialog", "menu", "button", "select", "fieldset", "span"}
BLOCKS = CONTAINERS - {"span", "button", "select"} | {
    "p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "tr", "dl", "dt", "dd", "pre", "hr", "figcaption", "address",
    "caption", "legend", "summary", "hgroup", "center", "thead", "tbody", "tfoot", "html", "head", "option"}
SPACED = {"br", "td", "th", "wbr"}
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "source", "area", "base", "col", "embed", "track"}
#: Words in class, id and role that name boilerplate or the article.
BOILERPLATE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|gdpr|header|menu|"
    r"modal|nav\w*|newsletter|notice|pagination|popup|promo\w*|related|share|sharing|sidebar|social|sponsor\w*|"
    r"subscribe|toolbar|widget)(?:$|[\s_-])", re.I)
MAIN_NAMES = re.compile(r"(?:^|[\s_-])(?:article(?:-?body)?|main(?:-?content)?|post(?:-?(?:body|content))?|"
                        r"entry-?content|story(?:-?body)?)(?:$|[\s_-])", re.I)
NAME = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
UNQUOTED = re.compile(r"[^>\"']*")
UNFINISHED = re.compile(r"<[A-Za-z/!?][^<]*\Z")
COMMENT_NAMES = re.compile(r"(?:^|[\s_-])(?:comments?|disqus)(?:$|[\s_-])", re.I)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


#: Pages of one path that are looked at on either side.
NEAR = 4
PART_BYTES = 4 << 20
MAX_PARTS = 1 << 15
HOT_COPIES = 1000


@dataclass
class _Open:
    tag: str
    place: int
    in_comments: bool = False
    outermost: int = -1  # place in the stack of the outermost boilerplate container


def tags(text: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(start, end, closing, name, attributes) of each tag, in one scan; comments
    and declarations have no name."""
    at, last, quotes = 0, text.rfind(">"), True
    while True:
        i = text.find("<", at)
        if i < 0:
            return
        if text.startswith("<!--", i):
            j = text.find("-->", i + 4)
            at = j + 3 if j >= 0 else len(text)
            yield i, at, False, "", ""
            continue
        if i > last:  # no tag ends any more
            at = i + 1
            continue
        if text[i + 1] in "!?":
            at = text.find(">", i) + 1
            yield i, at, False, "", ""
            continue
        m = NAME.match(text, i)
        if m is None:
            at = i + 1
            continue
        end = m.end()
        while quotes:
            end = UNQUOTED.match(text, end).end()
            if end == len(text):
                quotes = False
            elif text[end] == ">":
                break
            else:
                end = text.find(text[end], end + 1) + 1
                quotes = end > 0
        if not quotes:
            end = text.find(">", m.end())
            if end < 0:
                at = i + 1
                continue
        at = end + 1
        yield i, at, bool(m.group(1)), m.group(2).lower(), text[m.end():end]


def lines_of(page: str | None) -> list[tuple[str, int]]:
    """(text, place) of each block that has text, in page order."""
    out: list[tuple[str, int]] = []
    stack: list[_Open] = []
    opened: Counter[str] = Counter()
    buffer: list[str] = []
    at, text = 0, page or ""

    def flush() -> None:
        if buffer:
            line = " ".join(html.unescape("".join(buffer)).split())
            buffer.clear()
            if line:
                out.append((line, stack[-1].place if stack else OTHER))

    def close(i: int) -> None:
        opened.subtract(x.tag for x in stack[i:])
        del stack[i:]

    for start, end, closing, tag, attributes in tags(text):
        if start < at:  # inside a raw element
            continue
        if start > at:
            buffer.append(text[at:start])
        at = end
        if not tag:
            continue
        if tag in RAW:
            if not closing and not attributes.endswith("/"):
                found = re.compile(rf"</{tag}\b", re.I).search(text, at)
                at = text.find(">", found.end()) + 1 if found else 0
                if not at:
                    at = len(text)
                    break
            continue
        if tag in BLOCKS:
            flush()
        elif tag in SPACED:
            buffer.append(" ")
        if tag not in CONTAINERS or tag in VOID:
            continue
        if closing:
            if opened[tag] > 0:
                i = len(stack) - 1
                while stack[i].tag != tag:
                    i -= 1
                if tag in ("span", "button", "select") and stack[i].place != (stack[i - 1].place if i else OTHER):
                    flush()
                close(i)
            continue
        if attributes.endswith("/"):
            continue
        names = " ".join(x for g in NAMED.findall(attributes) for x in g) if "=" in attributes else ""
        above = stack[-1] if stack else _Open("", OTHER)
        comments = bool(names and COMMENT_NAMES.search(names))
        if tag in MAIN_TAGS and above.place == BOILERPLATE and not comments and not above.in_comments:
            close(above.outermost)  # it was never closed
            above = stack[-1] if stack else _Open("", OTHER)
        place = above.place
        if place != BOILERPLATE:
            if tag in SKIPPED and not (tag == "header" and place == MAIN) or names and BOILERPLATE_NAMES.search(names):
                place = BOILERPLATE
            elif tag in MAIN_TAGS or names and tag != "body" and MAIN_NAMES.search(names):
                place = MAIN
        if tag in ("span", "button", "select") and place != above.place:
            flush()
        outermost = above.outermost if above.place == BOILERPLATE else len(stack) if place == BOILERPLATE else -1
        stack.append(_Open(tag, place, comments or above.in_comments, outermost))
        opened[tag] += 1
    if at < len(text):
        cut = UNFINISHED.search(text, at)  # a tag that never ends
        buffer.append(text[at:cut.start()] if cut else text[at:])
    flush()
    return out


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b`` (bit-parallel)."""
    head, n, m = 0, len(a), len(b)
    while head < min(n, m) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(n, m) - head and a[n - 1 - tail] == b[m - 1 - tail]:
        tail += 1
    out = {*range(head), *range(n - tail, n)}
    x, y = a[head:n - tail], b[head:m - tail]
    if not x or not y:
        return out
    at: dict[str, int] = {}
    for j, line in enumerate(y):
        at[line] = at.get(line, 0) | 1 << j
    full = (1 << len(y)) - 1

    def after(row: int, line: str) -> int:  # a zero bit: the subsequence grows by one at this place of y
        hit = row & at.get(line, 0)
        return ((row + hit) | (row - hit)) & full

    def length(row: int, k: int) -> int:
        return k - (row & ((1 << k) - 1)).bit_count()

    stride = math.isqrt(len(x)) + 1
    row, marks = full, []  # the row before every stride-th line; those between are computed again
    for i, line in enumerate(x):
        if i % stride == 0:
            marks.append(row)
        row = after(row, line)
    j = len(y)
    for first in range((len(marks) - 1) * stride, -1, -stride):
        rows = [marks[first // stride]]
        for line in x[first:first + stride]:
            rows.append(after(rows[-1], line))
        for i in range(len(rows) - 2, -1, -1):
            before, now = rows[i], rows[i + 1]
            while j and length(now, j) == length(now, j - 1):
                j -= 1
            if j and length(before, j) < length(now, j):
                out.add(head + first + i)
                j -= 1
    return out


def main_text(lines: list[tuple[str, int]], neighbour: list[tuple[str, int]] | None) -> str:
    shared = common_lines([x for x, _ in lines], [x for x, _ in neighbour]) if neighbour else set()
    kept = [(x, p) for i, (x, p) in enumerate(lines) if p == MAIN or p == OTHER and i not in shared]
    if any(p == MAIN for _, p in kept):
        kept = [(x, p) for x, p in kept if p == MAIN]
    return "\n\n".join(x for x, _ in kept)


def shared_parts(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a.split("/"), b.split("/")):
        if x != y:
            break
        n += 1
    return n


def near_copies(a: list[str], b: list[str]) -> bool:
    """Whether nine tenths of both pages' text stands in the common lines."""
    same = sum(len(a[i]) for i in common_lines(a, b))
    return 10 * same >= 9 * max(sum(map(len, a)), sum(map(len, b)))


@dataclass
class _Page:
    host: str
    path: str
    key: bytes
    html: str
    copies: list = field(default_factory=list)  # (page_id, url) of the rows that get its text
    _lines: list | None = None

    @property
    def lines(self) -> list:
        if self._lines is None:
            self._lines = lines_of(self.html)
            self.html = ""
        return self._lines

    def tells(self, other: _Page) -> bool:
        """Whether this page's lines can be differenced against the other's."""
        if self.lines == other.lines:
            return False
        return self.path != other.path or not near_copies([x for x, _ in self.lines], [x for x, _ in other.lines])


def paths_in(pages: Iterable[_Page]) -> Iterator[list[_Page]]:
    """Consecutive pages of one host and path."""
    group: list[_Page] = []
    for p in pages:
        if group and (group[0].host, group[0].path) != (p.host, p.path):
            yield group
            group = []
        group.append(p)
    if group:
        yield group


def with_neighbours(pages: Iterable[_Page]) -> Iterator[tuple[_Page, _Page | None]]:
    """(page, the page it is differenced against or None) for ordered pages that
    have some copy; holds the pages of one path, and one of those beside it."""
    before: _Page | None = None
    groups = paths_in(pages)
    group = next(groups, None)
    while group:
        following = next(groups, None)
        after = following[0] if following else None
        for i, p in enumerate(group):
            if not p.copies:
                continue
            near = []
            for beside, beyond in ((group[max(0, i - NEAR):i][::-1], before), (group[i + 1:i + 1 + NEAR], after)):
                beyond = [beyond] if beyond is not None and beyond.host == p.host else []
                near += [q for q in [*beside, *beyond] if p.tells(q)][:1]
            yield p, max(near, key=lambda q: shared_parts(p.path, q.path)) if near else None
        before, group = group[-1], following


def named_rows(pages: DataFrame) -> DataFrame:
    """(host, path, key, page_id, url, html): the name of a page is host, path and hash."""
    source = F.coalesce("html", F.lit(""))
    rows = with_host_path(pages.select("page_id", "url", "html"))
    return rows.select("host", "path", F.unhex(F.md5(source)).alias("key"), "page_id", "url", source.alias("html"))


@dataclass
class Parts:
    """The first name of each part, names that go to further parts, and hot names."""

    starts: list[tuple[bytes, bytes, bytes]]
    also: dict[tuple[bytes, bytes, bytes], list[int]]
    hot: set[tuple[bytes, bytes, bytes]]

    def of(self, name: tuple[bytes, bytes, bytes]) -> int:
        return max(0, bisect.bisect_right(self.starts, name) - 1)


def plan_parts(rows: DataFrame, part_bytes: int = PART_BYTES, hot_copies: int = HOT_COPIES) -> Parts:
    """Number the names in order (no html is moved) and cut them into parts."""
    names = rows.groupBy("host", "path", "key").agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.octet_length("html")).alias("size"))
    ranked = numbered(names.withColumn("tree", F.lit("")), ["host", "path", "key"], "html-names").select(
        "host", "path", "key", "n_rows", "size", "idx")
    n, size, n_rows = ranked.agg(F.count(F.lit(1)), F.sum("size"), F.sum("n_rows")).first()
    if not n:
        return Parts([], {}, set())
    spark = rows.sparkSession

    def name(r) -> tuple[bytes, bytes, bytes]:
        return r["host"].encode(), r["path"].encode(), bytes(r["key"])

    hot = {name(r) for r in ranked.where(F.col("n_rows") > max(hot_copies, n_rows // 100_000)).collect()}
    count = max(1, min(MAX_PARTS, n, -(-size // part_bytes)))
    firsts = sorted({p * n // count for p in range(count)})

    def at(places: set[int]) -> dict[int, tuple[bytes, bytes, bytes]]:
        """Names at some places, at most a few for each part."""
        wanted = spark.createDataFrame([(i,) for i in sorted(places)], "idx long")
        return {r["idx"]: name(r) for r in ranked.join(F.broadcast(wanted), "idx").collect()}

    near = {j for i in firsts[1:] for j in range(max(0, i - NEAR), min(n, i + NEAR))}
    known = at(near | set(firsts))
    # the paths that stand at a cut, and the pages beside them
    cut = {known[j][:2] for i in firsts[1:] for j in (i - 1, i)}
    at_cut = spark.createDataFrame([(h.decode(), p.decode()) for h, p in sorted(cut)], "host string, path string")
    ends = {(r["host"].encode(), r["path"].encode()): (r["a"], r["b"]) for r in ranked.join(
        F.broadcast(at_cut), ["host", "path"]).groupBy("host", "path").agg(F.min("idx").alias("a"), F.max("idx").alias("b")).collect()}
    known |= at({j for a, b in ends.values() for j in (a - 1, b + 1) if 0 <= j < n})
    also: dict[tuple[bytes, bytes, bytes], set[int]] = {}
    for p, i in enumerate(firsts):
        last = (firsts[p + 1] if p + 1 < len(firsts) else n) - 1
        wanted = {*range(i - NEAR, i), *range(last + 1, last + 1 + NEAR)}
        if i:
            wanted.add(ends[known[i][:2]][0] - 1)
        if last + 1 < n:
            wanted.add(ends[known[last][:2]][1] + 1)
        for j in wanted:
            if 0 <= j < n and not i <= j <= last:
                also.setdefault(known[j], set()).add(p)
    return Parts([known[i] for i in firsts], {k: sorted(v) for k, v in also.items()}, hot)


def extract_text(pages: DataFrame, part_bytes: int = PART_BYTES, hot_copies: int = HOT_COPIES) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    spark = pages.sparkSession
    ship_package(spark)
    rows = named_rows(pages)
    parts = plan_parts(rows, part_bytes, hot_copies)
    id_type = dict(rows.dtypes)["page_id"]
    ddl = f"part int, host string, path string, key binary, page_id {id_type}, url string, html string, own boolean"

    def deal(batches):
        """Rows with their part; the html with the first of equal pages in this task only."""
        seen = set()
        for b in batches:
            take, part, own, bare = [], [], [], []
            for i, (h, p, k) in enumerate(zip(*(b.column(j).to_pylist() for j in range(3)))):
                name = (h.encode(), p.encode(), k)
                first, hot = name not in seen, name in parts.hot
                seen.add(name)
                if first or not hot:
                    take.append(i)
                    part.append(parts.of(name))
                    own.append(True)
                    bare.append(not first)
                if first:
                    for q in parts.also.get(name, ()):
                        take.append(i)
                        part.append(q)
                        own.append(False)
                        bare.append(False)
            t = b.take(pa.array(take, pa.int32()))
            text = pc.if_else(pa.array(bare, pa.bool_()), pa.scalar(None, t.column(5).type), t.column(5))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *t.columns[:5], text, pa.array(own, pa.bool_())],
                                             ["part", "host", "path", "key", "page_id", "url", "html", "own"])

    order = ["part", "host", "path", "key", F.isnull("html")]
    # as many partitions as parts: AQE does not join them again to large tasks
    dealt = rows.mapInArrow(deal, ddl).repartition(max(1, len(parts.starts)), "part").sortWithinPartitions(*order)

    def run(hot: bool):
        names = ["key", "host", "path", "page_id", "url", "text"]

        def rows_in(batches):
            for b in pieces(batches, "html"):
                yield from zip(*(c.to_pylist() for c in b.columns))

        def pages_of(group):
            """Pages in order; each collects the rows that are its own."""
            page = None
            for _, host, path, key, page_id, url, source, own in group:
                if page is None or (page.host, page.path, page.key) != (host, path, key):
                    if page is not None:
                        yield page
                    page = _Page(host, path, key, source or "")
                if own and ((host.encode(), path.encode(), key) in parts.hot) == hot:
                    page.copies.append((page_id, url))
            if page is not None:
                yield page

        def texts(batches):
            out, size = [], 0
            for _, group in itertools.groupby(rows_in(batches), key=lambda r: r[0]):
                for page, other in with_neighbours(pages_of(group)):
                    text = main_text(page.lines, other.lines if other else None)
                    for page_id, url in page.copies[:1] if hot else page.copies:
                        out.append((page.key, page.host, page.path, page_id, url, text))
                        size += len(text) + 64
                        if size > 1 << 20:
                            yield batch(out)
                            out, size = [], 0
            if out:
                yield batch(out)

        def batch(out):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], names)

        schema = to_arrow_schema(StructType([dealt.schema[c] if c != "text" else StructField(c, StringType()) for c in names]))
        return dealt.mapInArrow(texts, ", ".join(f"{c} {dict(dealt.dtypes).get(c, 'string')}" for c in names))

    out = run(False).select("page_id", "url", "text")
    if parts.hot:
        name = ["host", "path", "key"]
        hot = spark.createDataFrame([(h.decode(), p.decode(), bytearray(k)) for h, p, k in sorted(parts.hot)],
                                    "host string, path string, key binary")
        copies = rows.select(*name, "page_id", "url").join(F.broadcast(hot), name, "left_semi")
        out = out.union(copies.join(run(True).select(*name, "text"), name).select("page_id", "url", "text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages"))
