"""Main text of web pages by differencing pages that lie next to each other.

Pages of one host are put in the order of their URL paths and each is compared
with its nearest neighbours, two on each side: lines that two of them have, aligned
by longest common subsequence, are the site's furniture and are deleted (on hosts
of two pages, lines that the other has). What is never text
(scripts, styles, comments in the markup) is no line at all. An exact check by
the page's own structure follows: lines inside elements that name themselves
furniture (navigation, header, footer, sidebar, notices, adverts, forms, reader
comments) go even where no neighbour has them, and where a page marks its main
part only lines of that part stay.

Deleting what pages share has two limits, or it would delete articles. A line that
only one neighbour has stays, as a copied article does; and where nothing would be
left of a page, only lines of more neighbours go, so that the article of several
copies stays and the menu around them goes. If all neighbours are copies, all lines
stay. And articles quote the same passages: paragraphs, headings, list items and
cells inside a marked main part stay although they are shared; other lines there go.

Hosts of any size: all pages are dealt into ranges of one order (host, path, URL,
page id, content), whose bounds come from a sample. Pages near a bound are in both
ranges, where they serve as neighbours, so the ranges change no result and no host
is one task. A task holds five pages at a time.

Defined cases: null html counts as empty and gives an empty text; pages with a
null URL, or without a host, are only compared with each other; a page that is
alone is taken as it is; of repeated rows each is a neighbour of the other; null page ids are carried through;
further columns of the input are left out.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.shipping import map_batches
from marquee.llm.url_model import with_host_path

#: Pages that are worth a part of their own.
BUCKET_PAGES = 256
#: Neighbours on each side.
REACH = 2
#: Parts for each shuffle partition, at most, and pages of the sample for each part.
PARTS_PER_PARTITION, SAMPLED = 4, 64
SCHEMA = "page_id long, url string, text string, n_chars long"

# Elements that are furniture by their name.
FURNITURE = {"head", "template", "object", "svg", "canvas", "nav", "header", "footer", "aside", "form", "button", "select", "textarea", "dialog", "menu"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
MAIN = {"article", "main"}
UNMARKED = MAIN | {"body", "html"}
RUNNING = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "blockquote", "pre", "caption", "figcaption"}
# Kinds of lines.
PLAIN, LOOSE, TEXT, FURNISHED = range(4)
# Words of a class, id or role that mark furniture.
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|advertisement|banner|sponsor|sponsored|promo|cookie|cookies|consent|notice|popup|modal|"
    r"nav|navbar|navigation|menu|breadcrumb|breadcrumbs|sidebar|side|widget|header|footer|comment|comments|disqus|reply|replies|"
    r"share|sharing|social|related|newsletter|subscribe|signup|login|search|toolbar|pagination|pager|copyright|skip|contentinfo|complementary)(?:$|[\s_-])",
    re.I,
)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)",
    re.S,
)
RAW_END = {name: re.compile(rf"</{name}\s*[^>]*>", re.I) for name in ("script", "style", "title", "textarea", "noscript", "iframe")}
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"\b(?:hidden\b(?!\s*=\s*[\"']?until)|aria-hidden\s*=\s*[\"']?true)", re.I)
#: A start tag ends open elements of these names, as far as the nearest element that isn't one.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def page_lines(page: str) -> list[tuple[str, int]]:
    """Text lines (blocks) of a page in order, each with its kind.

    White space inside a block becomes one space, character references are
    decoded, elements that stand in running text do not end a block.
    """
    lines: list[tuple[str, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # name, furniture, in the main part, in running text
    furnished = main = running = False
    at, size = 0, len(page)

    def end_block() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            lines.append((text, FURNISHED if furnished else TEXT if main and running else LOOSE if main else PLAIN))

    def leave(depth: int) -> None:
        nonlocal furnished, main, running
        del stack[depth:]
        furnished, main, running = stack[-1][1:] if stack else (False, False, False)

    while at < size:
        found = TOKEN.search(page, at)
        parts.append(page[at : found.start() if found else size])
        if not found:
            break
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        inline = name in INLINE
        if not inline:
            end_block()
        if found["close"]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    leave(depth)
                    break
                if inline and stack[depth][0] not in INLINE:
                    break
            continue
        if name in VOID:
            continue
        ends = CLOSES.get(name)
        if ends:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in ends:
                    leave(depth)
                    break
                if stack[depth][0] not in INLINE:
                    break
        raw_end = RAW_END.get(name)
        if raw_end:
            close = raw_end.search(page, at)
            at = close.end() if close else size
            continue
        attrs = found["attrs"]
        furniture = name in FURNITURE and not (name == "header" and main)
        if attrs and not furniture:
            furniture = bool(HIDDEN.search(attrs)) or name not in UNMARKED and any(
                MARKED.search(a or b or c) for a, b, c in ATTRIBUTE.findall(attrs)
            )
        if furniture and inline:
            end_block()
        stack.append((name, furnished or furniture, main or name in MAIN, running or name in RUNNING))
        furnished, main, running = stack[-1][1:]
    end_block()
    return lines


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of a longest common subsequence of lines.

    Only lines that occur in both can take part, so what is compared is small
    for pages that differ in their articles. Memory is one bit per pair of the
    shorter list and the longer one's shared lines.
    """
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    shared = {*range(start), *range(len(a) - end, len(a))}
    left, right = a[start : len(a) - end], b[start : len(b) - end]
    both = set(left) & set(right)
    if both:
        keep = [i for i, x in enumerate(left) if x in both]
        other = [x for x in right if x in both]
        shared |= {start + keep[i] for i in _lcs([left[i] for i in keep], other)}
    return shared


def _lcs(a: list[str], b: list[str]) -> list[int]:
    """Places in ``a``: bit-parallel longest common subsequence, one whole
    number per line of ``a``, then followed backwards."""
    where: dict[str, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    rows = [full]
    for x in a:
        v = rows[-1]
        hit = v & where.get(x, 0)
        rows.append((v + hit | v - hit) & full)
    places, i, j = [], len(a), len(b)
    while i and j:
        # A cleared bit j - 1 of row i: the subsequence of a[:i] and b[:j] is longer than that of b[:j - 1].
        if rows[i] >> j - 1 & 1:
            j -= 1
        elif not rows[i - 1] >> j - 1 & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            places.append(i)
    return places[::-1]


def main_text(lines: list[tuple[str, int]], neighbours: list[list[tuple[str, int]]] | None) -> str:
    """The page's text without what its neighbours have too and without furniture."""
    neighbours = neighbours or []
    held = Counter(i for other in neighbours for i in common_lines([text for text, _ in lines], [text for text, _ in other]))
    own = range(min(2, len(neighbours)), len(neighbours) + 1)
    for need in own if neighbours else ():
        shared = {i for i, n in held.items() if n >= need}
        if any(kind != FURNISHED and i not in shared for i, (_, kind) in enumerate(lines)):
            break
    else:
        shared = set()
    left = [(text, kind) for i, (text, kind) in enumerate(lines) if kind == TEXT or kind != FURNISHED and i not in shared]
    marked = any(kind in (TEXT, LOOSE) for _, kind in left)
    return " ".join(text for text, kind in left if not marked or kind != PLAIN)


def with_key(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``html``, ``host`` and ``_key``, by which all pages are in one order."""
    rows = with_host_path(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    key = F.concat_ws("\0", "host", "path", text("url"), F.lpad(text("page_id"), 20, "0"), F.hex(F.xxhash64("html")))
    return rows.select("page_id", "url", "html", "host", key.alias("_key"))


def bounds(rows: DataFrame, bucket_pages: int) -> list[tuple[str, str | None, str | None]]:
    """First keys of all parts but the first, each with a key that at least two
    pages before it reach and one that it and at least one page after it reach
    (None: all do). All three are keys of a sample of pages."""
    n = rows.count()
    parts = min(-(-n // bucket_pages), PARTS_PER_PARTITION * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if parts < 2:
        return []
    share = SAMPLED * parts / n
    sample = rows.select("_key") if share >= 0.5 else rows.select("_key").sample(share, 1)
    keys = sorted({r["_key"] for r in sample.collect()})
    parts = min(parts, len(keys) // 3)
    at = [k * len(keys) // parts for k in range(1, parts)]
    return [(keys[i], keys[i - 2] if i > 1 else None, keys[i + 1] if i + 1 < len(keys) else None) for i in at]


def dealt(rows: DataFrame, found: list[tuple[str, str | None, str | None]]) -> DataFrame:
    """Adds ``_part`` and ``_own``: pages near a bound are in the next part, too, as its neighbours."""
    if not found:
        return rows.select("*", F.lit(0).alias("_part"), F.lit(True).alias("_own"))
    firsts, froms, untils = (F.lit([x[k] for x in found]) for k in range(3))
    key, n = F.col("_key"), len(found)
    # Binary search for the number of bounds up to the key.
    span = F.aggregate(
        F.sequence(F.lit(1), F.lit(n.bit_length())), F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi")),
        lambda s, _: F.when(s["lo"] >= s["hi"], s)
        .when(F.get(firsts, F.floor((s["lo"] + s["hi"]) / 2).cast("int")) <= key, F.struct((F.floor((s["lo"] + s["hi"]) / 2) + 1).cast("int").alias("lo"), s["hi"].alias("hi")))
        .otherwise(F.struct(s["lo"].alias("lo"), F.floor((s["lo"] + s["hi"]) / 2).cast("int").alias("hi"))),
    )
    placed = rows.withColumn("_p", span["lo"])
    p = F.col("_p")
    place = lambda part, own: F.struct(part.alias("_part"), F.lit(own).alias("_own"))
    before = (p > 0) & F.coalesce(key <= F.get(untils, p - 1), F.lit(True))
    after = (p < n) & F.coalesce(key >= F.get(froms, p), F.lit(True))
    places = F.array(place(p, True), F.when(before, place(p - 1, False)), F.when(after, place(p + 1, False)))
    return placed.select(*rows.columns, F.inline(F.filter(places, lambda x: x.isNotNull())))


def extract(pages: DataFrame, bucket_pages: int = BUCKET_PAGES) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of each page."""
    rows = with_key(pages)
    ready = (
        dealt(rows, bounds(rows, bucket_pages)).repartition("_part").sortWithinPartitions("_part", "_key")
        .select("page_id", "url", "html", "host", "_part", "_own")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near: list[_Page] = []  # pages of one part and host: two that are done, and those that wait for two more
        done: list[tuple[int, str, str]] = []
        first = group = None  # first: place in ``near`` of the first page that waits

        def finish(waiting: int) -> None:
            nonlocal first
            while first < len(near) - waiting:
                page = near[first]
                if page.own:
                    others = near[max(first - REACH, 0) : first] + near[first + 1 : first + 1 + REACH]
                    done.append((page.page_id, page.url, main_text(page.lines, [o.lines for o in others])))
                first += 1
            del near[: max(first - REACH, 0)]
            first = min(first, REACH)

        first = 0
        for batch in batches:
            for page_id, url, page, host, part, own in zip(*(c.to_pylist() for c in batch.columns)):
                if group != (host, part):
                    finish(0)
                    near.clear()
                    first, group = 0, (host, part)
                near.append(_Page(page_id, url, page or "", own))
                finish(REACH)
            yield _texts(done)
            done.clear()
        finish(0)
        yield _texts(done)

    return ready.transform(map_batches, run, SCHEMA)


class _Page:
    def __init__(self, page_id: int, url: str, page: str, own: bool):
        self.page_id, self.url, self.page, self.own = page_id, url, page, own

    @cached_property
    def lines(self) -> list[tuple[str, int]]:
        return page_lines(self.page)


def _texts(rows: list[tuple[int, str, str]]) -> pa.RecordBatch:
    ids, urls, texts = zip(*rows) if rows else ((), (), ())
    columns = [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])
