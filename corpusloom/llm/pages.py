"""Main text of web pages by nearest-URL page differencing.

A page is cut into block lines, each with the place it has in the markup. Pages are ordered by host and
URL path and paired with the nearest page by path; a longest common subsequence aligns the two
lists of lines, and lines that both pages share are the site's and not the article's: they are deleted.

Two things keep this right where the plain rule fails. A line inside a marked article (``article``,
``main``) is the author's word that it belongs to the text, so a shared one stays there: articles do
quote common passages. And a neighbour that shares nearly all characters, lines dropped by place left aside, is a copy of the
page, which says nothing about the site; the nearest page that differs is asked instead, however many copies lie between. Lines whose place names what they are (menus,
headers, footers, sidebars, notices, adverts, forms, reader comments) go in any case, as a page may
have no neighbour.
"""

from __future__ import annotations

import heapq
import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.batches import map_batches
from corpusloom.plans.ranking import with_prefix
from corpusloom.session import materialize

NEIGHBOURS = 2
COPY_SHARE = 0.9
CHUNK_ROWS = 256
SALTS = 64
NOWHERE = 1 << 62

# ---- fixed values: elements of HTML
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style noscript template iframe object textarea title canvas noembed noframes xmp foreignobject"
DROPPED = frozenset("nav header footer aside form button select dialog menu option label fieldset head search".split())
CLOSED_BY_BLOCK = frozenset(["p"])
FOREIGN = frozenset(["svg", "math"])  # may close themselves and nest; a block in them ends them
MARKED = frozenset(["article", "main"])
# ---- words in class, id and role that name what a block is
NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promos promotion "
    "banner banners menu menus nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer sidebar sidebars aside "
    "widget widgets cookie cookies consent gdpr notice notices notification notifications alert alerts popup popups modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations pagination pager "
    "search toolbar skip complementary contentinfo hidden toc".split()
)
TALK = frozenset("comment comments respond replies disqus".split())
NOT_NAMED = frozenset("has no with without is".split())  # has-sidebar tells of a page, it is no sidebar
OWN_HEADERS = frozenset("entry post article story section content page".split())
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|"
    rf"<(?P<raw>{RAW.replace(' ', '|')})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)|"
    r"<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|"
    r"<(?P<broken>/?[a-zA-Z][^<>]*)>?", re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)


def _named(attributes: str) -> tuple[bool, bool]:
    """Whether a block's names say that it is no main text, and that it holds reader comments."""
    if not attributes:
        return False, False
    named, talk = bool(HIDDEN.search(attributes)), False
    for found in ATTRIBUTE.findall(attributes):
        for name in "".join(found).lower().split():
            parts = re.split("[_-]+", name)
            if parts[0] in NOT_NAMED:
                continue
            words = set(parts)
            if parts[0] in OWN_HEADERS:
                words.discard("header")
            named = named or not NAMES.isdisjoint(words)
            talk = talk or not TALK.isdisjoint(words)
    return named, talk


def block_lines(page: str | None) -> list[tuple[str, bool, bool]]:
    """``(text, dropped, marked)`` of each block in page order, empty ones left out.

    ``dropped``: the place says it is no main text; ``marked``: it stands in an article. Character
    references are decoded and runs of white space become one space. Elements that are never closed end
    with the element around them, ``p`` with the next block.
    """
    if not page:
        return []
    lines: list[tuple[str, bool, bool]] = []
    parts: list[str] = []
    # Depths of what drops a line by element, by name and as comments, of articles around it, and of inline
    # elements that drop their own text out of a line.
    by_element = by_name = talk = marked = muted = 0
    told = False  # whether an article has had its say
    stack: list[tuple[str, int, int, int, int, int]] = []

    def end_line() -> None:
        nonlocal told
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            if text:
                dropped = by_element + by_name + talk > 0
                lines.append((text, dropped, marked > 0))
                told = told or marked > 0 and not dropped

    def leave(at: int) -> None:
        nonlocal by_element, by_name, talk, marked, muted
        _, by_element, by_name, talk, marked, muted = stack[at]
        del stack[at:]

    position = 0
    for found in TOKEN.finditer(page):
        if found.start() > position and not muted:
            parts.append(page[position:found.start()])
        position = found.end()
        name = found.group("name")
        if name is None:
            if found.group("raw"):
                parts.append(" ")
            continue
        name = name.lower()
        block = name in BLOCKS
        if name == "br":
            parts.append(" ")
            continue
        if block:
            end_line()
        if found.group("close"):
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == name:
                    leave(at)
                    break
                # An inline element cannot close a block around it.
                if not block and stack[at][0] in BLOCKS:
                    break
            continue
        attributes = found.group("attributes")
        if name in VOID or attributes.endswith("/"):
            continue
        if block:
            # A block ends drawings and formulas, an open paragraph, and the inline elements left open in it.
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] in FOREIGN:
                    leave(at)
                elif stack[at][0] in CLOSED_BY_BLOCK:
                    leave(at)
                    break
                elif stack[at][0] in BLOCKS:
                    break
        named, comments = _named(attributes)
        if not block and name not in DROPPED and name not in FOREIGN and not named and not comments:
            continue
        if stack and stack[-1][0] == name and name in ("li", "option", "tr", "td", "th", "dt", "dd"):
            leave(len(stack) - 1)
        stack.append((name, by_element, by_name, talk, marked, muted))
        if not block:
            muted += 1
            continue
        # The heading of an article is its own; only headers of the page are dropped.
        if name in DROPPED and not (name == "header" and marked):
            by_element += 1
        talk += comments
        if name in MARKED:
            marked += 1
            if not talk and not told:
                by_name = 0  # a wrapper's name does not decide about the article in it, only about teasers after it
        elif name not in ("body", "html"):
            by_name += named
    if position < len(page) and not muted:
        parts.append(page[position:])
    end_line()
    return lines


def common_lines(a: list[int], b: list[int]) -> np.ndarray:
    """Which places of ``a`` are in a longest common subsequence with ``b``.

    Equal ends are taken off; the rest is solved with one bit row per line, so a thousand lines against
    a thousand need a thousand numbers of a thousand bits.
    """
    shared = np.zeros(len(a), bool)
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        shared[start] = True
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
        shared[len(a) - end] = True
    left, right = a[start:len(a) - end], b[start:len(b) - end]
    if not left or not right or not set(left) & set(right):
        return shared
    full = (1 << len(right)) - 1
    where: dict[int, int] = {}
    for i, x in enumerate(right):
        where[x] = where.get(x, 0) | 1 << i
    # A zero bit j in row i: the best of left[:i] against right[:j + 1] is greater than against right[:j].
    rows = [full]
    for x in left:
        row = rows[-1]
        both = row & where.get(x, 0)
        rows.append(((row + both) | (row - both)) & full)
    i, j = len(left), len(right)
    while i and j:
        if left[i - 1] == right[j - 1]:
            shared[start + i - 1] = True
            i, j = i - 1, j - 1
        elif rows[i] >> (j - 1) & 1:
            j -= 1  # right[j - 1] adds nothing
        else:
            i -= 1
    return shared


Page = tuple[list[int], list[int]]  # hashes of the lines, and their characters, 0 for lines that their place drops


def copies(own: Page, other: Page, shared: np.ndarray) -> bool:
    """Whether the lines that two pages share hold ``COPY_SHARE`` of their characters."""
    common = int(np.asarray(own[1], np.int64)[shared].sum())
    return common > 0 and 2 * common >= COPY_SHARE * (sum(own[1]) + sum(other[1]))


def differ(a: Page, b: Page) -> bool:
    """Whether ``b`` is no copy of ``a``; lines in any order give a bound that mostly decides."""
    if a[0] == b[0]:
        return not any(a[1])
    left = Counter(b[0])
    bound = 0
    for line, size in zip(*a):
        if left[line] > 0:
            left[line] -= 1
            bound += size
    if 2 * bound < COPY_SHARE * (sum(a[1]) + sum(b[1])):
        return True
    return not copies(a, b, common_lines(a[0], b[0]))


def shared_lines(own: Page, others: Iterable[Page]) -> list[int] | None:
    """Places of ``own`` that the first page shares which is no copy of it; None if all are."""
    for other in others:
        if own[0] == other[0] and any(own[1]):
            continue
        shared = common_lines(own[0], other[0])
        if not copies(own, other, shared):
            return np.flatnonzero(shared).tolist()
    return None


def sorted_lines(page: str | None) -> tuple[list[str], list[int], list[int]]:
    """The block lines of a page, and the places of those in an article and of the undecided ones.

    Lines that their place drops are empty in the list, so that a line's place is its index.
    """
    lines = block_lines(page)
    texts = ["" if dropped else text for text, dropped, _ in lines]
    marked = [i for i, (_, dropped, inside) in enumerate(lines) if inside and not dropped]
    undecided = [i for i, (_, dropped, inside) in enumerate(lines) if not inside and not dropped]
    return texts, marked, undecided


def main_text(page: str | None, shared: list[int]) -> str:
    """Blocks that are left after named places and shared lines outside articles are deleted."""
    texts, marked, undecided = sorted_lines(page)
    return "\n\n".join(texts[i] for i in sorted({*marked, *(set(undecided) - set(shared))}))


def path_key(url):
    """``host`` and ``path`` of a URL column, the order in which neighbours are sought."""
    address = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^#]*)"
    host = F.lower(F.regexp_extract(url, address, 1))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, address, 2), F.lit(""))


def _numbered(keys: DataFrame) -> DataFrame:
    """``keys`` with a place along host, path and key; ranges are numbered apart and then shifted."""
    order = [F.col("host"), F.col("path"), F.col("key")]
    ranged = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    local = materialize(ranged.withColumn("serial", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("serial", 33)
    sizes = local.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    # One row per range of the sort.
    placed = local.join(F.broadcast(shifts), part == F.col("part"))
    return placed.withColumn("place", F.col("shift") + F.col("serial").bitwiseAND(F.lit((1 << 33) - 1))).drop("serial", "part", "shift")


Row = tuple  # place, home chunk, key, host, path, lines, sizes


def _nearest_first(rows: list[Row], i: int, fresh: list[bool]) -> Iterator[Page]:
    """Pages of the same host in ``rows``: the direct neighbours by path, then the near ends of the runs of copies beyond."""
    _, _, _, host, path, _, _ = rows[i]

    def page(j: int) -> Page:
        return rows[j][5], rows[j][6]

    near = [j for j in range(max(0, i - NEIGHBOURS), min(len(rows), i + NEIGHBOURS + 1)) if j != i and rows[j][3] == host]
    yield from map(page, sorted(near, key=lambda j: (-_alike(path, rows[j][4]), abs(j - i), j)))

    def before() -> Iterator[int]:
        for j in range(i - NEIGHBOURS - 1, -1, -1):
            if rows[j][3] != host:
                return
            if fresh[j + 1]:
                yield j

    def after() -> Iterator[int]:
        for j in range(i + NEIGHBOURS + 1, len(rows)):
            if rows[j][3] != host:
                return
            if fresh[j]:
                yield j

    yield from map(page, heapq.merge(before(), after(), key=lambda j: (abs(j - i), j)))


def _by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[Row]]]:
    """The rows of each chunk of sorted batches; a chunk is held at a time."""
    number, rows = None, []
    for batch in batches:
        for chunk, *row in zip(*[c.to_pylist() for c in batch.columns]):
            if chunk != number and rows:
                yield number, rows
                rows = []
            number = chunk
            rows.append(tuple(row))
    if rows:
        yield number, rows


def _compare_in_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, place, fresh, shared, open``: ``fresh`` pages are no copy of the one before, ``open`` ones met only copies."""
    for number, rows in _by_chunk(batches):
        fresh = [True] + [a[3] != b[3] or differ(a[5:], b[5:]) for a, b in zip(rows, rows[1:])]
        out = []
        for i, (place, home, key, host, _, lines, sizes) in enumerate(rows):
            if home != number:
                continue
            shared = shared_lines((lines, sizes), _nearest_first(rows, i, fresh))
            beyond = shared is None and host in (rows[0][3], rows[-1][3])
            out.append((key, place, fresh[i], None if beyond else shared or [], beyond))
        columns = list(zip(*out)) or [()] * 5
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.int32()), pa.bool_()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "place", "fresh", "shared", "open"]
        )


def _compare_beyond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, shared`` of open pages against the pages from beyond their chunk, which have no key."""
    for _, rows in _by_chunk(batches):
        outer = [r for r in rows if r[2] is None]
        keys, shared = [], []
        for place, _, key, host, path, lines, sizes in rows:
            if key is None:
                continue
            near = sorted((r for r in outer if r[3] == host), key=lambda r: (-_alike(path, r[4]), abs(r[0] - place)))
            keys.append(key)
            shared.append(shared_lines((lines, sizes), [r[5:] for r in near]) or [])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(shared, pa.list_(pa.int32()))], names=["key", "shared"])


def _from_beyond(placed: DataFrame, first: DataFrame) -> DataFrame:
    """``key, shared`` of the open pages, each compared with the ends of its run of copies outside its chunk.

    A run may hold any number of chunks: running maxima over one row per chunk carry the nearest break to
    it, and the page at a break that many chunks ask for is dealt out in ``SALTS`` copies.
    """
    chunk = F.floor(F.col("place") / CHUNK_ROWS)
    breaks = first.groupBy(chunk.alias("chunk")).agg(
        F.max(F.when(F.col("fresh"), F.col("place")).otherwise(-1)).alias("last"),
        F.max(F.when(F.col("fresh"), -F.col("place")).otherwise(-NOWHERE)).alias("first"),
        F.max("open").alias("open"),
    )
    # Both running maxima leave the chunk itself out; they skip no NULLs, so chunks without a break have numbers too.
    left = with_prefix(breaks, [F.col("chunk")], {"before": ("max", "last")}).filter("open")
    right = with_prefix(breaks, [F.col("chunk").desc()], {"after": ("max", "first")}).filter("open")
    wanted = left.select("chunk", (F.col("before") - 1).alias("place")).union(right.select("chunk", (-F.col("after")).alias("place")))
    wanted = materialize(wanted.filter("place >= 0").withColumn("salt", F.pmod("chunk", F.lit(SALTS))), "wanted")
    pages = wanted.select("place", "salt").distinct().join(placed, "place")
    names = ["chunk", "place", "home", "key", "host", "path", "lines", "sizes"]
    no_key = pages.withColumns({"key": F.lit(None).cast("string"), "home": F.lit(None).cast("bigint")})
    outer = wanted.join(no_key, ["place", "salt"]).select(names)
    opened = first.filter("open").select("place").join(placed, "place").withColumns({"chunk": chunk, "home": chunk})
    both = opened.select(names).union(outer)
    return both.repartition("chunk").sortWithinPartitions("chunk", "place").mapInArrow(_compare_beyond, "key string, shared array<int>")


def shared_by_page(pages: DataFrame) -> DataFrame:
    """``key, shared`` for every page of ``key, url, html``: the places of lines shared with a neighbour.

    Only hashes and sizes of lines move; equal keys are one page. Pages in order are dealt into chunks of ``CHUNK_ROWS``, each with the
    nearest pages of the chunks beside it, so a host of any size is spread and no task needs more than
    one chunk. Where a run of copies fills a chunk, its pages meet the pages at the ends of the run; where
    these are copies too, nothing is shared.
    """
    host, path = path_key(F.col("url"))
    source = pages.select("key", host.alias("host"), path.alias("path"), "html")

    def setup():
        def work(keys, hosts, paths, texts):
            digest = xxhash.xxh64_intdigest
            found = [block_lines(x) for x in texts]
            lines = [[digest(t) >> 1 for t, _, _ in page] for page in found]
            return [keys, hosts, paths, lines, [[0 if dropped else len(t) for t, dropped, _ in page] for page in found]]

        return work

    hashed = map_batches(source, "key string, host string, path string, lines array<bigint>, sizes array<int>", setup)
    # Written, as the bounds of the ranges are drawn from it before it is cut at them.
    placed = _numbered(materialize(hashed.dropDuplicates(["key"]), "lines"))
    chunk = F.floor(F.col("place") / CHUNK_ROWS)
    low = F.floor((F.col("place") - NEIGHBOURS) / CHUNK_ROWS)
    high = F.floor((F.col("place") + NEIGHBOURS) / CHUNK_ROWS)
    dealt = placed.select(
        F.explode(F.sequence(low, high)).alias("chunk"), "place", chunk.alias("home"), "key", "host", "path", "lines", "sizes"
    )
    sorted_chunks = dealt.repartition("chunk").sortWithinPartitions("chunk", "place")
    schema = "key string, place bigint, fresh boolean, shared array<int>, open boolean"
    first = materialize(sorted_chunks.mapInArrow(_compare_in_chunks, schema), "compared")
    settled = first.filter("NOT open").select("key", "shared")
    return settled if first.filter("open").isEmpty() else settled.union(_from_beyond(placed, first))


def _alike(a: str, b: str) -> int:
    """Length of the common beginning of two paths."""
    count = 0
    for x, y in zip(a, b):
        if x != y:
            break
        count += 1
    return count


def extract(df: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``id, url, text`` for every row of ``df``; ``text`` is empty where nothing is left.

    NULL html counts as empty; a NULL or odd URL is its own place in the order. Repeated rows are one page
    to their neighbours and stay rows in the result. Other columns are ignored. Pages of any length are
    read whole; an empty table gives an empty table.
    """
    kind = df.schema[id_column].dataType.simpleString()
    empty = F.lit("")
    parts = [F.col(c).cast("string") for c in (id_column, url_column, html_column)]
    key = F.md5(F.concat_ws("|", *[F.coalesce(F.length(p).cast("string"), F.lit("-")) for p in parts], *[F.coalesce(p, empty) for p in parts]))
    rows = df.select(key.alias("key"), F.col(id_column).alias("id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"))

    def setup():
        def work(keys, ids, urls, texts):
            return [keys, ids, urls, *map(list, zip(*map(sorted_lines, texts)))] if keys else [[]] * 6

        return work

    schema = f"key string, id {kind}, url string, texts array<string>, marked array<int>, undecided array<int>"
    # Texts move once, to meet their page's marks; what is deleted by place stays behind.
    joined = map_batches(rows, schema, setup).join(shared_by_page(rows.select("key", "url", "html")), "key", "left")
    left = F.array_except("undecided", F.coalesce("shared", F.array().cast("array<int>")))
    kept = F.sort_array(F.array_union("marked", left))
    text = F.array_join(F.transform(kept, lambda i: F.get("texts", i)), "\n\n")
    return joined.select(F.col("id").alias(id_column), F.col("url").alias(url_column), text.alias("text"))
