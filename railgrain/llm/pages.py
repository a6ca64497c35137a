"""Main text of web pages by differencing each page with its nearest neighbours by URL.

A small parser turns a page into text lines (blocks) and drops what its markup names: menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles, comments of readers.  Where a page marks its article (``article`` or
``main``), the lines are those inside it.  Lines are compared with those of the nearest different page in URL order on the
same host, lines of articles with lines of articles: a longest common subsequence aligns the two, and shared lines go;
of a marked article, only those that are common on the host (on a quarter of its different pages, and on three) and no
headings, because two articles may well say the same.  Pages with the same lines are one in that order.  A page that has nearly all of another's own lines, those
that are not common on the host, is a copy too and says nothing about its frame; the search then goes on further away.

Only hashes of lines travel to neighbours.  The order is a range sort over all hosts and a join on the place in it, so a
host with a third of all pages is not one task.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import parts, slices, table, written

#: A neighbour that has more of a page's own lines than this is a copy.
COPY = 0.8
#: Common lines are on this part of a host's different pages, and on three of them (or both).
COMMON = 0.25
#: How far away, in places either way, pages are tried after the nearest ones.
_FURTHER = [2 ** k for k in range(1, 24)]

# Element and class names.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
                   "option p pre section select summary table tbody td tfoot th thead title tr ul".split())
_DROP = frozenset("aside button canvas dialog footer form head iframe menu nav noscript object script select style svg "
                  "template textarea title".split())
_RAW = frozenset("script style textarea title".split())
_ARTICLE = frozenset(("article", "main"))
_HEADING = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_CLOSES = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dd", ("dl",)), "dd": ("dt", ("dl",)), "tr": ("tr", ("table",)),
           "td": ("td", ("tr", "table")), "th": ("th", ("tr", "table")), "option": ("option", ("select",))}
_NAMES = ("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner cookie "
          "cookies consent gdpr notice notices alert newsletter subscribe subscription signup popup modal overlay sidebar "
          "rail widget widgets menu nav navbar navigation breadcrumb breadcrumbs masthead header topbar footer comment "
          "comments reply replies disqus respond discussion share sharing social related recommended recommendations "
          "pagination pager toolbar login search").split()
_NAMED = re.compile(rf"(?:{'|'.join(_NAMES)})(?:[-_]\w+)*|(?:site|page|left|right|top|bottom|main|user|reader|global)[-_]"
                    rf"(?:{'|'.join(_NAMES)})", re.I)
_HEADER = re.compile(r"(?:site[-_]|page[-_])?(?:header|masthead|topbar|banner)(?:[-_]\w+)*", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+)|<",
                    re.S)
_ATTRIBUTE = re.compile(r"([^\s=/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([^\s=/]+)")


def _dropped(tag: str, attributes: str, inside: bool) -> bool:
    if tag in _DROP or tag == "header" and not inside:
        return True
    if not attributes.strip() or tag in ("html", "body") or tag in _ARTICLE:
        return False
    for name, a, b, c, alone in _ATTRIBUTE.findall(attributes):
        name, value = (name or alone).lower(), a or b or c
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name == "role" and value.lower() in _ROLES:
            return True
        if name in ("class", "id"):
            for word in value.split():
                if _NAMED.fullmatch(word) and not (inside and _HEADER.fullmatch(word)):
                    return True
    return False


def lines_of(page: str) -> tuple[list[str], bool]:
    """Text lines of a page without what the markup names as frame, and whether they come from a marked article."""
    lines, marked, _ = read_page(page)
    return lines, marked


def read_page(page: str) -> tuple[list[str], bool, list[bool]]:
    """What :func:`lines_of` gives, and which lines are headings."""
    stack: list[tuple[str, bool, bool]] = []  # element, dropped, inside an article
    all_lines: list[tuple[str, bool]] = []
    article: list[tuple[str, bool]] = []
    piece: list[str] = []
    found, raw, place = False, "", 0

    def flush() -> None:
        if piece:
            line = " ".join(html.unescape("".join(piece)).split())
            piece.clear()
            if line:
                heading = any(tag in _HEADING for tag, *_ in stack)
                all_lines.append((line, heading))
                if stack and stack[-1][2]:
                    article.append((line, heading))

    def close(tag: str, stop: tuple[str, ...] = ()) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                del stack[i:]
                return
            if stack[i][0] in stop:
                return

    while place < len(page):
        if raw:  # up to its end tag nothing is markup
            end = re.compile(rf"</{raw}\s*>", re.I).search(page, place)
            if end is None:
                break
            place, raw = end.end(), ""
            stack.pop()
            continue
        m = _TOKEN.match(page, place)
        place = m.end()
        tag = m[2] and m[2].lower()
        if tag is None:
            text = m[4] or ("<" if m[0] == "<" else "")
            if text and not (stack and stack[-1][1]):
                piece.append(text)
            continue
        if tag == "br":
            piece.append(" ")
            continue
        if tag in _BLOCK:
            flush()
        if m[1]:
            if tag not in _VOID:
                close(tag, () if tag in _BLOCK else tuple(_BLOCK))
            continue
        if tag in _VOID:
            continue
        if tag in _BLOCK and tag != "p":
            close("p", ("table", "td", "button", *_ARTICLE))
        elif tag == "p":
            close("p", tuple(_BLOCK - {"p"}))
        if tag in _CLOSES:
            for also in {tag, _CLOSES[tag][0]}:
                close(also, _CLOSES[tag][1])
        if tag == "body" or tag in _ARTICLE and stack and stack[-1][1] and not any(
                d and t in ("div", "section") for t, d, _ in stack):
            while stack and stack[-1][1]:  # a frame element that was never closed
                stack.pop()
        up = stack[-1] if stack else ("", False, False)
        drop = up[1] or _dropped(tag, m[3], up[2])
        inside = (up[2] or tag in _ARTICLE) and not drop
        found |= inside and tag in _ARTICLE
        stack.append((tag, drop, inside))
        if tag in _RAW:
            raw = tag
    flush()
    marked = bool(found and article)
    out = article if marked else all_lines
    return [line for line, _ in out], marked, [heading for _, heading in out]


def shared(a: list[int], b: list[int]) -> list[bool]:
    """Which items of ``a`` lie on a longest common subsequence with ``b``; one word operation per 64 items of ``b``."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    ones = (1 << len(b)) - 1
    v, rows = ones, []
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & ones
        rows.append(v)
    on, i, j = [False] * len(a), len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        if a[i] == b[j]:
            on[i] = True
            i, j = i - 1, j - 1
        elif rows[i] >> j & 1:
            j -= 1
        else:
            i -= 1
    return on


def _split_url(url: str | None) -> tuple[str, str]:
    try:
        u = urlsplit(url or "")
        return (u.hostname or "").removeprefix("www."), u.path.rstrip("/")
    except ValueError:
        return "", url or ""


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row per row of ``pages``: key, url, lines (the blocks kept), n_shared (lines deleted by differencing).

    A null page is empty.  A null or broken URL belongs to the host "".  Equal URLs are neighbours in order of the key;
    repeated rows stay.  Other columns are left out.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for whole in batches:
            for b in slices(whole, 2):
                split = [_split_url(u) for u in b.column(1).to_pylist()]
                read = [read_page(page or "") for page in b.column(2).to_pylist()]
                # The last bit of a hash tells headings from other lines.
                hashes = [[(xxhash.xxh3_64_intdigest(x) - (1 << 63)) & -2 | h for x, h in zip(lines, heads, strict=True)]
                          for lines, _, heads in read]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), *(pa.array([x[i] for x in split], pa.string()) for i in (0, 1)),
                     pa.array([x for x, *_ in read], pa.list_(pa.string())), pa.array(hashes, pa.list_(pa.int64())),
                     pa.array([x for _, x, _ in read], pa.bool_())],
                    ["key", "url", "host", "path", "lines", "hashes", "marked"])

    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.col(source).alias("html"))
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, url string, host string, path string, lines array<string>, hashes array<long>, marked boolean"
    parsed = written(rows.mapInArrow(parse, schema).withColumn("id", F.monotonically_increasing_id()), "lines")
    parsed = parsed.withColumn("sig", F.xxhash64("host", "marked", "hashes"))
    gone = written(differences(parsed), "shared_lines")
    kept = F.filter("lines", lambda x, i: ~F.coalesce(F.get("gone", i), F.lit(False)))
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(kept)
    out = parsed.join(gone, "sig", "left")
    out = out.select("key", "url", kept.alias("lines"), (F.size("lines") - F.size(kept)).cast("long").alias("n_shared"))
    return out.withColumnsRenamed({"key": key, "url": url})


def differences(parsed: DataFrame) -> DataFrame:
    """sig and gone (a flag for each line) of pages that lose lines to another page.

    ``parsed`` has id, key, host, path, hashes, marked and sig, which is equal for pages of a host with the same lines.  All
    different pages are in the order, and each is compared with the page before it and the page after it on its host, the
    one with the longer common path first; where both are copies, with pages further away, the nearest first.  Pages with a
    marked article are an order of their own.
    """
    spark = parsed.sparkSession
    order = ["host", "marked", "path", "key", "id"]
    pages = parsed.where(F.size("hashes") > 0).groupBy("sig").agg(
        F.min(F.struct(*order)).alias("at"), F.first("hashes").alias("hashes")).select("at.*", "sig", "hashes")
    pages = written(pages, "different_pages")
    site = ["host", "marked"]
    count = pages.groupBy(site).agg(F.count("*").alias("n_pages"))
    line = pages.select(*site, F.explode(F.array_distinct("hashes")).alias("line")).groupBy(*site, "line").agg(F.count("*").alias("n"))
    line = line.where("n > 1").join(count, site).where(F.expr(f"n >= greatest(least(3, n_pages), n_pages * {COMMON})"))
    # Each page has few lines, so few lines are on so large a part of the pages.
    line = line.groupBy(site).agg(F.collect_list("line").alias("common"))
    hosts = written(count.join(line, site, "left"), "common_lines")
    seq = pages.join(hosts, site, "left").withColumn("own", F.array_except("hashes", F.coalesce("common", F.array().cast("array<long>"))))
    seq = seq.select(*order, "sig", "hashes", "own", "n_pages")
    seq = seq.repartitionByRange(parts(spark), *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    seq = seq.withColumn("run", F.shiftright(place, 33)).withColumn("place", place.bitwiseAND((1 << 33) - 1))
    seq = written(seq, "url_order")
    ahead = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = seq.groupBy("run").agg(F.count("*").alias("n")).select("run", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    # One row for each part of the range sort.
    seq = seq.join(F.broadcast(runs), "run").withColumn("rank", F.col("base") + F.col("place"))
    seq = seq.select(*site, "path", "sig", "hashes", "own", "n_pages", "rank")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, flags = [], []
            for row in b.to_pylist():
                mine, own, gone = row["hashes"], set(row["own"]), None
                for n in sorted(row["near"], key=lambda n: (n["away"], -_common(row["path"], n["path2"]), n["after"])):
                    # Of two pages, one that is all in the other may be a piece of it.
                    if len(own.intersection(n["hashes2"])) > COPY * len(own) or not own and row["n_pages"] == 2:
                        continue
                    gone = shared(mine, n["hashes2"])
                    if row["marked"]:  # what two articles share is text, unless it is common on the host and no heading
                        gone = [g and row["n_pages"] > 2 and x not in own and not x & 1 for g, x in zip(gone, mine, strict=True)]
                    break
                ids.append(row["sig"])
                flags.append(gone)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(flags, pa.list_(pa.bool_()))], ["sig", "gone"])

    def compare(pages: DataFrame, away: list[int]) -> DataFrame:
        """sig and gone of pages that have a page so far away; gone is null where all of these are copies."""
        of = F.explode(F.array(*(F.struct((F.col("rank") + d * n).alias("rank"), F.lit(n).alias("away"), F.lit(d > 0).alias("after"))
                                 for n in away for d in (-1, 1)))).alias("of")
        asked = pages.select(*site, "sig", "path", "own", "n_pages", F.col("rank").alias("rank1"), of, "hashes")
        asked = asked.select(*site, "sig", "path", "own", "n_pages", "hashes", "of.*")
        other = seq.select("rank", *site, F.col("path").alias("path2"), F.col("hashes").alias("hashes2"))
        pairs = asked.join(other, ["rank", *site]).groupBy("sig").agg(
            *(F.first(c).alias(c) for c in ("path", "own", "n_pages", "hashes", "marked")),
            F.collect_list(F.struct("away", "after", "path2", "hashes2")).alias("near"))  # two for each distance at most
        return pairs.mapInArrow(align, "sig long, gone array<boolean>")

    near = written(compare(seq, [1]), "nearest")
    copies = seq.join(near.where("gone is null").select("sig"), "sig")
    return near.unionByName(compare(copies, _FURTHER)).where(F.exists("gone", lambda x: x))


def query(spark, sf_dir: str) -> DataFrame:
    text = F.array_join("lines", "\n\n")
    found = extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))
