"""HTML extraction: visible blocks, less those a page shares with the page of the nearest URL."""

from __future__ import annotations

import bisect
import html
import pickle
import re
import tempfile
import zlib
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .common import ROW, Workspace, numbered, tasks
from .hashing import common_places

#: Fixed values of the markup language.
UNSEEN = {"script", "style", "noscript", "template", "textarea", "title", "svg", "math", "iframe", "object", "canvas"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
    "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub",
    "sup", "time", "tt", "u", "var", "wbr",
}
FURNITURE = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "head"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form"}
#: Fixed words that name furniture in class and id attributes, and words that may stand with them in a name.
NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion",
    "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "disqus", "reply", "replies", "respond", "cookie",
    "cookies", "consent", "notice", "gdpr", "footer", "header", "masthead", "menu", "nav", "navbar", "navigation",
    "sidebar", "sidenav", "widget", "widgets", "modal", "overlay", "popup", "newsletter", "subscribe", "subscription",
    "signup", "login", "share", "sharing", "social", "related", "recommended", "recommendations", "pagination",
    "pager", "toolbar", "skip",
}
NEUTRAL = {
    "area", "bar", "block", "body", "bottom", "box", "container", "form", "global", "inner", "item", "items", "left",
    "link", "links", "list", "main", "outer", "page", "post", "posts", "primary", "right", "secondary", "section",
    "site", "slot", "text", "thread", "top", "unit", "wrap", "wrapper",
}
MAIN = {"article", "main"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)[^>]*>",  # a quote left open
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in ("script", "style", "textarea", "title", "iframe", "noscript")}


#: An element named like furniture that holds more than this share of a page's text is the page.
MOST = 0.8


def naming(value: str, in_main: bool) -> str | None:
    """`named` if a class or id is a furniture word, alone or among words that say no more than where it is.

    A furniture word that is only part of a name, as in page-with-sidebar or comments-open, can
    speak of something else: `maybe`.
    """
    own, found = NAMES - {"header"} if in_main else NAMES, None
    for name in value.split():
        words = set(re.split(r"[-_]+", name)) - {""}
        if words & own:
            if words <= NAMES | NEUTRAL:
                return "named"
            found = "maybe"
    return found


def furniture_kind(tag: str, rest: str, in_main: bool) -> str | None:
    """Whether an element is a menu, advert and so on: `sure` by its tag, role or state, else by its names."""
    if tag in UNSEEN or tag in FURNITURE or tag == "header" and not in_main:
        return "sure"
    if "=" not in rest and "hidden" not in rest or tag in ("html", "body"):
        return None
    kinds = set()
    for match in ATTRIBUTE.finditer(rest):
        name, value = match[1].lower(), (match[2] or match[3] or match[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return "sure"
        if name == "role" and value in ROLES:
            return "sure"
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return "sure"
        if name in ("class", "id") and tag not in ("h1", "p", *MAIN):
            kinds.add(naming(value, in_main))
    return "named" if "named" in kinds else "maybe" if "maybe" in kinds else None


def blocks_of(page: str) -> tuple[list[str], list[int], list[bool]]:
    """Blocks of visible text in page order; of each, whether it is in the main element, and in furniture.

    In the main element a block counts 1, one that may be furniture by its names 2. Tags need
    not match: an end tag closes what is open inside its element, one without a start
    tag nothing; the first main element is outside any furniture left open before it. An
    element named like furniture that holds most of the page is none.
    """
    texts: list[str] = []
    mains: list[int] = []
    sure: list[bool] = []
    within: list[tuple[int, ...]] = []  # the elements named like furniture, by number
    open_: list[tuple[str, int, bool, tuple[int, ...]]] = []  # tag, in main, sure, named
    parts: list[str] = []
    met_main, named = False, 0

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                _, main, out, numbers = open_[-1] if open_ else ("", 0, False, ())
                texts.append(text)
                mains.append(main)
                sure.append(out)
                within.append(numbers)

    at = 0
    while match := TOKEN.search(page, at):
        if match.start() > at:
            parts.append(page[at : match.start()])
        at = match.end()
        name = match["tag"] or match["tag2"]
        if name is None:
            continue
        tag, rest = name.lower(), match["rest"] or ""
        if tag not in INLINE:
            flush()
        if match["close"] or match["close2"]:
            for depth in range(len(open_) - 1, -1, -1):
                if open_[depth][0] == tag:
                    if tag in INLINE and any(e[0] not in INLINE for e in open_[depth:]):
                        break  # a stray inline end tag closes no block
                    if open_[-1][1:] != (open_[depth - 1][1:] if depth else (0, False, ())):
                        flush()
                    del open_[depth:]
                    break
            continue
        if rest.endswith("/") or tag in VOID:
            continue
        if tag in RAW_END:
            end = RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        in_main, out, numbers = open_[-1][1:] if open_ else (0, False, ())
        kind = furniture_kind(tag, rest, in_main > 0)
        if tag in MAIN and not kind and not met_main and not any(e[0] == "aside" for e in open_):
            out, numbers, met_main = False, (), True
        if tag in INLINE and kind and kind != "maybe":
            flush()
        if kind == "named":
            numbers, named = (*numbers, named), named + 1
        if kind == "maybe" and in_main:
            in_main = 2
        elif tag in MAIN and not kind:
            in_main = in_main or 1
        open_.append((tag, in_main, out or kind == "sure", numbers))
    parts.append(page[at:])
    flush()
    sizes = [0] * named
    whole = 0
    for text, out, numbers in zip(texts, sure, within, strict=True):
        if not out:
            whole += len(text)
            for number in numbers:
                sizes[number] += len(text)
    return texts, mains, [out or any(sizes[n] <= MOST * whole for n in numbers) for out, numbers in zip(sure, within, strict=True)]


def place_of(url: str | None) -> tuple[str, str]:
    """Host in lower case, and path; a text that is no URL is its own path."""
    try:
        parts = urlsplit((url or "").strip())
        return (parts.hostname or "").lower(), parts.path or "/"
    except ValueError:
        return "", url or ""


def nearness(a: str, b: str) -> int:
    """Leading characters two paths share."""
    least = min(len(a), len(b))
    return next((i for i in range(least) if a[i] != b[i]), least)


#: A page with at most one in so many characters of its own is a copy.
COPY = 50
#: Bytes of pages in a bucket, about; bytes of a run of copies that are held in memory.
BUCKET = 32 << 20
HELD = 16 << 20

LINE = "struct<key:long, main:int, text:string>"
PAGE = f"bucket int, row long, page_id long, url string, host string, path string, lines array<{LINE}>"
KINDS = pa.schema(
    [("bucket", pa.int32()), ("row", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()),
     ("path", pa.string()),
     ("lines", pa.list_(pa.struct([("key", pa.int64()), ("main", pa.int32()), ("text", pa.string())])))]
)
PLACE = "row long, host string, path string, content long, size long"


def located(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places = [place_of(url) for url in batch[1].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch[0], *(pa.array([p[i] for p in places], pa.string()) for i in (0, 1)), batch[2], batch[3]],
            names=["row", "host", "path", "content", "size"],
        )


#: Host, path and row of the first page of every bucket but the first.
Edges = list[tuple[str, str, int]]


def bucketed(edges: Edges) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(*(batch[c].to_pylist() for c in ("host", "path", "row")), strict=True)
            buckets = pa.array([bisect.bisect_right(edges, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, buckets], names=[*batch.schema.names, "bucket"])

    return run


def parsed(edges: Edges) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pages as lines; the text of a line only if it can be part of the main text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                out = []
                for row, page_id, url, page in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns), strict=True):
                    host, path = place_of(url)
                    blocks = list(zip(*blocks_of(page or ""), strict=True))
                    marked = any(main and not out_ for _, main, out_ in blocks)
                    lines = [
                        {
                            "key": zlib.crc32(text.encode()) << 20 | len(text) & 0xFFFFF,
                            "main": main,
                            "text": text if not out_ and (main or not marked) else None,
                        }
                        for text, main, out_ in blocks
                    ]
                    bucket = bisect.bisect_right(edges, (host, path, row))
                    out.append(
                        {"bucket": bucket, "row": row, "page_id": page_id, "url": url, "host": host, "path": path, "lines": lines}
                    )
                yield pa.RecordBatch.from_pylist(out, schema=KINDS)

    return run


def main_text(lines: list[dict], other: list[dict]) -> str:
    """Main text of a page, given the lines of the page it is compared with.

    Lines shared with the other page, in the order of a longest common subsequence, are the
    site's and go, however many; the other page is no copy. In a main element they go if
    their element may be furniture by its names; what is not so named there is the article,
    which can have sentences in common with another one.
    """
    keys = [line["key"] for line in lines]
    shared = set(common_places(keys, [line["key"] for line in other]))
    own = [i for i, line in enumerate(lines) if line["text"] is not None]
    return " ".join(lines[i]["text"] for i in own if i not in shared or lines[i]["main"] == 1)


def is_copy(keys: set[int], other: set[int]) -> bool:
    """Whether one of two pages has almost nothing, by characters, that the other has not."""

    def own(a: set[int], b: set[int]) -> bool:
        return COPY * sum(k & 0xFFFFF for k in a - b) <= sum(k & 0xFFFFF for k in a)

    return own(keys, other) or own(other, keys)


class Held:
    """Pages in the order they came, the most of them in a file of the task's own."""

    def __init__(self) -> None:
        self.file = tempfile.SpooledTemporaryFile(HELD)
        self.n = 0

    def add(self, page: dict) -> None:
        pickle.dump(page, self.file, pickle.HIGHEST_PROTOCOL)
        self.n += 1

    def pages(self) -> Iterator[dict]:
        self.file.seek(0)
        for _ in range(self.n):
            yield pickle.load(self.file)
        self.file.close()


RESULT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def differenced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages in order of host, path and row, each compared with the nearer of its neighbours.

    Copies of one another that stand together are a run; the neighbours of its pages are the
    last page before it and the first after it. A run waits for the page after it, in a file
    if it is long. Pages of other buckets come along as neighbours only (`halo`) and give no
    row.
    """
    run = Held()
    first: dict | None = None
    last: dict | None = None
    prior: dict | None = None
    keys: set[int] = set()

    def judged(after: dict | None) -> Iterator[pa.RecordBatch]:
        out = []
        for page in run.pages():
            if not page["halo"]:
                near = max((s for s in (prior, after) if s), key=lambda s: nearness(s["path"], page["path"]), default=None)
                text = main_text(page["lines"], near["lines"] if near else [])
                out.append({"page_id": page["page_id"], "url": page["url"], "text": text})
            if len(out) == 500:
                yield pa.RecordBatch.from_pylist(out, schema=RESULT)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=RESULT)

    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            for page in batch.slice(at, 500).to_pylist():
                own = {line["key"] for line in page["lines"]}
                # a new bucket begins where the order falls back; its halo brings what it needs
                same = first is not None and all(page[c] == first[c] for c in ("bucket", "host"))
                if not (same and is_copy(own, keys)):
                    yield from judged(page if same else None)
                    prior = last if same else None
                    run, first, keys = Held(), page, own
                run.add(page)
                last = page
    yield from judged(None)


def neighbours(ends: list[Row]) -> list[tuple[int, int]]:
    """(row, bucket) of the pages that a bucket needs of those before and after it.

    Those are the nearest page, and the nearest of other content, as the nearest may be a copy.
    """
    out = []
    for i, to in enumerate(ends):
        for side, step in (("last", -1), ("first", 1)):
            nearest = None
            at = i + step
            while 0 <= at < len(ends):
                page, different = ends[at][side], ends[at][f"{side}_other"]
                if nearest is None:
                    nearest = page
                    out.append((page["row"], to["bucket"]))
                elif page["content"] != nearest["content"]:
                    different = page
                if different is not None and different["content"] != nearest["content"]:
                    out.append((different["row"], to["bucket"]))
                    break
                at += step
    return out


def bucket_edges(places: DataFrame, sample: int) -> Edges:
    """Where buckets of about BUCKET bytes begin, by a sample of about `sample` rows per bucket."""
    pages, size = places.agg(F.count("*"), F.sum("size")).first()
    buckets = max(tasks(places.sparkSession), -(-(size or 0) // BUCKET))
    share = min(1.0, sample * buckets / max(1, pages))
    drawn = places.where(F.shiftrightunsigned(F.xxhash64("row"), 11) <= int(share * 2**53))
    keys = sorted((r["host"], r["path"], r["row"], r["size"]) for r in drawn.drop("content").collect())
    edges, upto, whole = [], 0, sum(k[3] for k in keys)
    for *key, own in keys:
        if upto * buckets >= (len(edges) + 1) * whole:
            edges.append(tuple(key))
        upto += own
    return edges


def main_texts(spark: SparkSession, pages: DataFrame, sample: int = 100) -> DataFrame:
    """`page_id`, `url` and main `text` of every page.

    Pages are ordered by host, path and row and cut into buckets of about equal bytes by the
    keys of a sample of `sample` rows per bucket; the sample decides the sizes only. A bucket
    is a task. The last page of a bucket, and the last of other content than that, also go
    to the next one, and the first ones to the one before, so each page meets its neighbours
    in the whole order: a host of a third of all pages is many buckets. Bounds come from the
    URLs and sizes alone, other content is told by the pages without tags; pages are parsed
    and shuffled once. Null html is empty and gives empty text, null or odd URLs are a host
    of their own, repeated rows are compared as neighbours and found to be copies, a run of
    copies of any length waits in a file, very long pages are read whole, ties in the order
    go by row number, other columns play no part, an empty table gives no rows.
    """
    space = Workspace(spark, "pages")
    rows = numbered(pages).select(
        F.col(ROW).alias("row"), F.col("page_id").cast("long"), F.col("url").cast("string"), "html"
    )
    content = F.xxhash64(F.regexp_replace("html", "<[^>]*>", "")).alias("content")
    size = F.coalesce(F.octet_length("html"), F.lit(0)).cast("long").alias("size")
    places = space.save(rows.select("row", "url", content, size).mapInArrow(located, PLACE))
    edges = bucket_edges(places, sample)
    in_buckets = places.mapInArrow(bucketed(edges), f"{PLACE}, bucket int")
    page = F.struct("host", "path", "row", "content")
    ends = space.save(in_buckets.groupBy("bucket").agg(F.min(page).alias("first"), F.max(page).alias("last")))
    first_other, last_other = (F.when(F.col("content") != F.col(f"{side}.content"), page) for side in ("first", "last"))
    ends = (
        in_buckets.join(F.broadcast(ends), "bucket")  # a row per bucket
        .groupBy("bucket", "first", "last")
        .agg(F.min(first_other).alias("first_other"), F.max(last_other).alias("last_other"))
        .orderBy("bucket")
        .collect()
    )
    copies = spark.createDataFrame(neighbours(ends), "row long, other int")  # four rows per bucket at most
    copies = copies.groupBy("row").agg(F.collect_list(F.struct(F.col("other").alias("bucket"), F.lit(True).alias("halo"))).alias("others"))
    own = F.array(F.struct("bucket", F.lit(False).alias("halo")))
    dealt = (
        rows.mapInArrow(parsed(edges), PAGE)
        .join(F.broadcast(copies), "row", "left")
        .withColumn("to", F.explode(F.when(F.col("others").isNull(), own).otherwise(F.concat(own, "others"))))
        .select("row", "page_id", "url", "host", "path", "lines", "to.bucket", "to.halo")
        .repartitionById(len(edges) + 1, "bucket")
        .sortWithinPartitions("bucket", "host", "path", "row")
    )
    return dealt.mapInArrow(differenced, "page_id long, url string, text string")


def page_report(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return main_texts(spark, pages).withColumn("n_chars", F.length("text").cast("long"))
