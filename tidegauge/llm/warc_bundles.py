"""WARC archives as seekable Zstandard bundles: independent frames, a footer seek table, an index of records."""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import ROW, Workspace, numbered, tasks, whole_text

#: Payloads from this size are stored once.
LEAST = 100
#: Bytes of records in a frame, unless one record alone has more; bytes of records in a bundle.
FRAME = 1 << 20
BUNDLE = 256 << 20
LEVEL = 3

#: Fixed values of the seekable format: a skippable frame of (compressed, decompressed) sizes, then
#: the number of frames, a descriptor byte and the second magic number, all little-endian.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
ENTRY, HEAD, FOOT = struct.Struct("<II"), struct.Struct("<II"), struct.Struct("<IBI")

#: Fixed values of the archive format.
VERSION = "WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = "urn:tidegauge:page:"
NO_URL = "about:blank"


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The store and path of a folder that all executors share; `s3a` is Spark's name of `s3`."""
    scheme = urlsplit(folder).scheme
    if not scheme:
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def record_id(page: int | None, row: int) -> str:
    """A page's id may come again, so the row number is part of the record's."""
    return f"<{NAMESPACE}{'' if page is None else page}:{row}>"


def page_of(record: str) -> int | None:
    page = record[len(NAMESPACE) + 1 :].split(":")[0]
    return int(page) if page else None


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def archived(url: str | None, date: str, own: str, payload: bytes, digest: str, original: str | None) -> bytes:
    """A response record, or a revisit record without payload if `original` has the same one."""
    kind = "response" if original is None else "revisit"
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", own),
        ("WARC-Date", date),
        ("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else NO_URL),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if original is not None:
        headers += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", original)]
    headers.append(("Content-Type", "application/http;msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return record_bytes(headers, http.encode() + (payload if original is None else b""))


class Bundle:
    """One file of frames, written front to back."""

    def __init__(self, store: fs.FileSystem, path: str) -> None:
        self.out = store.open_output_stream(path, compression=None)  # frames are made here
        self.sizes: list[tuple[int, int]] = []
        self.held, self.total = io.BytesIO(), 0
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame of the record, and its offset in the frame."""
        if self.held.tell() and self.held.tell() + len(record) > FRAME:
            self.flush()
        place = len(self.sizes), self.held.tell()
        self.held.write(record)
        self.total += len(record)
        return place

    def flush(self) -> None:
        data = self.held.getvalue()
        if data:
            packed = self.compressor.compress(data)
            self.out.write(packed)
            self.sizes.append((len(packed), len(data)))
            self.held = io.BytesIO()

    def close(self) -> None:
        self.flush()
        entries = b"".join(ENTRY.pack(*s) for s in self.sizes)
        self.out.write(HEAD.pack(SKIPPABLE, len(entries) + FOOT.size) + entries + FOOT.pack(len(self.sizes), 0, SEEKABLE))
        self.out.close()


def seek_table(source: pa.NativeFile) -> list[tuple[int, int, int]]:
    """(offset, compressed size, decompressed size) of every frame, from the end of the file alone."""
    end = source.size()
    frames, _, magic = FOOT.unpack(source.read_at(FOOT.size, end - FOOT.size))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    sizes = source.read_at(frames * ENTRY.size, end - FOOT.size - frames * ENTRY.size)
    out, at = [], 0
    for packed, whole in ENTRY.iter_unpack(sizes):
        out.append((at, packed, whole))
        at += packed
    return out


INDEX = "record_id string, bundle string, frame int, offset long, length long"


def written(folder: str, date: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Writes records to bundles and gives a row per record.

    A bundle's name is new for every attempt of a task. Only the rows of the attempt that
    succeeds become part of the index, so what a lost attempt left is never read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        store.create_dir(base, recursive=True)
        bundle, name = None, ""
        for batch in batches:
            rows = []
            columns = (batch[c] for c in ("row", "page_id", "url", "html", "digest", "first_id", "first_row"))
            for values in zip(*columns):
                row, page, url, html, digest, first_id, first_row = (v.as_py() for v in values)
                if bundle is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    bundle = Bundle(store, f"{base}/{name}")
                own = record_id(page, row)
                original = None if first_row is None or first_row == row else record_id(first_id, first_row)
                data = archived(url, date, own, html.encode(), digest, original)
                rows.append((own, name, *bundle.add(data), len(data)))
                if bundle.total >= BUNDLE:
                    bundle.close()
                    bundle = None
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(
                    zip(*rows) if rows else [()] * 5,
                    [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()], strict=True)],
                names=["record_id", "bundle", "frame", "offset", "length"],
            )
        if bundle is not None:
            bundle.close()

    return run


def write_archives(
    spark: SparkSession, pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", least: int = LEAST
) -> DataFrame:
    """Writes a record per page to bundles in `folder`, and the index of the records, which it returns.

    The index has `record_id`, its `bundle`, the `frame`, and `offset` and `length` in the
    decompressed frame. Of pages with the same payload of `least` bytes or more, the one
    with the smallest page_id (null is the greatest; of repeated ids the row numbered
    first) is the response, the others are revisit records that refer to it. Payloads are
    told apart by size and SHA-256, grouped without their texts; a payload of a third of
    all pages is one row per task there; only payloads that come again are joined back, without
    a shuffle of the pages where these are few.

    Null html is empty, a null url is `about:blank`, characters that no URL may have are
    percent-encoded; a very long page is a frame of its own; other columns play no part; an
    empty table gives no bundle and an empty index. `folder` has to be new, and in a store
    that both Spark and pyarrow open.
    """
    data = whole_text(F.col("html").cast("string"))
    rows = numbered(pages).select(
        F.col(ROW).alias("row"),
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        data.alias("html"),
        F.sha2(F.encode(data, "UTF-8"), 256).alias("digest"),
    )
    size = F.octet_length("html")
    first = F.min(F.struct(F.col("page_id").isNull(), "page_id", "row")).alias("first")
    copied = (
        rows.where(size >= least)
        .groupBy(F.col("digest").alias("of"), size.alias("size"))
        .agg(F.count("*").alias("n"), first)
        .where("n > 1")
        .select("of", "size", F.col("first.page_id").alias("first_id"), F.col("first.row").alias("first_row"))
    )
    copied = Workspace(spark, "copies").save(copied)  # by its size Spark broadcasts it, or shuffles both sides
    stored = rows.join(copied, (F.col("digest") == F.col("of")) & (size == F.col("size")), "left").drop("of", "size")
    index = stored.mapInArrow(written(f"{folder.rstrip('/')}/bundles", date), INDEX)
    index.write.option("compression", "zstd").parquet(f"{folder.rstrip('/')}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder.rstrip('/')}/index")


class Record:
    """One record of a decompressed frame."""

    def __init__(self, data: memoryview) -> None:
        head, _, rest = bytes(data).partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        if version != VERSION:
            raise ValueError(f"not a record: {version[:20]}")
        self.headers = dict(line.split(": ", 1) for line in lines)
        block = rest[: int(self.headers["Content-Length"])]
        http, _, self.payload = block.partition(b"\r\n\r\n")
        self.http = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])


READ = (
    "record_id string, page_id long, target_uri string, record_type string, refers_to_record string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary"
)
SHAPE = pa.schema(
    [("record_id", pa.string()), ("page_id", pa.int64()), ("target_uri", pa.string()), ("record_type", pa.string()),
     ("refers_to_record", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
     ("payload_digest", pa.string()), ("payload", pa.binary())]
)


def parsed(record: Record, payloads: bool) -> dict:
    """A record as a row; sizes and digests of responses are those of the bytes read, and must be as stated."""
    headers, kind = record.headers, record.headers["WARC-Type"]
    size, digest = int(record.http["Content-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (len(record.payload), hashlib.sha256(record.payload).hexdigest()) != (size, digest):
        raise ValueError(f"{headers['WARC-Record-ID']}: the payload is not that of its digest")
    uri, original = headers["WARC-Target-URI"], headers.get("WARC-Refers-To")
    return {
        "record_id": headers["WARC-Record-ID"],
        "page_id": page_of(headers["WARC-Record-ID"]),
        "target_uri": None if uri == NO_URL else uri,
        "record_type": kind,
        "refers_to_record": original,
        "refers_to": page_of(original) if original else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": record.payload if payloads and kind == "response" else None,
    }


def fetched(folder: str, payloads: bool) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The listed records of each frame; of a bundle, only its seek table and those frames are read."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        name, source, table = None, None, []
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for bundle, frame, places in zip(*(batch[c] for c in ("bundle", "frame", "places"))):
                if bundle.as_py() != name:
                    name = bundle.as_py()
                    source = store.open_input_file(f"{base}/{name}")
                    table = seek_table(source)
                at, packed, _ = table[frame.as_py()]
                data = memoryview(unpack.decompressobj().decompress(source.read_at(packed, at)))
                out = []
                for place in places.as_py():
                    own = data[place["offset"] : place["offset"] + place["length"]]
                    out.append(parsed(Record(own), payloads))
                yield pa.RecordBatch.from_pylist(out, schema=SHAPE)

    return run


def read_archives(spark: SparkSession, folder: str, index: DataFrame | None = None, payloads: bool = True) -> DataFrame:
    """The records of `index` (by default all of `folder`), read from the bundles by their seek tables.

    The frames are dealt to all tasks, whatever bundle they are in; a task holds one frame.
    A record's `payload` is null if it is a revisit, or if `payloads` is off. Payloads that
    are not as their digests say, and bundles without a seek table, fail the read.
    """
    index = read_index(spark, folder) if index is None else index
    # so many tasks whatever the bytes of the list, as the work is in the frames
    dealt = index.repartition(tasks(spark), "bundle", "frame")
    frames = (
        dealt.groupBy("bundle", "frame")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("places"))  # bounded by the frame
        .sortWithinPartitions("bundle", "frame")
    )
    return frames.mapInArrow(fetched(f"{folder.rstrip('/')}/bundles", payloads), READ)


def find_records(spark: SparkSession, folder: str, wanted: Column) -> DataFrame:
    """Records by a condition on the index, such as `record_id`; only their frames are read."""
    return read_archives(spark, folder, read_index(spark, folder).where(wanted))


def archive_report(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """What the archives of `pages` hold, read back from them."""
    folder = scratch_dir(spark, "archives")
    write_archives(spark, pages, folder)
    return read_archives(spark, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
