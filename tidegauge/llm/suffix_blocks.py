"""Suffix-array dedup: bytes covered by a string of `WINDOW` bytes that starts anywhere else.

A suffix matters only by its first WINDOW bytes, and equal windows have equal minimisers
(least fingerprint of the KMER-byte strings inside). So the minimiser is the suffix bucket:
windows are compared within their bucket only, and a bucket with one run of windows, by far
the most, needs no sorting. Of the others the text is cut out, a run of neighbouring windows
at a time, dealt to tasks by bucket, and sorted there blockwise, a block of whole buckets at
a time, with ties in the leading and last bytes resolved by the ranks of a difference-cover
sample, computed once per block. Memory is bounded by the block, as powers are products of two
short tables and a bucket of long runs is split by its bytes, and where runs are cut by the text.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import setting
from .common import ROW, Workspace, numbered, whole_text
from .hashing import mixed, sliding_min

WINDOW = 400
KMER = 32
#: Windows of a run at most, so that a run of a monotonous text stays small.
RUN = 2048
#: Runs of a bucket in one task at most; a larger bucket is split and its parts compared by fingerprint.
PART = 4096
#: Bytes of the runs of a bucket in one task, as far as the hash deals them evenly; long runs fill a part before PART.
PART_BYTES = 2_000_000
#: Bytes of a text whose runs go to one part; a long monotonous text goes to many.
STRETCH = 16 * RUN
BLOCK = 1_000_000
#: Bytes of a text that are fingerprinted at once.
PIECE = 1 << 18
#: Texts that Spark hands to a function at once.
BATCH = 1000
#: Bytes at either end of a window by which the windows of such a bucket are told apart first.
END = 64

#: A difference cover modulo 64; every residue is a difference of two of them.
COVER = (0, 1, 2, 5, 14, 16, 34, 42, 59)
PERIOD = 64
#: Bytes ranked by the sample: the window less the longest way to a common sample place.
DEPTH = WINDOW - 80

BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


#: Powers of a base that are kept; those further on are products of one of them and one of every SPAN-th.
SPAN = 1 << 16


@functools.cache
def powers(base: int) -> np.ndarray:
    """First SPAN powers modulo 2^64."""
    out = np.full(SPAN, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@functools.cache
def cover_step() -> np.ndarray:
    """Least step from two places, by their residues, to places that are both in the sample."""
    inside = np.isin(np.arange(2 * PERIOD) % PERIOD, COVER)
    return np.array(
        [[int(np.argmax(inside[a : a + PERIOD] & inside[b : b + PERIOD])) for b in range(PERIOD)] for a in range(PERIOD)]
    )


class Fingerprints:
    """Fingerprint of any substring of `data`, from running sums of a polynomial.

    It depends on the bytes alone: the inverse power takes the place out.
    """

    def __init__(self, data: np.ndarray, base: int = BASES[0]) -> None:
        n = len(data)
        inverse = pow(base, -1, 1 << 64)
        self.near = powers(inverse)
        self.far = np.array([pow(inverse, at, 1 << 64) for at in range(0, n + 1, SPAN)], np.uint64)
        self.sums = np.zeros(n + 1, np.uint64)
        terms = self.sums[1:]
        terms[:] = data
        terms += np.uint64(1)
        for at in range(0, n, SPAN):
            own = terms[at : at + SPAN]
            own *= powers(base)[: len(own)]
            own *= np.uint64(pow(base, at, 1 << 64))
        np.cumsum(terms, out=terms)

    def at(self, places: np.ndarray, length: int) -> np.ndarray:
        out = self.sums[places + length]
        out -= self.sums[places]
        out *= self.near[places % SPAN]
        out *= self.far[places // SPAN]
        return out

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        out = self.sums[length:] - self.sums[:n]
        for at in range(0, n, SPAN):
            own = out[at : at + SPAN]
            own *= self.near[: len(own)]
            own *= self.far[at // SPAN]
        return out


def runs_of(data: bytes) -> tuple[np.ndarray, ...]:
    """Bucket, first window, number of windows and places of the minimiser (1, or 2 for more) of each run.

    A minimiser that comes again within its run, as in a monotonous text, may make windows
    of the one run equal: such a run is compared even if it is alone in its bucket. A text
    is taken a piece at a time; a run over the edge of two is two runs of one bucket.
    """
    if len(data) < WINDOW:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    pieces = [piece_runs(data[at : at + PIECE + WINDOW - 1], at) for at in range(0, len(data) - WINDOW + 1, PIECE)]
    return tuple(np.concatenate(c) for c in zip(*pieces, strict=True))


def piece_runs(data: bytes, at: int) -> tuple[np.ndarray, ...]:
    """Runs of the piece of a text that starts at a place."""
    marks = mixed(Fingerprints(np.frombuffer(data, np.uint8)).all(KMER))
    bucket = sliding_min(marks, WINDOW - KMER + 1)
    change = bucket[1:] != bucket[:-1]
    first = np.flatnonzero(np.r_[True, change])
    count = np.diff(np.r_[first, len(bucket)])
    again = np.cumsum(np.r_[False, ~change & (marks[: len(change)] == bucket[:-1])])
    times = 1 + (again[first + count - 1] > again[first])
    parts = -(-count // RUN)
    within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    first, count, times = (np.repeat(x, parts) for x in (first + 0, count, times))
    return bucket[first].view(np.int64), at + first + within * RUN, np.minimum(RUN, count - within * RUN), times


def end_runs(data: bytes, first: int, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parts of a run with the same minimisers in the first and last END bytes of the windows."""
    text = np.frombuffer(data, np.uint8)[first : first + count + WINDOW - 1]
    least = sliding_min(mixed(Fingerprints(text).all(KMER)), END - KMER + 1)
    ends = mixed(least[:count]) + least[WINDOW - END :][:count]
    begins = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]])
    return ends[begins].view(np.int64), first + begins, np.diff(np.r_[begins, count])


class Block:
    """Texts of runs, one after the other, and the ranks of their difference-cover sample."""

    def __init__(self, texts: list[bytes]) -> None:
        data = np.frombuffer(b"".join(texts) + bytes(WINDOW + PERIOD), np.uint8)
        self.prints = Fingerprints(data)
        self.data = data
        n = len(data) - 8
        self.words = np.ndarray(n, "<u8", data, strides=(1,))  # eight bytes from each place on, no copy
        sampled = np.zeros(n - DEPTH, bool)
        for i in COVER:
            sampled[i::PERIOD] = True
        places = np.flatnonzero(sampled)
        self.rank = np.zeros(len(data), np.int32)  # fewer names than bytes
        names = self.named(places)
        step = PERIOD
        while step * 2 <= DEPTH:
            names = self.doubled(places, names, step)
            step *= 2
        if step < DEPTH:  # the rest, by the names of its length
            rest = DEPTH - step
            tail = self.named(places, step, rest)
            names = np.unique(names * (tail.max(initial=0) + 1) + tail, return_inverse=True)[1]
        self.rank[places] = names

    def same(self, a: np.ndarray, b: np.ndarray, start: int, end: int) -> np.ndarray:
        """Whether the bytes start..end after two places are equal, byte by byte."""
        equal = np.ones(len(a), bool)
        for step in range(start, end, 8):
            equal &= self.words[a + step] == self.words[b + step]
        return equal

    def named(self, places: np.ndarray, after: int = 0, length: int = PERIOD) -> np.ndarray:
        """Integer names of the strings `after` each place, equal iff the bytes are."""
        marks = self.prints.at(places + after, length)
        _, first, names = np.unique(marks, return_index=True, return_inverse=True)
        if not self.same(places, places[first][names], after, after + length).all():
            strings = np.lib.stride_tricks.sliding_window_view(self.data, length)[places + after]
            names = np.unique(strings, axis=0, return_inverse=True)[1].ravel()
        return names

    def doubled(self, places: np.ndarray, names: np.ndarray, step: int) -> np.ndarray:
        """Names of strings twice as long: a place and the one `step` on are both in the sample."""
        self.rank[places] = names
        # the last places reach beyond the block; no window starts there
        later = self.rank[np.minimum(places + step, len(self.rank) - 1)]
        return np.unique(names * (names.max(initial=0) + 1) + later, return_inverse=True)[1]

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the windows at two places are equal: ranks at a common sample place, then both ends."""
        step = cover_step()[a % PERIOD, b % PERIOD]
        out = self.rank[a + step] == self.rank[b + step]
        tied = np.flatnonzero(out)
        ends = self.same(a[tied], b[tied], 0, PERIOD) & self.same(a[tied], b[tied], DEPTH, WINDOW)
        out[tied] = ends
        return out

    def classes(self, windows: np.ndarray) -> np.ndarray:
        """Class number of each window; equal iff the windows are.

        Windows are sorted by their leading and last bytes. In each tie, all are compared
        with the first; those that differ tie among themselves, and so on.
        """
        marks = mixed(self.prints.at(windows, PERIOD)) ^ self.prints.at(windows + DEPTH, WINDOW - DEPTH)
        order = np.argsort(marks, kind="stable")
        tie = np.cumsum(np.r_[False, marks[order][1:] != marks[order][:-1]]) if len(order) else order
        out = np.empty(len(windows), np.int64)
        classes = 0
        while len(order):
            starts = np.flatnonzero(np.r_[True, tie[1:] != tie[:-1]])
            number = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(order)]))
            leader = order[starts][number]
            alike = np.ones(len(order), bool)
            others = np.flatnonzero(order != leader)
            alike[others] = self.equal(windows[order[others]], windows[leader[others]])
            out[order[alike]] = classes + number[alike]
            classes += len(starts)
            order, tie = order[~alike], tie[~alike]
        return out


def spans_of(flags: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each stretch of flagged windows; stretches end where a run begins."""
    breaks = np.zeros(len(flags), bool)
    breaks[begins] = True
    opens = flags & (breaks | np.r_[True, ~flags[:-1]])
    closes = flags & np.r_[breaks[1:] | ~flags[1:], True]
    return np.flatnonzero(opens), np.flatnonzero(closes)


FOUND = pa.schema(
    [("row", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("mark", pa.int64()), ("mark2", pa.int64())]
)
FOUND_SQL = "row long, start long, end long, mark long, mark2 long"


def compared(rows: dict[str, list]) -> pa.RecordBatch:
    """Repeated windows of a block as spans; of split buckets also a fingerprint of one window per class."""
    counts = np.array(rows["count"], np.int64)
    begins = np.cumsum(counts) - counts
    sizes = np.array([len(t) for t in rows["data"]], np.int64)
    run = np.repeat(np.arange(len(counts)), counts)
    windows = np.arange(len(run)) + (np.cumsum(sizes) - sizes - begins)[run]

    def place(chosen: np.ndarray) -> np.ndarray:
        return (np.array(rows["first"], np.int64) - begins)[run[chosen]] + chosen

    def row(chosen: np.ndarray) -> np.ndarray:
        return np.array(rows["row"], np.int64)[run[chosen]]

    block = Block(rows["data"])
    names = block.classes(windows)
    repeated = np.bincount(names)[names] > 1
    opens, closes = spans_of(repeated, begins)
    columns = [row(opens), place(opens), place(closes) + WINDOW]
    one = np.unique(names, return_index=True)[1]
    one = one[np.array(rows["split"], bool)[run[one]]]
    other = Fingerprints(block.data, BASES[1])
    pad = np.zeros(len(opens), np.int64)
    marks = [block.prints.at(windows[one], WINDOW).view(np.int64), other.at(windows[one], WINDOW).view(np.int64)]
    valid = np.r_[np.zeros(len(opens), bool), np.ones(len(one), bool)]
    return pa.RecordBatch.from_arrays(
        [
            *(pa.array(np.r_[a, b]) for a, b in zip(columns, (row(one), place(one), place(one) + WINDOW), strict=True)),
            *(pa.array(np.r_[pad, m], mask=~valid) for m in marks),
        ],
        schema=FOUND,
    )


def sorted_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole buckets, as many as make a block, compared a block at a time."""
    names = ("row", "first", "count", "split", "data")
    held: dict[str, list] = {n: [] for n in names}
    size, last = 0, None
    for batch in batches:
        keys = list(zip(batch["bucket"].to_pylist(), batch["part"].to_pylist(), strict=True))
        values = [batch[n].to_pylist() for n in names]
        for i, key in enumerate(keys):
            if size >= BLOCK and key != last:
                yield compared(held)
                held, size = {n: [] for n in names}, 0
            for n, column in zip(names, values, strict=True):
                held[n].append(column[i])
            size += len(values[-1][i])
            last = key
    if size:
        yield compared(held)


def text_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches):
        parts, rows = [], []
        for row, data in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
            parts.append(runs_of(data))
            rows.append(np.full(len(parts[-1][0]), row, np.int64))
        if rows:
            bucket, first, count, times = (np.concatenate(c) for c in zip(*parts, strict=True))
            columns = (np.concatenate(rows), bucket, first, count.astype(np.int32), times.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], names=["row", "bucket", "first", "count", "times"]
            )


CUT = pa.schema(
    [("row", pa.int64()), ("bucket", pa.int64()), ("ends", pa.int64()), ("part", pa.int64()), ("split", pa.bool_()),
     ("first", pa.int64()), ("count", pa.int32()), ("times", pa.int32()), ("data", pa.binary())]
)
CUT_SQL = (
    "row long, bucket long, ends long, part long, split boolean, first long, count int, times int, data binary"
)
RUNS = "row long, bucket long, first long, count int, times int"


def in_slices(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Smaller batches, for functions that copy the texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def with_data(runs: Iterable[dict], row: int, data: bytes) -> list[dict]:
    return [{**r, "row": row, "data": data[r["first"] : r["first"] + r["count"] + WINDOW - 1]} for r in runs]


def cut_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each run of a small bucket.

    Runs of large buckets come without bytes, cut further where the minimisers of the
    windows' ends change; a text that has such runs comes once as a whole, without bucket.
    """
    for batch in in_slices(batches):
        for row, data, runs in zip(*(batch[i].to_pylist() for i in range(3)), strict=True):
            out = with_data(({**r, "part": 0, "split": False} for r in runs if not r["large"]), row, data)
            large = [r for r in runs if r["large"]]
            for run in large:
                for ends, first, count in zip(*end_runs(data, run["first"], run["count"]), strict=True):
                    out.append({**run, "row": row, "ends": ends, "first": first, "count": count})
            if large:
                out.append({"row": row, "data": data})
            yield pa.RecordBatch.from_pylist(out, schema=CUT)


def cut_large(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of what is left of the runs of large buckets; neighbouring runs of a bucket are one."""
    for batch in batches:
        for row, data, runs in zip(*(batch[i].to_pylist() for i in range(3)), strict=True):
            whole: list[dict] = []
            for run in sorted(runs, key=lambda r: r["first"]):
                last = whole[-1] if whole else None
                next_to = last and (last["bucket"], last["first"] + last["count"]) == (run["bucket"], run["first"])
                if next_to and last["count"] + run["count"] <= RUN:
                    last["count"] += run["count"]
                else:
                    whole.append(run)
            yield pa.RecordBatch.from_pylist(with_data(whole, row, data), schema=CUT)


def per_text(runs: DataFrame, *columns: str) -> DataFrame:
    return runs.groupBy("row").agg(F.collect_list(F.struct(*columns)).alias("runs"))  # bounded by the text


def fill() -> Column:
    """Parts that the runs of a bucket fill, by number and by bytes."""
    size = F.col("count").cast("long") + (WINDOW - 1)
    return F.greatest(F.sum("times") / PART, F.sum(size) / PART_BYTES)


def in_batches(space: Workspace, rows: DataFrame) -> DataFrame:
    """Saves what functions on texts give, with few texts at once on either side."""
    with setting(space.spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH)):
        return space.save(rows)


def live_runs(space: Workspace, texts: DataFrame) -> DataFrame:
    """Runs of windows that may come again, with their bytes and the part of their bucket.

    A run alone in its bucket is not among them. The windows of a bucket of more than a part
    must share the minimisers of both their ends, too, which drops most of what a passage of
    very many texts is followed and preceded by; a bucket still larger is split by hash.
    """
    runs = in_batches(space, texts.mapInArrow(text_runs, RUNS))
    sizes = runs.groupBy("bucket").agg(F.sum("times").alias("n"), (fill() > 1).alias("large")).where("n > 1")
    sizes = space.save(sizes.select("bucket", "large"))
    live = per_text(runs.join(sizes, "bucket"), "bucket", "large", "first", "count", "times")
    # a merge at any size: the texts are the larger side by far
    cut = in_batches(space, texts.join(live.hint("merge"), "row").mapInArrow(cut_runs, CUT_SQL))
    space.free(runs, sizes)
    ends = cut.where("ends is not null").select("row", "bucket", "ends", "first", "count", "times")
    again = space.save(ends.groupBy("bucket", "ends").agg(F.sum("times").alias("m")).where("m > 1"))
    left = space.save(ends.join(again, ["bucket", "ends"]).drop("ends", "m"))
    filled = left.withColumn("times", F.lit(1)).groupBy("bucket").agg(F.ceil(fill()).alias("parts"))
    parts = F.col("parts")
    dealt = (
        left.join(space.save(filled), "bucket")
        .withColumn("part", F.pmod(F.xxhash64("row", "bucket", F.floor(F.col("first") / STRETCH)), parts))
        .withColumn("split", parts > 1)
    )
    whole = cut.where("bucket is null").select("row", "data")
    large = whole.join(per_text(dealt, "bucket", "part", "split", "first", "count"), "row").mapInArrow(cut_large, CUT_SQL)
    return cut.where("ends is null and bucket is not null").unionByName(large)


def repeated_spans(spark: SparkSession, docs: DataFrame, text: str = "text") -> DataFrame:
    """Spans (`row`, `start`, `end`) of every repeated window, overlapping, in bytes of the input.

    Parts of a split bucket compare their own windows and pass on one window per class with
    two 64-bit fingerprints, which are then counted over all parts, so that a passage in a
    third of all documents is one fingerprint per part. No window is left out.

    Null text is empty; a very long text is many runs, in many parts; repeated rows repeat
    each other; ties between equal windows do not matter, as all of them are spans; other
    columns play no part; an empty table gives no rows.
    """
    space = Workspace(spark, "suffixes")
    data = F.encode(whole_text(text), "UTF-8").alias("data")
    texts = numbered(docs).select(F.col(ROW).alias("row"), data)
    runs = live_runs(space, texts).select("bucket", "part", "split", "row", "first", "count", "data")
    dealt = runs.repartition("bucket", "part").sortWithinPartitions("bucket", "part")
    found = in_batches(space, dealt.mapInArrow(sorted_blocks, FOUND_SQL))
    single = found.where("mark is null").select("row", "start", "end")
    marked = found.where("mark is not null")
    across = space.save(marked.groupBy("mark", "mark2").agg(F.count("*").alias("n")).where("n > 1"))
    return single.unionByName(marked.join(across, ["mark", "mark2"]).select("row", "start", "end"))


def kept_text(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    shape = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("data", pa.binary()), ("spans", pa.list_(span)),
                       ("kept", pa.binary())])
    for batch in in_slices(batches):
        out = []
        for row, doc, data, found in zip(*(batch[i].to_pylist() for i in range(4)), strict=True):
            spans: list[dict] = []
            for one in sorted(found or (), key=lambda s: s["start"]):
                if spans and one["start"] <= spans[-1]["end"]:
                    spans[-1]["end"] = max(spans[-1]["end"], one["end"])
                else:
                    spans.append(dict(one))
            ends = [0, *(s["end"] for s in spans)]
            starts = [*(s["start"] for s in spans), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(ends, starts, strict=True))
            out.append({"row": row, "doc_id": doc, "data": data, "spans": spans, "kept": kept})
        yield pa.RecordBatch.from_pylist(out, schema=shape)


def remove_repeats(spark: SparkSession, docs: DataFrame, text: str = "text") -> DataFrame:
    """Every document with its bytes (`data`), maximal removed `spans` and `kept` bytes.

    Each byte covered by a WINDOW-byte string that also starts elsewhere, in the same or
    another document, is removed; the first copy too. Null text counts as empty; texts
    shorter than WINDOW keep all; repeated rows count as copies of each other; kept bytes
    may end inside a character, so they stay bytes.
    """
    spans = repeated_spans(spark, docs, text).groupBy("row").agg(
        F.collect_list(F.struct("start", "end")).alias("spans")  # bounded by the text
    )
    texts = numbered(docs).select(
        F.col(ROW).alias("row"), F.col("doc_id").cast("long"), F.encode(whole_text(text), "UTF-8").alias("data")
    )
    return texts.join(spans, "row", "left").mapInArrow(
        kept_text, "row long, doc_id long, data binary, spans array<struct<start:long,end:long>>, kept binary"
    )


def repeat_report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Sizes, spans and checksum of what `remove_repeats` leaves."""
    done = remove_repeats(spark, docs)
    n = F.octet_length("data").cast("long")
    return done.select(
        "doc_id",
        n.alias("n_bytes"),
        (n - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
