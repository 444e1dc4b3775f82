"""Vector code compression: nearest codebook entries by per-dimension value dictionaries."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, ship

#: More labels than this are joined by a shuffle; a row of the sums is under 100 bytes.
BROADCAST_LABELS = 50_000
#: Vectors whose distances to all entries of a part are in memory at once.
SLICE = 4096


@dataclass(frozen=True)
class Codec:
    """Components are floor(`scale` x); a vector is cut into `parts` equal consecutive parts, each
    of which has a codebook of `entries` that `rounds` rounds refine."""

    scale: int = 256
    parts: int = 16
    entries: int = 64
    rounds: int = 2


def integers(vectors: pa.Array, size: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors can be coded (none missing or not finite, `size` components), and their integers."""
    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    fits = np.flatnonzero(lengths == size)
    values = vectors.take(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    finite = np.isfinite(values).all(axis=1)
    floors = np.floor(values[finite] * scale)
    # squared differences of all components have to add up below 2^63
    limit = math.isqrt((2**63 - 1) // size) // 2
    if len(floors) and np.abs(floors).max() > limit:
        raise OverflowError(f"a component beyond {limit // scale} has no exact 64-bit distance")
    return fits[finite], floors.astype(np.int64)


class Tables:
    """Distances of parts to codebook entries by the distinct integers of each dimension.

    A dimension of a batch is a dictionary of its distinct integers and one code per vector.
    For each dictionary value the squared differences to all entries are tabulated once; the
    distance of a part is the sum, over its dimensions, of the rows gathered by its codes.
    """

    def __init__(self, ints: np.ndarray) -> None:
        self.dictionaries = [np.unique(column, return_inverse=True) for column in ints.T]
        self.n = len(ints)

    def nearest(self, book: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (the lowest of several) and its squared distance, for the part at `first`."""
        tables = [
            (values[:, None] - entries[None, :]) ** 2
            for (values, _), entries in zip(self.dictionaries[first : first + book.shape[1]], book.T, strict=True)
        ]
        index, distance = np.empty(self.n, np.int64), np.empty(self.n, np.int64)
        for at in range(0, self.n, SLICE):
            own = slice(at, at + SLICE)
            sums = tables[0][self.dictionaries[first][1][own]]
            for d, table in enumerate(tables[1:], first + 1):
                sums += table[self.dictionaries[d][1][own]]
            index[own] = sums.argmin(axis=1)
            distance[own] = np.take_along_axis(sums, index[own, None], axis=1)[:, 0]
        return index, distance


SUMS = "part int, entry int, n long, sums array<long>"


def totals(books: np.ndarray, codec: Codec) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Count and component sums of the parts next to each entry, one row per entry and task."""
    parts, entries, width = books.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            _, ints = integers(batch[0], parts * width, codec.scale)
            tables = Tables(ints)
            for p in range(parts):
                index, _ = tables.nearest(books[p], p * width)
                order = np.argsort(index, kind="stable")
                used, starts, times = np.unique(index[order], return_index=True, return_counts=True)
                counts[p, used] += times
                if len(used):
                    sums[p, used] += np.add.reduceat(ints[order, p * width : (p + 1) * width], starts, axis=0)
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[p, e]),
             pa.array(list(sums[p, e]), pa.list_(pa.int64()))],
            names=["part", "entry", "n", "sums"],
        )

    return run


CODES = "vec_id long, label string, code string, error long"


def coded(books: np.ndarray, codec: Codec) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    parts, entries, width = books.shape
    digits = max(2, len(f"{entries - 1:x}"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f"{e:0{digits}x}" for e in range(entries)]
        for batch in batches:
            kept, ints = integers(batch[0], parts * width, codec.scale)
            tables, error, columns = Tables(ints), np.zeros(len(ints), np.int64), []
            for p in range(parts):
                index, distance = tables.nearest(books[p], p * width)
                error += distance
                columns.append(index.tolist())
            codes = ["".join(map(names.__getitem__, row)) for row in zip(*columns, strict=True)]
            rows = pa.array(kept)
            yield pa.RecordBatch.from_arrays(
                [batch[1].take(rows), batch[2].take(rows), pa.array(codes, pa.string()), pa.array(error)],
                names=["vec_id", "label", "code", "error"],
            )

    return run


def first_books(vectors: DataFrame, codec: Codec) -> np.ndarray:
    """(part, entry, position) integers: the parts of the vectors of the smallest ids.

    A vector's length is that of the vector with the smallest id among those that can be cut.
    """
    limit = F.lit(float("inf"))
    component = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit)
    usable = vectors.where((F.size("vector") > 0) & (F.size("vector") % codec.parts == 0) & F.forall("vector", component))

    def least(rows: DataFrame) -> list[list[int]]:
        order = F.col("vec_id").asc_nulls_last(), F.col("vector").asc()
        floors = F.transform("vector", lambda x: F.floor(x.cast("double") * codec.scale)).alias("floors")
        return [r["floors"] for r in rows.orderBy(*order).limit(codec.entries).select(floors).collect()]

    found = least(usable)
    if any(len(v) != len(found[0]) for v in found):
        found = least(usable.where(F.size("vector") == len(found[0])))
    if not found:
        return np.empty((codec.parts, 0, 0), np.int64)
    return np.array(found, np.int64).reshape(len(found), codec.parts, -1).transpose(1, 0, 2)


def trained_books(vectors: DataFrame, codec: Codec) -> np.ndarray:
    """Codebooks after all rounds. A round sums up within each task; entries x dimensions sums reach the driver."""
    books = first_books(vectors, codec)
    for _ in range(codec.rounds if books.size else 0):
        sums = vectors.select("vector").mapInArrow(totals(books, codec), SUMS)
        added = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(books.shape[2])]
        refined = books.copy()
        for r in sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *added).collect():
            refined[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(books.shape[2])]
        books = refined
    return books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compressed(
    spark: SparkSession, table: DataFrame, vector: str = "embedding", codec: Codec = Codec()
) -> tuple[DataFrame, np.ndarray]:
    """(`vec_id`, `label`, `code`, `error`) of every vector that can be coded, and the codebooks.

    Left out are vectors that are null, hold a null or a component that is not finite, or
    are not as long as the vector of the smallest id. A code has two hex digits per part
    (as many as the entries need). Rows that repeat an id are vectors of their own; of them
    the codebooks start with those that sort first. A null id comes after all others. With
    fewer vectors than entries the codebooks have an entry per vector; an empty table gives
    no rows. Labels are compared as texts and null is a label; other columns play no part. A
    component too large for exact 64-bit distances fails the job and says so.
    """
    ship(spark)
    vectors = table.select(F.col(vector).alias("vector"), F.col("vec_id").cast("long"), F.col("label").cast("string"))
    books = trained_books(vectors, codec)
    if not books.size:
        return spark.createDataFrame([], CODES), books
    return vectors.mapInArrow(coded(books, codec), CODES), books


def code_report(spark: SparkSession, table: DataFrame, vector: str = "embedding", codec: Codec = Codec()) -> DataFrame:
    """Codes with their errors, those of all vectors of a label, and a checksum of the codebooks.

    Errors are summed per label before the shuffle, so a label of a third of all vectors is
    one row per task.
    """
    codes, books = compressed(spark, table, vector, codec)
    space = Workspace(spark, "codes")
    codes = space.save(codes)
    sums = space.save(codes.groupBy("label").agg(F.sum("error").alias("label_error")))
    sums = sums.withColumnRenamed("label", "of_label")
    if sums.count() <= BROADCAST_LABELS:
        sums = F.broadcast(sums)
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )
