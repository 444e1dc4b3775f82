"""Sharding: a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import ROW, numbered, whole_text

RING_BITS = 64
#: A slice of over so many times the mean is ranked in cells.
HEAVY = 4

SEATS = T.StructType(
    [
        T.StructField("__slice", T.LongType()),
        T.StructField("__first", T.LongType()),
        T.StructField("__upto", T.LongType()),
        T.StructField("__shard", T.IntegerType()),
        T.StructField("__first_slot", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Ring:
    """The ring is cut into 2^slice_bits equal slices, the unit in which rows are counted.

    `load` bounds a shard at that multiple of the mean; 1.0 fills all of them, to within
    one row. A lower bound on balance costs movement: rows beyond it walk on clockwise.
    """

    shards: int = 40
    nodes: int = 64
    slice_bits: int = 12
    load: float = 1.0

    def points(self) -> list[tuple[int, int]]:
        """(slice, shard) of every virtual node, clockwise."""
        places = []
        for shard in range(self.shards):
            for node in range(self.nodes):
                digest = hashlib.sha256(f"{shard}:{node}".encode()).digest()
                places.append((int.from_bytes(digest[:8], "big"), shard))
        return [(place >> (RING_BITS - self.slice_bits), shard) for place, shard in sorted(places)]

    def capacities(self, rows: int) -> list[int]:
        if self.load > 1:
            return [math.ceil(self.load * rows / self.shards)] * self.shards
        share, more = divmod(rows, self.shards)
        return [share + (shard < more) for shard in range(self.shards)]


def seats(ring: Ring, counts: dict[int, int]) -> list[tuple[int, int, int, int, int]]:
    """Which rows of each slice sit in which shard, from the row counts alone.

    All slices offer their rows to their first node; what a full shard turns away walks on
    to the next node, and so on. The work depends on slices and nodes, not on rows.
    """
    points, room = ring.points(), ring.capacities(sum(counts.values()))
    filled = [0] * ring.shards
    nodes, at, waiting = len(points), 0, []
    for piece in range(1 << ring.slice_bits):
        while at < nodes and points[at][0] < piece:
            at += 1
        if counts.get(piece):
            waiting.append((piece, 0, counts[piece], at % nodes))
    placed = []
    while waiting:
        turned_away = []
        for piece, first, upto, node in waiting:
            shard = points[node][1]
            taken = min(upto - first, room[shard] - filled[shard])
            if taken:
                placed.append((piece, first, first + taken, shard, filled[shard]))
                filled[shard] += taken
            if first + taken < upto:
                turned_away.append((piece, first + taken, upto, (node + 1) % nodes))
        waiting = turned_away
    return placed


def heavy_cells(counts: dict[int, int]) -> dict[int, int]:
    """Slices of over HEAVY times the mean, and into how many cells each is split to be ranked."""
    lot = max(1, HEAVY * sum(counts.values()) // max(1, len(counts)))
    return {piece: -(-n // lot) for piece, n in counts.items() if n > lot}


def ring_shards(spark: SparkSession, rows: DataFrame, key: str = "doc_id", ring: Ring = Ring()) -> DataFrame:
    """`rows` with `shard` and `slot`, its place in the shard (gapless from 0).

    The key's hash is its place on the ring; within a slice, rows stand in hash order. Two
    passes: count rows per slice (2^slice_bits counts reach the driver, however many rows
    there are), then rank rows within their slice and look the rank up in the seats, a
    table bounded by slices, nodes and shards. A slice holds 1/2^slice_bits of the rows:
    raise `slice_bits` with the data.

    A slice of over HEAVY times the mean, as a key with a third of all rows makes it, is split
    into cells by row number; a rank is then the rank in the cell and the sizes of the cells
    before it, so that no task ranks a whole hot key. There are at most 2^slice_bits / HEAVY
    cells more than slices.

    Null keys are spread by row number. Repeated keys share a ring place and take
    neighbouring slots; an empty table gives no rows; other columns are kept.
    """
    own = F.xxhash64(F.lit("no key"), ROW)
    place = F.when(F.col(key).isNull(), own).otherwise(F.xxhash64(key))
    placed = numbered(rows).withColumn("__place", place).withColumn(
        "__slice", F.shiftrightunsigned("__place", RING_BITS - ring.slice_bits)
    )
    counts = {r["__slice"]: r["count"] for r in placed.groupBy("__slice").count().collect()}
    plan = spark.createDataFrame(seats(ring, counts), SEATS)
    cells = heavy_cells(counts)
    split = F.broadcast(spark.createDataFrame(list(cells.items()), "__slice long, __cells int"))
    cell = F.coalesce(F.pmod(F.xxhash64(F.lit("cell"), ROW), F.col("__cells")), F.lit(0)).cast("int")
    dealt = placed.join(split, "__slice", "left").withColumn("__cell", cell)
    sizes = dealt.where("__cells is not null").groupBy("__slice", "__cell").count().collect() if cells else []
    before, ahead = [], dict.fromkeys(cells, 0)
    for piece, at, n in sorted(sizes):
        before.append((piece, at, ahead[piece]))
        ahead[piece] += n
    offsets = F.broadcast(spark.createDataFrame(before, "__slice long, __cell int, __before long"))
    order = Window.partitionBy("__slice", "__cell").orderBy("__place", ROW)
    ranked = dealt.withColumn("__own", F.row_number().over(order) - 1).join(offsets, ["__slice", "__cell"], "left")
    seat = F.broadcast(plan)  # at most slices + nodes x shards rows
    rank = F.col("__rank")
    return (
        ranked.withColumn("__rank", F.col("__own") + F.coalesce("__before", F.lit(0)))
        .join(seat, "__slice")
        .where((rank >= F.col("__first")) & (rank < F.col("__upto")))
        .withColumn("shard", F.col("__shard"))
        .withColumn("slot", F.col("__first_slot") + rank - F.col("__first"))
        .drop("__place", "__rank", "__own", "__before", "__cell", "__cells", ROW, *SEATS.names)
    )


def shard_documents(spark: SparkSession, docs: DataFrame, ring: Ring = Ring()) -> DataFrame:
    """Shard, slot, size and checksum of every document; law `rows`: counts differ by one at most."""
    data = F.encode(whole_text("text"), "UTF-8")
    sized = docs.select(
        "doc_id", (F.octet_length(data) + 16).cast("long").alias("size"), F.crc32(data).alias("text_crc32")
    )
    return ring_shards(spark, sized, "doc_id", ring).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
