"""Best-fit packing by hierarchical residual packing.

Pieces are dealt to tasks by hash and packed best-fit there. A task emits the sequences that
are full or nearly so; the others go on as single items, and fewer, larger groups of such
items are packed again, up a tree, until one group is left or a level stops helping.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, Workspace, numbered, union, whole_text

SEQUENCE = 2048
NEARLY_FULL = 16
GROUP = 16_000
#: Both libraries are known to cut this range alike (tests); other texts go the slow way.
PLAIN = r"[^\x00-ɏ‐-‧€]"

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
ITEM = f"length long, members array<struct<{PIECE.replace(' long', ':long').replace(' int', ':int')}, row:long>>"


def encoder(json_path: str, ranks_path: str):
    """Function text -> ids of the tokenizer file `json_path`.

    Its vocabulary as ranks in `ranks_path` gives the same ids about five times as fast.
    Texts that hold a special token's name or characters on which the two libraries'
    character classes may differ are cut by the tokenizer file itself.
    """
    import base64

    import public_tokenizers
    import regex
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    exact = Tokenizer.from_file(json_path)
    special = regex.compile("|".join([PLAIN, regex.escape("<|endoftext|>")]))

    def ids(text: str) -> list[int]:
        if special.search(text):
            return exact.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return ids


def token_pieces(docs: DataFrame, json_path: str, ranks_path: str, sequence: int = SEQUENCE) -> DataFrame:
    """Every document as pieces of at most `sequence` ids: its text's ids, then id 0.

    Of a longer document the first piece is the short one. Null text counts as empty and
    gives the one id 0; a null doc_id stays null.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(json_path, ranks_path)
        for batch in batches:
            rows = []
            for row, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.array([*ids_of(text), 0], dtype="<u4")
                first = len(ids) % sequence or min(len(ids), sequence)
                starts = [0, *range(first, len(ids), sequence)]
                for piece, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    rows.append((doc, piece, start, end - start, zlib.crc32(ids[start:end].tobytes()), row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 6, types, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "row"],
            )

    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    text = numbered(docs).select(ROW, F.col("doc_id").cast("long"), whole_text("text"))
    return text.mapInArrow(cut, f"{PIECE}, row long")


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest items first, each into the fullest bin it fits.

    Bins wait in a stack per free space; the occupied spaces are the bits of one integer,
    so the tightest fit is a shift and a lowest bit.
    """
    bins: list[list[int]] = []
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces = 0
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need = lengths[item]
        fitting = spaces >> need
        if fitting:
            space = need + (fitting & -fitting).bit_length() - 1
            place = waiting[space].pop()
            if not waiting[space]:
                spaces ^= 1 << space
        else:
            space, place = capacity, len(bins)
            bins.append([])
        bins[place].append(item)
        left = space - need
        if left:
            waiting[left].append(place)
            spaces |= 1 << left
    return bins


def packed(items: DataFrame, groups: int, depth: int, capacity: int) -> DataFrame:
    """One level: items dealt to `groups` tasks by hash, anew at each depth, and packed best-fit there."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [row for batch in batches for row in batch.to_pylist()]
        # a fixed order, so that a task that runs again makes the same bins
        table.sort(key=lambda r: tuple((m["row"], m["piece"]) for m in r["members"][:1]))
        lengths = [r["length"] for r in table]
        out = [
            {"length": sum(lengths[i] for i in bin_), "members": [m for i in bin_ for m in table[i]["members"]]}
            for bin_ in best_fit(lengths, capacity)
        ]
        for at in range(0, len(out), 2000):
            yield pa.RecordBatch.from_pylist(out[at : at + 2000], schema=shape)

    member = pa.struct(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
         ("ids_crc32", pa.int64()), ("row", pa.int64())]
    )
    shape = pa.schema([("length", pa.int64()), ("members", pa.list_(member))])
    first = F.col("members")[0]
    return items.repartition(groups, first["row"], first["piece"], F.lit(depth)).mapInArrow(pack, ITEM)


def pack_pieces(spark: SparkSession, pieces: DataFrame, capacity: int = SEQUENCE, group: int = GROUP) -> DataFrame:
    """`pieces` with `sequence_id` and `offset`, in as few sequences of `capacity` as best-fit finds.

    A group of `group` items is the most one task holds, at every level; a sequence has at
    most `capacity` members. Pieces that fill a sequence are not packed at all. A level
    whose items would still need several groups and that saves under 1 in 1,000 sequences
    is the last: what does not fit together in any group stays as it is, whole.
    """
    space = Workspace(spark, "packing")
    own = F.struct("doc_id", "piece", "start", "length", "ids_crc32", "row")
    stored = space.save(pieces)
    items = stored.select("length", F.array(own).alias("members"))
    full = items.where(F.col("length") == capacity)
    level = items.where(F.col("length") < capacity)
    done, waiting = [full], level.count()
    for depth in itertools.count():
        if not waiting:
            break
        groups = -(-waiting // group)
        bins = space.save(packed(level, groups, depth, capacity))
        nearly = F.col("length") > capacity - NEARLY_FULL
        before, (made, waiting) = waiting, bins.agg(F.count("*"), F.count_if(~nearly)).first()
        if groups == 1 or made > 0.999 * before:
            done.append(bins)
            break
        done.append(bins.where(nearly))
        level = bins.where(~nearly)
    bins = union(done).withColumn("sequence_id", F.monotonically_increasing_id())
    placed = bins.select(
        "sequence_id", F.posexplode("members").alias("at", "m"), F.col("members.length").alias("lengths")
    )
    before = F.aggregate(F.slice("lengths", F.lit(1), F.col("at")), F.lit(0).cast("long"), lambda a, x: a + x)
    return placed.select("m.doc_id", "m.piece", "m.start", "m.length", "m.ids_crc32", "sequence_id", before.alias("offset"))


def pack_documents(spark: SparkSession, docs: DataFrame, json_path: str, ranks_path: str) -> DataFrame:
    """All documents packed. An empty table gives no rows; repeated rows are packed one by one."""
    return pack_pieces(spark, token_pieces(docs, json_path, ranks_path))
