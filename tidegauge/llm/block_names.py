"""Exact dedup by deterministic block naming: integer names for blocks, then for pairs of names."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, Workspace, numbered, union, whole_text

BLOCK = 4096


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; `lower` is faster and does just that to pure ASCII."""
    pure = F.octet_length(text) == F.length(text)
    return F.when(pure, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def named(space: Workspace, rows: DataFrame, *content: str) -> DataFrame:
    """`rows` with `name`: the least `place` of all rows with the same content, which goes.

    Equal content, equal name, and no two contents share one, since the content itself is
    compared. Places are summed up before the shuffle, and only contents that come twice
    are stored and joined back; a content of a third of all rows is one row there, and
    Spark splits the other side.
    """
    names = rows.groupBy(*content).agg(F.min("place").alias("name"), F.count("*").alias("n_rows"))
    names = space.save(names.where("n_rows > 1").drop("n_rows"))
    return rows.join(names, list(content), "left").withColumn("name", F.coalesce("name", "place")).drop(*content)


def block_level(docs: DataFrame, block: int) -> DataFrame:
    """Blocks of the normalised texts: document row, index, place, number of blocks, content."""
    text = ascii_lower(whole_text("text"))
    norm = numbered(docs).select(ROW, F.col("doc_id"), F.encode(text, "UTF-8").alias("data"))
    blocks = F.greatest(F.lit(1), F.ceil(F.octet_length("data") / block)).cast("int")
    cut = norm.select(
        ROW, "doc_id", "data", blocks.alias("n"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("idx")
    )
    first = F.col("idx") == 0
    return cut.select(
        ROW,
        "idx",
        F.monotonically_increasing_id().alias("place"),
        "n",
        F.when(first, F.col("doc_id")).alias("doc_id"),
        F.when(first, F.sha2("data", 256)).alias("text_sha256"),
        F.substring("data", F.col("idx") * block + 1, F.lit(block)).alias("block"),
    )


def identities(space: Workspace, docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every document's row, doc_id, sha256 and identity (`level`, `name`): equal iff its text is.

    Level 0 names blocks of `block` bytes by their content; each further level names pairs
    of neighbouring names by the two integers, an odd last one alone, until a document has
    one name. Blocks are shuffled once to be summed up and once to be joined; the levels
    after that hold integers only and halve each time.
    """
    level = space.save(named(space, block_level(docs, block), "block"))
    rows = level.where("idx = 0").select(ROW, "doc_id", "text_sha256")
    depth, tops = 0, []
    while True:
        tops.append(level.where("n = 1").select(ROW, F.lit(depth).alias("level"), "name"))
        longer = level.where("n > 1")
        if longer.isEmpty():
            break
        side = F.col("idx") % 2
        pairs = longer.groupBy(ROW, F.shiftright("idx", 1).alias("idx")).agg(
            F.min("place").alias("place"),
            F.max(F.ceil(F.col("n") / 2).cast("int")).alias("n"),
            F.max(F.when(side == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(side == 1, F.col("name"))), F.lit(-1)).alias("right"),
        )
        level = space.save(named(space, pairs, "left", "right"))
        depth += 1
    return rows.join(union(tops), ROW)


def exact_groups(spark: SparkSession, docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and its row number.

    Texts are equal if they are after lower-casing A-Z; null counts as empty. The largest
    doc_id of a group stays (null is the smallest); of rows that repeat it, the last one
    stays, so a group always keeps exactly one row. Other columns play no part; an empty
    table gives no rows.
    """
    space = Workspace(spark, "exact")
    rows = space.save(identities(space, docs, block))
    top = F.max(F.struct("doc_id", ROW)).alias("top")
    groups = space.save(rows.groupBy("level", "name").agg(top, F.count("*").alias("group_size")))
    return rows.join(groups, ["level", "name"]).select(
        ROW,
        "doc_id",
        F.col("top.doc_id").alias("keep_id"),
        "group_size",
        (F.col(ROW) == F.col(f"top.{ROW}")).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """`docs` without the rows `exact_groups` drops; all columns stay as they are."""
    kept = exact_groups(spark, docs).where("kept").select(ROW)
    return numbered(docs).join(kept, ROW, "left_semi").drop(ROW)
