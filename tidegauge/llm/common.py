"""What several operators share: tables, row numbers, stored intermediate tables."""

from __future__ import annotations

import itertools
import math
import shutil
import tempfile
from collections.abc import Iterable
from pathlib import Path
from urllib.parse import urlsplit

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_dir, scratch_dir, setting

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Reserved: the one column name that a table given to an operator must not have.
ROW = "__tidegauge_row"


PACKAGE = Path(__file__).resolve().parents[1]


def ship(spark: SparkSession) -> None:
    """Gives executors this package, for the functions that run in their Python workers."""
    context = spark.sparkContext
    archive = f"{PACKAGE.name}-functions"
    if not any(archive in name for name in context._python_includes):
        folder = tempfile.mkdtemp()  # Spark copies the file from the driver to the executors
        context.addPyFile(shutil.make_archive(f"{folder}/{archive}", "zip", PACKAGE.parent, PACKAGE.name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def is_scan(rows: DataFrame) -> bool:
    """Whether `rows` is a scan of Parquet files with projections and filters, one row per stored row."""
    plan = rows._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().apply(0)
    if plan.nodeName() != "LogicalRelation":
        return False
    hidden = plan.metadataOutput()
    return any("row_index" in hidden.apply(i).dataType().catalogString() for i in range(hidden.size()))


def plain_path(uri: str) -> str:
    """A file's address as Spark's `_metadata.file_path` has it."""
    parts = urlsplit(uri)
    return (f"{parts.scheme}://{parts.netloc}" if parts.netloc else f"{parts.scheme}:") + parts.path


def file_numbers(files: list[str]) -> tuple[int, str]:
    """Bits and salt under which the hashes of the files' paths are all distinct."""
    bits = math.ceil(2 * math.log2(max(1, len(files))))
    for salt in map(str, itertools.count()):
        numbers = {xxhash.xxh64_intdigest(path + salt, seed=42) >> (64 - bits) for path in files} if bits else {0}
        if len(numbers) == len(files) or not files:
            return bits, salt


def numbered(rows: DataFrame) -> DataFrame:
    """Adds ROW, a number per row that is the same each time the rows are read, by any number of cores.

    It is the hash of the row's file, of just the bits and with a salt under which no two of
    the files collide, and the row's place in the file: how Spark deals files to tasks plays
    no part. Rows that are no scan of Parquet files (the result of a shuffle, say, or rows
    from the driver) are written to the shared folder first, once for one DataFrame.
    """
    spark = rows.sparkSession
    ship(spark)
    if not is_scan(rows):
        if not hasattr(rows, "stored_copy"):
            rows.stored_copy = Workspace(spark, "rows").save(rows)
        rows = rows.stored_copy
    bits, salt = file_numbers([plain_path(f) for f in rows.inputFiles()])
    origin = rows.metadataColumn("_metadata")
    place, room = origin["row_index"], 63 - bits
    if not bits:
        return rows.withColumn(ROW, place)
    file = F.shiftrightunsigned(F.xxhash64(F.concat(origin["file_path"], F.lit(salt))), 64 - bits)
    number = F.when(place < 1 << room, F.shiftleft(file, room) + place)
    return rows.withColumn(ROW, number.otherwise(F.raise_error(F.lit("a file has too many rows to number"))))


def whole_text(text: str | Column) -> Column:
    """Null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


class Workspace:
    """Tables in the shared folder that cut an operator's plan into recoverable parts.

    A lost executor costs the running part only. `save` also drops the shuffle files of the
    part; `free` drops a table that no later part reads. What is left goes when the
    application ends, since a lazy result may still read it.
    """

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        self.spark = spark
        self.folder = scratch_dir(spark, purpose)
        self.count = itertools.count()

    def save(self, rows: DataFrame) -> DataFrame:
        path = f"{self.folder}/{next(self.count)}"
        with setting(self.spark, CLEANUP, "true"):
            rows.write.option("compression", "zstd").parquet(path)
        saved = self.spark.read.schema(rows.schema).parquet(path)
        saved.stored_at = path
        return saved

    def free(self, *saved: DataFrame) -> None:
        for one in saved:
            remove_dir(self.spark, one.stored_at)


def union(parts: Iterable[DataFrame]) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
