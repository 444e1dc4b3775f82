"""Quality rules: base counts per document, and line frequency across the documents of a host."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, Workspace, numbered, whole_text

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"


@dataclass(frozen=True)
class Limits:
    """A line goes if it is in more than `share` of the distinct documents of its host, and in
    more than `documents` of them, a floor for hosts of few; a document goes if lines with over
    `depleted` of its words went, or by the base rules. Of a group of near copies, which share
    lines that few others have, one stays with all its lines."""

    documents: int = 3
    share: float = 0.005
    depleted: float = 0.5
    least_words: int = 50
    repeated_percent: int = 50


def line_key(line: str) -> int:
    """Hash of a line, or of a whole text, without case and with single spaces."""
    value = xxhash.xxh3_64_intdigest(" ".join(line.lower().split()))
    return value - (1 << 64) if value >> 63 else value


def repeated_words(words: list[bytes]) -> int:
    """Words covered by 3-word windows that the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered, upto = 0, 0
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered += i + 3 - max(i, upto)
            upto = i + 3
    return covered


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    data = text.encode()
    words = data.split()
    seen: set[bytes] = set()
    doubled = 0
    for line in data.split(b"\n"):
        if line.strip():
            doubled += line in seen
            seen.add(line)
    spaces = len(data) - len(data.translate(None, SPACES))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    return len(words), len(text) - spaces, symbols, doubled, repeated_words(words)


def line_words(text: str) -> tuple[list[int], list[int]]:
    """Keys of the distinct lines that have a word, and the words they hold in the text."""
    found: dict[int, int] = {}
    for line in text.split("\n"):
        if words := len(line.encode().split()):
            key = line_key(line)
            found[key] = found.get(key, 0) + words
    return list(found), list(found.values())


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHAPE = f"row long, doc_id long, host string, content long, {', '.join(f'{c} long' for c in COUNTS)}, lines array<long>, words array<int>"


def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), *[pa.int64()] * 5, pa.list_(pa.int64()), pa.list_(pa.int32())]
    names = ["row", "doc_id", "host", "content", *COUNTS, "lines", "words"]
    for batch in batches:
        rows = [
            (row, doc, host, line_key(text), *base_counts(text), *line_words(text))
            for row, doc, host, text in zip(*(c.to_pylist() for c in batch.columns), strict=True)
        ]
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
        )


def frequent_lines(stats: DataFrame, limits: Limits) -> DataFrame:
    """(`host`, `line`) in too many distinct documents.

    Copies are no distinct documents: a document is told by its whole text without case and
    with single spaces, so copies count once and different texts never collapse, whatever
    lines they share. Distinct counts are summed up in two steps, first per document, so a
    line of a third of all documents is no hot group.
    """
    lines = stats.select("host", "content", F.explode("lines").alias("line"))
    per_line = lines.groupBy("host", "line").agg(F.countDistinct("content").alias("documents"))
    hosts = stats.where(F.size("lines") > 0).groupBy("host").agg(F.countDistinct("content").alias("of_host"))
    many = per_line.where(F.col("documents") > limits.documents)
    return (
        many.join(hosts, "host")
        .where(F.col("documents") > F.col("of_host") * limits.share)
        .select("host", "line", "documents")
    )


def spared_contents(lost: DataFrame) -> DataFrame:
    """(`host`, `content`) that stay although their lines are frequent, of the documents that would go for it.

    Near copies lose the lines they share. They are told by the rarest line that each of them
    loses: if half the distinct documents with that line would go, these are its only ones,
    rather than pages that share a notice. The first of them stays for all.
    """
    line = F.col("rarest.line").alias("line"), F.col("rarest.documents").alias("documents")
    of_content = lost.groupBy("host", *line, "content").agg(F.min("row").alias("row"))
    groups = of_content.groupBy("host", "line", "documents").agg(
        F.count("*").alias("n"), F.min(F.struct("row", "content")).alias("first")
    )
    return groups.where(2 * F.col("n") >= F.col("documents")).select("host", F.col("first.content").alias("content")).distinct()


def judged(space: Workspace, docs: DataFrame, host: str, limits: Limits) -> DataFrame:
    """Base counts, verdict and the keys of the removed lines of every document, by row number."""
    texts = numbered(docs).select(
        F.col(ROW).alias("row"), F.col("doc_id").cast("long"), F.coalesce(host, F.lit("")).alias("host"), whole_text("text")
    )
    stats = space.save(texts.mapInArrow(counted, SHAPE))
    frequent = space.save(frequent_lines(stats, limits))
    lines = stats.select("row", "host", F.explode(F.arrays_zip("lines", "words")).alias("l"))
    gone = (
        lines.select("row", "host", F.col("l.lines").alias("line"), F.col("l.words").alias("words"))
        .join(frequent, ["host", "line"])
        .groupBy("row")
        .agg(
            F.sum("words").alias("gone_words"),
            F.collect_list("line").alias("gone"),  # bounded by the text
            F.min(F.struct("documents", "line")).alias("rarest"),
        )
    )
    base = (F.col("n_words") < limits.least_words) | (
        100 * F.col("n_repeat_words") > limits.repeated_percent * F.col("n_words")
    )
    depleted = F.coalesce("gone_words", F.lit(0)) > limits.depleted * F.col("n_words")
    found = space.save(
        stats.drop("lines", "words")
        .join(gone, "row", "left")
        .withColumn("base_failed", base)
        .withColumn("depleted", ~base & depleted)
    )
    spared = spared_contents(found.where("depleted")).withColumn("spared", F.lit(True))
    spared_row = F.col("depleted") & F.coalesce("spared", F.lit(False))
    return (
        found.join(spared, ["host", "content"], "left")
        .withColumn("kept", ~F.col("base_failed") & (~F.col("depleted") | spared_row))
        .withColumn("gone_words", F.when(~spared_row, F.col("gone_words")))
        .withColumn("gone", F.when(~spared_row, F.col("gone")))
        .drop("host", "content", "spared", "depleted", "rarest")
    )


def quality_report(spark: SparkSession, docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """One row per document: base counts, `base_failed`, `kept`, and the words of removed lines.

    Null text has no words and fails; null hosts are a host of their own (the empty one);
    repeated rows are judged alike, and so are texts that differ in case and spacing only;
    very long texts are read whole; ties between copies go by row number; an empty table
    gives no rows; other columns play no part.
    """
    return judged(Workspace(spark, "lines"), docs, host, limits).select(
        "doc_id", *COUNTS, "base_failed", "kept", F.coalesce("gone_words", F.lit(0)).cast("long").alias("n_removed_words")
    )


def without_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines whose keys are listed; the last two columns are text and keys."""
    for batch in batches:
        texts, keys = batch[batch.num_columns - 2].to_pylist(), batch[batch.num_columns - 1].to_pylist()
        out = []
        for text, gone in zip(texts, keys, strict=True):
            if gone:
                listed = set(gone)
                text = "\n".join(x for x in text.split("\n") if line_key(x) not in listed)
            out.append(text)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-2], pa.array(out, pa.string())], names=batch.schema.names[:-1]
        )


def apply_rules(spark: SparkSession, docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """The documents that pass, without their removed lines; the other columns stay as they are."""
    verdicts = judged(Workspace(spark, "rules"), docs, host, limits).where("kept")
    gone = verdicts.select(F.col("row").alias(ROW), F.col("gone").alias("__gone"))
    passing = numbered(docs).join(gone, ROW)
    others = [c for c in docs.columns if c != "text"]
    shaped = passing.select(*others, "text", "__gone")
    schema = shaped.drop("__gone").schema
    return shaped.mapInArrow(without_lines, schema).select(*docs.columns)
