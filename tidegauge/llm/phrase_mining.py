"""Phrase collocations by SETM: occurrence relations, joined at adjacent positions, counted, semi-joined, extended."""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Workspace, ship, union, whole_text
from .hashing import MULTIPLIER, mixed

#: Ends a piece; no text has this byte, as texts are UTF-8.
END = b"\xff"
#: A-Z in lower case, the ends of pieces, and the tab as a space.
TABLE = bytes.maketrans(
    bytes(range(65, 91)) + b".,;:!?\x0a\x0b\x0c\x0d" + b"\t", bytes(range(97, 123)) + END * 10 + b" "
)
#: Bits of the map by which occurrences of frequent phrases are told, whatever the number of
#: phrases: 16 MB. A rare phrase that falls on the bit of a frequent one is dropped by its count.
BITS = 1 << 27
BUCKET = 1 << 15
#: Occurrences that are counted in a task before they are given on, words kept with their counts or
#: names, entries of a row of a relation, and its rows that are joined at once.
CHUNK = 1_000_000
WORDS = 250_000
ENTRIES = 32_768
ROWS = 100


@dataclass(frozen=True)
class Mining:
    """Phrases of 2 to `longest` words with a count of `support`; one goes if `absorb` per cent of its
    occurrences lie in one longer phrase; `top` of each language."""

    support: int = 30
    longest: int = 4
    absorb: int = 80
    top: int = 2000
    scale: int = 2_000_000


class NamesCollide(Exception):
    """Two phrases have one name, one of them a frequent phrase; another salt is needed."""


def tokens(data: bytes) -> list[bytes]:
    """Words in order, with END between pieces."""
    return data.translate(TABLE).replace(END, b" " + END + b" ").split()


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def counted_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, own in counts.items():
            own.pop(END, None)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.binary()).cast(pa.string()),
                 pa.array(list(own.values()), pa.int64())],
                names=["lang", "word", "n"],
            )
        counts.clear()

    for batch in slices(batches):
        for lang, data in zip(batch[0], batch[1], strict=True):
            counts.setdefault(lang.as_py(), Counter()).update(tokens(data.as_py()))
        if sum(map(len, counts.values())) > WORDS:
            yield from flush()
    yield from flush()


def word_name(salt: Column, lang: str, word: str) -> Column:
    return F.xxhash64(salt, F.col(lang), F.col(word))


class Names(dict):
    """Names of the words of a language, 0 for those that are not frequent."""

    def __init__(self, salt: str, lang: str, live: np.ndarray) -> None:
        # as Spark hashes (salt, lang, word)
        self.seed = xxhash.xxh64_intdigest(lang, seed=xxhash.xxh64_intdigest(salt, seed=42))
        self.live = live
        self[END] = 0

    def __missing__(self, word: bytes) -> int:
        name = xxhash.xxh64_intdigest(word, seed=self.seed)
        bit = name % (8 * len(self.live))
        self[word] = name = name if self.live[bit >> 3] >> (bit & 7) & 1 else 0
        return name


RELATION = "at array<int>, name array<long>"


def relation(at: np.ndarray, name: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    """Rows of a relation, from all their entries and where each row starts."""
    offsets = pa.array(np.r_[starts, len(at)].astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (at.astype(np.int32), name.view(np.int64))]
    return pa.RecordBatch.from_arrays(lists, names=["at", "name"])


def word_relation(salt: str, live: Broadcast) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Occurrences of frequent words that stand next to another one, in order of their places.

    A row holds one text, or whole pieces of a very long one. Between two pieces a place is
    left out, so words are neighbours only where their places are.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, Names] = {}
        for part in slices(batches):
            places, found, sizes = [], [], []
            if sum(map(len, names.values())) > WORDS:
                names.clear()
            for lang, data in zip(part[0].to_pylist(), part[1].to_pylist(), strict=True):
                if lang not in names:
                    names[lang] = Names(salt, lang, live.value)
                words = tokens(data)
                name = np.fromiter(map(names[lang].__getitem__, words), np.uint64, len(words))
                at = np.flatnonzero(name)
                step = np.diff(at) == 1
                at = at[np.r_[False, step] | np.r_[step, False]] if len(at) else at
                if len(at):
                    places.append(at)
                    found.append(name[at])
                    ends = np.flatnonzero(np.diff(at) > 1) + 1
                    cuts = np.unique(ends[np.searchsorted(ends, np.arange(ENTRIES, ends[-1], ENTRIES))]) if len(ends) else ends
                    sizes += np.diff(np.r_[0, cuts, len(at)]).tolist()
            if sizes:
                yield relation(np.concatenate(places), np.concatenate(found), np.r_[0, np.cumsum(sizes)[:-1]])

    return run


def neighbours(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The relation joined with itself at the next place: place, both names, and the row of each pair."""
    lists = batch["at"]
    sizes = lists.value_lengths().to_numpy()
    at, name = lists.flatten().to_numpy(), batch["name"].flatten().to_numpy().view(np.uint64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    pair = np.flatnonzero((np.diff(at) == 1) & (row[1:] == row[:-1]))
    return at[pair], name[pair], name[pair + 1], row[pair]


def joined_name(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mixed(left * MULTIPLIER + (right ^ (right >> np.uint64(29))))


GROUPS = "name long, left long, right long, n long"


def counted_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases one word longer than those of the relation, and how often a task meets them."""
    held: list[tuple] = []

    def flush() -> Iterator[pa.RecordBatch]:
        left, right = (np.concatenate(c) for c in zip(*held, strict=True))
        held.clear()
        name, first, n = np.unique(joined_name(left, right), return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c.view(np.int64)) for c in (name, left[first], right[first], n)], names=["name", "left", "right", "n"]
        )

    size = 0
    for batch in slices(batches):
        _, left, right, _ = neighbours(batch)
        held.append((left, right))
        size += len(left)
        if size > CHUNK:
            yield from flush()
            size = 0
    if held:
        yield from flush()


def longer_relation(live: Broadcast) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The relation of the next length: pairs whose phrase is frequent and that have a neighbour of their kind."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at, left, right, row = neighbours(batch)
            name = joined_name(left, right)
            bit = (name % np.uint64(8 * len(live.value))).astype(np.int64)
            kept = np.flatnonzero(live.value[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
            at, name, row = at[kept], name[kept], row[kept]
            step = (np.diff(at) == 1) & (row[1:] == row[:-1])
            near = np.r_[False, step] | np.r_[step, False] if len(at) else np.empty(0, bool)
            at, name, row = at[near], name[near], row[near]
            if len(at):
                yield relation(at, name, np.flatnonzero(np.r_[True, np.diff(row) != 0]))

    return run


def live_map(spark: SparkSession, frequent: DataFrame) -> Broadcast:
    """A bit for each frequent name: BITS bits however many there are, made up in parts by tasks."""
    bit = F.pmod(F.col("name"), F.lit(BITS).cast("long"))  # BITS is a power of two, so this is also the unsigned rest
    parts = (
        frequent.select(F.floor(bit / BUCKET).cast("int").alias("part"), (bit % BUCKET).alias("bit"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()  # BITS / BUCKET rows of BUCKET / 8 bytes at most
    )
    live = np.zeros(BITS // 8, np.uint8)
    for r in parts:
        bits = np.frombuffer(bytes(r["bits"]), np.uint8)
        live[r["part"] * BUCKET // 8 :][: len(bits)] = bits
    return spark.sparkContext.broadcast(live)


def frequent_words(space: Workspace, texts: DataFrame, salt: str, how: Mining) -> tuple[DataFrame, DataFrame]:
    """Frequent words as phrases, and the number of words per language."""
    words = space.save(
        texts.mapInArrow(counted_words, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("f"))
        .withColumn("name", word_name(F.lit(salt), "lang", "word"))
    )
    shared = words.groupBy("name").agg(F.count("*").alias("words"), F.max("f").alias("f"))
    if not shared.where((F.col("words") > 1) & (F.col("f") >= how.support)).isEmpty():
        raise NamesCollide
    sizes = space.save(words.groupBy("lang").agg(F.sum("f").alias("n")))
    frequent = words.where(F.col("f") >= how.support).select(
        "name", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f",
        F.array("f").alias("prefixes"), F.array("f").alias("suffixes"),
    )
    return space.save(frequent), sizes


def next_phrases(space: Workspace, rows: DataFrame, shorter: DataFrame, how: Mining) -> DataFrame:
    """Frequent phrases one word longer, from the relation of the shorter ones.

    A phrase is named by its first and its last words but one, which are phrases with names
    of their own, so equal names with other halves show that two phrases collide.
    """
    halves = (f(c).alias(f"{f.__name__}_{c}") for c in ("left", "right") for f in (F.min, F.max))
    groups = space.save(
        rows.mapInArrow(counted_pairs, GROUPS)
        .groupBy("name")
        .agg(F.sum("n").alias("f"), *halves)
        .where(F.col("f") >= how.support)
    )
    if not groups.where("min_left <> max_left or min_right <> max_right").isEmpty():
        raise NamesCollide
    left = shorter.select(F.col("name").alias("left"), "lang", F.col("phrase").alias("head"), F.col("prefixes").alias("before"))
    right = shorter.select(F.col("name").alias("right"), "last", F.col("suffixes").alias("after"))
    return space.save(
        groups.select("name", "f", F.col("min_left").alias("left"), F.col("min_right").alias("right"))
        .join(left, "left")
        .join(right, "right")
        .select(
            "name", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "f",
            F.concat("before", F.array("f")).alias("prefixes"), F.concat("after", F.array("f")).alias("suffixes"),
            "left", "right",
        )
    )


def lengths_of(space: Workspace, texts: DataFrame, salt: str, how: Mining) -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases of each length from one word on, and the number of words per language."""
    spark = texts.sparkSession
    found, sizes = frequent_words(space, texts, salt, how)
    levels = [found]
    live = live_map(spark, found)
    rows = space.save(texts.mapInArrow(word_relation(salt, live), RELATION))
    while True:
        levels.append(next_phrases(space, rows, levels[-1], how))
        live.destroy()
        if len(levels) == how.longest:
            space.free(rows)
            return levels, sizes
        live = live_map(spark, levels[-1])
        longer = space.save(rows.mapInArrow(longer_relation(live), RELATION))
        space.free(rows)
        rows = longer


def ranked(levels: list[DataFrame], sizes: DataFrame, how: Mining) -> DataFrame:
    """The phrases that stay, cut where they bind least, the first of each language.

    What the order of a language can put out is told in each task before its rows are brought together.
    """
    wider = union(
        one.select(F.lit(size - 1).alias("words"), F.explode(F.array("left", "right")).alias("name"), "f")
        for size, one in enumerate(levels[2:], 3)
    )
    around = wider.groupBy("words", "name").agg(F.max("f").alias("around"))
    phrases = union(
        one.select(F.lit(size).alias("words"), "name", "lang", "phrase", "f", "prefixes", "suffixes")
        for size, one in enumerate(levels[1:], 2)
    )
    whole = "decimal(19,0)"
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("words") - 1),
        lambda k: F.struct(
            k.alias("k"),
            F.element_at("prefixes", k).alias("l"),
            F.element_at("suffixes", F.col("words") - k).alias("r"),
        ),
    )
    score = f"cast({how.scale} as decimal(10,0)) * cast(f as {whole}) div (cast(c.l as {whole}) + cast(c.r as {whole}))"
    worst = F.array_min(F.expr(f"transform(cuts, c -> struct({score} as score, c.k, c.l, c.r))"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        phrases.join(around, ["words", "name"], "left")
        .where(F.expr(f"around is null or cast(around as {whole}) * 100 < cast(f as {whole}) * {how.absorb}"))
        .withColumn("cuts", cuts)
        .withColumn("cut", worst)
        .select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")
        .withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= how.top)
        .join(sizes, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long"))
    )


def mine_phrases(spark: SparkSession, docs: DataFrame, text: str = "text", how: Mining = Mining()) -> DataFrame:
    """Collocations per language: `lang`, `rank` from 1, `phrase`, counts `a`, `l`, `r`, `n`, and `score`.

    Texts are lower-cased (A-Z), split at `.,;:!?` and line ends into pieces and those at
    spaces and tabs into words. `a` counts a phrase in the pieces of its language, overlaps
    included. It is cut where it binds least: `l` and `r` count the two parts of that cut,
    and the score is floor(scale a / (l + r)), exact beyond 64 bits. `n` counts all words.
    A phrase goes if a longer one around it has `absorb` per cent of its count or more; as
    counts fall with length, a phrase one word longer tells.

    Each length has a relation of places, kept in the shared folder in order of pieces and
    places, so joining neighbours needs no shuffle. Counts are summed per task first, so
    a word in all texts is one row per task. Only places of frequent phrases go on to the
    next length; they are told by a bit map of fixed size that may let others pass, which
    their own count then drops. Names are 64-bit hashes; should a frequent phrase share
    its name with any other, all is done again with another salt.

    Null text is empty, a null language is `und`. Repeated rows count each time; a very long
    text is several rows of a relation, cut between pieces; ties are broken as the order by
    score, count and phrase says; an empty table gives no rows; other columns play no part.
    """
    ship(spark)
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.encode(whole_text(F.col(text).cast("string")), "UTF-8").alias("data"),
    )
    for salt in map(str, itertools.count()):
        try:
            levels, sizes = lengths_of(Workspace(spark, "phrases"), texts, salt, how)
            break
        except NamesCollide:
            continue
    return ranked(levels, sizes, how)
