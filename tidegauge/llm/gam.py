"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature has a lookup table over its bins, and so have a few pairs of features. Tables
are learned by cyclic boosting: feature after feature, a shallow tree on the bins' gradients
adds a small step to the feature's table. A score is a sum of table entries.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, Workspace, numbered, whole_text

FEATURES = (
    "log_words", "log_lines", "word_length", "longest_word", "distinct_words", "repeated_neighbours", "repeated_triples",
    "repeated_lines", "short_lines", "capitals", "capital_words", "digits", "marks", "symbols", "bars", "exclamations",
    "stops", "commas", "other_scripts", "byte_entropy", "compression", "commonest_word", "word_ends", "addresses",
)

LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features_of(text: str) -> list[float]:
    """The features of a whole text, from the text alone."""
    data = text.encode()
    words = data.split()
    n, size = len(words), max(1, len(data))
    some = max(1, n)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letters = max(1, int(counts[LETTERS].sum()))
    probability = counts[counts > 0] / size
    lengths = np.fromiter(map(len, words), np.int64, n)
    times: dict[bytes, int] = {}
    for word in words:
        times[word] = times.get(word, 0) + 1
    lines = [x for x in (line.strip() for line in data.split(b"\n")) if x]
    triples = list(zip(words, words[1:], words[2:]))
    return [
        math.log1p(n),
        math.log1p(len(lines)),
        float(lengths.mean()) if n else 0.0,
        math.log1p(float(lengths.max(initial=0))),
        len(times) / math.sqrt(some),
        sum(a == b for a, b in zip(words, words[1:])) / some,
        1 - len(set(triples)) / max(1, len(triples)),
        1 - len(set(lines)) / max(1, len(lines)),
        sum(len(x) < 30 for x in lines) / max(1, len(lines)),
        int(counts[65:91].sum()) / letters,
        sum(w.isupper() for w in words) / some,
        int(counts[48:58].sum()) / size,
        int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()) / size,
        int(counts[[35, 42, 36, 37, 38, 60, 62, 94, 126]].sum()) / some,
        int(counts[124]) / some,
        int(counts[33] + counts[63]) / some,
        int(counts[46]) / some,
        int(counts[44]) / some,
        int(counts[128:].sum()) / size,
        float(-(probability * np.log2(probability)).sum()),
        len(zlib.compress(data, 1)) / size,
        max(times.values(), default=0) / some,
        sum(w[-1] in b".,;:" for w in words) / some,
        (text.count("@") + text.count("://")) / some,
    ]


@dataclass(frozen=True)
class Settings:
    """`rows` is the bound of the labelled sample; the rest shapes the boosting."""

    rows: int = 20_000
    bins: int = 48
    pair_bins: int = 12
    pairs: int = 8
    rounds: int = 120
    pair_rounds: int = 60
    rate: float = 0.15
    leaf_rows: int = 10
    ridge: float = 1.0


@dataclass
class Model:
    """Bin edges and tables; a pair of features has coarser edges of its own."""

    start: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def score(self, columns: np.ndarray) -> np.ndarray:
        """Probability of label 1; one row of `columns` per feature."""
        total = np.full(columns.shape[1], self.start)
        for column, edges, table in zip(columns, self.edges, self.tables, strict=True):
            total += table[np.searchsorted(edges, column, "right")]
        binned = {
            i: np.searchsorted(self.coarse[i], columns[i], "right") for i in {j for pair in self.pairs for j in pair}
        }
        for (i, j), grid in zip(self.pairs, self.grids, strict=True):
            total += grid[binned[i], binned[j]]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def quantile_edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def best_split(gradient: np.ndarray, weight: np.ndarray, rows: np.ndarray, how: Settings) -> tuple[float, int]:
    """Gain and place of the best cut of ordered bins into two."""
    g, h, n = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1], np.cumsum(rows)[:-1]
    if not len(g):
        return 0.0, 0
    whole_g, whole_h, whole_n = gradient.sum(), weight.sum(), rows.sum()
    gain = g**2 / (h + how.ridge) + (whole_g - g) ** 2 / (whole_h - h + how.ridge) - whole_g**2 / (whole_h + how.ridge)
    gain[(n < how.leaf_rows) | (whole_n - n < how.leaf_rows)] = 0
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def shallow_tree(gradient: np.ndarray, weight: np.ndarray, rows: np.ndarray, how: Settings) -> np.ndarray:
    """Step of each bin by a tree of two levels on one feature's bins."""

    def grow(low: int, high: int, depth: int) -> None:
        gain, cut = best_split(gradient[low:high], weight[low:high], rows[low:high], how) if depth else (0.0, 0)
        if gain > 1e-9:
            grow(low, low + cut, depth - 1)
            grow(low + cut, high, depth - 1)
        else:
            step[low:high] = gradient[low:high].sum() / (weight[low:high].sum() + how.ridge)

    step = np.zeros(len(gradient))
    grow(0, len(gradient), 2)
    return step


def grid_tree(gradient: np.ndarray, weight: np.ndarray, rows: np.ndarray, how: Settings) -> tuple[float, np.ndarray]:
    """Gain and steps of the best tree that cuts one feature, then each side by the other."""
    best, step = 0.0, np.zeros_like(gradient)
    for axis in (0, 1):
        g, h, n = (x if axis == 0 else x.T for x in (gradient, weight, rows))
        for cut in range(1, len(g)):
            gain, halves = 0.0, []
            for part in (slice(0, cut), slice(cut, None)):
                sums = g[part].sum(0), h[part].sum(0), n[part].sum(0)
                more, at = best_split(*sums, how)
                gain += more
                halves.append((part, sums, at if more > 1e-9 else 0))
            if gain > best:
                best, step = gain, np.zeros_like(gradient)
                view = step if axis == 0 else step.T
                for part, (sg, sh, _), at in halves:
                    for side in (slice(0, at), slice(at, None)):
                        view[part, side] = sg[side].sum() / (sh[side].sum() + how.ridge)
    return best, step


def fit(columns: np.ndarray, labels: np.ndarray, how: Settings = Settings()) -> Model:
    """A model of the given rows; without rows, or with one label only, a constant."""
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    model = Model(start=math.log(share / (1 - share)))
    model.edges = [quantile_edges(c, how.bins) if len(c) else np.empty(0) for c in columns]
    model.coarse = [quantile_edges(c, how.pair_bins) if len(c) else np.empty(0) for c in columns]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if not 0 < labels.sum() < len(labels):
        return model
    fine = [np.searchsorted(e, c, "right") for e, c in zip(model.edges, columns, strict=True)]
    total = np.full(len(labels), model.start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    def summed(place: np.ndarray, size: int) -> list[np.ndarray]:
        return [np.bincount(place, w, size) for w in (*slopes(), None)]

    for _ in range(how.rounds):
        for place, table in zip(fine, model.tables, strict=True):
            step = how.rate * shallow_tree(*summed(place, len(table)), how)
            table += step
            total += step[place]

    rough = [np.searchsorted(e, c, "right") for e, c in zip(model.coarse, columns, strict=True)]
    sizes = [len(e) + 1 for e in model.coarse]

    def gridded(i: int, j: int) -> list[np.ndarray]:
        return [x.reshape(sizes[i], sizes[j]) for x in summed(rough[i] * sizes[j] + rough[j], sizes[i] * sizes[j])]

    every = [(i, j) for i in range(len(columns)) for j in range(i)]
    gains = {pair: grid_tree(*gridded(*pair), how)[0] for pair in every}
    model.pairs = sorted((p for p in every if gains[p] > 0), key=lambda p: -gains[p])[: how.pairs]
    model.grids = [np.zeros((sizes[i], sizes[j])) for i, j in model.pairs]
    for _ in range(how.pair_rounds):
        for (i, j), grid in zip(model.pairs, model.grids, strict=True):
            step = how.rate * grid_tree(*gridded(i, j), how)[1]
            grid += step
            total += step[rough[i], rough[j]]
    return model


def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features_of(text) for text in batch[2].to_pylist()]
        columns = np.array(rows, np.float64).reshape(-1, len(FEATURES)).T
        yield pa.RecordBatch.from_arrays(
            [batch[0], batch[1], *(pa.array(c, pa.float32()) for c in columns)], names=["row", "doc_id", *FEATURES]
        )


def held_out() -> Column:
    """Every third document, by its id, is kept from learning; null ids too."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(True))


def learned(features: DataFrame, labels: DataFrame, label: str, how: Settings) -> Model:
    """The model of the labelled rows outside the held-out third, at most `how.rows` of them by hash."""
    marks = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("double").alias("label"))
    )
    usable = features.where(~held_out()).join(marks, "doc_id").select("doc_id", "row", "label", *FEATURES)
    share = min(1.0, 1.05 * how.rows / max(1, usable.count()))
    drawn = (
        usable.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 11) <= int(share * 2**53))
        .orderBy(F.xxhash64("doc_id"), "row")
        .limit(how.rows)
        .toPandas()
    )
    return fit(drawn[list(FEATURES)].to_numpy(np.float64).T, drawn["label"].to_numpy(np.float64), how)


def scored_documents(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str = "quality", how: Settings = Settings()
) -> DataFrame:
    """`doc_id`, `held_out`, `score` and `predicted` of every document.

    Texts are read once, for their features; learning and scoring read the stored features.
    Null text counts as empty and is scored like any text. A label given several times is
    averaged, a null one ignored; without any usable label all scores are one half. Very
    long texts are measured whole; repeated rows are scored each; an empty table gives no
    rows; other columns, whatever their names, play no part.
    """
    space = Workspace(spark, "quality")
    texts = numbered(docs).select(F.col(ROW).alias("row"), F.col("doc_id").cast("long"), whole_text("text"))
    shape = ", ".join(["row long", "doc_id long", *(f"{f} float" for f in FEATURES)])
    features = space.save(texts.mapInArrow(measured, shape))
    model = learned(features, labels, label, how)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = np.array([batch[f].to_numpy() for f in FEATURES], np.float64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(model.score(columns))], names=["doc_id", "score"])

    scores = features.mapInArrow(score, "doc_id long, score double")
    return scores.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
