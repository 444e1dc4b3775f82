"""Near dedup by order MinHash: least occurrence-labelled shingles, kept in text order."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, Workspace, numbered, union, whole_text
from .hashing import BASE, MULTIPLIER, hashed_words, labelled, mixed, rising, shingles, words_of

WORDS = 5
SIMILARITY = 0.8
#: A text of similarity s shares a band with a chance of about s^PICKED, so of BANDS at least one
#: with 1 - 0.59^32, over 0.9999999, at 0.8. With few shingles the chance is less, so texts of up to
#: SHORT of them, and those that can be like one, have keys besides that leave none out.
PICKED = 4
BANDS = 32
SHORT = 20
#: Bits that tell by their differences how many labelled shingles two texts do not share, at least.
BITS = 1024
#: Texts of a band that one task compares with as many others by their bits; in a larger band only
#: texts that share a rare shingle are compared.
BLOCK = 1000
#: Links of which one task makes components at once.
LINKS = 1 << 18
#: Rows of the band matrix at once, so that a very long text needs no more memory than its words.
CHUNK = 2_000_000

SEEDS = mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def sketch(labels: np.ndarray) -> np.ndarray:
    """One value per band: the PICKED least labelled shingles under the band's order, in text order."""
    if not len(labels):
        return np.empty(0, np.int64)
    picked = min(PICKED, len(labels))
    step = max(1, CHUNK // len(labels))
    chosen = []
    for at in range(0, BANDS, step):
        orders = mixed(labels[None, :] ^ SEEDS[at : at + step, None])
        if picked < len(labels):
            places = np.argpartition(orders, picked - 1, axis=1)[:, :picked]
        else:
            places = np.broadcast_to(np.arange(picked), (len(orders), picked))
        chosen.append(labels[np.sort(places, axis=1)])
    values = SEEDS.copy()
    for column in np.concatenate(chosen).T:
        values = mixed(values * np.uint64(0x9E3779B97F4A7C15) + column)
    return values.view(np.int64)


def prefix(labels: np.ndarray) -> np.ndarray:
    """The first labelled shingles in one order of all, as many as must hold one of every text this alike.

    Two texts of similarity 0.8 share so many labelled shingles that the first they share is
    among the first n - ceil(0.8 n) + 1 of either.
    """
    n = len(labels)
    if not 0 < n <= SHORT / SIMILARITY:
        return np.empty(0, np.int64)
    return np.sort(mixed(labels ^ MULTIPLIER))[: n - math.ceil(SIMILARITY * n - 1e-9) + 1].view(np.int64)


def labels_of(text: str) -> np.ndarray:
    (hashes,) = hashed_words([text])
    return labelled(shingles(hashes, WORDS))


def sketched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 4 + [pa.int32(), pa.list_(pa.int64())]
    for batch in batches:
        rows = []
        ids, docs, texts = (c.to_pylist() for c in batch.columns)
        for row, doc, text, words in zip(ids, docs, texts, hashed_words(texts), strict=True):
            labels = labelled(shingles(words, WORDS))
            whole = xxhash.xxh3_128_digest(b" ".join(words_of(text)))
            high, low = (int.from_bytes(whole[i : i + 8], "big", signed=True) for i in (0, 8))
            rows.append((row, doc, high, low, len(labels), np.r_[sketch(labels), prefix(labels)]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 6, kinds, strict=True)],
            names=["row", "doc_id", "high", "low", "size", "bands"],
        )


def parities(labels: np.ndarray) -> np.ndarray:
    """Whether an odd number of labels falls to each bit, as 64-bit words.

    A label that only one of two texts has changes one bit, so that two texts differ in no
    more bits than labels.
    """
    odd = np.bincount(labels & np.uint32(BITS - 1), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled shingles in text order, 32 bits of each, as bytes; and their parities."""
    for batch in batches:
        words = hashed_words(batch[1].to_pylist())
        labels = [labelled(shingles(w, WORDS)).astype("<u4") for w in words]
        kept = pa.array([one.tobytes() for one in labels], pa.binary())
        bits = pa.array([parities(one) for one in labels], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch[0], kept, bits], names=["node", "labels", "bits"])


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Shingles that align in order, of all shingles of the two texts.

    Labelled shingles are distinct within a text, so each has one possible partner, and the
    best alignment is the longest rising chain of partners. The band is what the similarity
    allows: texts this alike differ by a ninth of their shingles at most, so no aligned
    pair is further from the diagonal.
    """
    both = len(a) + len(b)
    if not both:
        return 1.0
    _, x, y = np.intersect1d(a, b, return_indices=True)
    band = np.abs(x - y) <= both * (1 - SIMILARITY) / (1 + SIMILARITY)
    x, y = x[band], y[band]
    if len(x) < SIMILARITY * (both - len(x)):
        return len(x) / (both - len(x))
    y = y[np.argsort(x)]
    aligned = len(y) if (np.diff(y) > 0).all() else rising(y.tolist())
    return aligned / (both - aligned)


def aligned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [[np.frombuffer(x, "<u4") for x in batch[c].to_pylist()] for c in ("left_labels", "right_labels")]
        linked = [similarity(a, b) >= SIMILARITY for a, b in zip(*texts, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch["left"], batch["right"], pa.array(linked, pa.bool_())], names=["left", "right", "linked"]
        )


def verified(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """`edges` with `linked`; a text compared with very many others has many edges, which Spark splits."""
    side = lambda name: labels.select(F.col("node").alias(name), F.col("labels").alias(f"{name}_labels"))
    return edges.join(side("left"), "left").join(side("right"), "right").mapInArrow(
        aligned, "left long, right long, linked boolean"
    )


def classes(space: Workspace, nodes: DataFrame, texts: DataFrame) -> DataFrame | None:
    """(`node`, `top`): every text that is like another, with one that stands for its class.

    Texts that share a band are compared with one of them, the one that shares most bands
    with others, as the origin of a group of copies does. Those that end up outside its
    class stay in the band and are compared with the next such text, until a band has one
    text left or a round links nothing. Pairs grow with the texts of a band, not with their
    square, and no band is cut short. Texts whose lengths rule the similarity out, and
    texts of one class, are not compared. What these rounds cannot see, a link between a
    text and one that had already found its class, `unseen` looks for at the end, so that
    the classes are those of all pairs that share a band.
    """
    bands = nodes.select("node", "size", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    live = space.save(bands.join(shared, "band"))
    weight = live.groupBy("node").agg(F.sum("n").alias("weight"))
    waiting = space.save(live.drop("n").join(weight, "node").withColumn("class", F.col("node")))
    members = waiting.select(F.col("node").alias(ROW)).distinct()
    # a merge at any size: the texts are the larger side by far
    of_members = texts.join(members.hint("merge"), ROW)
    labels = space.save(of_members.select(ROW, "text").mapInArrow(listed, "node long, labels binary, bits array<long>"))
    found, tops = [], None
    while True:
        top = F.max(F.struct("weight", (-F.col("node")).alias("before"), "size", "class")).alias("top")
        others = waiting.groupBy("band").agg(top).select(
            "band",
            (-F.col("top.before")).alias("other"),
            F.col("top.size").alias("other_size"),
            F.col("top.class").alias("other_class"),
        )
        pairs = space.save(waiting.join(others, "band").where("class <> other_class"))
        fits = F.least("size", "other_size") >= SIMILARITY * F.greatest("size", "other_size")
        edges = pairs.where(fits).select(
            F.greatest("node", "other").alias("left"), F.least("node", "other").alias("right")
        )
        for before in found:
            edges = edges.join(before, ["left", "right"], "left_anti")
        tested = space.save(verified(edges.distinct(), labels))
        if tested.where("linked").isEmpty():
            break
        found.append(tested)
        tops = components(space, union(found).where("linked").select("left", "right"))
        of_node = tops.withColumnRenamed("top", "new")
        of_other = tops.select(F.col("node").alias("other"), F.col("top").alias("other_new"))
        waiting = space.save(
            pairs.join(of_node, "node", "left")
            .join(of_other, "other", "left")
            .withColumn("class", F.coalesce("new", "class"))
            .where(F.col("class") != F.coalesce("other_new", "other_class"))
            .select("band", "node", "weight", "size", "class")
        )
        space.free(pairs)
    found.append(space.save(verified(unseen(space, live, tops, labels), labels)))
    if found[-1].where("linked").isEmpty():
        return tops
    return components(space, union(found).where("linked").select("left", "right"))


def split_labels(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per labelled shingle of each text."""
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            labels = [np.frombuffer(x, "<i4") for x in part["labels"].to_pylist()]
            nodes = np.repeat(part["node"].to_numpy(), [len(one) for one in labels])
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.concatenate(labels))], names=["node", "label"])


def rare_keys(space: Workspace, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """(`band`, `node`, `size`, `class`): the labelled shingles that tell a text from the others, as its keys.

    All shingles are put in one order, the rarest first. Two texts of similarity 0.8 have one
    in common among the first n - ceil(0.8 n) + 1 of either, so no link is without a key;
    what only one text has is no key of two, and takes up much of these places where texts
    drift apart. Shingles are numbers in the shuffles, each text's list is bounded by the text.
    """
    texts = nodes.join(labels.select("node", "labels"), "node").select("node", "labels")
    each = space.save(texts.mapInArrow(split_labels, "node long, label int"))
    shared = space.save(each.groupBy("label").agg(F.count("*").alias("n")).where("n > 1"))
    per_text = each.join(shared, "label").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "label"))).alias("shared"))
    first = F.col("size") - F.ceil(F.lit(SIMILARITY) * F.col("size") - 1e-9) + 2  # one more, as labels are 32 bits here
    places = F.greatest(F.lit(0), first - (F.col("size") - F.size("shared"))).cast("int")
    keys = nodes.join(per_text, "node").select(
        "node", "size", "class", F.explode(F.slice("shared", F.lit(1), places)).alias("key")
    )
    return keys.select(F.col("key.label").cast("long").alias("band"), "node", "size", "class")


def of_several_classes(keyed: DataFrame) -> DataFrame:
    """Number of texts of each band that holds more than one class."""
    found = keyed.groupBy("band").agg(F.count("*").alias("n"), F.min("class").alias("low"), F.max("class").alias("high"))
    return found.where("low <> high").select("band", "n")


def unseen(space: Workspace, live: DataFrame, tops: DataFrame | None, labels: DataFrame) -> DataFrame:
    """Pairs (`left`, `right`) that share a band, are of different classes and may be alike.

    Bands of one class need nothing. In a band of up to BLOCK texts all pairs of different
    classes are held against each other, in a larger one those that share a rare shingle, so
    that a large group that drifts apart does not cost the square of its size. Texts of
    similarity s share all but (1 - s) / (1 + s) of their labelled shingles, and differ in
    no more bits; pairs are held against that inside the join. Should so many texts share a
    rare shingle, these are cut into blocks, and each pair of blocks is a key of its own, so
    that no task gets a whole band.
    """
    classed = live.select("band", "node", "size", F.col("node").alias("class"))
    if tops is not None:
        classed = live.join(tops, "node", "left").select("band", "node", "size", F.coalesce("top", "node").alias("class"))
    classed = space.save(classed)
    bands = space.save(of_several_classes(classed))
    keyed = classed.join(bands.where(F.col("n") <= BLOCK), "band").withColumn("blocks", F.lit(1)).drop("n")
    large = bands.where(F.col("n") > BLOCK)
    if not large.isEmpty():
        nodes = space.save(classed.join(large, "band").select("node", "size", "class").distinct())
        rare = space.save(rare_keys(space, nodes, labels))
        blocks = F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")
        keyed = keyed.unionByName(rare.join(of_several_classes(rare).select("band", blocks), "band"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = space.save(keyed.join(labels.select("node", "bits"), "node").withColumn("block", block))

    def side(name: str, own: str, other: str, others) -> DataFrame:
        columns = [F.col(c).alias(f"{name}_{c}") for c in ("size", "class", "bits")]
        return rows.withColumn(other, F.explode(others)).select("band", F.col("block").alias(own), other, F.col("node").alias(name), *columns)

    lefts = side("left", "i", "j", F.sequence(F.col("block"), F.col("blocks") - 1))
    rights = side("right", "j", "i", F.sequence(F.lit(0), F.col("block"))).withColumnsRenamed({"band": "b", "i": "k", "j": "l"})
    sizes = F.col("left_size"), F.col("right_size")
    differ = sum(
        (F.bit_count(F.col("left_bits")[at].bitwiseXOR(F.col("right_bits")[at])) for at in range(BITS // 64)), F.lit(0)
    )
    alike = (
        (F.col("left_class") != F.col("right_class"))
        & (F.least(*sizes) >= SIMILARITY * F.greatest(*sizes))
        & (differ * (1 + SIMILARITY) <= (sizes[0] + sizes[1]) * (1 - SIMILARITY) + 1e-6)
        & ((F.col("i") < F.col("j")) | (F.col("left") < F.col("right")))
    )
    same = (F.col("band") == F.col("b")) & (F.col("i") == F.col("k")) & (F.col("j") == F.col("l"))
    pairs = lefts.join(rights, same & alike)
    return pairs.select(F.greatest("left", "right").alias("left"), F.least("left", "right").alias("right")).distinct()


def forest(salt: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(`node`, `root`) for every node of a task's links: of the nodes they join it with, the first in the salt's order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(node: int) -> int:
            top = node
            while (up := parent.setdefault(top, top)) != top:
                top = up
            while parent[node] != top:
                parent[node], node = top, parent[node]
            return top

        def order(node: int) -> tuple[int, int]:
            return (node * BASE ^ salt * 0xD6E8FEB86659FD93) * BASE >> 32 & 0xFFFFFFFF, node

        for batch in batches:
            for a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                first, other = sorted((root(a), root(b)), key=order)
                parent[other] = first
        nodes = list(parent)
        for at in range(0, len(nodes), LINKS):
            part = nodes[at : at + LINKS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int64()), pa.array([root(n) for n in part], pa.int64())], names=["node", "root"]
            )

    return run


def components(space: Workspace, pairs: DataFrame) -> DataFrame:
    """(`node`, `top`): every node of a link with a node that stands for its component.

    Tasks of about LINKS links each make the trees of their own links. A node with several
    roots, one in each of some tasks, links these; such links are the next round's, until
    they are one task's. A node goes on only if it is first among its neighbours in some
    task, in an order that is another one each round, so even a chain loses a third of its
    nodes per round.
    """
    levels: list[DataFrame] = []
    links = pairs.select(F.col("left").alias("a"), F.col("right").alias("b"))
    n = links.count()
    for round_ in itertools.count():
        parts = max(1, -(-n // LINKS))
        roots = space.save(links.repartition(parts).mapInArrow(forest(round_), "node long, root long"))
        if parts == 1:
            break
        # a node has a root per task at most
        of_node = space.save(roots.groupBy("node").agg(F.sort_array(F.collect_set("root")).alias("roots")))
        levels.append(of_node.select("node", F.col("roots")[0].alias("top")))
        links = of_node.where(F.size("roots") > 1).select(
            F.explode(F.slice("roots", F.lit(2), F.size("roots"))).alias("a"), F.col("roots")[0].alias("b")
        )
        links = space.save(links.distinct())
        n = links.count()
    found = roots.select("node", F.col("root").alias("top"))
    for level in reversed(levels):
        onward = found.select(F.col("node").alias("top"), F.col("top").alias("onward"))
        found = level.join(onward, "top", "left").select("node", F.coalesce("onward", "top").alias("top"))
    return space.save(found) if levels else found


def near_groups(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept, and its row number.

    Alike are texts whose five-word shingles (lower case; fewer words are one shingle)
    align to a similarity of 0.8 or more; a class is what such links join. Copies of the
    same words are one text from the start, linked to nothing twice. `class_id` is the
    least doc_id of the class (null only if all are); the first row with it is kept. Null
    text counts as empty, and texts without words are copies of each other; repeated rows
    are copies; an empty table gives no rows.
    """
    space = Workspace(spark, "near")
    rows = numbered(docs)
    texts = rows.select(ROW, whole_text("text").alias("text"))
    shape = "row long, doc_id long, high long, low long, size int, bands array<long>"
    sketches = space.save(
        rows.select(ROW, F.col("doc_id").cast("long"), whole_text("text")).mapInArrow(sketched, shape)
    )
    copies = space.save(sketches.groupBy("high", "low").agg(F.min("row").alias("node")))
    members = space.save(sketches.select("row", "doc_id", "high", "low").join(copies, ["high", "low"]).drop("high", "low"))
    firsts = members.where("row = node").select("row")
    nodes = sketches.join(firsts, "row", "left_semi").select(F.col("row").alias("node"), "size", "bands")
    tops = classes(space, nodes, texts)
    if tops is None:
        classed = members.withColumn("top", F.col("node"))
    else:
        classed = members.join(tops, "node", "left").withColumn("top", F.coalesce("top", "node"))
    classed = space.save(classed.select("row", "doc_id", "top"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    summed = classed.groupBy("top").agg(first, F.count("*").alias("class_size"))
    return classed.join(space.save(summed), "top").select(
        F.col("row").alias(ROW),
        "doc_id",
        F.col("first.doc_id").alias("class_id"),
        "class_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """`docs` with one document of each class; all columns stay as they are."""
    kept = near_groups(spark, docs).where("kept").select(ROW)
    return numbered(docs).join(kept, ROW, "left_semi").drop(ROW)
