"""Mixing sources: tempered token shares, realised as budgeted block permutations."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ROW, Workspace, numbered, whole_text

WORD = r"[^\x20\x09-\x0D]+"
#: Each pass over the sources tries so many exponents, five bisection steps at once.
STEPS = 5
PASSES = 8
BLOCK_BITS = 10
PLACE_BITS = 63
#: Documents that one task puts in order at most; a larger block is cut into smaller ones first.
EDGE = 100_000
#: More sources than this are joined by a shuffle; a row of the plan is under 200 bytes.
BROADCAST_SOURCES = 50_000


@dataclass(frozen=True)
class Mix:
    """What the exponent has to meet, and how many tokens the mixture has.

    `repeats`: no source is shown more than so many times as often as any other: the
    flattest mixture that keeps it. `entropy`: that share of the greatest possible entropy
    at least, and the mixture nearest to the given shares that has it. `budget`: tokens;
    by default as many as show each document at least once.
    """

    repeats: float | None = 1.5
    entropy: float | None = None
    budget: int | None = None


def source_key(source: str) -> Column:
    """Null is a source of its own, apart from the empty one."""
    return F.when(F.col(source).isNull(), "").otherwise(F.concat(F.lit("="), F.col(source).cast("string")))


def token_count(text: str) -> Column:
    """Words of the text, and one for its end, so that empty documents take part too."""
    return (F.regexp_count(whole_text(text), F.lit(WORD)) + 1).cast("long")


def last_place() -> Column:
    """A row's place, 63 bits, in the permutation of a partial epoch."""
    return F.shiftrightunsigned(F.xxhash64(F.lit("last"), ROW), 1)


def last_block(bits: int) -> Column:
    return F.shiftright("place", PLACE_BITS - bits)


def tempering(sources: DataFrame, mix: Mix) -> float:
    """The exponent, by bisection between 0 (all sources alike) and 1 (shares as given).

    The spread of repetition falls and the entropy falls as the exponent rises. A pass sums
    up over all sources what 31 exponents give; only those sums come back.
    """
    whole = sources.agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")).first()
    if not whole["n"]:
        return 1.0
    shares = sources.select((F.col("tokens") / whole["tokens"]).alias("share"))
    power = F.pow("share", F.col("exponent"))
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        step = (high - low) / 2**STEPS
        tried = F.array(*(F.lit(low + step * i) for i in range(1, 2**STEPS)))
        sums = (
            shares.select("share", F.explode(tried).alias("exponent"))
            .groupBy("exponent")
            .agg(
                F.ln(F.sum(power)).alias("norm"),
                (F.sum(power * F.ln("share")) / F.sum(power)).alias("mean"),
                (F.max(power / F.col("share")) / F.min(power / F.col("share"))).alias("spread"),
            )
            .collect()
        )
        if mix.entropy is None:
            at = sum(r["spread"] > mix.repeats for r in sums)
        else:
            least = mix.entropy * math.log(whole["n"])
            at = sum(r["norm"] - r["exponent"] * r["mean"] >= least for r in sums)
        low, high = low + step * at, low + step * (at + 1)
    return high if mix.entropy is None else low


def source_plan(space: Workspace, rows: DataFrame, mix: Mix) -> DataFrame:
    """Per source: tokens, weight, budget, whole epochs, and where its last, partial epoch ends.

    The partial epoch is the head of a permutation by hash. Its end is found by token sums
    of 2^BLOCK_BITS hash blocks per source, and of as many in the one block where the budget
    runs out, until that block has at most EDGE documents; inside it, by running sums over
    these. So the largest group is as large whatever the source.
    """
    placed = rows.select(ROW, source_key("source").alias("__source"), "text", last_place().alias("place"))
    sums = F.sum(token_count("text")).alias("tokens"), F.count("*").alias("documents")
    blocks = space.save(placed.groupBy("__source", last_block(BLOCK_BITS).alias("block")).agg(*sums))
    sources = space.save(blocks.groupBy("__source").agg(F.sum("tokens").alias("tokens")))
    power = F.pow(F.col("tokens").cast("double"), F.lit(tempering(sources, mix)))
    norm, thinnest = sources.agg(F.sum(power), F.min(power / F.col("tokens"))).first()
    weight = power / F.lit(norm)
    if mix.budget is None:
        budget = F.greatest(F.col("tokens"), F.floor(power / F.lit(thinnest)))
    else:
        budget = F.floor(weight * mix.budget)
    plan = (
        sources.select("__source", "tokens", weight.alias("weight"), budget.alias("budget"))
        .withColumn("epochs", F.floor(F.col("budget") / F.col("tokens")).cast("int"))
        .withColumn("rest", F.col("budget") % F.col("tokens"))
    )
    ahead = Window.partitionBy("__source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def edge_of(blocks: DataFrame, rest: DataFrame) -> DataFrame:
        """The block of each source in which its rest runs out, and what is left of it there."""
        left = F.col("rest") - F.coalesce(F.sum("tokens").over(ahead), F.lit(0))
        held = blocks.join(rest, "__source").withColumn("left", left)
        inside = held.where((F.col("left") >= 0) & (F.col("left") < F.col("tokens")))
        return space.save(inside.select("__source", "block", "left", "documents"))

    edge, bits = edge_of(blocks, plan.select("__source", "rest")), BLOCK_BITS
    while bits + BLOCK_BITS <= PLACE_BITS and not edge.where(F.col("documents") > EDGE).isEmpty():
        inside = placed.withColumn("block", last_block(bits)).join(few(edge.select("__source", "block")), ["__source", "block"])
        bits += BLOCK_BITS
        finer = space.save(inside.groupBy("__source", last_block(bits).alias("block")).agg(*sums))
        edge = edge_of(finer, edge.select("__source", F.col("left").alias("rest")))
    running = Window.partitionBy("__source").orderBy("place", ROW).rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        placed.withColumn("block", last_block(bits))
        .join(few(edge), ["__source", "block"])
        .withColumn("so_far", F.sum(token_count("text")).over(running))
        .where(F.col("so_far") > F.col("left"))
        .groupBy("__source")
        .agg(F.min(F.struct("place", ROW)).alias("cut"))
    )
    return space.save(plan.join(cut, "__source"))


def few(plan: DataFrame) -> DataFrame:
    """Broadcast if counted to be small; else Spark joins by a shuffle and splits a hot source."""
    return F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan


def mixed_rows(spark: SparkSession, docs: DataFrame, mix: Mix = Mix(), blocks: int = 256) -> DataFrame:
    """`docs`, each row as often as its source's budget shows it.

    Adds `epoch` (from 0), `n_tokens`, `weight` of the source, `position` in [0, 1), the
    place in the mixed stream, and `block`, that place in `blocks` equal parts. Each epoch
    of a source is a permutation of its own, and its epochs fill the stream evenly, so that
    any block holds the sources by weight. Whole epochs show every document; the last one
    is the head of a permutation, up to the budget. The text is read, never shuffled.

    A null source is a source of its own and null text counts as empty; a document has its
    words and one token more. Repeated rows are rows like any other; other columns are
    kept, those named like the added ones replaced; an empty table gives no rows.
    """
    rows = numbered(docs)
    added = ("epoch", "n_tokens", "weight", "position", "block")
    plan = source_plan(Workspace(spark, "mixing"), rows, mix)
    plan = few(plan.select("__source", *(F.col(c).alias(f"__{c}") for c in ("tokens", "weight", "budget", "epochs", "cut"))))
    in_head = F.struct(last_place().alias("place"), F.col(ROW)) < F.col("__cut")
    shown = F.col("__epochs") + F.when(in_head, 1).otherwise(0)
    own = F.shiftrightunsigned(F.xxhash64(F.lit("whole"), ROW, "__epoch"), 1)
    place = F.when(F.col("__epoch") < F.col("__epochs"), own).otherwise(last_place()) / F.lit(float(2**63))
    position = (F.col("__epoch") + place) * F.col("__tokens") / F.col("__budget")
    return (
        rows.withColumn("__source", source_key("source"))
        .join(plan, "__source")
        .withColumn("__shown", shown)
        .where("__shown > 0")
        .withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.col("__shown") - 1)))
        .withColumn("__position", F.least(position, F.lit(1 - 2.0**-53)))
        .select(
            *(c for c in docs.columns if c not in added),
            F.col("__epoch").alias("epoch"),
            token_count("text").alias("n_tokens"),
            F.col("__weight").alias("weight"),
            F.col("__position").alias("position"),
            F.floor(F.col("__position") * blocks).cast("int").alias("block"),
        )
    )


def mix_report(spark: SparkSession, docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mixture without texts: which document, of which source, when and where."""
    return mixed_rows(spark, docs, mix).select(
        "doc_id", "source", "epoch", "n_tokens", "weight", "position", "block"
    )
