"""From raw documents to packed token sequences, stage by stage.

Each stage takes what its predecessor kept and writes its result to the shared folder, so
a lost executor costs the running stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm.block_names import drop_exact_copies
from tidegauge.llm.common import Workspace, table
from tidegauge.llm.line_rules import apply_rules
from tidegauge.llm.mixing import mixed_rows
from tidegauge.llm.order_minhash import drop_near_copies
from tidegauge.llm.packing import pack_documents
from tidegauge.llm.queries import RANKS, TOKENIZER

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that are too frequent in their source; one of each group of near copies."""
    return apply_rules(spark, docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of those whose texts are equal after lower-casing A-Z, the one with the largest id."""
    return drop_exact_copies(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one with the least id."""
    return drop_near_copies(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once at least; those of small sources again, up to half as often again."""
    return mixed_rows(spark, docs).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and the sequence and offset of each."""
    return pack_documents(spark, docs, TOKENIZER, RANKS)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

#: The first, third, fourth and last stage have no SQL; tests/llm compares them with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES[:-1]:
        done = space.save(stage(spark, docs, sf_dir))
        if hasattr(docs, "stored_at"):
            space.free(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
