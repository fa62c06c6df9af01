"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what a
stage returns as Parquet to the shared working folder and reads it back as the next
one's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from bazaarlens.llm import chosen_path, exact_dedup, language, mixing, packing
from bazaarlens.sources.storage import materialize

#: Weights of sources by name; without them, the square root of each source's rows.
TARGETS: Mapping[str, float] | None = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identified language go."""
    return language.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return chosen_path.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: file by file and row by row."""
    return mixing.in_mixed_order(docs, TARGETS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence and offset, sequences in the order of the mix.

    Spark does not read files in the order of their names, so the places are worked out again.
    """
    placed = mixing.placed_rows(docs, TARGETS).select("_row.doc_id", "_row.text", "_position")
    return packing.packed_documents(placed, public_tokenizers.path("byte_bpe_50k.json"), position="_position")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A trained tagger and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
