"""The corpus pipeline: five stages from raw documents to packed sequences.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage
before kept and returns a DataFrame; all but the last return the columns of
``documents``.  ``run`` writes what a stage returns as Parquet in the shared
checkpoint folder and hands the reread table to the next one, so a lost
executor costs at most part of one stage, and removes each input copy, and
whatever scratch a stage left, when the next stage is written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventlens.llm.decontaminate import drop_hit
from eventlens.llm.exact_dedup import drop_duplicates
from eventlens.llm.language_id import keep_identified
from eventlens.llm.near_dedup import drop_near
from eventlens.llm.packing import packed_documents
from eventlens.session import materialize, release, release_since, scratch_mark


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification rejects go."""
    return keep_identified(docs)


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original, then the smallest doc_id, stays."""
    return drop_duplicates(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return drop_near(docs, percent=75)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a whole benchmark window go."""
    return drop_hit(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenise, cut and pack what is left."""
    return packed_documents(docs).drop("row_id")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("exact_dedup", dedup_exact),
    ("near_dedup", dedup_near),
    ("decontaminate", decontaminate),
    ("packing", pack),
]

#: Language models and cutting-stock plans are not SQL; the tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        mark = scratch_mark()
        kept = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        release_since(spark, mark, kept)
        if i:
            release(docs)
        docs = kept
    return docs
