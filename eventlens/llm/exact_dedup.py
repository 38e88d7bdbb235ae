"""Exact duplicates by a tree-merge of sorted digest runs.

Each input partition makes one run: its distinct digests, sorted, with the
best row and the number of rows of each.  Runs are numbered; in round r the
sixteen runs whose numbers differ only in hexadecimal digit r swap pieces, so
that each keeps the digests whose own digit r is its number's, and merges the
up to sixteen sorted pieces it receives (sort-merge aggregation).  After
log16(runs) rounds every digest lives in exactly one run, with the verified
best row of its whole group; no task ever holds more than its share, and a
digest that a third of all rows share moves as one row per run and round.

A digest is a SHA-256 with the normalised length beside it; both are compared
at every merge.

Edge cases: null text counts as empty (empty texts equal one another); a null
``doc_id`` loses ties against any other; of rows repeated with the same id and
text exactly one stays; an empty table gives an empty result; columns beyond
``doc_id`` and ``text`` are ignored here and kept by ``drop_duplicates``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import WHITE, join_skewed, plain, text_or_empty
from eventlens.session import materialize

DIGIT_BITS = 4


def normalised(text: str = "text") -> Column:
    return F.translate(text_or_empty(text), WHITE, "")


def digests(docs: DataFrame) -> DataFrame:
    """One narrow row per document: digest, lengths, row number and run."""
    norm = normalised()
    return docs.select(
        "doc_id",
        F.unhex(F.sha2(norm, 256)).alias("sha"),
        F.length(norm).cast("long").alias("n_norm"),
        F.length(text_or_empty()).cast("long").alias("n_text"),
        F.monotonically_increasing_id().alias("row_id"),
        F.spark_partition_id().cast("long").alias("run"),
    )


def merge_runs(rows: DataFrame, runs: int) -> DataFrame:
    """Digest groups (sha, n_norm, best, size) by rounds of exchange and merge."""
    best = F.struct(
        (-F.col("n_text")).alias("shorter"),
        F.col("doc_id").isNull().alias("no_id"),
        F.col("doc_id").alias("doc_id"),
        F.col("row_id").alias("row_id"),
    )
    level = rows.select("run", "sha", "n_norm", best.alias("best"), F.lit(1).cast("long").alias("size"))
    place = F.xxhash64("sha")
    rounds = 1
    while runs > 1 << DIGIT_BITS * rounds:
        rounds += 1
    for r in range(rounds):
        digit = F.lit(((1 << DIGIT_BITS) - 1) << DIGIT_BITS * r).cast("long")
        run = F.col("run").bitwiseAND(F.bitwise_not(digit)).bitwiseOR(place.bitwiseAND(digit))
        level = (
            level.withColumn("run", run)
            .groupBy("run", "sha", "n_norm")
            .agg(F.min("best").alias("best"), F.sum("size").alias("size"))
        )
    return level.drop("run")


def exact_groups(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256, n_text, row_id."""
    rows = materialize(digests(docs), "digests")
    runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    groups = materialize(merge_runs(rows, runs), "digest-groups")
    out = join_skewed(rows, groups, ["sha", "n_norm"], "size")
    return out.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row_id") == F.col("best.row_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "n_text",
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    keep = exact_groups(docs).filter("kept").select(F.concat_ws("|", "doc_id", "n_text", "text_sha256").alias("_key"))
    key = F.concat_ws("|", F.col("doc_id"), F.length(text_or_empty()), F.sha2(normalised(), 256))
    rows = plain(docs, "doc_id", "text")
    kept = rows.withColumn("_key", key).join(keep, "_key", "left_semi").dropDuplicates(["_key"])
    return kept.select(*rows.columns).toDF(*docs.columns)
