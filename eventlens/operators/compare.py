"""Result comparison and selection (Q1, Q2) over bounded rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ranking_agreement(left: DataFrame, right: DataFrame, n: int = 5) -> DataFrame:
    """Q1: do the first ``n`` names agree, in order?  Inputs carry
    (rank, name); only ranks <= n are joined (bounded).  Returns one row:
    agree, compared, first_diff_rank (NULL when they agree)."""
    l = left.where(F.col("rank") <= n).select("rank", F.col("name").alias("l"))
    r = right.where(F.col("rank") <= n).select("rank", F.col("name").alias("r"))
    j = l.join(r, "rank", "full_outer")
    same = F.col("l").eqNullSafe(F.col("r"))
    return j.agg(
        F.coalesce(F.bool_and(same), F.lit(True)).alias("agree"),
        F.count("*").cast("bigint").alias("compared"),
        F.min(F.when(~same, F.col("rank"))).cast("bigint").alias("first_diff_rank"),
    )


def ranking_fallback(primary: DataFrame, secondary: DataFrame, key: str = "metric") -> DataFrame:
    """Q2: per ``key``, rows of ``primary``; for keys with no primary rows,
    the rows of ``secondary``.  Adds ``source``.  The anti-join side is the
    distinct key list of ``primary`` (one row per metric)."""
    have = primary.select(key).distinct()
    return primary.withColumn("source", F.lit("primary")).unionByName(
        secondary.join(have, key, "left_anti").withColumn("source", F.lit("secondary"))
    )
