"""Sorting, top-k and ranks.

Order everywhere: ``count desc, name asc`` (binary collation); hours are
ordered by name.  Top-k uses ``orderBy().limit()`` (TakeOrderedAndProject:
per-task top-k, then a merge of k x tasks rows) or, for many metrics at once,
``row_number() <= k`` per metric, which Spark turns into a WindowGroupLimit
applied *before* the shuffle.  Full sorts get a rank from ``global_rank``,
which never moves the data to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.schema import METRIC_NAMES, TOP_K
from eventlens.session import materialize

def rank_order() -> list[Column]:
    """``count desc, name asc``."""
    return [F.col("count").desc(), F.col("name").asc()]


def _order(by_name: bool) -> list[Column]:
    return [F.col("name").asc()] if by_name else rank_order()


def top_k(ranking: DataFrame, k: int, by_name: bool = False) -> DataFrame:
    """T2 (T3 with ``by_name``): first k rows of a (name, count) ranking,
    with their 1-based rank.  The window runs over at most k rows."""
    order = _order(by_name)
    top = ranking.orderBy(*order).limit(k)
    return top.select(F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("rank"), "name", "count")


def global_rank(df: DataFrame, order: list[Column], rank_col: str = "rank") -> DataFrame:
    """Attach a 1-based global rank to a full sort without a single-task window.

    1. ``orderBy`` range-partitions and sorts (the only shuffle);
    2. the sorted rows are written as Parquet in the shared folder with their
       partition number (``_pid``) and place, so both are fixed even if tasks
       are retried or executors are lost;
    3. per-partition counts read the ``_pid`` column only and give offsets;
    4. rank = offset of the partition + position in it.  The position comes
       from ``monotonically_increasing_id`` (partition id in the upper bits,
       row index in the lower 33), so no second sort or window is needed.
    The offsets table has one row per partition: bounded by the shuffle
    width, never by the data, so broadcasting it is safe."""
    placed = df.orderBy(*order).withColumns({"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()})
    placed = materialize(placed, "ranked")
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = partition_counts(placed).select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (
        placed.join(F.broadcast(offsets), "_pid")
        .withColumn(rank_col, (F.col("_off") + pos + 1).cast("bigint"))
        .drop("_pid", "_mid", "_off")
    )


def partition_counts(placed: DataFrame) -> DataFrame:
    return placed.groupBy("_pid").agg(F.count("*").alias("_n"))


def full_ranking(ranking: DataFrame) -> DataFrame:
    """Every row, ``count desc, name asc``, with a global rank."""
    return global_rank(ranking, rank_order()).select("rank", "name", "count")


def top_k_per_metric(metrics: DataFrame, limits: dict[str, int] | None = None) -> DataFrame:
    """Top-k of every metric kind in one plan: (kind, name, count) ->
    (metric, rank, name, count).

    Ranked kinds share one window; ``row_number <= max(k)`` is a literal
    bound, so Spark inserts a partial WindowGroupLimit before the exchange and
    ships at most max(k) rows per kind per task.  Hours are not a top-k: all
    of them are kept, ordered by hour (their number is bounded by the two
    characters they are cut from)."""
    limits = dict(limits or TOP_K)
    ranked_kinds = list(limits)
    cap = max(limits[k] for k in ranked_kinds)
    kinds_sql = ", ".join(f"'{k}'" for k in ranked_kinds)
    limit_sql = "CASE kind " + " ".join(f"WHEN '{k}' THEN {limits[k]}" for k in ranked_kinds) + " END"
    metric_sql = "CASE kind " + " ".join(f"WHEN '{k}' THEN '{m}'" for k, m in METRIC_NAMES.items()) + " END"
    w = Window.partitionBy("kind").orderBy(*rank_order())
    ranked = (
        metrics.where(f"kind IN ({kinds_sql})")
        .withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= cap)
        .where(f"rank <= {limit_sql}")
    )
    hours = metrics.where("kind = 'hour'").withColumn(
        "rank", F.row_number().over(Window.partitionBy("kind").orderBy(F.col("name").asc()))
    )
    return ranked.unionByName(hours).selectExpr(
        f"{metric_sql} AS metric", "CAST(rank AS BIGINT) AS rank", "name", "CAST(count AS BIGINT) AS count"
    )


def leader_headline(report: DataFrame, counters: DataFrame) -> DataFrame:
    """Per metric the leading name, its count, entries shown and total
    records.  Both inputs are bounded (k rows per metric, one counter row), so
    the single-partition window below is over a few hundred rows at most."""
    rep = report.select("metric", "rank", "name", "count", F.lit(None).cast("bigint").alias("records"))
    cnt = counters.select(
        F.lit(None).cast("string").alias("metric"),
        F.lit(None).cast("bigint").alias("rank"),
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("bigint").alias("count"),
        F.col("records").cast("bigint").alias("records"),
    )
    u = rep.unionByName(cnt).withColumn("records", F.max("records").over(Window.partitionBy(F.lit(1))))
    return (
        u.where(F.col("metric").isNotNull())
        .groupBy("metric")
        .agg(
            F.min_by("name", "rank").alias("leader"),
            F.min_by("count", "rank").alias("leader_count"),
            F.count("*").alias("entries"),
            F.max("records").alias("records"),
        )
    )
