"""Connected components of a link table by alternating large-star and small-star.

Every step is one aggregation (a node's smallest neighbour, combined before
the shuffle) and one join back; a hub's rows are never gathered in one task
(``join_skewed`` with the degree as weight).  Each round is written to the
shared checkpoint folder, so lineage stays short and a lost executor costs one
round at most.  A round has as many tasks and files as its links need (or as
the session has partitions, if fewer): rounds are many and mostly small, and the
driver would be busy with, and filled by, tasks of a few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import join_skewed
from eventlens.session import materialize, release


#: Links of a task of a round, and tasks that a round has at least.
TASK_LINKS, LEAST_TASKS = 1 << 13, 8


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _smallest(rows: DataFrame, tasks: int) -> DataFrame:
    least = rows.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("degree"))
    return materialize(least.coalesce(tasks), "cc-min")


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined = join_skewed(both, _smallest(both, tasks), ["a"], "degree").coalesce(tasks)
    wide = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
    return wide.distinct().coalesce(tasks)


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    joined = join_skewed(down, _smallest(down, tasks), ["a"], "degree").coalesce(tasks)
    moved = joined.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(joined.select("a", F.col("m").alias("b"))).distinct().coalesce(tasks)


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b), in any direction, self-links allowed -> (node,
    component) for every node that has a link to another one; ``component`` is
    the smallest node reachable."""
    now = materialize(edges.filter(F.col("a") != F.col("b")).select("a", "b").distinct(), "cc-edges")
    mark = _fingerprint(now)
    while mark[0]:
        tasks = max(LEAST_TASKS, -(-mark[0] // TASK_LINKS))
        wide = materialize(_large_star(now, tasks), "cc-large")
        after = materialize(_small_star(wide, tasks), "cc-small")
        release(wide, now)
        now, last = after, mark
        mark = _fingerprint(now)
        if mark == last:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
