"""Lines that many documents share, by levelled sorted runs of line hashes.

A run is a table of (line hash, number of documents), bucketed and sorted by
hash.  Documents come in batches; a batch's own sorted run is merge-anti-joined
with the runs already there, so that a line known to be common is not stored
again, and then joins level 0.  When a level holds ``fanout`` runs they are
merged (sorted merge joins over equal buckets, no shuffle) into one run of the
next level.  Merging all levels gives every line that ``threshold`` documents
have; those lines are dropped from every document.

The main path is DataFrame functions only.  Per-document distinct lines are
counted by partial aggregation, so a line that every document has costs one
row per task; the common lines are broadcast only after a count shows that
they are few, and otherwise joined by shuffle.

Edge cases: a null or empty text is one empty line; a key of fewer than
``min_chars`` code points is never dropped; each row of a repeated ``doc_id``
is a document of its own; empty tables give empty results; other columns are
ignored.  Line keys are compared by 128 bits of hash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.llm.common import WHITE, ascii_lower, text_or_empty, width
from eventlens.session import materialize, remove_path, scratch_path

KEY = ["h1", "h2"]

#: Common lines up to this many (about 16 bytes each) are broadcast.
BROADCAST_LINES = 500_000


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hashes(text: Column, min_chars: int) -> Column:
    """Per line a struct of two hashes of its key, null where the key is too short."""

    def hashed(line: Column) -> Column:
        key = F.trim(line, F.lit(WHITE))
        return F.when(F.length(key) >= min_chars, F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")))

    return F.transform(lines_of(ascii_lower(text)), hashed)


class LineRuns:
    """The levels of sorted runs."""

    def __init__(self, spark: SparkSession, threshold: int, fanout: int = 2):
        self.spark, self.threshold, self.fanout = spark, threshold, fanout
        self.buckets = width(spark)
        self.levels: list[list[DataFrame]] = []
        self.tables: dict[str, str] = {}

    def store(self, run: DataFrame, parts: list[str] | None = None) -> DataFrame:
        """Write a run bucketed and sorted by hash; reading it back needs no shuffle."""
        name = f"line_run_{uuid.uuid4().hex[:12]}"
        path = scratch_path(self.spark, name)
        writer = run.repartition(self.buckets, *KEY).write.format("parquet").option("path", path)
        if parts:
            writer = writer.partitionBy(*parts)
        writer.bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name)
        self.tables[name] = path
        return self.spark.table(name)

    def add(self, batch: DataFrame) -> None:
        """``batch``: a sorted run (h1, h2, n) of documents not seen before."""
        for run in (r for level in self.levels for r in level):
            known = run.filter(F.col("n") >= self.threshold).select(*KEY)
            batch = batch.join(known.hint("merge"), KEY, "left_anti")
        self._put(0, batch)

    def _put(self, i: int, run: DataFrame) -> None:
        if len(self.levels) == i:
            self.levels.append([])
        self.levels[i].append(run)
        if len(self.levels[i]) == self.fanout:
            merged = self.store(self._merge(self.levels[i]))
            self.levels[i] = []
            self._put(i + 1, merged)

    def _merge(self, runs: list[DataFrame]) -> DataFrame:
        out = runs[0]
        for run in runs[1:]:
            other = run.withColumnRenamed("n", "m").hint("merge")
            out = out.join(other, KEY, "full").select(*KEY, (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))
        return out

    def common(self) -> DataFrame:
        """Every line key of at least ``threshold`` documents, materialised."""
        runs = [r for level in self.levels for r in level]
        out = materialize(self._merge(runs).filter(F.col("n") >= self.threshold), "common-lines")
        for name, path in self.tables.items():
            self.spark.sql(f"DROP TABLE {name}")
            remove_path(self.spark, path)
        return out


def common_lines(docs: DataFrame, threshold: int, min_chars: int = 1, batches: int = 4, fanout: int = 2) -> DataFrame:
    """(h1, h2, n): the line keys found in at least ``threshold`` documents;
    ``n`` counts documents until a run showed the line to be common."""
    runs = LineRuns(docs.sparkSession, threshold, fanout)
    counted = (
        docs.select(
            F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch"),
            F.explode(F.array_distinct(line_hashes(text_or_empty(), min_chars))).alias("key"),
        )
        .filter(F.col("key").isNotNull())
        .groupBy("batch", F.col("key.h1").alias("h1"), F.col("key.h2").alias("h2"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    staged = runs.store(counted, ["batch"])
    for b in range(batches):
        runs.add(staged.filter(F.col("batch") == b).select(*KEY, "n"))
    return runs.common()


def drop_common_lines(docs: DataFrame, threshold: int = 10, min_chars: int = 1) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped and the kept ``text``."""
    common = common_lines(docs, threshold, min_chars)
    few = common.count() <= BROADCAST_LINES
    keys = F.broadcast(common.select(*KEY)) if few else common.select(*KEY).hint("merge")
    text = text_or_empty()
    dropped = (
        docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.posexplode(line_hashes(text, min_chars)).alias("pos", "key"))
        .filter(F.col("key").isNotNull())
        .select("doc_id", "text_hash", "pos", F.col("key.h1").alias("h1"), F.col("key.h2").alias("h2"))
        .join(keys, KEY, "left_semi")
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .agg(F.collect_set("pos").alias("_dropped"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))
    rows = docs.select("doc_id", text.alias("_text"), F.xxhash64(text).alias("_text_hash")).join(dropped, same, "left")
    lines = lines_of(F.col("_text"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_dropped"))
    with_lines = rows.select("doc_id", "_text", "_dropped", lines.alias("_lines"), kept.alias("_kept"))
    joined = F.array_join(F.transform("_kept", lambda i: F.get("_lines", i)), "\n")
    return with_lines.select(
        "doc_id",
        F.size("_lines").cast("long").alias("n_lines"),
        F.when(F.col("_dropped").isNull(), 0).otherwise(F.size("_dropped")).cast("long").alias("n_dropped"),
        F.when(F.col("_dropped").isNull(), F.col("_text")).otherwise(joined).alias("text"),
    )
