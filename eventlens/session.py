"""Session helpers: one place for the confs the library relies on.

Nothing here hard-codes cluster sizing.  Shuffle width is left to AQE
(coalescing + skew handling); callers on a real cluster pass their own
``spark.sql.shuffle.partitions`` sized to the input.
"""

from __future__ import annotations

import atexit
import gc
import itertools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Confs that change *results*, not just speed.  Applied by ``get_session`` and
# checked by ``ensure_semantics`` for sessions built elsewhere.
SEMANTIC_CONFS = {
    # Duplicate keys inside a JSON object keep the last value (what Python's
    # json.loads does) instead of failing the variant parse.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Hours are cut from ISO strings, but any timestamp formatting is UTC.
    "spark.sql.session.timeZone": "UTC",
}

PERF_CONFS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


#: Scratch tables that are written from one ``clean_driver`` to the next.
CLEAN_EVERY = 4

_handed_out: set[str] = set()
_written = itertools.count(1)


def get_session(master: str | None = None, app: str = "eventlens", **extra: str) -> SparkSession:
    """Build (or reuse) a session with the library's semantic confs."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**PERF_CONFS, **SEMANTIC_CONFS, **extra}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_semantics(spark)
    return spark


def ensure_semantics(spark: SparkSession) -> None:
    """Set the result-affecting SQL confs on a session built elsewhere."""
    for k, v in SEMANTIC_CONFS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    ``SparkContext.getCheckpointDir()`` first (a folder set by
    ``setCheckpointDir`` or, at start-up, by ``spark.checkpoint.dir``), then the
    session's ``spark.checkpoint.dir``.  Where neither is set, a local master
    (tests, one machine) gets a folder of its own that goes when Python ends;
    any other master raises, because a machine-local folder would be
    unreadable to the other executors."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="eventlens-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    path = f"{checkpoint_root(spark)}/eventlens-scratch/{name}-{uuid.uuid4().hex[:12]}"
    _handed_out.add(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Remove every scratch path this process was given.  For the end of an
    application: results that were not written out may still read them."""
    while _handed_out:
        remove_path(spark, _handed_out.pop())


def scratch_mark() -> frozenset[str]:
    """The scratch paths handed out so far, for ``release_since``."""
    return frozenset(_handed_out)


def release_since(spark: SparkSession, mark: frozenset[str], *keep) -> None:
    """Remove the scratch paths handed out after ``mark``, but for those of the
    materialised tables ``keep``: what a finished step left behind."""
    kept = {df.scratch for df in keep}
    for path in _handed_out - mark - kept:
        remove_path(spark, path)
        _handed_out.discard(path)


def materialize(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back.  Used when several consumers need the same expensive input: readers
    get column pruning and pushdown, and recovery after an executor loss
    re-reads files instead of re-running the lineage.  ``release`` removes the
    copy when nothing reads it any more."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    if next(_written) % CLEAN_EVERY == 0:
        clean_driver(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def clean_driver(spark: SparkSession) -> None:
    """Let go of what finished jobs left in the driver.  Spark removes their
    broadcasts and shuffles only when the driver's JVM collects the plans that
    name them, of which Python may hold some in cycles; a step of very many
    short jobs would let the heap grow to its limit before that."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def release(*tables) -> None:
    """Remove the scratch copies that ``materialize`` made of these tables."""
    for df in tables:
        remove_path(df.sparkSession, df.scratch)
        _handed_out.discard(df.scratch)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a path with the file system that Spark itself uses for it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
