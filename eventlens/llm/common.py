"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that word and line keys know: space and U+0009-U+000D.
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Longest list of hot keys that is ever broadcast.
HOT_KEYS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` would fold other alphabets)."""
    return F.translate(c, UPPER, UPPER.lower())


def plain(docs: DataFrame, *wanted: str) -> DataFrame:
    """``docs`` with every column but ``wanted`` named by its place, so that no
    helper column can clash; ``toDF(*docs.columns)`` undoes it."""
    return docs.toDF(*[c if c in wanted else f"_{i}" for i, c in enumerate(docs.columns)])


def width(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the session sizes them for its input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Arrow batches bounded in rows and bytes, so that a worker holds a few
    MB of text at a time however long the documents are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def scan(values: Column, merge: Callable[[Column, Column], Column], zero: int = 0, chunk: int = 128) -> Column:
    """What ``merge`` makes of all values before each one (``zero`` before the
    first), for an array of integers.  Arrays grow inside chunks only, so the
    work is in proportion to the length times the chunk."""
    kind = "struct<at:bigint,out:array<bigint>>"

    def along(items: Column, value: Callable[[Column], Column]) -> Column:
        start = F.struct(F.lit(zero).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("out")).cast(kind)
        step = lambda acc, x: F.struct(merge(acc["at"], value(x)).cast("bigint").alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(items, start, step)

    parts = F.transform(F.sequence(F.lit(1), F.size(values), F.lit(chunk)), lambda i: along(F.slice(values, i, F.lit(chunk)), lambda x: x))
    whole = F.array(parts)
    based = F.transform(whole, lambda p: F.arrays_zip(p.alias("part"), along(p, lambda x: x["at"])["out"].alias("base")))
    out = F.transform(F.flatten(based), lambda z: F.transform(z["part"]["out"], lambda x: merge(z["base"], x)))
    return F.when(F.size(values) > 0, F.flatten(out)).otherwise(F.array().cast("array<bigint>"))


def running_sum(values: Column) -> Column:
    return scan(values, lambda a, b: a + b)


def join_skewed(rows: DataFrame, keyed: DataFrame, keys: list[str], weight: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` with ``keyed`` (unique on ``keys``; ``weight`` is at most
    a small factor off the number of rows that have the key).

    Keys with more than a thousandth of all weight number ``HOT_KEYS`` at
    most; the hashes of those come to the driver and part both sides, their
    rows are joined by broadcast, and no task receives the rows of a hot key.
    The rest is an ordinary shuffled join.  (A key that shares a hot key's
    hash goes with it on both sides.)  ``keyed`` should be materialised: it is
    read three times."""
    place = F.xxhash64(*keys)
    total = keyed.agg(F.sum(weight)).first()[0] or 0
    limit = max(100, total // HOT_KEYS + 1)
    hot = [r[0] for r in keyed.filter(F.col(weight) >= limit).select(place).collect()]
    if not hot:
        return rows.join(keyed, keys, how)
    warm = rows.filter(place.isin(hot)).join(F.broadcast(keyed.filter(place.isin(hot))), keys, "inner")
    cold = rows.filter(~place.isin(hot)).join(keyed.filter(~place.isin(hot)), keys, how)
    return warm.unionByName(cold)
