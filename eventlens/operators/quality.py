"""Data-quality and preview operators.

Each is a single pass with a global aggregate (map-side partial, one tiny
final row) or a bounded top-n; none collects data to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.functions import extract as X
from eventlens.schema import PREVIEW_KEYS, PREVIEW_N, REQUIRED_FIELDS
from eventlens.sources.json_scan import valid_events


def _unpivot(agg: DataFrame, names: list[str], key: str, value: str) -> DataFrame:
    cols = [F.col(f"`{n}`") for n in names]
    return agg.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias(key), c.cast("bigint").alias(value)) for n, c in zip(names, cols)]))
    )


def required_fields(lines: DataFrame, fields: list[str] | None = None, line_col: str = "value") -> DataFrame:
    """For every required top-level key, the number of valid records that
    lack it (presence only; a JSON null counts as present).  Checks every
    line in one pass: keys are listed from the text of lines that the envelope
    parse found valid: (field, missing_rows), zero rows included."""
    fields = fields or REQUIRED_FIELDS
    keys = valid_events(lines, line_col).select(F.json_object_keys("line").alias("keys"))
    agg = keys.agg(*[F.count_if(~F.array_contains("keys", f)).alias(f) for f in fields])
    return _unpivot(agg, fields, "field", "missing_rows")


def path_coverage(events: DataFrame, paths: list[str], payload: str = "payload") -> DataFrame:
    """For candidate payload paths, how many events carry a value there
    (JSON null counts as present).  One pass: (path, present_rows)."""
    agg = events.agg(
        *[F.count_if(F.try_variant_get(F.col(payload), p, "variant").isNotNull()).alias(p) for p in paths]
    )
    return _unpivot(agg, paths, "path", "present_rows")


def preview(events: DataFrame, n: int = PREVIEW_N) -> DataFrame:
    """P5: the first n valid events by numeric id: type (not defaulted),
    actor, repo, created_at, language and the first sorted payload keys."""
    proj = events.select(
        F.col("id"),
        F.col("type"),
        X.user_name("actor").alias("actor"),
        X.repo_name("repo").alias("repo"),
        F.col("created_at"),
        X.language().alias("language"),
        F.concat_ws(",", F.slice(X.payload_keys("payload"), 1, PREVIEW_KEYS)).alias("payload_keys"),
        F.col("id").try_cast("bigint").alias("_n"),
    )
    from pyspark.sql import Window

    top = proj.orderBy(F.col("_n").asc_nulls_last(), "id").limit(n)
    return top.select(
        F.row_number().over(Window.orderBy(F.col("_n").asc_nulls_last(), "id")).cast("bigint").alias("rank"),
        *[c for c in proj.columns if c != "_n"],
    )
