"""One event -> its metric emissions, as a narrow Generate (no Python).

Each valid event emits ``evt`` (repo x type), ``user`` and ``type`` rows;
pushes add ``push`` and ``commits`` (value = commit count); events with a
language add ``lang``; events with an hour add ``hour``.  Columns: kind,
name, event_type (``evt`` only), value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.schema import PUSH

EMISSION_KINDS = ["evt", "user", "type", "push", "commits", "lang", "hour"]


def _row(kind: str, name: Column, value: Column | int = 1, etype: Column | None = None) -> Column:
    v = value if isinstance(value, Column) else F.lit(value)
    return F.struct(
        F.lit(kind).alias("kind"),
        name.alias("name"),
        (etype if etype is not None else F.lit(None).cast("string")).alias("event_type"),
        v.cast("bigint").alias("value"),
    )


def emission_array() -> Column:
    """Array of emission structs for one silver row (NULLs filtered out)."""
    push = F.col("type") == F.lit(PUSH)
    rows = [
        _row("evt", F.col("repo"), 1, F.col("type")),
        _row("user", F.col("user")),
        _row("type", F.col("type")),
        F.when(push, _row("push", F.col("repo"))),
        F.when(push, _row("commits", F.col("repo"), F.col("commits"))),
        F.when(F.col("language").isNotNull(), _row("lang", F.col("language"))),
        F.when(F.col("hour").isNotNull(), _row("hour", F.col("hour"))),
    ]
    return F.filter(F.array(*rows), lambda x: x.isNotNull())


def emissions(silver: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Silver -> one row per emission: ``keep`` columns + kind, name,
    event_type, value."""
    keep = keep or []
    return silver.select(*keep, F.inline(emission_array()))
