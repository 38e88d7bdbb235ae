"""Event-line parsing: declared-schema scan with quarantine.

``parse_events`` parses each line exactly once with ``from_json`` against the
declared envelope.  A line is a valid event only when it is one JSON object by
the letter of the grammar (double quotes only, no NaN or Infinity, no comments,
no control characters in strings, no leading zeros): it must start with ``{``,
parse without a corrupt-record marker, and have object-typed ``actor`` / ``repo``
when present (a falsy value, such as an empty string, counts as missing).
Nothing may follow the object: Spark's parser stops at its end, so the line is
also read as the first element of an array whose second one is a number made
from the line itself, and that number must come next.  Everything else is
quarantined with a reason and never reaches a metric; ``quarantine`` gives
those lines for a sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.schema import CORRUPT_COL, EVENT_DDL
from eventlens.sources.lines import read_lines

#: JSON by the letter of the grammar, as far as the parser can be told.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}

EVENT_FIELDS = ["id", "type", "actor", "repo", "payload", "created_at"]

#: SQL: a number made from the line, and the array of the line and that number.
_MARK = "cast(xxhash64(line) AS string)"
_MARKED = f"concat('[', line, ',', {_MARK}, ']')"


def parse_events(lines: DataFrame, line_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Lines -> one row per line with the envelope fields plus ``valid`` and
    ``reason`` (NULL when valid).  Keeps ``line`` and the ``keep`` columns.
    Row-local, no shuffle."""
    keep = keep or []
    line = F.col(line_col)
    parsed = F.from_json(line, EVENT_DDL, {**STRICT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL})
    # The parse result leaves through a one-row generator: Catalyst cannot push
    # the validity filter below a Generate, so neither the line expression nor
    # from_json is copied into the filter (each line is parsed exactly once).
    df = lines.select(F.inline(F.array(F.struct(*[F.col(c) for c in keep], line.alias("line"), parsed.alias("_e")))))
    one = f"get_json_object({_MARKED}, '$[1]') IS DISTINCT FROM {_MARK}"
    reason = F.expr(f"""CASE
        WHEN length(line) = 0 THEN 'empty'
        WHEN NOT startswith(line, '{{') THEN 'not_object'
        WHEN _e.{CORRUPT_COL} IS NOT NULL THEN
          CASE WHEN try_parse_json(line) IS NULL THEN 'invalid_json'
               WHEN {one} THEN 'trailing_text'
               WHEN NOT ({_object_or_falsy('actor')} AND {_object_or_falsy('repo')}) THEN 'bad_field_type' END
        WHEN {one} THEN 'trailing_text'
      END""")
    return df.select(*keep, "line", *[F.col(f"_e.{c}").alias(c) for c in EVENT_FIELDS], reason.alias("reason")).withColumn(
        "valid", F.col("reason").isNull()
    )


def _object_or_falsy(field: str, variant: str = "try_parse_json(line)") -> str:
    """SQL: the field is an object, or absent, null, false, zero, "" or []."""
    value = f"try_variant_get({variant}, '$.{field}', 'variant')"
    text = f"coalesce(to_json({value}), 'null')"
    return f"""(try_variant_get({variant}, '$.{field}', 'map<string, variant>') IS NOT NULL
      OR {text} IN ('null', 'false', '""', '[]') OR {text} RLIKE '^-?0+([.]0*)?(E.*)?$')"""


def valid_variants(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """The valid lines (``line``), each with its VARIANT ``v``, by the same
    rules as ``parse_events`` (for schema discovery, which needs no envelope)."""
    kept = lines.select(F.col(line_col).alias("line")).where(F.startswith("line", F.lit("{")))
    pair = kept.select("line", F.expr(f"inline(array(struct(try_parse_json({_MARKED}) AS pair, {_MARK} AS mark)))"))
    alone = pair.where("try_variant_get(pair, '$[1]', 'string') = mark")
    found = alone.select("line", F.expr("inline(array(struct(try_variant_get(pair, '$[0]', 'variant') AS v)))"))
    return found.where(F.expr(f"{_object_or_falsy('actor', 'v')} AND {_object_or_falsy('repo', 'v')}"))


def valid_events(lines: DataFrame, line_col: str = "value") -> DataFrame:
    return parse_events(lines, line_col).where("valid").drop("valid", "reason")


def quarantine(lines: DataFrame, line_col: str = "value") -> DataFrame:
    return parse_events(lines, line_col).where(~F.col("valid")).select("line", "reason")


def read_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``spark.read.json`` with an inferred nested schema.  Inference is
    a distributed pass of its own over all lines.  Malformed lines come back as rows with only ``_corrupt_record`` set.
    For production runs prefer ``read_declared``: no inference pass."""
    return spark.read.options(**STRICT).option("columnNameOfCorruptRecord", CORRUPT_COL).json(path)


def read_declared(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """S2 line scan + ``parse_events``: the production path (no inference job,
    corrupt detection not affected by column pruning)."""
    return parse_events(read_lines(spark, path))
