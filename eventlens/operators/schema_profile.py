"""Schema discovery and profile.

Both read the valid lines (``json_scan.valid_variants``).  A13 merges
per-record schemas with ``schema_of_variant_agg`` -- a true aggregate (partial
merge per task, one final merge), so discovery is one pass with no driver-side
sample.  A14 walks each record, every element of every array
included, as deep as the record goes, and counts for every path the records
that carry it and the type names seen there.  Each task adds up what it reads,
in a table of bounded size; one aggregation with partial sums per (path, type)
follows, whatever the depth.  ``discover`` takes both from one pass.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from eventlens.session import materialize
from eventlens.sources.json_scan import valid_variants

#: (path, type, elem) rows, and path steps, that a task holds.
TASK_STATES = 100_000
_State = tuple[str | None, str | None, bool | None]
_UNSAFE = re.compile(r"[.\[\]`]")
_KINDS = {type(None): "null", bool: "boolean", int: "long", float: "double", str: "string", dict: "struct", list: "array"}
#: Whole numbers from here on are no longer 64-bit.
_LONG = 1 << 63


def infer_schema(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """One row (records, schema) with the merged schema of all valid
    lines (Spark's variant schema notation; conflicting scalar types widen,
    otherwise become VARIANT)."""
    return valid_variants(lines, line_col).agg(F.count("*").alias("records"), F.schema_of_variant_agg("v").alias("schema"))


def quoted(key: str) -> str:
    """A key as a path step: in backticks where it could be read otherwise."""
    return key if key and not _UNSAFE.search(key) else "`" + key.replace("`", "``") + "`"


def _typed(value: object) -> tuple[str, bool | None]:
    """Type name of a value in the profile's vocabulary, and whether an array has elements."""
    kind = _KINDS[type(value)]
    if kind == "long" and not -_LONG <= value < _LONG:
        return "double", None
    return kind, bool(value) if kind == "array" else None


def _note(record: dict, steps: dict[str, str], held: Counter) -> None:
    """Add every place below the record's root to ``held`` (path, type, elem).
    Only paths below an array can occur twice, so only those are made distinct."""
    many: set[_State] = set()
    front: list[tuple[str, dict | list]] = [("", record)]
    while front:
        path, node = front.pop()
        if type(node) is dict:
            at = f"{path}." if path else ""
            below = [(at + (steps.get(k) or steps.setdefault(k, quoted(k))), x) for k, x in node.items()]
        else:
            below = [(f"{path}[]", x) for x in node]
        for place, value in below:
            state = (place, *_typed(value))
            if "[]" in place:
                many.add(state)
            else:
                held[state] += 1
            if state[1] in ("struct", "array"):
                front.append((place, value))
    for state in many:
        held[state] += 0
    for place in {state[0] for state in many}:
        held[place, None, None] += 1
    held[None, None, None] += 1


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states of a task's lines (valid JSON objects), summed while they are few."""
    steps: dict[str, str] = {}
    held: Counter[_State] = Counter()

    def out() -> pa.RecordBatch:
        paths, types, elems = zip(*held, strict=True)
        # half a surrogate pair is written as Java writes it
        paths = [None if x is None else x.encode("utf-8", "replace") for x in paths]
        columns = [pa.array(paths, pa.string()), pa.array(types, pa.string()), pa.array(elems, pa.bool_()), pa.array(held.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["path", "type", "elem", "n"])

    for batch in batches:
        for line in batch.column("line"):
            _note(json.loads(line.as_py().decode("utf-8", "replace")), steps, held)
            if len(held) >= TASK_STATES:
                yield out()
                held.clear()
            if len(steps) >= TASK_STATES:
                steps.clear()
    if held:
        yield out()


def path_states(records: DataFrame) -> DataFrame:
    """(path, type, elem, n) of records ``line``: n counts the records where the
    row stands for the path; a null path counts the records."""
    rows = records.select(F.col("line").cast("binary").alias("line")).mapInArrow(_counted, "path string, type string, elem boolean, n bigint")
    return rows.groupBy("path", "type", "elem").agg(F.sum("n").cast("bigint").alias("n"))


def _merged(states: DataFrame) -> DataFrame:
    """Per path: types, types_seen, present_rows, has_elements."""
    per_path = states.where(F.col("path").isNotNull()).groupBy("path").agg(
        F.array_sort(F.collect_set("type")).alias("types"), F.sum("n").cast("bigint").alias("present_rows"), F.bool_or("elem").alias("has_elements")
    )
    return per_path.withColumn("types_seen", F.concat_ws(",", "types"))


def _profile(lines: DataFrame, line_col: str) -> DataFrame:
    return _merged(path_states(valid_variants(lines, line_col)))


def discover(lines: DataFrame, required: list[str], paths: list[str], line_col: str = "value") -> DataFrame:
    """A13, A14, S6 and P4 from one scan and one parse: (part, name, types,
    rows).  ``schema``: the merged schema and the records; ``profile``: every
    path with its types and records; ``required``: records that lack a key;
    ``coverage``: records with a value at a payload path.  The schema is
    observed on the rows that the walk reads."""
    seen = Observation()
    records = valid_variants(lines, line_col).observe(seen, F.schema_of_variant_agg("v").alias("schema"))
    states = materialize(path_states(records), "discovery")
    profile = _merged(states)
    present = profile.select("path", "present_rows")
    spark = lines.sparkSession
    count = states.where(F.col("path").isNull()).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("records"))
    # an optimised-away empty input is never observed
    schema = seen.get["schema"] if count.first()[0] else infer_schema(lines, line_col).first()["schema"]
    one = lambda names, key: spark.createDataFrame([(n, k) for n, k in zip(names, key, strict=True)], "name string, path string")
    steps = [".".join(["payload", *p.removeprefix("$.").split(".")]) for p in paths]
    none = F.lit(None).cast("string")
    found = F.coalesce("present_rows", F.lit(0))
    return (
        count.select(F.lit("schema").alias("part"), F.lit("").alias("name"), F.lit(schema).cast("string").alias("types"), F.col("records").alias("rows"))
        .unionByName(profile.select(F.lit("profile").alias("part"), F.col("path").alias("name"), F.col("types_seen").alias("types"), F.col("present_rows").alias("rows")))
        .unionByName(
            one(required, required).join(present, "path", "left").join(F.broadcast(count))
            .select(F.lit("required").alias("part"), "name", none.alias("types"), (F.col("records") - found).alias("rows"))
        )
        .unionByName(one(paths, steps).join(present, "path", "left").select(F.lit("coverage").alias("part"), "name", none.alias("types"), found.alias("rows")))
    )


def schema_profile(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """(path, types_seen, present_rows).  ``types_seen`` is the sorted,
    comma-joined set of type names at that path; ``present_rows`` counts
    records, also where a path occurs several times in one."""
    return _profile(lines, line_col).select("path", "types_seen", "present_rows")


def schema_field_count(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """A14 summary: named fields, leaves, and the compatible field score,
    where a struct scores its number of fields plus their scores, an array 1
    plus its element, a leaf 1 (so a leaf under a struct scores twice).  Over
    paths that is: +1 per named field, +1 per leaf node (a named leaf or an
    array element), +1 per array node, and +1 for an array whose element is
    never seen (its element type is null)."""
    prof = _profile(lines, line_col)
    is_elem = F.endswith("path", F.lit("[]"))
    is_array = F.array_contains("types", "array")
    is_leaf = ~is_array & ~F.array_contains("types", "struct")
    empty_array = is_array & ~F.coalesce(F.col("has_elements"), F.lit(False))
    return prof.agg(
        F.count_if(~is_elem).cast("bigint").alias("fields"),
        F.count_if(is_leaf).cast("bigint").alias("leaves"),
        (F.count_if(~is_elem) + F.count_if(is_leaf) + F.count_if(is_array) + F.count_if(empty_array))
        .cast("bigint").alias("score"),
    )
