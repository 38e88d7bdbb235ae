"""Column expressions over parsed events.

All are built-in Catalyst expressions (no Python UDFs), so they stay inside
whole-stage codegen.  Payload paths read the VARIANT payload: navigation
through a non-object yields NULL, like a nested ``dict.get`` chain.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlens.schema import LANGUAGE_PATHS, PUSH, UNKNOWN_REPO, UNKNOWN_TYPE, UNKNOWN_USER


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Whitespace as stripped around an NDJSON line: what Unicode calls white space
# or a separator of lines, paragraphs, records or units (fixed values).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: str | Column) -> Column:
    """Trim leading/trailing whitespace (not only spaces, as ``trim`` does)."""
    return F.btrim(_c(c), F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def payload_path(path: str, payload: str | Column = "payload", as_type: str = "string") -> Column:
    """Value at a JSON path of the payload, NULL when any step is absent
    or not an object (or the leaf does not cast)."""
    return F.try_variant_get(_c(payload), path, as_type)


def language(paths: list[str] | None = None, payload: str = "payload") -> Column:
    """F1 (4 paths) / F2 (pass LANGUAGE_PATHS_3): first non-empty language.
    Only a JSON string is a language; any other value is passed over."""

    def one(path: str) -> str:
        value = f"try_variant_get({_q(payload)}, {_lit(path)}, 'variant')"
        text = f"try_variant_get({_q(payload)}, {_lit(path)}, 'string')"
        return f"CASE WHEN schema_of_variant({value}) = 'STRING' THEN nullif({text}, '') END"

    return F.expr(f"coalesce({', '.join(map(one, paths or LANGUAGE_PATHS))})")


def size_is_int(payload: str | Column = "payload") -> Column:
    return F.schema_of_variant(F.try_variant_get(_c(payload), "$.size", "variant")) == F.lit("BIGINT")


def commit_count(payload: str | Column = "payload", fallback: str = "commits") -> Column:
    """integer ``size``; else the length of a ``commits`` array; else 0.
    A string, float or boolean ``size`` is not an integer.
    ``fallback="zero"`` is F12: integer ``size`` else 0."""
    if isinstance(payload, str):
        p = _q(payload)
        other = "0L" if fallback == "zero" else f"coalesce(CAST(array_size(try_variant_get({p}, '$.commits', 'array<variant>')) AS BIGINT), 0L)"
        return F.expr(
            f"CASE WHEN schema_of_variant(try_variant_get({p}, '$.size', 'variant')) = 'BIGINT' "
            f"THEN try_variant_get({p}, '$.size', 'bigint') ELSE {other} END"
        )
    p = _c(payload)
    size = F.try_variant_get(p, "$.size", "bigint")
    if fallback == "zero":
        other = F.lit(0).cast("bigint")
    else:
        other = F.coalesce(F.array_size(F.try_variant_get(p, "$.commits", "array<variant>")).cast("bigint"), F.lit(0).cast("bigint"))
    return F.when(size_is_int(p), size).otherwise(other)


def user_name(actor: str | Column = "actor") -> Column:
    """login, else display login, else 'unknown' (empty counts as missing)."""
    if isinstance(actor, str):
        a = _q(actor)
        return F.expr(f"coalesce(nullif({a}.login, ''), nullif({a}.display_login, ''), {_lit(UNKNOWN_USER)})")
    a = _c(actor)
    return F.coalesce(blank_to_null(a.getField("login")), blank_to_null(a.getField("display_login")), F.lit(UNKNOWN_USER))


def repo_name(repo: str | Column = "repo") -> Column:
    """repository name, else 'unknown/unknown'."""
    if isinstance(repo, str):
        return F.expr(f"coalesce(nullif({_q(repo)}.name, ''), {_lit(UNKNOWN_REPO)})")
    return F.coalesce(blank_to_null(_c(repo).getField("name")), F.lit(UNKNOWN_REPO))


def event_type(type_col: str | Column = "type") -> Column:
    """event type, else 'Unknown'."""
    if isinstance(type_col, str):
        return F.expr(f"coalesce(nullif({_q(type_col)}, ''), {_lit(UNKNOWN_TYPE)})")
    return F.coalesce(blank_to_null(_c(type_col)), F.lit(UNKNOWN_TYPE))


def event_hour(created_at: str | Column = "created_at") -> Column:
    """characters 12-13 of the ISO timestamp; NULL when shorter than 13."""
    if isinstance(created_at, str):
        c = _q(created_at)
        return F.expr(f"CASE WHEN length({c}) >= 13 THEN substring({c}, 12, 2) END")
    c = _c(created_at)
    return F.when(F.length(c) >= 13, F.substring(c, 12, 2))


def payload_keys(payload: str | Column = "payload") -> Column:
    """F8: the sorted top-level payload keys; empty for a missing or
    non-object payload."""
    keys = F.map_keys(F.try_variant_get(_c(payload), "$", "map<string, variant>"))
    return F.coalesce(F.array_sort(keys), F.array().cast("array<string>"))


def is_push(type_col: str | Column = "type") -> Column:
    """P1."""
    return _c(type_col) == F.lit(PUSH)


def normalize_name(c: str | Column) -> Column:
    """result normalization, NULL name -> ''."""
    return F.coalesce(_c(c).cast("string"), F.lit(""))


def normalize_count(c: str | Column) -> Column:
    """NULL count -> 0."""
    return F.coalesce(_c(c).cast("bigint"), F.lit(0).cast("bigint"))
