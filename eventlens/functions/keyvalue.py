"""Composite key/value encoding (F9-F11) used by the text sink and its
reader: ``kind|name`` or ``evt|repo|type`` keys, tab, integer value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def encode_key(kind: str | Column, name: str | Column, event_type: str | Column | None = None) -> Column:
    """``kind|name`` (``evt|repo|type`` when an event type is given)."""
    parts = [F.col(kind) if isinstance(kind, str) else kind, F.col(name) if isinstance(name, str) else name]
    if event_type is not None:
        parts.append(F.col(event_type) if isinstance(event_type, str) else event_type)
    return F.concat_ws("|", *parts)


def encode_line(key: str | Column, value: str | Column) -> Column:
    """S10 line: ``key<TAB>value``."""
    k = F.col(key) if isinstance(key, str) else key
    v = F.col(value) if isinstance(value, str) else value
    return F.concat_ws("\t", escape(k), v.cast("string"))


# What a text line cannot hold as it is, and its spelling (fixed values).
ESCAPES = [("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")]


def escape(c: Column) -> Column:
    """Backslash, tab and line ends spelled out."""
    for raw, spelled in ESCAPES:
        c = F.replace(c, F.lit(raw), F.lit(spelled))
    return c


def unescape(c: Column) -> Column:
    """The inverse of ``escape``: backslash pairs are read from the left."""
    parts = F.split(c, r"\\\\", -1)

    def plain(part: Column) -> Column:
        for raw, spelled in ESCAPES[1:]:
            part = F.replace(part, F.lit(spelled), F.lit(raw))
        return part

    return F.when(F.contains(c, F.lit("\\")), F.array_join(F.transform(parts, plain), "\\")).otherwise(c)


def parse_value(text: str | Column) -> Column:
    """missing or non-integer value text counts as 1."""
    t = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.nullif(t, F.lit("")).try_cast("bigint"), F.lit(1).cast("bigint"))


def split_line(lines: DataFrame, col: str = "value") -> DataFrame:
    """``key<TAB>value`` -> key, value_text (value empty when no tab)."""
    v = F.col(col)
    pos = F.instr(v, "\t")
    key = F.when(pos > 0, F.substr(v, F.lit(1), pos - 1)).otherwise(v)
    val = F.when(pos > 0, F.substr(v, pos + 1)).otherwise(F.lit(""))
    return lines.select(unescape(key).alias("key"), val.alias("value_text"))


def decode_key(key: str | Column) -> tuple[Column, Column, Column]:
    """split at the first '|'; for ``evt`` keys split the rest again at
    its first '|' into repo and event type.  Returns (kind, name, event_type)."""
    k = F.col(key) if isinstance(key, str) else key
    kind = F.substring_index(k, "|", 1)
    rest = F.when(F.instr(k, "|") > 0, F.substr(k, F.instr(k, "|") + 1)).otherwise(F.lit(""))
    is_evt = kind == F.lit("evt")
    name = F.when(is_evt, F.substring_index(rest, "|", 1)).otherwise(rest)
    etype = F.when(is_evt, F.when(F.instr(rest, "|") > 0, F.substr(rest, F.instr(rest, "|") + 1)).otherwise(F.lit("")))
    return kind, name, etype

