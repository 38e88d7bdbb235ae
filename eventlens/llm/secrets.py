"""Secrets in texts, weighed by who owns them across the corpus.

Base candidates are the matches of three patterns; each is kept whatever the
corpus says.  Further candidates (``live``) are long mixed runs of letters and
digits that no pattern announces: on its own such a run may be a product code
or an example from a manual.  The value of every candidate is hashed and
counted over the whole corpus, by distinct repositories (documents) and by
distinct owners (sources).  A value that ``wide_owners`` or more owners carry
is a widely copied example; one that few owners have, in few repositories, is
owner-specific and live-looking.  Only owner-specific ``live`` candidates
become spans, and base spans are labelled by the same figures.

The main path is DataFrame functions only.  Counting combines before each
shuffle; a value that a third of all documents carry comes back to them by
broadcast (``join_skewed``).

Edge cases: null or empty texts have no spans; a null source is one owner; a
value repeated inside a document counts once for it; rows of a repeated
``doc_id`` are rows of their own, and one repository; empty tables give empty
results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import join_skewed, plain, running_sum, scan, text_or_empty
from eventlens.session import materialize

#: Fixed patterns: what is matched, the least length, and the part that it is measured on.
ASSIGN_HEAD = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN_VALUE = r"[A-Za-z0-9+/_.=-]+"
ASSIGN = ASSIGN_HEAD + ASSIGN_VALUE
ASSIGN_LEAST = 12
#: A maximal run of at least n is the same as a run filtered by its length.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: Unannounced: 20 or more letters and digits with all three classes among them.
LIVE = r"(?<![A-Za-z0-9])(?=[a-z0-9]*[A-Z])(?=[A-Z0-9]*[a-z])(?=[A-Za-z]*[0-9])[A-Za-z0-9]{20,}"

KINDS = ["assign", "access", "hex", "live"]


_SPANS = "array<struct<start:int,kind:int,end:int,text:string>>"


def spans_of(text: Column, pattern: str, kind: str) -> Column:
    """Array of (start, kind rank, end, value) for the leftmost matches that do
    not overlap.  The lengths of matches and of the pieces between them, summed
    along the text, give their places in code points."""
    matched = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(matched.alias("m"), F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matched)).alias("b"))

    def placed(pair: Column) -> Column:
        before = running_sum(F.transform(pair, lambda x: F.length(x["b"]) + F.length(x["m"])))
        return F.transform(F.arrays_zip(pair.alias("p"), before.alias("at")), lambda z: _span(z["p"], z["at"], kind))

    # the pairs are bound once: an expression used twice in a lambda is not evaluated twice for its argument
    return F.flatten(F.transform(F.array(pairs), placed)).cast(_SPANS)


def _span(pair: Column, at: Column, kind: str) -> Column:
    start = at + F.length(pair["b"])
    return F.struct(
        start.cast("int").alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (start + F.length(pair["m"])).cast("int").alias("end"), pair["m"].alias("text")
    )


def candidates(docs: DataFrame, owner: str) -> DataFrame:
    """Rows of documents that have any candidate: row_id, doc_id, owner, spans."""
    text = F.col("text_")
    value = lambda s: F.regexp_replace(s, "^" + ASSIGN_HEAD, "")
    empty = F.array().cast(_SPANS)
    maybe = text.rlike(ASSIGN_HEAD + "[A-Za-z0-9+/_.=-]{%d,}" % ASSIGN_LEAST)
    assign = F.when(maybe, F.filter(spans_of(text, ASSIGN, "assign"), lambda s: F.length(value(s["text"])) >= ASSIGN_LEAST)).otherwise(empty)
    others = [F.when(text.rlike(p), spans_of(text, p, k)).otherwise(empty) for k, p in (("access", ACCESS), ("hex", HEX), ("live", LIVE))]
    rows = docs.select("doc_id", F.col(owner).alias("owner"), text_or_empty().alias("text_"))
    spans = rows.select("doc_id", "owner", F.concat(assign, *others).alias("spans"))
    hashed = F.transform(
        "spans",
        lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
            F.xxhash64(F.when(s["kind"] == 0, value(s["text"])).otherwise(s["text"])).alias("value"),
        ),
    )
    return spans.select("doc_id", "owner", F.monotonically_increasing_id().alias("row_id"), hashed.alias("spans"))


def ownership(found: DataFrame) -> DataFrame:
    """(value, n_owners, n_repos, n_rows) over the whole corpus."""
    each = found.select("doc_id", "owner", F.explode("spans.value").alias("value"))
    by_repo = each.groupBy("value", "owner", "doc_id").agg(F.count(F.lit(1)).alias("n_rows"))
    by_owner = by_repo.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("n_repos"), F.sum("n_rows").alias("n_rows"))
    return by_owner.groupBy("value").agg(
        F.count(F.lit(1)).alias("n_owners"), F.sum("n_repos").alias("n_repos"), F.sum("n_rows").alias("n_rows")
    )


def find_secrets(docs: DataFrame, owner: str = "source", wide_owners: int = 3, wide_repos: int = 10) -> DataFrame:
    """Per document: doc_id, row_id and ``spans``, an array of (start, kind,
    end, n_owners, n_repos, example) in order of start and kind."""
    found = materialize(candidates(docs, owner), "secret-candidates")
    owners = materialize(ownership(found), "secret-owners")
    placed = found.select("row_id", F.explode("spans").alias("s")).select("row_id", "s.*")
    judged = join_skewed(placed, owners, ["value"], "n_rows").withColumn(
        "example", (F.col("n_owners") >= wide_owners) | (F.col("n_repos") >= wide_repos)
    )
    live = KINDS.index("live")
    per_row = (
        judged.filter((F.col("kind") != live) | ~F.col("example"))
        .groupBy("row_id")
        .agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "n_owners", "n_repos", "example"))).alias("spans"))
    )
    none = F.array().cast(per_row.schema["spans"].dataType)
    return found.select("doc_id", "row_id").join(per_row, "row_id", "left").select("doc_id", "row_id", F.coalesce("spans", none).alias("spans"))


def rendered(spans: str, kinds: list[str]) -> Column:
    """kind:start:end, comma-joined, of the spans of these kinds."""
    names = F.array(*[F.lit(k) for k in KINDS])
    kept = F.filter(spans, lambda s: s["kind"] < len(kinds))
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redact(docs: DataFrame, mask: str = "[secret]", **options) -> DataFrame:
    """``docs`` with the owner-specific spans replaced by ``mask``, and all other columns."""
    key = F.struct("doc_id", F.xxhash64(text_or_empty()).alias("h"))
    spans = find_secrets(docs.withColumn("doc_id", key), **options).select(
        F.col("doc_id").alias("_key"), F.filter("spans", lambda s: ~s["example"]).alias("_spans")
    ).filter(F.size("_spans") > 0).dropDuplicates(["_key"])

    def piece(z: Column) -> Column:
        """The text up to a span's part that no span before it covers, and the mask."""
        start, end = F.greatest(z["s"]["start"], z["at"]), F.greatest(z["s"]["end"], z["at"])
        return F.when(end > start, F.concat(F.substring(F.col("text"), z["at"] + 1, start - z["at"]), F.lit(mask))).otherwise("")

    ends = F.transform("_spans", lambda s: s["end"])
    covered = F.transform(scan(ends, F.greatest), lambda x: x.cast("int"))
    pieces = F.transform(F.arrays_zip(F.col("_spans").alias("s"), covered.alias("at")), piece)
    masked = F.concat(F.array_join(pieces, ""), F.substring(F.col("text"), F.array_max(ends) + 1, F.length("text")))
    rows = plain(docs, "doc_id", "text")
    joined = rows.withColumn("_key0", key).join(spans, F.col("_key0").eqNullSafe(F.col("_key")), "left")
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(masked)
    return joined.select(*[text if c == "text" else F.col(c) for c in rows.columns]).toDF(*docs.columns)
