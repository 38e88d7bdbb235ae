"""Benchmark windows inside documents: a prefix-filtered containment join.

An item's windows are its runs of ``window`` consecutive words (an item of
fewer words is one window).  A window is a set of ``SHINGLE``-word shingles
with known offsets.  Finding it whole in a document is containment 1.0, for
which the necessary prefix, shingles ordered by rarity, is the single rarest
shingle.  So:

1. One pass over the texts keeps, per document, the positions whose shingle
   may be a benchmark shingle (a bitmap of their hashes, sized by their
   number), each with the few words around it.  Nothing else of the text moves.
2. Those occurrences are counted per shingle over all documents; each window
   takes its rarest shingle, and a window with an absent shingle is dropped.
3. Occurrences of prefix shingles are joined with their windows.  Positional
   and length bounds come first (the window must start and end inside the
   document), then the words of the window are compared one by one.

The main path is DataFrame functions only.  The bitmap has ``SLOTS_EACH`` slots
a shingle, so one position in so many passes by chance, between 512 KB and
32 MB; with more shingles than that more pass, and the join drops them.  Windows
are broadcast only after a count; beyond it both joins, on the shingle and on
the window's words, part hot keys from the rest (``join_skewed``), so that a
passage in a third of all documents fills no task.

Edge cases: null or empty texts have no words and hit nothing; items without
words have no window; a repeated item counts once per ``item_id``; rows of a
repeated ``doc_id`` are documents of their own; with an empty benchmark all
documents are clean; other columns are ignored and kept by ``drop_hit``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.llm.common import ascii_lower, join_skewed, plain, text_or_empty
from eventlens.session import materialize

SHINGLE = 5
#: Slots of the bitmap of benchmark shingles: so many a shingle, within bounds
#: (powers of two, 64 to a word).
SLOTS_EACH, LEAST_SLOTS, MOST_SLOTS = 64, 1 << 22, 1 << 28

#: Windows up to this many are broadcast (about 200 bytes each).
BROADCAST_WINDOWS = 100_000

#: What separates words: every ASCII character but 0-9 and a-z.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased words; splitting leaves at most one empty piece at each end."""
    return F.array_remove(F.split(ascii_lower(text), NOT_WORD, -1), "")


def shingle_at(words: str, i: Column, q: int) -> Column:
    return F.xxhash64(*[F.get(words, i + j) for j in range(q)])


def positions(n: Column, q: int) -> Column:
    """0 .. n - q, or nothing."""
    return F.when(n >= q, F.sequence(F.lit(0), n - q)).otherwise(F.array().cast("array<int>"))


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, words): the distinct windows of each item."""
    worded = items.select("item_id", words_of(text_or_empty()).alias("w")).filter(F.size("w") > 0)
    starts = F.when(F.size("w") >= window, F.sequence(F.lit(0), F.size("w") - window)).otherwise(F.array(F.lit(0)))
    return (
        worded.select("item_id", "w", F.explode(starts).alias("at"))
        .select("item_id", F.slice("w", F.col("at") + 1, F.lit(window)).alias("words"))
        .distinct()
    )


def window_shingles(windows: DataFrame, q: int) -> DataFrame:
    """(words, k, h) for the windows that use shingles of ``q`` words."""
    return windows.select("words", F.explode(positions(F.size("words"), q)).alias("k"), F.lit(q).alias("q")).withColumn(
        "h", shingle_at("words", F.col("k"), q)
    )


def slots_for(shingles: int) -> int:
    return min(max(1 << (SLOTS_EACH * shingles - 1).bit_length() if shingles else 0, LEAST_SLOTS), MOST_SLOTS)


def bitmap(shingles: DataFrame, slots: int) -> DataFrame:
    """One row: array<long> of ``slots`` bits, set where a shingle hashes to."""
    slot = F.col("h").bitwiseAND(F.lit(slots - 1).cast("long"))
    marked = shingles.groupBy(F.shiftrightunsigned(slot, 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits")
    )
    words = shingles.sparkSession.range(0, slots >> 6, numPartitions=1)
    filled = words.join(marked, words["id"] == marked["at"], "left").select("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "bits"))), lambda s: s["bits"]).alias("bits"))


def occurrences(docs: DataFrame, shingles: DataFrame, widths: list[int], window: int) -> DataFrame:
    """Every document with its word count and the places that may hold a
    benchmark shingle, each with the words within a window's reach."""
    slots = slots_for(shingles.count())
    bits = materialize(bitmap(shingles, slots), "shingle-bits")
    out = docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row_id"), words_of(text_or_empty()).alias("w"), bits.scalar().alias("bits")
    )
    mask = slots - 1

    def possible(q: int) -> Column:
        def marked(i: Column) -> Column:
            h = shingle_at("w", i, q)
            word = F.get("bits", F.shiftright(h.bitwiseAND(F.lit(mask).cast("long")), 6).cast("int"))
            return F.getbit(word, h.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1

        def around(i: Column) -> Column:
            first = F.greatest(i - (window - q), F.lit(0))
            return F.struct(
                i.alias("pos"),
                F.lit(q).alias("q"),
                shingle_at("w", i, q).alias("h"),
                first.alias("first"),
                F.slice("w", first + 1, i - first + window).alias("near"),
            )

        return F.transform(F.filter(positions(F.size("w"), q), marked), around)

    return out.select("doc_id", "row_id", F.size("w").cast("long").alias("n_words"), F.concat(*[possible(q) for q in widths]).alias("places"))


def hits(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """Per document: doc_id, row_id, n_words, n_hit, item_ids (sorted array)."""
    windows = materialize(item_windows(items, window), "windows")
    short = F.least(F.size("words"), F.lit(SHINGLE))
    widths = sorted(r[0] for r in windows.select(short).distinct().collect()) or [SHINGLE]
    shingles = None
    for q in widths:
        part = window_shingles(windows.filter(short == q).select("words").distinct(), q)
        shingles = part if shingles is None else shingles.unionByName(part)
    shingles = materialize(shingles, "window-shingles")
    found = materialize(occurrences(docs, shingles, widths, window), "places")

    places = found.select("row_id", "n_words", F.explode("places").alias("p")).select("row_id", "n_words", "p.*")
    counts = places.groupBy("q", "h").agg(F.count(F.lit(1)).alias("n"))
    ranked = shingles.join(counts, ["q", "h"], "left").groupBy("words").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "q", "h", "k")).alias("rarest")
    )
    prefixes = ranked.filter(F.col("rarest.n") > 0).select("words", "rarest.*")
    prefixes = prefixes.groupBy("q", "h").agg(F.max("n").alias("n"), F.collect_list(F.struct("words", "k")).alias("windows"))
    prefixes = materialize(prefixes, "prefixes")
    few = windows.count() <= BROADCAST_WINDOWS
    met = places.join(F.broadcast(prefixes.drop("n")), ["q", "h"]) if few else join_skewed(places, prefixes, ["q", "h"], "n")
    met = met.select("row_id", "n_words", "pos", "first", "near", F.inline("windows"))
    start, length = F.col("pos") - F.col("k"), F.size("words")
    spans = (
        met.filter((start >= 0) & (start + length <= F.col("n_words")))
        .filter(F.slice("near", F.greatest(start - F.col("first") + 1, F.lit(1)), length) == F.col("words"))
        .select("row_id", start.alias("start"), (start + length).alias("end"), "words")
    )
    spans = materialize(spans, "spans")
    owned = windows.groupBy("words").agg(F.collect_set("item_id").alias("items"))
    in_rows = spans.select("row_id", "words").distinct()
    if few:
        seen = in_rows.join(F.broadcast(owned), "words")
    else:
        often = in_rows.groupBy("words").agg(F.count(F.lit(1)).alias("n"))
        seen = join_skewed(in_rows, materialize(owned.join(often, "words"), "window-items"), ["words"], "n")
    seen = seen.select("row_id", F.explode("items").alias("item"))
    by_items = seen.groupBy("row_id").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("item_ids"))
    before = Window.partitionBy("row_id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = (
        spans.select("row_id", "start", "end").distinct()
        .withColumn("reach", F.coalesce(F.max("end").over(before), F.lit(0)))
        .groupBy("row_id")
        .agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "reach"))).alias("n_hit"))
    )
    return (
        found.select("doc_id", "row_id", "n_words")
        .join(covered, "row_id", "left")
        .join(by_items, "row_id", "left")
        .select(
            "doc_id", "row_id", "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        )
    )


def drop_hit(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` that no benchmark window hits, with all their columns."""
    text_hash = F.xxhash64(text_or_empty())
    bad = hits(docs.select(F.struct("doc_id", text_hash.alias("h")).alias("doc_id"), "text"), items, window)
    bad = bad.filter(F.col("n_hit") > 0).select(F.col("doc_id.doc_id").alias("_id"), F.col("doc_id.h").alias("_hash"))
    rows = plain(docs, "doc_id", "text")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_hash"))
    return rows.withColumn("_h", text_hash).join(bad, same, "left_anti").select(*rows.columns).toDF(*docs.columns)
