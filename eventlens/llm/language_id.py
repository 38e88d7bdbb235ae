"""Language identification with Kneser-Ney character models.

Training: every task counts the 4-grams of the labelled texts it reads, in
sorted arrays of bounded size, and one aggregation adds the counts up.  All
labelled training rows are counted and the models keep every 4-gram.  Up to
``MODEL_GRAMS`` distinct (language, 4-gram) pairs the models are estimated as
sorted arrays and broadcast; beyond it they are tables, estimated and applied
by joins (``kneser_ney_tables``), with the same results, and neither the driver
nor a worker holds them.

Scoring: a text's cross-entropy per character under every model; the lowest
wins.  ``score`` is the winner's share of the likelihoods at a temperature
fitted on the training texts.  Rejection is calibrated per language, both on
every labelled training row with letters: a text is rejected when its
cross-entropy exceeds the language's median by ``REJECT_DEVIATIONS`` deviations
(scaled median ones, widened for short texts) and is over twice the median
besides, or when it has no letters.  The medians are exact, found by counting.

Edge cases: null or letterless texts are ``und`` with score 0; rows without a
label train nothing and are scored; with no labelled rows everything is
``und``; repeated rows count and score twice; other columns are ignored here
and kept by ``keep_identified``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.llm.char_lm import ORDER, SPACE, LanguageModels, folded, packed, padded, summed
from eventlens.llm.common import plain, small_batches
from eventlens.llm.kneser_ney_tables import Tables, entropies, estimate
from eventlens.session import materialize, release, release_since, scratch_mark

#: 4-grams that a task holds per language before it passes them on.
TASK_GRAMS = 1_000_000
#: (language, 4-gram) pairs, about 12 bytes each, that may go to every worker.
MODEL_GRAMS = 10_000_000
REJECT_DEVIATIONS = 8.0
TEMPERATURES = [0.05 * 1.5**k for k in range(12)]
#: Bins that a round of ``medians`` counts a language's values in.
BINS = 1024
UNKNOWN = "und"
#: A training text's cross-entropy under its own language, and its loss at every temperature.
_OWN = "lang string, h double, loss array<double>"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n): sums of what this task has read."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    fresh: dict[str, list[np.ndarray]] = {}

    def fold_in(lang: str) -> None:
        keys, counts = np.unique(np.concatenate(fresh.pop(lang)), return_counts=True)
        old = held.get(lang, (np.empty(0, np.uint64), np.empty(0, np.int64)))
        held[lang] = summed(np.concatenate([old[0], keys]), np.concatenate([old[1], counts]))

    def out(lang: str) -> Iterator[pa.RecordBatch]:
        keys, counts = held.pop(lang)
        for i in range(0, len(keys), 1 << 16):
            k, c = keys[i : i + (1 << 16)].view(np.int64), counts[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k)), pa.array(k), pa.array(c)], ["lang", "gram", "n"])

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), utf8(batch.column("text")), strict=True):
            units = folded(text.as_py())
            if (units != SPACE).any():
                fresh.setdefault(lang, []).append(packed(padded(units), ORDER))
        for lang in list(fresh):
            if sum(map(len, fresh[lang])) >= TASK_GRAMS:
                fold_in(lang)
                if len(held[lang][0]) >= TASK_GRAMS:
                    yield from out(lang)
    for lang in list(fresh):
        fold_in(lang)
    for lang in list(held):
        yield from out(lang)


def utf8(texts: pa.Array) -> pa.Array:
    return texts.cast(pa.binary() if pa.types.is_string(texts.type) else pa.large_binary())


def count_grams(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n), materialised, of the rows of ``labelled`` (text, lang) that have a label."""
    small_batches(labelled.sparkSession)
    rows = labelled.filter(F.col("lang").isNotNull()).select("lang", "text")
    return materialize(rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "gram-counts")


def sorted_arrays(counts: DataFrame) -> LanguageModels:
    """The models of all languages of ``counts``, on the driver."""
    model = counts.toArrow()
    lang = model.column("lang").combine_chunks().dictionary_encode()
    place = lang.indices.to_numpy()
    gram, n = model.column("gram").to_numpy().view(np.uint64), model.column("n").to_numpy()
    counted = {}
    for i, x in enumerate(lang.dictionary.to_pylist()):
        mine = np.flatnonzero(place == i)
        mine = mine[np.argsort(gram[mine])]
        counted[x] = gram[mine], n[mine]
    return LanguageModels(counted)


class Calibration(NamedTuple):
    """Per language the median and deviation of the cross-entropy, and a
    temperature."""

    mean: np.ndarray
    deviation: np.ndarray
    temperature: float

    def verdict(self, entropies: np.ndarray, units: int) -> tuple[int, float, bool]:
        """Best language, its score, and whether the text (of so many folded units) is rejected."""
        best = int(entropies.argmin())
        weights = np.exp(-(entropies - entropies[best]) / self.temperature)
        score = float(1 / weights.sum())
        slack = REJECT_DEVIATIONS * self.deviation[best] * (1 + 20 / np.sqrt(units))
        over = entropies[best] - self.mean[best]
        return best, score, bool(over > slack and over > self.mean[best])


def medians(values: DataFrame) -> dict[str, float]:
    """The exact median of ``h`` in every ``lang``.  Each round counts the
    values between the bounds known so far in bins, and the ends of the values
    in the middle's bin are the next bounds, so that neither a task nor the
    driver holds a language's values."""
    spark = values.sparkSession
    ends = values.groupBy("lang").agg(F.count(F.lit(1)), F.min("h"), F.max("h")).collect()
    # (language, middle rank) -> the values before the bounds, and the bounds
    bounds = {(lang, k): (0, lo, hi) for lang, n, lo, hi in ends for k in ((n - 1) // 2, n // 2)}
    while wide := [(*key, lo, hi) for key, (_, lo, hi) in bounds.items() if lo < hi]:
        asked = F.broadcast(spark.createDataFrame(wide, "lang string, k long, lo double, hi double"))
        place = F.least(F.floor((F.col("h") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS), F.lit(BINS - 1))
        inside = values.join(asked, "lang").filter(F.col("h").between(F.col("lo"), F.col("hi")))
        bins = inside.groupBy("lang", "k", place.alias("place")).agg(F.count(F.lit(1)), F.min("h"), F.max("h"))
        counted = defaultdict(list)
        for lang, k, *found in sorted(bins.collect()):
            counted[lang, k].append(found)
        for (lang, k), found in counted.items():
            before = bounds[lang, k][0]
            for _, n, lo, hi in found:
                if k < before + n:
                    bounds[lang, k] = before, lo, hi
                    break
                before += n
    return {lang: (bounds[lang, (n - 1) // 2][1] + bounds[lang, n // 2][1]) / 2 for lang, n, _, _ in ends}


def calibrate(own: DataFrame, languages: list[str]) -> Calibration:
    """The calibration by all rows of ``own`` (lang, h, loss)."""
    rows = materialize(own, "calibration")
    loss = rows.agg(*[F.sum(F.get("loss", F.lit(i))) for i in range(len(TEMPERATURES))]).first()
    temperature = TEMPERATURES[int(np.argmin(loss))]
    middle = medians(rows.select("lang", "h"))
    known = F.broadcast(own.sparkSession.createDataFrame(list(middle.items()), "lang string, middle double"))
    off = medians(rows.join(known, "lang").select("lang", F.abs(F.col("h") - F.col("middle")).alias("h")))
    release(rows)
    deviation = [1.4826 * off[x] + 1e-3 for x in languages]
    return Calibration(np.array([middle[x] for x in languages]), np.array(deviation), temperature)


def _owned(languages: list[str], found: Iterable[tuple[str, np.ndarray]]) -> pa.RecordBatch:
    """``_OWN`` of (language, cross-entropies under all languages)."""
    at = {x: i for i, x in enumerate(languages)}
    langs, own, losses = [], [], []
    for lang, h in found:
        z = (h.min() - h) / np.array(TEMPERATURES)[:, None]
        langs.append(lang)
        own.append(float(h[at[lang]]))
        losses.append(np.log(np.exp(z).sum(axis=1)) - z[:, at[lang]])
    kinds = [pa.string(), pa.float64(), pa.list_(pa.float64())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((langs, own, losses), kinds, strict=True)], ["lang", "h", "loss"])


def _own_by_arrays(shared: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            texts = ((x, folded(t.as_py())) for x, t in zip(batch.column("lang").to_pylist(), utf8(batch.column("text")), strict=True))
            yield _owned(models.languages, ((x, models.entropies(units)) for x, units in texts if (units != SPACE).any()))

    return run


def _own_by_tables(languages: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = zip(batch.column("lang").to_pylist(), map(np.array, batch.column("entropies").to_pylist()), strict=True)
            yield _owned(languages, found)

    return run


def _scorer(shared, text_at: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, calibration = shared.value
        for batch in batches:
            langs, scores, rejected = [], [], []
            for text in utf8(batch.column(text_at)):
                units = folded(text.as_py())
                if models is None or not (units != SPACE).any():
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                best, score, out = calibration.verdict(models.entropies(units), len(units))
                langs.append(models.languages[best])
                scores.append(score)
                rejected.append(out)
            said = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *said], [*batch.schema.names, "lang_pred", "score", "rejected"])

    return run


class ArrayModel(NamedTuple):
    """A model that every worker holds."""

    models: Broadcast
    calibration: Calibration | None

    @property
    def value(self) -> tuple[LanguageModels | None, Calibration | None]:
        return self.models.value, self.calibration


class TableModel(NamedTuple):
    """A model that is applied by joins."""

    tables: Tables
    calibration: Calibration


def fit(labelled: DataFrame) -> ArrayModel | TableModel:
    """What is learnt from ``labelled`` (text, lang): models in arrays that are
    broadcast, or in tables where they would be too large, calibrated on every
    row that has a label."""
    spark = labelled.sparkSession
    counts = count_grams(labelled)
    size = counts.count()
    named = labelled.filter(F.col("lang").isNotNull()).select("lang", "text")
    if size > MODEL_GRAMS:
        tables = estimate(counts)
        mark = scratch_mark()
        rows = materialize(named.withColumn("row_id", F.monotonically_increasing_id()), "calibration-rows")
        found = entropies(tables, rows.select("row_id", F.encode("text", "UTF-8").alias("text"))).join(rows.select("row_id", "lang"), "row_id")
        calibration = calibrate(found.select("lang", "entropies").mapInArrow(_own_by_tables(tables.languages), _OWN), tables.languages)
        release_since(spark, mark)
        return TableModel(tables, calibration)
    models = spark.sparkContext.broadcast(sorted_arrays(counts) if size else None)
    release(counts)
    if not size:
        return ArrayModel(models, None)
    return ArrayModel(models, calibrate(named.mapInArrow(_own_by_arrays(models), _OWN), models.value.languages))


def _judge(model: TableModel) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = zip(batch.column("entropies").to_pylist(), batch.column("units").to_pylist(), strict=True)
            said = [calibration.verdict(np.array(h), n) for h, n in found]
            langs = [languages[best] for best, _, _ in said]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), pa.array(langs, pa.string()), pa.array([x[1] for x in said], pa.float64()), pa.array([x[2] for x in said], pa.bool_())],
                ["_row", "lang_pred", "score", "rejected"],
            )

    languages, calibration = model.tables.languages, model.calibration
    return run


def _identify_by_joins(docs: DataFrame, model: TableModel) -> DataFrame:
    rows = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "identify-rows")
    text = F.encode(F.coalesce(rows[docs.columns.index("text")], F.lit("")), "UTF-8")
    found = entropies(model.tables, rows.select(F.col("_row").alias("row_id"), text.alias("text")))
    said = found.mapInArrow(_judge(model), "_row long, lang_pred string, score double, rejected boolean")
    out = rows.join(said, "_row", "left")
    return out.select(
        *[rows[c] for c in docs.columns], F.coalesce("lang_pred", F.lit(UNKNOWN)).alias("lang_pred"),
        F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("rejected", F.lit(True)).alias("rejected"),
    )


def identify(docs: DataFrame, model) -> DataFrame:
    """``docs`` with lang_pred, score and rejected; only the column ``text`` is looked at."""
    if isinstance(model, TableModel):
        return _identify_by_joins(docs, model)
    small_batches(docs.sparkSession)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    said = ["lang_pred string", "score double", "rejected boolean"]
    return docs.mapInArrow(_scorer(model, docs.columns.index("text")), ", ".join([*kinds, *said]))


def held_out(doc_id: str = "doc_id") -> Column:
    """The quarter of ids that never train ``op5_language_id``'s models."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows whose language is identified, with all their columns.  Every
    labelled row is learnt from: no quarter is held out, as nothing is tested."""
    model = fit(docs.select("text", "lang"))
    rows = plain(docs, "text")
    kept = identify(rows, model).filter(~F.col("rejected")).select(*rows.columns)
    return kept.toDF(*docs.columns)
