"""Kneser-Ney models as tables: estimated and applied by joins.

The same interpolated model as ``char_lm.KneserNey``, for counts that no driver
or worker should hold.  Per order n a table of n-grams (lang, gram, logp) and
one of contexts (lang, context, backoff), built from order 1 up: a gram's
probability joins its context's figures and the probability of its suffix one
order down, which is always there, because lower orders count the suffixes of
higher ones.  Applying the model asks the tables for the distinct grams of the
texts only: a gram found has its probability, any other its suffix's plus the
backoff of its context.  Discounts, a number a language and order, are all that
comes together.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.llm.char_lm import ALPHABET, ORDER, SPACE, folded, packed, padded
from eventlens.llm.common import join_skewed
from eventlens.session import materialize, release


class Tables(NamedTuple):
    """A model: its languages, and n-grams and contexts of every order."""

    languages: list[str]
    grams: list[DataFrame]
    contexts: list[DataFrame]


def _suffix(n: int, gram: str = "gram") -> Column:
    """The last n units of a packed n-gram."""
    return F.col(gram).bitwiseAND(F.lit((1 << 16 * n) - 1).cast("long"))


def _context(gram: str = "gram") -> Column:
    return F.shiftrightunsigned(F.col(gram), 16)


def estimate(counts: DataFrame) -> Tables:
    """Tables from ``counts`` (lang, gram, n) of ORDER-grams."""
    by_order = {ORDER: counts.select("lang", "gram", F.col("n").cast("double").alias("c"))}
    for n in range(ORDER - 1, 0, -1):
        shorter = by_order[n + 1].groupBy("lang", _suffix(n).alias("gram")).agg(F.count(F.lit(1)).cast("double").alias("c"))
        by_order[n] = materialize(shorter, f"grams-{n}")
    languages = sorted(r["lang"] for r in by_order[1].select("lang").distinct().collect())
    grams, contexts = [], []
    for n in range(1, ORDER + 1):
        once, twice = F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)
        discount = F.when((once > 0) & (twice > 0), once / (once + 2 * twice)).otherwise(0.5)
        # one row a language
        discounts = F.broadcast(materialize(by_order[n].groupBy("lang").agg(discount.alias("d")), "discounts"))
        heads = by_order[n].groupBy("lang", _context().alias("context")).agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds"))
        heads = heads.join(discounts, "lang").withColumn("backoff", F.col("d") * F.col("kinds") / F.col("total"))
        heads = materialize(heads, f"contexts-{n}")
        rows = by_order[n].withColumn("context", _context()).join(heads, ["lang", "context"])
        if n == 1:
            rows = rows.withColumn("below", F.lit(1 / ALPHABET))
        else:
            below = grams[-1].select("lang", F.col("gram").alias("suffix"), F.pow(F.lit(2.0), "logp").alias("below"))
            rows = rows.withColumn("suffix", _suffix(n - 1)).join(below, ["lang", "suffix"])
        p = (F.col("c") - F.col("d")) / F.col("total") + F.col("backoff") * F.col("below")
        grams.append(materialize(rows.select("lang", "gram", F.log2(p).alias("logp")), f"model-{n}"))
        contexts.append(heads.select("lang", "context", F.log2("backoff").alias("backoff")))
    release(*[by_order[n] for n in range(1, ORDER)])
    return Tables(languages, grams, contexts)


def scores(model: Tables, wanted: DataFrame) -> DataFrame:
    """(gram, scores): log2 P of every ORDER-gram of ``wanted`` (gram, distinct)
    under every language, in the order of ``model.languages``."""
    needed = {ORDER: wanted.select("gram")}
    for n in range(ORDER - 1, 0, -1):
        needed[n] = materialize(needed[n + 1].select(_suffix(n).alias("gram")).distinct(), "grams-wanted")
    every = F.explode(F.array(*[F.lit(x) for x in model.languages])).alias("lang")
    below = None
    for n in range(1, ORDER + 1):
        rows = needed[n].select("gram", every).join(model.grams[n - 1], ["lang", "gram"], "left")
        known, rest = rows.filter(F.col("logp").isNotNull()), rows.filter(F.col("logp").isNull()).drop("logp")
        rest = rest.withColumn("context", _context()).join(model.contexts[n - 1], ["lang", "context"], "left")
        if below is None:
            shorter = F.lit(-float(np.log2(ALPHABET)))
        else:
            rest = rest.withColumn("suffix", _suffix(n - 1)).join(below, ["lang", "suffix"])
            shorter = F.col("shorter")
        backed = rest.select("lang", "gram", (shorter + F.coalesce("backoff", F.lit(0.0))).alias("logp"))
        found = materialize(known.select("lang", "gram", "logp").unionByName(backed), "grams-scored")
        below = found.select("lang", F.col("gram").alias("suffix"), F.col("logp").alias("shorter"))
    # what the sorted arrays keep of a gram seen in training is single precision
    seen = model.grams[-1].select("gram").distinct().withColumn("seen", F.lit(True))
    rounded = found.join(seen, "gram", "left").withColumn("logp", F.when(F.col("seen"), F.col("logp").cast("float").cast("double")).otherwise(F.col("logp")))
    together = F.array_sort(F.collect_list(F.struct("lang", "logp")))
    return rounded.groupBy("gram").agg(F.transform(together, lambda x: x["logp"]).alias("scores"))


def _text_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row_id, units, grams): a text's folded length and its distinct grams
    with their counts; none for texts without letters."""
    for batch in batches:
        ids, sizes, found = [], [], []
        for row, text in zip(batch.column("row_id").to_pylist(), batch.column("text"), strict=True):
            units = folded(text.as_py())
            if (units != SPACE).any():
                keys, counts = np.unique(packed(padded(units), ORDER), return_counts=True)
                ids.append(row)
                sizes.append(len(units))
                found.append([{"gram": k, "n": c} for k, c in zip(keys.view(np.int64).tolist(), counts.tolist(), strict=True)])
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("gram", pa.int64()), ("n", pa.int64())]))]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((ids, sizes, found), kinds, strict=True)], ["row_id", "units", "grams"])


def entropies(model: Tables, texts: DataFrame) -> DataFrame:
    """(row_id, units, entropies) of ``texts`` (row_id, text in UTF-8) that have letters:
    cross-entropy in bits per unit under every language."""
    grams = materialize(texts.mapInArrow(_text_grams, "row_id long, units long, grams array<struct<gram: long, n: long>>"), "text-grams")
    each = grams.select("row_id", "units", F.inline("grams"))
    wanted = materialize(each.groupBy("gram").agg(F.count(F.lit(1)).alias("rows")), "grams-wanted")
    scored = materialize(scores(model, wanted).join(wanted, "gram"), "gram-scores")
    met = join_skewed(each, scored, ["gram"], "rows")
    sums = [F.sum(F.col("n") * F.get("scores", F.lit(i))).alias(f"s{i}") for i in range(len(model.languages))]
    total = met.groupBy("row_id", "units").agg(F.sum("n").alias("grams"), *sums)
    return total.select("row_id", "units", F.array(*[-F.col(f"s{i}") / F.col("grams") for i in range(len(model.languages))]).alias("entropies"))
