"""Language identification by character language models.

One interpolated Kneser-Ney model per language of the training rows (see
``charlm``).  A text gets the language whose model has the lowest cross-entropy
per sign over its letters.  Rejection is calibrated on the training rows: a text
is refused when its best cross-entropy lies above what texts of that language
reach there.

Special rows.  A text that is NULL or has no letter gets ``und``, score 0 and is
rejected; it never trains.  Training rows without a language are left out.
Without training rows every text is ``und``.  Marks without a letter are no word.
There may be any number of languages.  Repeated rows are judged alike,
each on its own; columns of the input other than the named ones play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.charlm import CharModel, fit, lengths, letters, signs_of
from pairloom.llm.common import Words, kept_with, quantiles, release, schema, slices, staged_batches

UND = "und"
#: A text is rejected this many nats per sign above the training texts' 99th percentile.
MARGIN = 1.0
#: Signs after which more text makes a verdict no surer.
SURE_AFTER = 40

_SCORED = "lang_pred string, score double, cross_entropy double, n_signs long"


def train(rows: DataFrame, text: str = "text", lang: str = "lang") -> CharModel | None:
    """Models of all ``rows`` with a language and a text; None if there are none."""
    known = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    return fit(known.select(F.col(lang).alias("grp"), F.col(text).alias("text")), letters, modified=False)


def predict(docs: DataFrame, model: CharModel | None, keep: list[Column], text: str = "text") -> DataFrame:
    """``keep`` columns of every row, with language, score, cross-entropy and number of signs.

    The score is the share of the chosen language when exp(-cross-entropy), to
    the power of the number of signs (SURE_AFTER at most), is compared over all
    languages.
    """
    rows, kept, text = kept_with(docs, keep, text)
    if model is None:
        return rows.select(
            *kept, F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"),
            F.lit(None).cast("double").alias("cross_entropy"), F.lit(0).cast("long").alias("n_signs"),
        )
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a row per language; the arrays are in files

    def judge(batches):
        for batch in slices(batches, text):
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + _judged(shared.value, batch.column(text)), names=kept + _NAMES
            )
            release()

    return rows.mapInArrow(judge, schema(rows, kept, _SCORED))


_NAMES = ["lang_pred", "score", "cross_entropy", "n_signs"]


def _judged(model: CharModel, texts: pa.Array) -> list[pa.Array]:
    words = Words(texts)
    signs = signs_of(letters(words.distinct))
    total = words.sums(lengths(signs))
    least, best, weight = np.full(len(texts), 1e300), np.zeros(len(texts), np.int64), np.zeros(len(texts))
    for g in range(len(model.groups)):
        cross = -words.sums(model.log_p(signs, g)) / np.maximum(total, 1)
        # the sum of exp(-gap) over the languages so far, gaps being counted from the lowest
        moved = np.minimum(total, SURE_AFTER) * (least - cross)
        lower = cross < least
        weight = np.where(lower, weight * np.exp(-np.maximum(moved, 0)) + 1, weight + np.exp(np.minimum(moved, 0)))
        best, least = np.where(lower, g, best), np.minimum(least, cross)
    none = total == 0
    names = np.array([*model.groups, UND], dtype=object)
    return [
        pa.array(names[np.where(none, len(model.groups), best)], pa.string()),
        pa.array(np.where(none, 0.0, 1.0 / np.maximum(weight, 1.0))),
        pa.array(least, mask=none),
        pa.array(total.astype(np.int64)),
    ]


def identify(docs: DataFrame, trains: Column, keep: list[Column], text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the rows where ``trains`` holds, judge all rows, and calibrate the rejection.

    Adds ``rejected`` to what ``predict`` returns: no language, or a cross-entropy
    more than MARGIN above the 99th percentile that training texts of the chosen
    language have under it.
    """
    trains = F.coalesce(trains, F.lit(False))
    model = train(docs.where(trains), text, lang)
    fits = (trains & F.col(lang).isNotNull()).alias("__trains")
    judged = staged_batches(predict(docs, model, [*keep, fits], text))
    known = judged.where("__trains AND cross_entropy IS NOT NULL")
    limits = quantiles(known, "lang_pred", "cross_entropy", [0.99], 0.001, "__q").select("lang_pred", (F.col("__q")[0] + MARGIN).alias("__limit"))
    rejected = (F.col("lang_pred") == UND) | F.coalesce(F.col("cross_entropy") > F.col("__limit"), F.lit(False))
    # a row per language of the model
    out = judged.join(F.broadcast(limits), "lang_pred", "left").withColumn("rejected", rejected)
    return out.select(*[c for c in judged.columns if c != "__trains"], "rejected")
