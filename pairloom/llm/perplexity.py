"""Quality rules: text statistics and n-gram perplexity bands per language.

The language models are modified Kneser-Ney models of characters, counted over
all texts (see ``charlm``), two per value of the language column: texts are dealt
to halves by a hash, so that copies stay together, and each half is judged by the
model of the other one.  Only where the other half has no word of a language does
a text meet its own half's model.

A text has two cross-entropies: per word, which is high for rare words (words
drawn at random from a vocabulary, another language's words) and low for a few
frequent ones, and per sign, which tells noise whatever its words' lengths.  Each
has a band per language, set from all texts that pass the base rules: the median,
and on either side DISTANCES times the distance to a quartile, so texts that do
not belong move it little, as long as they are fewer than a quarter.  Means over
few words scatter more, so a band is as much wider as the root of a text's number
of words (SURE_WORDS at most) is smaller.  A side whose quartile is the median
takes the other side's distance; a language without any spread (one text, or
copies) has the fixed widths WIDTH_FLOORS.

Special rows.  A NULL text has no word, so it fails the base rule and is not
kept.  A NULL language is a language of its own, apart from ''.  There may be any
number of languages.  Repeated rows get the same verdict, each on its own; other
columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.charlm import CharModel, fit, lengths, plain, signs_of
from pairloom.llm.common import Words, kept_with, quantiles, release, schema, slices, staged_batches

#: Characters that count as symbols (fixed values).
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Distances from the median to a quartile that make half of each band; the one per sign need only tell noise.
DISTANCES = {"per_word": 8.0, "per_sign": 12.0}
#: Words after which a mean is as sure as it gets.
SURE_WORDS = 400
#: Half-width of the bands of a language without any spread, in nats.
WIDTH_FLOORS = {"per_word": 2.0, "per_sign": 0.5}
#: Steps in which medians and scaled distances are counted.
_STEP, _SCALED_STEP = 0.001, 0.01

_STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "per_word", "per_sign"]
_WHITE = b" \t\n\v\f\r"


def repeat_words(codes: np.ndarray) -> int:
    """Words inside a window of three that occurs at least twice; ``codes`` name the words."""
    if len(codes) < 4:
        return 0
    # two words to one number, then three: windows are equal when their numbers are
    key = codes[:-2].astype(np.int64) << 32 | codes[1:-1]
    _, key = np.unique(key, return_inverse=True)
    key = key << 32 | codes[2:]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(len(codes), bool)
    for shift in range(3):
        inside[shift : shift + len(key)] |= twice
    return int(inside.sum())


def dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if text.count(b"\n") == 0:
        return 0
    seen, found = set(), 0
    for line in text.split(b"\n"):
        if line.strip(_WHITE):
            found += line in seen
            seen.add(line)
    return found


def _stats(texts: pa.Array, words: Words) -> list[np.ndarray]:
    raw = pc.fill_null(texts, "").cast(pa.binary()).to_pylist()
    lengths = pc.utf8_length(words.distinct).to_numpy(zero_copy_only=False).astype(np.int64)
    at = words.offsets
    return [
        np.diff(at),
        words.sums(lengths),
        np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in raw], np.int64),
        np.array([dup_lines(t) for t in raw], np.int64),
        np.array([repeat_words(words.codes[a:b]) for a, b in zip(at[:-1], at[1:])], np.int64),
    ]


def _name(lang: str) -> Column:
    """The language as a name that is never NULL."""
    return F.when(F.col(lang).isNull(), "none").otherwise(F.concat(F.lit("="), lang))


def _half(text: str) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), F.lit(2)).cast("int")


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> CharModel | None:
    """The models of all texts, two per language; None without any word."""
    grp = F.concat(_half(text).cast("string"), _name(lang)).alias("grp")
    return fit(docs.select(grp, F.col(text).alias("text")), plain, modified=True)


def measure(docs: DataFrame, model: CharModel | None, keep: list[Column], text: str = "text", lang: str = "lang") -> DataFrame:
    """``keep`` columns with the statistics, ``per_word`` and ``per_sign`` (NULL without a word)."""
    rows, kept, text = kept_with(docs, [*keep, _name(lang).alias("__lang"), _half(text).alias("__half")], text)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a row per language and half; the arrays are in files

    def run(batches):
        for batch in slices(batches, text):
            texts, words = batch.column(text), Words(batch.column(text))
            cross = _cross_entropies(shared.value, words, batch.column("__lang"), batch.column("__half"))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *map(pa.array, _stats(texts, words)), *cross], names=[*kept, *_NAMES]
            )
            del texts, words, cross
            release()

    return rows.mapInArrow(run, schema(rows, kept, f"{_STATS}, per_word double, per_sign double"))


def _cross_entropies(model: CharModel | None, words: Words, langs: pa.Array, halves: pa.Array) -> list[pa.Array]:
    if model is None:
        return [pa.nulls(len(langs), pa.float64())] * 2
    number = {g: i for i, g in enumerate(model.groups)}
    judge = np.array(
        [number.get(f"{1 - h}{x}", number.get(f"{h}{x}", -1)) for x, h in zip(langs.to_pylist(), halves.to_pylist())], np.int64
    )
    n_words = np.diff(words.offsets)
    of_word, forms = np.repeat(judge, n_words), plain(words.distinct)
    cost, signs = np.zeros(len(judge)), np.zeros(len(judge), np.int64)
    for g in np.unique(judge[judge >= 0]).tolist():
        # the different words of the texts that this model judges
        met = np.unique(words.codes[of_word == g])
        runs = signs_of(forms.take(pa.array(met)))
        log_p, length = np.zeros(len(forms)), np.zeros(len(forms), np.int64)
        log_p[met], length[met] = model.log_p(runs, g), lengths(runs)
        mine = judge == g
        cost[mine], signs[mine] = -words.sums(log_p)[mine], words.sums(length)[mine]
    none = (signs == 0) | (judge < 0)
    return [pa.array(cost / np.maximum(n, 1), mask=none) for n in (n_words, signs)]


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _scale() -> Column:
    return F.sqrt(F.least(F.greatest(F.col("n_words"), F.lit(1)), F.lit(SURE_WORDS)))


def bands(measured: DataFrame, column: str) -> DataFrame:
    """(__lang, middle, below, above): the band of each language, from texts that pass the base rules.

    ``below`` and ``above`` are half-widths times the root of the number of words.
    """
    sure = measured.where(~F.col("base_failed") & F.col(column).isNotNull())
    middles = quantiles(sure, "__lang", column, [0.5], _STEP, "q").select("__lang", F.col("q")[0].alias("middle"))
    # a row per language
    scaled = sure.join(F.broadcast(middles), "__lang").withColumn("scaled", (F.col(column) - F.col("middle")) * _scale())
    q = F.col("q")
    found = quantiles(scaled, "__lang", "scaled", [0.25, 0.5, 0.75], _SCALED_STEP, "q").join(middles, "__lang")
    below, above = (F.when(q[k + 1] > q[k], DISTANCES[column] * (q[k + 1] - q[k])) for k in (0, 1))
    floor = F.lit(WIDTH_FLOORS[column] * SURE_WORDS**0.5)
    return found.select("__lang", "middle", F.coalesce(below, above, floor).alias("below"), F.coalesce(above, below, floor).alias("above"))


def judge(docs: DataFrame, keep: list[Column], text: str = "text", lang: str = "lang") -> DataFrame:
    """``keep`` columns, the statistics, ``perplexity`` (per word), ``sign_perplexity``, ``base_failed``,
    ``band_failed``, ``kept``, and the band of the cross-entropy per word as ``lower`` and ``upper``."""
    measured = staged_batches(measure(docs, train(docs, text, lang), keep, text, lang).withColumn("base_failed", base_failed()))
    banded, inside, ends = measured, F.lit(True), {}
    for column in WIDTH_FLOORS:
        own = bands(measured, column).select("__lang", *[F.col(c).alias(f"__{column}_{c}") for c in ("middle", "below", "above")])
        banded = banded.join(F.broadcast(own), "__lang", "left")  # a row per language
        middle, below, above = (F.col(f"__{column}_{c}") for c in ("middle", "below", "above"))
        ends[column] = (middle - below / _scale(), middle + above / _scale())
        inside = inside & F.coalesce(F.col(column).between(*ends[column]), F.lit(False))
    return banded.select(
        *measured.columns[: measured.columns.index("__lang")], *_NAMES[:-2], "base_failed",
        (~F.col("base_failed") & ~inside).alias("band_failed"), (~F.col("base_failed") & inside).alias("kept"),
        F.exp("per_word").alias("perplexity"), F.exp("per_sign").alias("sign_perplexity"),
        ends["per_word"][0].alias("lower"), ends["per_word"][1].alias("upper"),
    )
