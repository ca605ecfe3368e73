"""Character language models with Kneser-Ney smoothing, one per group of texts.

A word is scored by itself: its signs (characters, then an end sign), each after
the four signs before it, with four start signs in front of the word.  Spark
counts the five-sign runs of all texts; a shorter run counts the different signs
before it (continuation counts), runs that begin with start signs included.  Then

    p_n(w | c) = (N(c w) - D(N(c w))) / N(c) + rest(c) p_{n-1}(w | c without its first sign)

for n = 5 .. 1, where N(c) sums over the signs after c, rest(c) is the discounts
of those runs over N(c), and p_0 is 1 / V, V being the different signs of all
groups and one more for a sign that no group has.  Counts, discounts, contexts
and probabilities are group-bys, windows and joins; a context is keyed by its own
signs, so contexts of start signs are contexts like any other.

A model is sorted hash arrays: each run with log p, each context with log rest,
under its whole key (a 64-bit mix of the key and the part of the key from which
the rest can be told), so different runs never share an entry.  Each group has
arrays of its own, cut by the leading bits of the mix into parts of PART_ROWS
entries on average and written by Spark to the shared folder.  Nothing but a row
per group comes to the driver, and the number of runs and groups has no limit: a
task keeps CACHE_BYTES of parts and reads others as it needs them.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import Words, mix64, release, slices, staged_batches
from pairloom.session import scratch_path, staged

ORDER = 5
#: Entries of a part, on average (20 bytes each).
PART_ROWS = 1 << 20
#: Bytes of parts that a Python worker keeps.
CACHE_BYTES = 192 << 20
#: Least discount, so that every context leaves some weight to shorter ones.
LEAST_DISCOUNT = 0.1

#: Words that are scored at once.
_WORDS = 1 << 15

_SIGN = 21  # bits of a sign: a code point, 0 before the word, 1 after it
_ONE, _TWO = (1 << _SIGN) - 1, (1 << 2 * _SIGN) - 1
_CONTEXT = 8  # added to a context's number of signs in its key
_TURN = np.uint64(0x9E3779B97F4A7C15)


def _key(kind: int, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the rest of the key of runs of one kind; together they tell ``hi`` and ``lo``."""
    rest = (hi.astype(np.uint64) << np.uint64(4)) | np.uint64(kind)
    return mix64(lo.astype(np.uint64)) ^ mix64(rest + _TURN), rest


def _runs(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Five-sign runs that end at each sign of each word (the end sign too).

    Returns the first two and the last three signs packed in integers, and each
    word's number of signs.
    """
    counts = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    text = "\x01".join(words.to_pylist()) + "\x01" if len(words) else ""
    signs = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.int64)
    at = np.arange(len(signs)) - np.repeat(np.cumsum(counts) - counts, counts)

    def back(d: int) -> np.ndarray:
        """The sign ``d`` places before, 0 before the word."""
        moved = np.zeros_like(signs)
        moved[d:] = signs[: max(len(signs) - d, 0)]
        moved[at < d] = 0
        return moved

    return (back(4) << _SIGN) | back(3), (back(2) << 2 * _SIGN) | (back(1) << _SIGN) | signs, counts


def _counted(words: Words, groups: list, tokens) -> Iterator[pa.RecordBatch]:
    """Counts of five-sign runs of a batch, per group of its texts."""
    distinct = tokens(words.distinct)
    text_group = pa.array(groups, pa.string()).dictionary_encode()
    names = text_group.dictionary.to_pylist()
    of_word = np.repeat(text_group.indices.to_numpy(zero_copy_only=False), np.diff(words.offsets))
    per_word = [np.bincount(words.codes[of_word == g], minlength=len(distinct)) for g in range(len(names))]
    blocks = []
    for at in range(0, len(distinct), _WORDS):
        hi, lo, counts = _runs(distinct.slice(at, _WORDS))
        empty = counts == 1  # nothing but the end sign
        times = [np.repeat(np.where(empty, 0, n[at : at + _WORDS]), counts) for n in per_word]
        blocks.append(_summed(hi, lo, times))
    if not blocks:
        return
    hi, lo, *totals = (np.concatenate(c) for c in zip(*blocks))
    hi, lo, *totals = _summed(hi, lo, totals)
    for name, total in zip(names, totals):
        seen = np.flatnonzero(total)
        columns = [pa.array([name] * len(seen), pa.string()), hi[seen], lo[seen], total[seen]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["grp", "hi", "lo", "c"])


def _distinct(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the different runs, and for each run the place of its like among those."""
    codes, names = pd.factorize(_key(ORDER, hi, lo)[0])
    first = np.empty(len(names), np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    if (hi[first][codes] != hi).any():  # two runs of one hash
        _, first, codes = np.unique(np.stack([hi, lo], axis=1), axis=0, return_index=True, return_inverse=True)
    return first, codes.ravel()


def _summed(hi: np.ndarray, lo: np.ndarray, times: list[np.ndarray]) -> list[np.ndarray]:
    """Each different run once, with the sums of its counts."""
    first, same = _distinct(hi, lo)
    return [hi[first], lo[first], *(np.bincount(same, weights=n, minlength=len(first)).astype(np.int64) for n in times)]


def plain(words: pa.Array) -> pa.Array:
    """Words as they are, in lower case."""
    return pc.utf8_lower(words)


def letters(words: pa.Array) -> pa.Array:
    """Only the letters of words and the marks on them, in lower case; words without a letter are empty."""
    found = pc.replace_substring_regex(pc.utf8_lower(words), r"[^\p{L}\p{M}]+", "")
    return pc.if_else(pc.match_substring_regex(found, r"\p{L}"), found, "")


# --- scoring -----------------------------------------------------------------


class _Part:
    """Entries in order of their hash."""

    def __init__(self, row: dict):
        self.hash, self.rest = np.frombuffer(row["hash"], np.uint64), np.frombuffer(row["rest"], np.uint64)
        self.value = np.frombuffer(row["value"], np.float32)
        self.nbytes = self.hash.nbytes + self.rest.nbytes + self.value.nbytes

    def find(self, hashes: np.ndarray, rests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of each key, and whether there is one."""
        row = np.searchsorted(self.hash, hashes)
        top = len(self.hash) - 1
        row = np.minimum(row, top)
        same = self.hash[row] == hashes
        found = same & (self.rest[row] == rests)
        left = np.flatnonzero(same & ~found)
        while len(left):  # keys of one hash stand next to each other
            row[left] = np.minimum(row[left] + 1, top)
            same = self.hash[row[left]] == hashes[left]
            found[left] = same & (self.rest[row[left]] == rests[left])
            left = left[same & ~found[left] & (row[left] < top)]
        return row, found


#: Parts that this Python worker has read.
_loaded: OrderedDict[tuple, _Part | None] = OrderedDict()


def _load(folder: str, group: int, part: int) -> _Part | None:
    key = (folder, group, part)
    if key in _loaded:
        _loaded.move_to_end(key)
        return _loaded[key]
    files, base = fs.FileSystem.from_uri(folder)
    found = files.get_file_info(fs.FileSelector(f"{base}/grp={group}/part={part}", allow_not_found=True))
    tables = [pq.ParquetFile(files.open_input_file(f.path)).read() for f in found if f.path.endswith(".parquet")]
    # a worker outlives models: those of another folder are not asked again
    for old in [k for k in _loaded if k[0] != folder]:
        del _loaded[old]
    # the arrays stay where Arrow read them
    _loaded[key] = _Part({c: tables[0].column(c)[0].as_buffer() for c in ("hash", "rest", "value")}) if tables else None
    release()
    while len(_loaded) > 1 and sum(p.nbytes for p in _loaded.values() if p) > CACHE_BYTES:
        _loaded.popitem(last=False)
    return _loaded[key]


class Signs:
    """The different runs of some words, and where each word has which."""

    def __init__(self, words: pa.Array):
        hi, lo, counts = _runs(words)
        first, self.codes = _distinct(hi, lo)
        self.hi, self.lo = hi[first], lo[first]
        self.starts = np.cumsum(counts) - counts
        self.counts = np.where(counts == 1, 0, counts)  # no sign but the end: not a word

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum over the runs of each word."""
        if not len(self.starts):
            return np.zeros(0)
        return np.where(self.counts == 0, 0.0, np.add.reduceat(values[self.codes], self.starts))


def signs_of(words: pa.Array) -> list[Signs]:
    return [Signs(words.slice(at, _WORDS)) for at in range(0, len(words), _WORDS)]


def lengths(signs: list[Signs]) -> np.ndarray:
    """Number of signs of each word, the end sign included; 0 for an empty word."""
    return np.concatenate([np.zeros(0, np.int64), *(s.counts for s in signs)])


@dataclass(frozen=True)
class CharModel:
    """Where the arrays of each group are; a row per group."""

    groups: list[str]
    folder: str
    bits: list[int]  # that name a part of each group
    log_unseen: list[float]  # a sign that no run of the group has

    def _find(self, group: int, kind: int, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value of each key, and whether there is one."""
        hashes, rests = _key(kind, hi, lo)
        out, found = np.zeros(len(hi), np.float32), np.zeros(len(hi), bool)
        bits = self.bits[group]
        if not bits:
            parts = [(0, slice(None))]
        else:
            number = (hashes >> np.uint64(64 - bits)).astype(np.int64)
            order = np.argsort(number, kind="stable")
            names, starts = np.unique(number[order], return_index=True)
            parts = zip(names.tolist(), np.split(order, starts[1:])) if len(names) else []
        for name, at in parts:
            part = _load(self.folder, group, name)
            if part is not None:
                row, found[at] = part.find(hashes[at], rests[at])
                out[at] = part.value[row]
        return out, found

    def log_p(self, signs: list[Signs], group: int) -> np.ndarray:
        """Log probability of each word in a group."""
        return np.concatenate([np.zeros(0), *(s.sums(self._log_p(s.hi, s.lo, group)) for s in signs)])

    def _log_p(self, hi: np.ndarray, lo: np.ndarray, group: int) -> np.ndarray:
        out, left = np.zeros(len(lo)), np.arange(len(lo))
        for n in range(ORDER, 0, -1):
            value, found = self._find(group, n, *_cut(n, hi[left], lo[left]))
            out[left[found]] += value[found]
            left = left[~found]
            if n > 1 and len(left):  # the weight that the context leaves for shorter runs
                value, found = self._find(group, _CONTEXT + n - 1, *_before(n, hi[left], lo[left]))
                out[left[found]] += value[found]
        out[left] += self.log_unseen[group]
        return out


def _cut(n, hi, lo):
    """The last ``n`` signs of a run."""
    if n == 5:
        return hi, lo
    if n == 4:
        return hi & _ONE, lo
    keep = {3: (1 << 3 * _SIGN) - 1, 2: _TWO, 1: _ONE}[n]
    return hi * 0, lo & keep


def _before(n, hi, lo):
    """The run of ``n`` signs that ends here, without its last one."""
    h, l = _cut(n, hi, lo)
    return h >> _SIGN, ((h & _ONE) << 2 * _SIGN) | (l >> _SIGN)


# --- fitting -----------------------------------------------------------------


def count_runs(texts: DataFrame, tokens) -> DataFrame:
    """(grp, hi, lo, c) of ``texts`` (grp, text): every five-sign run and its count."""

    def count(batches):
        for batch in slices(batches, "text"):
            yield from _counted(Words(batch.column("text")), batch.column("grp").to_pylist(), tokens)
            release()

    runs = texts.select("grp", "text").mapInArrow(count, "grp string, hi long, lo long, c long")
    return runs.groupBy("grp", "hi", "lo").agg(F.sum("c").alias("c"))


def discounts(kinds: list[int], modified: bool) -> list[float]:
    """Discounts for counts 1, 2 and 3 or more; ``kinds`` are the runs with counts 1, 2, 3 and 4.

    A number of runs that is none counts as one.
    """
    n1, n2, n3, n4 = (max(k, 1) for k in kinds)
    y = n1 / (n1 + 2.0 * n2)
    if not modified:
        return [max(y, LEAST_DISCOUNT)] * 3
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, LEAST_DISCOUNT), most) for d, most in zip(found, (1.0, 2.0, 3.0))]


def probabilities(texts: DataFrame, tokens, modified: bool) -> tuple[DataFrame, DataFrame, list, int]:
    """Runs (grp, n, hi, lo, p), contexts (grp, n, hi, lo, rest), a row (grp, name, runs, unseen) per group, and V.

    ``n`` is the number of signs; ``texts`` are (grp string not NULL, text).
    """
    spark = texts.sparkSession
    full = staged_batches(count_runs(texts, tokens))
    names = sorted(r.grp for r in full.select("grp").distinct().collect())
    if not names:
        return full, full, [], 1
    numbers = spark.createDataFrame(list(enumerate(names)), "g int, grp string")
    # a row per group
    level = full.join(F.broadcast(numbers), "grp").select(F.col("g").alias("grp"), "hi", "lo", "c")
    hi, lo = F.col("hi"), F.col("lo")
    runs = level.select("grp", F.lit(ORDER).alias("n"), "hi", "lo", "c")
    for n in range(ORDER - 1, 0, -1):
        h, l = _columns(n, hi, lo)
        level = level.groupBy("grp", h.alias("hi"), l.alias("lo")).agg(F.count("*").alias("c"))
        runs = runs.union(level.select("grp", F.lit(n).alias("n"), "hi", "lo", "c"))
    runs = staged(runs)
    tally = runs.groupBy("grp", "n").agg(F.count("*").alias("runs"), *[F.count_if(F.col("c") == k).alias(f"n{k}") for k in (1, 2, 3, 4)])
    tally = tally.collect()  # ORDER rows per group
    off = [(r.grp, r.n, *discounts([r.n1, r.n2, r.n3, r.n4], modified)) for r in tally]
    off = spark.createDataFrame(off, "grp int, n int, d1 double, d2 double, d3 double")
    taken = F.when(F.col("c") >= 3, F.col("d3")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d1"))
    before_hi = F.shiftright("hi", _SIGN)
    before_lo = F.shiftleft(hi.bitwiseAND(_ONE), 2 * _SIGN).bitwiseOR(F.shiftright("lo", _SIGN))
    context = Window.partitionBy("grp", "n", "before_hi", "before_lo")
    weighed = staged(
        runs.join(F.broadcast(off), ["grp", "n"])
        .withColumns({"taken": taken, "before_hi": before_hi, "before_lo": before_lo})
        .withColumns({"total": F.sum("c").over(context), "spare": F.sum("taken").over(context)})
        .select(
            "grp", "n", "hi", "lo", "before_hi", "before_lo", ((F.col("c") - F.col("taken")) / F.col("total")).alias("own"),
            (F.col("spare") / F.col("total")).alias("rest"),
        )
    )
    signs = runs.where("n = 1").select("lo").distinct().count() + 1
    level = weighed.where("n = 1").select("grp", "n", "hi", "lo", (F.col("own") + F.col("rest") / signs).alias("p"))
    every = level
    for n in range(2, ORDER + 1):
        h, l = _columns(n - 1, hi, lo)
        mine = weighed.where(F.col("n") == n).withColumns({"short_hi": h, "short_lo": l})
        shorter = level.select("grp", F.col("hi").alias("short_hi"), F.col("lo").alias("short_lo"), F.col("p").alias("short_p"))
        joined = mine.join(shorter, ["grp", "short_hi", "short_lo"])
        level = staged(joined.select("grp", "n", "hi", "lo", (F.col("own") + F.col("rest") * F.col("short_p")).alias("p")))
        every = every.union(level)
    contexts = weighed.where("n > 1").groupBy("grp", (F.col("n") - 1).alias("n"), F.col("before_hi").alias("hi"), F.col("before_lo").alias("lo"))
    contexts = contexts.agg(F.first("rest").alias("rest"))
    unseen = {r.grp: r.rest / signs for r in weighed.where("n = 1").groupBy("grp").agg(F.first("rest").alias("rest")).collect()}
    size = dict.fromkeys(range(len(names)), 0)
    for r in tally:
        size[r.grp] += r.runs
    return every, contexts, [(g, name, size[g], unseen[g]) for g, name in enumerate(names)], signs


def _columns(n: int, hi: Column, lo: Column) -> tuple[Column, Column]:
    if n == 4:
        return hi.bitwiseAND(_ONE), lo
    keep = {3: (1 << 3 * _SIGN) - 1, 2: _TWO, 1: _ONE}[n]
    return F.lit(0).cast("long"), lo.bitwiseAND(keep)


def fit(texts: DataFrame, tokens, modified: bool, part_rows: int = PART_ROWS) -> CharModel | None:
    """A model of ``texts`` (grp string not NULL, text string); None if they hold no word.

    Every text counts.
    """
    runs, contexts, groups, _ = probabilities(texts, tokens, modified)
    if not groups:
        return None
    # a context for each run at most
    bits = [(max(2 * size - 1, 0) // part_rows).bit_length() for _, _, size, _ in groups]
    kinds = runs.select("grp", F.col("n").alias("kind"), "hi", "lo", F.log("p").cast("float").alias("value")).union(
        contexts.select("grp", (F.col("n") + _CONTEXT).alias("kind"), "hi", "lo", F.log("rest").cast("float").alias("value"))
    )
    shifts = np.array([64 - b for b in bits], np.uint64)

    def keyed(batches):
        for batch in batches:
            col = {c: batch.column(c).to_numpy() for c in ("grp", "kind", "hi", "lo", "value")}
            hashes, rests = np.empty(batch.num_rows, np.uint64), np.empty(batch.num_rows, np.uint64)
            for kind in np.unique(col["kind"]).tolist():
                at = col["kind"] == kind
                hashes[at], rests[at] = _key(kind, col["hi"][at], col["lo"][at])
            shift = shifts[col["grp"]]
            part = np.where(shift == 64, np.uint64(0), hashes >> np.minimum(shift, np.uint64(63))).astype(np.int32)
            columns = [col["grp"], part, hashes.view(np.int64), rests.view(np.int64), col["value"]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["grp", "part", "hash", "rest", "value"])

    def pack(table: pa.Table) -> pa.Table:
        hashes, rests = (table.column(c).to_numpy().view(np.uint64) for c in ("hash", "rest"))
        order = np.argsort(hashes, kind="stable")
        arrays = {"hash": hashes[order], "rest": rests[order], "value": table.column("value").to_numpy()[order]}
        row = {"grp": table.column("grp")[0].as_py(), "part": table.column("part")[0].as_py()} | {c: a.tobytes() for c, a in arrays.items()}
        fields = [("grp", pa.int32()), ("part", pa.int32()), *((c, pa.binary()) for c in arrays)]
        return pa.Table.from_pylist([row], schema=pa.schema(fields))

    folder = scratch_path(texts.sparkSession, "model")
    entries = kinds.mapInArrow(keyed, "grp int, part int, hash long, rest long, value float")
    parts = entries.groupBy("grp", "part").applyInArrow(pack, "grp int, part int, hash binary, rest binary, value binary")
    parts.write.partitionBy("grp", "part").parquet(folder)
    return CharModel([name for _, name, _, _ in groups], folder, bits, [math.log(unseen) for _, _, _, unseen in groups])
