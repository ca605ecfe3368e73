"""Mixture-controlled packing of token sequences.

Every source is a queue of its documents' tokens, in the order of a hash key,
cut into units of UNIT tokens.  Deficit round-robin serves the queue that is
furthest behind its target share: unit j of a queue is due at (j + 1/2) divided
by its share, and units are served in the order of those times.  A window
(sequence) takes the next ``window / UNIT`` units, so it has the target shares
to within a unit, and what a window owes to a source comes in the next one.
Times spread evenly, so ranges of time are the partitions; each starts from the
number of units served before it, which carries the deficits across.  What is
left of each queue after its whole units (less than a unit) fills the last
windows.  Every window is full but the last.

Without given shares the target is each source's share of all tokens, and all
queues end together; with them, a queue that ends early leaves its turns to the
others.

Special rows.  A NULL text counts as empty: its only token is the end token.  A
NULL source is a queue of its own.  Repeated rows are packed one by one.  An
empty table gives no piece.  Columns besides the named ones are not looked at.
"""

from __future__ import annotations

import os
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import SLICE_BYTES, Words, hash_key, numbered, running_total, schema, slices, staged_batches
from pairloom.session import staged

WINDOW = 2048
#: Tokens of a unit; a power of two that divides the window.
UNIT = 256
END = 1
SEED = 42
#: Ranges of serving times.
_RANGES = 16384
#: Text bytes that are encoded at once: twice as many share more words.
_SLICE = 2 * SLICE_BYTES
#: Words whose ids a worker keeps for the next batch (a cache, not a limit): about 80 MB.
_KEPT = 1_000_000
#: Words that are encoded at once: the tokenizer's own objects are far larger than the ids.
_WORDS = 1 << 13
#: Plain words that are encoded as one text: a text costs the tokenizer as much as several words.
_JOINED = 256
#: Words of letters that no step of the tokenizer changes or parts.
_PLAIN = r"^[a-zß-öø-ÿ]+$"
#: How a token ends that ends a word (fixed value).
_END_OF_WORD = "</w>"
#: ASCII signs that the tokenizer always parts from letters (not the apostrophe).
_SIGNS = '.,;:!?$%&*#|()"'


class Encoder:
    """Token ids of texts by a tokenizer that drops white space and parts words there.

    A batch's distinct words are encoded once, and kept for later batches.
    Trailing signs are cut off first when the word is letters and such signs
    only: the tokenizer parts them as well, and fewer distinct words are left.
    """

    def __init__(self, path: str, end: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = end
        vocab = self.tokenizer.get_vocab()
        self.kind = np.uint16 if len(vocab) <= 1 << 16 else np.uint32
        self.ends = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith(_END_OF_WORD)]] = True
        self.words = pa.array([], pa.string())
        self.ids, self.bounds = np.zeros(0, self.kind), np.zeros(1, np.int64)

    def _stored(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A store of ids, its bounds, and the place of each of ``words`` (distinct) in it."""
        place = pc.index_in(words, self.words)
        fresh = words.filter(pc.is_null(place))
        plain = pc.match_substring_regex(fresh, _PLAIN)
        rank = np.argsort(~plain.to_numpy(zero_copy_only=False), kind="stable")
        fresh, n_plain = fresh.take(pa.array(rank)), pc.sum(plain).as_py() or 0
        found = [self._each(fresh.slice(n_plain)[at : at + _WORDS].to_pylist()) for at in range(0, len(fresh) - n_plain, _WORDS)]
        found = [self._joined(fresh.slice(at, min(_WORDS, n_plain - at)).to_pylist()) for at in range(0, n_plain, _WORDS)] + found
        ids = np.concatenate([self.ids, *(f[0] for f in found)])
        bounds = np.concatenate([self.bounds[:-1], np.cumsum(np.concatenate([self.bounds[-1:], *(f[1] for f in found)]))])
        at = pc.fill_null(place, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.empty(len(rank), np.int64)
        new[rank] = len(self.words) + np.arange(len(rank))
        at[at < 0] = new
        if len(self.words) + len(fresh) <= _KEPT:
            self.words, self.ids, self.bounds = pa.concat_arrays([self.words, fresh]), ids, bounds
        return ids, bounds, at

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and how many each has."""
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(lists), self.kind), np.fromiter(map(len, lists), np.int64, len(lists))

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for plain words, many in a text: a word's last token is the one that ends a word."""
        texts = [" ".join(words[i : i + _JOINED]) for i in range(0, len(words), _JOINED)]
        ids, _ = self._each(texts)
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(words) or last[-1] != len(ids) - 1:  # a tokenizer that marks no ends
            return self._each(words)
        return ids, np.diff(last, prepend=-1)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text's end token included, and the bounds of each text."""
        words = Words(texts)
        # in other cases than its own, the name of a special token is ordinary text
        low = pc.if_else(pc.match_substring(words.distinct, "<|"), words.distinct, pc.ascii_lower(words.distinct))
        parts = pc.match_substring_regex(low, r"^\p{L}+[" + "".join("\\" + c for c in _SIGNS) + "]+$")
        stem = pc.if_else(parts, pc.ascii_rtrim(low, characters=_SIGNS), low)
        tail = pc.if_else(parts, pc.replace_substring_regex(low, r"^\p{L}+", ""), "")
        coded = pa.concat_arrays([stem, tail]).dictionary_encode()
        ids, bounds, at = self._stored(coded.dictionary)
        # a batch of strings is below 2 GB, so 32 bits hold all places and sums
        at = at[coded.indices.to_numpy(zero_copy_only=False)].reshape(2, -1).astype(np.int32)
        # every word is a stem and a tail; every text has one more word, the end token
        ids = np.append(ids, self.kind(self.end))
        starts = np.append(bounds[:-1], len(ids) - 1).astype(np.int32)
        sizes = np.append(np.diff(bounds), 1).astype(np.int32)
        n = len(words.offsets) - 1
        runs = np.full((len(words.codes) + n, 2), at[1, 0] if at.size else 0, np.int32)
        last = words.offsets[1:] + np.arange(n)
        inner = np.ones(len(runs), bool)
        inner[last] = False
        runs[inner] = at.T[words.codes]
        runs[last, 0] = len(starts) - 1
        lengths = sizes[runs]
        lengths[last, 1] = 0
        runs, lengths = runs.ravel(), lengths.ravel()
        ends = np.cumsum(lengths, dtype=np.int32)
        index = np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)
        index += np.repeat(starts[runs] - (ends - lengths), lengths)
        return ids[index], np.append(0, ends[2 * last + 1]).astype(np.int64)


#: One encoder per tokenizer file and worker process, kept between tasks.
_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoded(docs: DataFrame, path: str, keep: list[Column], text: str = "text", end: int = END) -> DataFrame:
    """``keep`` columns, ``row_id``, ``ids`` (little-endian unsigned, 16 bits where they suffice) and ``doc_tokens``.

    Written to the shared folder: ids are needed when the pieces are known.
    """
    rows = docs.select(*keep, F.monotonically_increasing_id().alias("row_id"), F.col(text).alias("__text"))
    kept = rows.columns[:-1]

    def run(batches):
        encoder = _ENCODERS.get((path, end)) or _ENCODERS.setdefault((path, end), Encoder(path, end))
        for batch in slices(batches, "__text", _SLICE):
            ids, bounds = encoder(batch.column("__text"))
            raw = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds * ids.itemsize), pa.py_buffer(ids)]
            )
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), raw.cast(pa.binary()), pa.array(np.diff(bounds))],
                names=[*kept, "ids", "doc_tokens"],
            )

    return staged_batches(rows.mapInArrow(run, schema(rows, kept, "ids binary, doc_tokens long")), _SLICE)


def layout(rows: DataFrame, shares: dict[str | None, float] | None = None, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Pieces of ``rows`` (row_id, doc_id, source, doc_tokens): (row_id, start, length, sequence_id, offset).

    ``shares``: the target share of each source; a source it does not name keeps
    its share of the tokens, relative to the named ones' sum.
    """
    queues = staged(
        numbered(
            rows.groupBy("source").agg(F.sum("doc_tokens").alias("_tokens")),
            F.col("source").isNull(), F.col("source"), name="source_no",
        )
    )
    units = F.floor(F.col("_tokens") / UNIT)
    share = F.col("_tokens").cast("double")
    for source, given in (shares or {}).items():
        share = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(float(given))).otherwise(share)
    queues = queues.withColumn("_units", units).withColumn("_rate", units / share)
    total, slowest = queues.agg(F.coalesce(F.sum("_units"), F.lit(0)), F.max("_rate")).first()
    # rest of each queue: where it goes after all units, by number of the source
    rests = staged(_rest_places(queues, total * UNIT))
    rows = rows.join(queues, rows["source"].eqNullSafe(queues["source"])).drop(queues["source"])
    rows = rows.withColumn("_key", hash_key(F.col("doc_id"), seed=seed))
    placed = running_total(rows, "source_no", "_key", ["doc_id", "row_id"], "doc_tokens", "_at")
    unit = F.sequence(F.floor(F.col("_at") / UNIT), F.floor((F.col("_at") + F.col("doc_tokens") - 1) / UNIT))
    cut = placed.select("row_id", "source_no", "_units", "_rate", "_at", "doc_tokens", F.explode(unit).alias("unit"))
    begin, stop = F.greatest("_at", F.col("unit") * UNIT), F.least(F.col("_at") + F.col("doc_tokens"), (F.col("unit") + 1) * UNIT)
    pieces = staged(
        cut.select(
            "row_id", "source_no", "unit", (begin - F.col("_at")).alias("start"), (stop - begin).alias("length"),
            (begin - F.col("unit") * UNIT).alias("inside"), (F.col("unit") >= F.col("_units")).alias("rest"),
            (F.try_divide(F.col("unit") + 0.5, F.col("_units")) * F.col("_rate") / F.lit(slowest or 1.0)).alias("due"),
        )
    )
    served = _served(pieces.where("inside = 0 AND NOT rest").select("source_no", "unit", "due"), window)
    at = F.col("place") + F.col("inside")
    main = pieces.where("NOT rest").join(served, ["source_no", "unit"]).withColumn("pos", at)
    last = pieces.where("rest").join(rests, "source_no").withColumn("pos", at)
    # a rest may cross the end of a window
    over = F.greatest(F.lit(0), F.pmod("pos", F.lit(window)) + F.col("length") - window)
    kept = F.struct(F.col("start"), (F.col("length") - over).alias("length"), F.col("pos"))
    moved = F.struct(
        (F.col("start") + F.col("length") - over).alias("start"), over.alias("length"),
        (F.col("pos") + F.col("length") - over).alias("pos"),
    )
    both = last.select("row_id", F.explode(F.filter(F.array(kept, moved), lambda p: p["length"] > 0)).alias("p"))
    every = main.select("row_id", "start", "length", "pos").union(both.select("row_id", "p.start", "p.length", "p.pos"))
    return every.select(
        "row_id", "start", "length",
        F.floor(F.col("pos") / window).alias("sequence_id"), F.pmod("pos", F.lit(window)).alias("offset"),
    )


def _rest_places(queues: DataFrame, first: int) -> DataFrame:
    """(source_no, place): where the tokens after each queue's whole units go."""
    rest = queues.select(F.col("source_no"), (F.col("_tokens") - F.col("_units") * UNIT).alias("_rest"))
    # ranges of sources first, then sources within a range
    rest = rest.withColumn("_range", F.floor(F.col("source_no") / 4096))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = rest.groupBy("_range").agg(F.sum("_rest").alias("_sum"))
    sums = sums.select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("_range").orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    place = F.lit(first) + F.col("_base") + F.coalesce(F.sum("_rest").over(inner), F.lit(0))
    return rest.join(sums, "_range").select("source_no", place.cast("long").alias("place"))


def _served(units: DataFrame, window: int) -> DataFrame:
    """(source_no, unit, place): the token position at which each unit is served.

    Within a window, the units of a source stand together.
    """
    ranged = units.withColumn("_range", F.floor(F.col("due") * (_RANGES - 1)).cast("int"))
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    # _RANGES rows at most
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("_range").orderBy("due", "source_no", "unit")
    ranked = ranged.join(counts, "_range").withColumn("_rank", F.row_number().over(inner) - 1 + F.col("_base"))
    each = window // UNIT
    within = Window.partitionBy("_window").orderBy("source_no", "unit")
    ranked = ranked.withColumn("_window", F.floor(F.col("_rank") / each))
    place = F.col("_window") * window + (F.row_number().over(within) - 1) * UNIT
    return ranked.select("source_no", "unit", place.cast("long").alias("place"))


def packed(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """Each piece with its document's columns and the CRC-32 of its ids.

    Pieces of a document that follow each other in a sequence become one.  A
    document's pieces meet its ids once, whatever their number.
    """
    lists = pieces.groupBy("row_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("__pieces")
    )
    joined = rows.select("row_id", "doc_id", "ids", "doc_tokens").join(lists, "row_id")

    def cut(batches):
        for batch in batches:
            yield from _cut(batch)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(
        cut,
        f"row_id long, doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long",
    )


def _cut(batch: pa.RecordBatch):
    ids, lists = batch.column("ids"), batch.column("__pieces")
    flat = lists.flatten()
    field = {f: flat.field(f).to_numpy(zero_copy_only=False) for f in ("start", "length", "sequence_id", "offset")}
    doc = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
    if not len(doc):
        return
    end = field["offset"] + field["length"]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (np.diff(doc) != 0) | (np.diff(field["sequence_id"]) != 0) | (field["offset"][1:] != end[:-1])
    first = np.flatnonzero(fresh)
    length = np.add.reduceat(field["length"], first)
    tokens = batch.column("doc_tokens").to_pylist()
    crc, start = np.empty(len(first), np.int64), field["start"][first]
    for k, (d, a, n) in enumerate(zip(doc[first].tolist(), start.tolist(), length.tolist())):
        if k == 0 or d != doc[first[k - 1]]:
            whole = np.frombuffer(ids[d].as_buffer(), "<u2" if 2 * tokens[d] == len(ids[d].as_buffer()) else "<u4").astype("<u4")
        crc[k] = zlib.crc32(whole[a : a + n])
    rows = pa.array(doc[first])
    yield pa.RecordBatch.from_arrays(
        [
            batch.column("row_id").take(rows), batch.column("doc_id").take(rows), pa.array(start), pa.array(length),
            pa.array(crc), batch.column("doc_tokens").take(rows), pa.array(field["sequence_id"][first]),
            pa.array(field["offset"][first]),
        ],
        names=["row_id", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    )


def pack(docs: DataFrame, path: str, shares: dict[str | None, float] | None = None, window: int = WINDOW) -> DataFrame:
    """All pieces of ``docs`` (doc_id, source, text) in sequences of ``window`` tokens."""
    rows = encoded(docs, path, [F.col("doc_id"), F.col("source")])
    return packed(rows, layout(rows, shares, window))
