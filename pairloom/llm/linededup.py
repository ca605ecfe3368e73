"""Line deduplication by probing a sharded minimal perfect hash.

A line's key is the line without ASCII white space at its ends, A-Z in lower
case.  Keys of MIN_CHARS code points or more that MIN_DOCS documents or more hold
lose their lines everywhere but in the document of the largest id that holds them.

Spark counts the documents of every key by its 128-bit hash: repeats fold within
a document, within a batch and before the shuffle, so a line that all documents
share is no hot key.  Keys below MIN_DOCS can lose nothing and are not indexed.
The others are dealt to shards by the leading bits of their hash; a shard is a
minimal perfect hash (bit arrays of several levels, a key's index being the rank
of its bit) over arrays of fingerprints, document counts and keepers, about 24
bytes a key.  Shards are files in the shared folder.  Documents are not joined:
a task hashes the lines of a batch, sorts the hashes by shard and probes the
arrays, keeping at most CACHE_BYTES of shards.  A line is matched by 64 bits of
its hash within a shard of SHARD_KEYS keys on average.

Special rows.  A text that is NULL or empty is one empty line.  Repeated rows
count as documents of their own; all rows of the largest id keep their lines.  A
NULL id is smaller than any other.  All columns are kept.  An empty table gives
an empty result.
"""

from __future__ import annotations

from collections import OrderedDict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pairloom.llm.common import kept_with, mix64, slices
from pairloom.session import scratch_path, staged

MIN_CHARS, MIN_DOCS = 20, 3
#: Keys of a shard, on average.
SHARD_KEYS = 1 << 18
#: Bytes of shards that a task keeps.
CACHE_BYTES = 256 << 20
#: Bits of a level for each key that is left.
GAMMA = 2.0

_WHITE = " \t\n\v\f\r"
_NO_ID = -(1 << 63)  # the id of documents without one
_SHARD = "shard int, sizes array<long>, bits binary, fingerprints binary, counts binary, keepers binary"


def line_hashes(lines: list[str], min_chars: int) -> list[bytes | None]:
    """The hash of each line's key; None for keys that are too short."""
    keys = [line.strip(_WHITE) for line in lines]
    return [xxhash.xxh3_128_digest(k.encode().lower()) if len(k) >= min_chars else None for k in keys]


def _numbers(hashes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(hashes), dtype=">u8").astype(np.uint64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(_NO_ID).to_numpy(zero_copy_only=False)


def count_lines(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """(hi, lo, n, keeper): documents and largest document id of every key."""

    def count(batches):
        for batch in slices(batches, "text"):
            found: dict[bytes, list[int]] = {}
            for own, text in zip(_ids(batch.column("id")).tolist(), batch.column("text").to_pylist()):
                for key in set(line_hashes((text or "").split("\n"), min_chars)):
                    if key in found:
                        entry = found[key]
                        entry[0] += 1
                        entry[1] = max(entry[1], own)
                    else:
                        found[key] = [1, own]
            found.pop(None, None)
            if found:
                hi, lo = _numbers(list(found))
                n, keeper = np.array(list(found.values()), np.int64).T
                columns = [hi.view(np.int64), lo.view(np.int64), n, keeper]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["hi", "lo", "n", "keeper"])

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    counts = rows.mapInArrow(count, "hi long, lo long, n long, keeper long")
    return counts.groupBy("hi", "lo").agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper"))


def _place(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where keys fall in the bits of a level."""
    turned = mix64(hi + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
    return (mix64(lo ^ turned) % np.uint64(size)).astype(np.int64)


@dataclass
class PerfectHash:
    """Numbers 0 .. n - 1 for n different keys; any number, or none, for other keys."""

    sizes: list[int]
    words: np.ndarray

    def __post_init__(self):
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])

    @classmethod
    def build(cls, hi: np.ndarray, lo: np.ndarray) -> PerfectHash:
        """Every level takes the keys that fall alone; the others go on to the next."""
        left, sizes, bits = np.arange(len(hi)), [], []
        while len(left):
            size = max(int(GAMMA * len(left)) + 63, 64) // 64 * 64
            at = _place(hi[left], lo[left], len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left = left[~alone[at]]
        packed = np.packbits(np.concatenate(bits or [np.zeros(0, bool)]), bitorder="little")
        return cls(sizes, packed.view(np.uint64))

    def index(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The number of each key, -1 if it is none for certain."""
        out, left, base = np.full(len(hi), -1, np.int64), np.arange(len(hi)), 0
        for level, size in enumerate(self.sizes):
            at = base + _place(hi[left], lo[left], level, size)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = ((word >> bit) & np.uint64(1)).astype(bool)
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = (self.before[at >> 6] + np.bitwise_count(below))[hit]
            left, base = left[~hit], base + size
        return out


def _shard_row(shard: int, hi: np.ndarray, lo: np.ndarray, n: np.ndarray, keeper: np.ndarray) -> pa.Table:
    found = PerfectHash.build(hi, lo)
    order = np.empty(len(hi), np.int64)
    order[found.index(hi, lo)] = np.arange(len(hi))
    row = {
        "shard": shard, "sizes": found.sizes, "bits": found.words.tobytes(), "fingerprints": hi[order].tobytes(),
        "counts": np.minimum(n[order], (1 << 32) - 1).astype(np.uint32).tobytes(), "keepers": keeper[order].tobytes(),
    }
    fields = [("shard", pa.int32()), ("sizes", pa.list_(pa.int64())), *((c, pa.binary()) for c in list(row)[2:])]
    return pa.Table.from_pylist([row], schema=pa.schema(fields))


def build_index(lines: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[str, int]:
    """Write the shards of ``lines`` (hi, lo, n, keeper); returns their folder and the bits that name a shard."""
    total = lines.count()
    bits = max(total - 1, 0) // shard_keys
    bits = bits.bit_length()
    shard = F.shiftrightunsigned("hi", 64 - bits).cast("int") if bits else F.lit(0)

    def build(table: pa.Table) -> pa.Table:
        col = {c: table.column(c).to_numpy() for c in table.column_names}
        return _shard_row(int(col["shard"][0]), col["hi"].view(np.uint64), col["lo"].view(np.uint64), col["n"], col["keeper"])

    folder = scratch_path(lines.sparkSession, "lines")
    shards = lines.withColumn("shard", shard).groupBy("shard").applyInArrow(build, _SHARD)
    shards.write.partitionBy("shard").parquet(folder)
    return folder, bits


class Index:
    """Probes the shards of a folder; a task has one."""

    def __init__(self, folder: str, bits: int, cache_bytes: int = CACHE_BYTES):
        self.files, self.base = fs.FileSystem.from_uri(folder)
        self.bits, self.room = bits, cache_bytes
        self.loaded: OrderedDict[int, tuple] = OrderedDict()

    def _shard(self, shard: int) -> tuple | None:
        if shard in self.loaded:
            self.loaded.move_to_end(shard)
            return self.loaded[shard]
        found = self.files.get_file_info(fs.FileSelector(f"{self.base}/shard={shard}", allow_not_found=True))
        rows = [pq.ParquetFile(self.files.open_input_file(f.path)).read() for f in found if f.path.endswith(".parquet")]
        entry = None
        if rows:
            row = pa.concat_tables(rows).slice(0, 1).to_pylist()[0]
            arrays = [np.frombuffer(row[c], t) for c, t in (("fingerprints", np.uint64), ("counts", np.uint32), ("keepers", np.int64))]
            entry = (PerfectHash(row["sizes"], np.frombuffer(row["bits"], np.uint64)), *arrays)
        self.loaded[shard] = entry
        while len(self.loaded) > 1 and sum(sum(a.nbytes for a in e[1:]) for e in self.loaded.values() if e) > self.room:
            self.loaded.popitem(last=False)
        return entry

    def probe(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of documents (0 if not indexed) and keeper of each key."""
        count, keeper = np.zeros(len(hi), np.int64), np.zeros(len(hi), np.int64)
        shard = (hi >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hi), np.int64)
        order = np.argsort(shard, kind="stable")
        names, starts = np.unique(shard[order], return_index=True)
        for name, at in zip(names.tolist(), np.split(order, starts[1:])):
            entry = self._shard(name)
            if entry is None:
                continue
            table, fingerprints, counts, keepers = entry
            where = table.index(hi[at], lo[at])
            at, where = at[where >= 0], where[where >= 0]
            same = fingerprints[where] == hi[at]
            count[at[same]], keeper[at[same]] = counts[where[same]], keepers[where[same]]
        return count, keeper


def dedup(
    docs: DataFrame, keep: list[Column], doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS, shard_keys: int = SHARD_KEYS,
) -> DataFrame:
    """``keep`` columns of every row, its text without repeated lines as ``kept_text``, ``n_lines`` and ``n_dropped``."""
    lines = staged(count_lines(docs, doc_id, text, min_chars).where(F.col("n") >= min_docs))
    folder, bits = build_index(lines, shard_keys)
    own = F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID).cast("long")).alias("__id")
    rows, kept, name = kept_with(docs, [*keep, own], text)

    def drop(batches):
        index = Index(folder, bits)
        for batch in slices(batches, name):
            columns = [batch.column(c) for c in kept if c != "__id"]
            yield pa.RecordBatch.from_arrays(
                columns + _kept(index, batch.column("__id").to_numpy(), batch.column(name).to_pylist(), min_chars, min_docs),
                names=[c for c in kept if c != "__id"] + _NAMES,
            )

    fields = [rows.schema[c] for c in kept if c != "__id"]
    return rows.mapInArrow(drop, StructType(fields + StructType.fromDDL("kept_text string, n_lines long, n_dropped long").fields))


_NAMES = ["kept_text", "n_lines", "n_dropped"]


def _kept(index: Index, ids: np.ndarray, texts: list[str | None], min_chars: int, min_docs: int) -> list[pa.Array]:
    lists = [(t or "").split("\n") for t in texts]
    hashes = [line_hashes(lines, min_chars) for lines in lists]
    asked = [(i, j, h) for i, doc in enumerate(hashes) for j, h in enumerate(doc) if h is not None]
    gone: dict[int, set[int]] = {}
    if asked:
        row, place, keys = zip(*asked)
        count, keeper = index.probe(*_numbers(list(keys)))
        row = np.array(row)
        for at in np.flatnonzero((count >= min_docs) & (keeper != ids[row])).tolist():
            gone.setdefault(int(row[at]), set()).add(place[at])
    out = [t or "" for t in texts]
    for i, places in gone.items():
        out[i] = "\n".join(line for j, line in enumerate(lists[i]) if j not in places)
    n_dropped = np.array([len(gone.get(i, ())) for i in range(len(texts))], np.int64)
    return [pa.array(out, pa.string()), pa.array([len(x) for x in lists], pa.int64()), pa.array(n_dropped)]
