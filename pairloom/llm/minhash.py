"""Near duplicates by word shingles: MinHash finds candidates, exact Jaccard decides.

A text's set are the hashes of its runs of SHINGLE words (all its words, if they
are fewer), in lower case.  Two texts are near duplicates when their sets' Jaccard
similarity is LIMIT or more; a group is what such links connect.

Candidates.  BANDS keys of ROWS minima each: two texts of similarity j share a key
with probability 1 - (1 - j ** ROWS) ** BANDS, which is 0.9999 at 0.8 and above
0.999999 from 0.84 on; the rest are missed unless a third text links them.  Keys
connect texts to candidate components.

Verification.  Every candidate component is searched for all pairs of LIMIT or
more, by the sets themselves.  A component with many texts is cut into blocks.  Each
is searched alone, then the first texts of the groups found (if few), then every pair of
blocks that holds texts of different groups is a cell of its own: no such pair is
left out and no task holds more than two blocks.  A cell returns a spanning forest of
its links.  So the texts of one large group are sent once, and their first ones once more.

Special rows.  A text that is NULL or has no word is a copy of every other such
text.  Texts with the same words are one node, whatever their number.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pairloom.llm.common import schema, slices, staged_batches
from pairloom.llm.graphs import components
from pairloom.session import staged

SHINGLE = 5
#: Least similarity of near duplicates, as a fraction of integers.
LIMIT = (4, 5)
BANDS, ROWS = 32, 6
SEED = 42
#: Texts in a block of a large candidate component, and their bytes.
BLOCK, BLOCK_BYTES = 1024, 4 << 20
#: Shingles that are mixed at once; they stay in a core's cache.
_CHUNK = 1 << 15

_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 32, (2, BANDS * ROWS), dtype=np.uint32) | np.array([[1], [0]], np.uint32)


def shingles(text: bytes) -> tuple[int, np.ndarray]:
    """The hash of a text's words and the hashes of its shingles, repeated ones too."""
    words = text.lower().split()  # both take ASCII only on bytes
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    whole = digest(joined, SEED)
    if len(words) <= SHINGLE:
        return whole, np.array([whole] if words else [], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = (ends - [len(w) for w in words]).tolist()
    ends = ends.tolist()
    return whole, np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :])], np.uint64)


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """BANDS keys for each set; an empty set has those of the largest minima."""
    least = np.full((len(sets), BANDS * ROWS), np.iinfo(np.uint32).max, np.uint32)
    sizes = np.array([len(s) for s in sets], np.int64)
    every = (np.concatenate(sets) if sets else np.array([], np.uint64)) >> np.uint64(32)
    every, owner = every.astype(np.uint32), np.repeat(np.arange(len(sets)), sizes)
    for at in range(0, len(every), _CHUNK):
        part, mine = every[at : at + _CHUNK], owner[at : at + _CHUNK]
        first = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
        rows = mine[first]
        for k, (a, b) in enumerate(_FACTORS.T):
            least[rows, k] = np.minimum(least[rows, k], np.minimum.reduceat(part * a + b, first))
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sets), BANDS)).copy()
    for r in range(ROWS):
        keys = (keys ^ least[:, r::ROWS]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def _signed(docs: DataFrame, keep: list[Column], text: str) -> DataFrame:
    """``keep`` columns of every row, ``node`` (a hash of its words) and ``keys`` (its bands)."""
    rows = docs.select(*keep, F.col(text).cast("binary").alias("__text"))
    kept = rows.columns[:-1]

    def run(batches):
        for batch in slices(batches, "__text"):
            found = [shingles(t or b"") for t in batch.column("__text").to_pylist()]
            node = np.array([n for n, _ in found], np.uint64).view(np.int64)
            keys = pa.FixedSizeListArray.from_arrays(pa.array(band_keys([s for _, s in found]).ravel()), BANDS)
            columns = [*(batch.column(c) for c in kept), pa.array(node), keys.cast(pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "node", "keys"])

    return rows.mapInArrow(run, schema(rows, kept, "node long, keys array<long>"))


def candidates(nodes: DataFrame) -> DataFrame:
    """(node, root) of ``nodes`` (node, keys) that share a key with another one."""
    rows = nodes.select("node", F.explode("keys").alias("key"))
    # the key's first node, as a running value: nothing is held but a row
    first = F.first("node").over(Window.partitionBy("key").orderBy("node").rowsBetween(Window.unboundedPreceding, 0))
    return components(rows.select("node", first.alias("first")).where("node <> first"), "node", "first")


def _blocks(n: str, size: str) -> Column:
    """Blocks that ``n`` texts of ``size`` bytes are cut into."""
    return F.ceil(F.greatest(F.col(n) / BLOCK, F.col(size) / BLOCK_BYTES))


def _block(blocks: str) -> Column:
    return F.pmod(F.xxhash64("node"), F.col(blocks)).cast("long")


def block_pairs(group: str, main: Column, other: Column) -> Column:
    """The cells of a row: pairs of its own block with those it has to meet.

    Rows whose ``group`` is _main lie in _mains blocks (their own is ``main``), all
    others in _rest blocks (``other``); rows without _rest are one cell.
    """
    rest = F.col("_rest")
    pair = lambda i, j: rest * rest + i * rest + j
    all_rest, all_mains = F.sequence(F.lit(0).cast("long"), rest - 1), F.sequence(F.lit(0).cast("long"), F.col("_mains") - 1)
    of_main = F.transform(all_rest, lambda j: pair(main, j))
    among = F.transform(all_rest, lambda j: F.least(other, j) * rest + F.greatest(other, j))
    of_rest = F.concat(among, F.transform(all_mains, lambda i: pair(i, other)))
    one = F.array(F.lit(0).cast("long"))
    return F.when(rest.isNull(), one).when(F.col(group) == F.col("_main"), of_main).otherwise(of_rest)


def _unsettled_cells(texts: DataFrame) -> DataFrame:
    """(root, cell, name, text) of ``texts`` (root, group, node, text): cells that hold all pairs of texts of different groups of a root.

    A root of one group has none.  The texts of a root's most frequent group meet
    only the others, which meet each other as well.
    """
    groups = texts.groupBy("root", "group").agg(F.count("*").alias("_n"), F.sum(F.length("text")).cast("long").alias("_bytes"))
    top = F.max(F.struct("_n", "_bytes", "group")).alias("_top")
    roots = groups.groupBy("root").agg(F.sum("_n").alias("_n"), F.sum("_bytes").alias("_bytes"), top).where(F.col("_n") > F.col("_top._n"))
    rest = roots.select("root", (F.col("_n") - F.col("_top._n")).alias("_n"), (F.col("_bytes") - F.col("_top._bytes")).alias("_bytes"), "_top")
    main = rest.select("*", F.col("_top._n").alias("_top_n"), F.col("_top._bytes").alias("_top_bytes"))
    cut = staged(main.select("root", F.col("_top.group").alias("_main"), _blocks("_top_n", "_top_bytes").alias("_mains"), _blocks("_n", "_bytes").alias("_rest")))
    rows = texts.join(cut, "root")
    cells = block_pairs("group", _block("_mains"), _block("_rest"))
    return rows.select("root", F.explode(cells).alias("cell"), F.col("group").alias("name"), "text")


def _searched(cells: DataFrame) -> DataFrame:
    """(a, b): names of near duplicates among the texts of each (root, cell) of ``cells`` (root, cell, name, text), as a forest per cell."""

    def verify(batches):
        group, names, sets = None, [], []
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("root", "cell")))
            for key, name, text in zip(keys, batch.column("name").to_pylist(), batch.column("text")):
                if key != group:
                    yield from _forest(names, sets)
                    group, names, sets = key, [], []
                names.append(name)
                sets.append(np.unique(shingles(text.as_py() or b"")[1]))
        yield from _forest(names, sets)

    return cells.repartition("root", "cell").sortWithinPartitions("root", "cell").mapInArrow(verify, "a long, b long")


def links(texts: DataFrame) -> DataFrame:
    """(a, b): links whose components are those of all near duplicates among the nodes of each root of ``texts`` (root, node, text).

    Every text is first searched within its block, which is all of a small root.
    For a root that is cut, the first texts of the groups found meet next if they
    are one block, then all texts of groups that are still apart.
    """
    sizes = texts.groupBy("root").agg(F.count("*").alias("_n"), F.sum(F.length("text")).alias("_bytes"))
    large = staged(sizes.select("root", _blocks("_n", "_bytes").alias("_blocks")).where("_blocks > 1"))
    rows = texts.join(large, "root", "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    found = staged(_searched(rows.select("root", _block("_blocks").alias("cell"), F.col("node").alias("name"), "text")))
    if large.isEmpty():
        return found
    grouped = texts.join(large.select("root"), "root", "left_semi")
    grouped = _grouped(grouped, components(found))
    heads = grouped.where("node = group")
    few = heads.groupBy("root").agg(F.count("*").alias("_n"), F.sum(F.length("text")).alias("_bytes")).where(_blocks("_n", "_bytes") == 1)
    found = staged(found.union(_searched(_unsettled_cells(heads.join(few.select("root"), "root", "left_semi")))))
    return found.union(_searched(_unsettled_cells(_grouped(grouped, components(found)))))


def _grouped(texts: DataFrame, roots: DataFrame) -> DataFrame:
    """``texts`` with the component of their node as ``group``."""
    named = texts.drop("group").join(roots.toDF("node", "group"), "node", "left")
    return staged_batches(named.select("root", F.coalesce("group", "node").alias("group"), "node", "text"))


def _forest(names: list[int], sets: list[np.ndarray]):
    pairs = forest(sets)
    if len(pairs):
        ends = np.array(names, np.int64)[pairs]
        ends = np.unique(ends[ends[:, 0] != ends[:, 1]], axis=0)
        yield pa.RecordBatch.from_pydict({"a": ends[:, 0], "b": ends[:, 1]})


def forest(sets: list[np.ndarray]) -> np.ndarray:
    """Pairs of places that span the components of all pairs of LIMIT or more."""
    found, sizes = [], np.array([len(s) for s in sets], np.int64)
    waiting = np.ones(len(sets), bool)
    held, codes, owner, starts = 0, None, None, None
    for seed in range(len(sets)):
        if not waiting[seed]:
            continue
        waiting[seed], queue = False, [seed]
        while queue and waiting.any():
            if codes is None or 2 * waiting.sum() < held:  # places of each hash among those that wait
                held = int(waiting.sum())
                left = np.flatnonzero(waiting)
                codes, owner = np.concatenate([sets[i] for i in left]), np.repeat(left, sizes[left])
                order = np.argsort(codes, kind="stable")
                owner = owner[order]
                codes, starts = np.unique(codes[order], return_index=True)
                starts = np.append(starts, len(owner))
            one = queue.pop()
            at = np.searchsorted(codes, sets[one])
            at = at[(at < len(codes)) & (codes[np.minimum(at, len(codes) - 1)] == sets[one])] if len(codes) else at[:0]
            n = starts[at + 1] - starts[at]
            places = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[at], n)
            both = np.bincount(owner[places], minlength=len(sets))
            near = waiting & (LIMIT[1] * both >= LIMIT[0] * (sizes + sizes[one] - both)) & (both > 0)
            met = np.flatnonzero(near)
            waiting[met] = False
            queue += met.tolist()
            found += [(one, m) for m in met.tolist()]
    return np.array(found, np.int64).reshape(-1, 2)


def near_duplicates(rows: DataFrame, member: Column, text: str = "text", row: str = "row_id") -> DataFrame:
    """(row, member, least) of ``rows``: ``least`` is the smallest ``member`` of the group.

    ``row`` is unique and ``rows`` gives the same one each time it is read.
    """
    return settled(rows, _signed(rows, [F.col(row), member.alias("member")], text), candidates, text, row)


def settled(rows: DataFrame, signed: DataFrame, find: Callable[[DataFrame], DataFrame], text: str, row: str) -> DataFrame:
    """(row, member, least) of ``signed`` (row, member, node and what ``find`` needs), decided by the texts of ``rows``.

    ``find`` takes one row per node and returns (node, root) of those that may have a near duplicate.
    """
    signed = staged_batches(signed)
    marks = [c for c in signed.columns if c not in (row, "member", "node")]
    nodes = staged(
        signed.groupBy("node").agg(F.min("member").alias("least"), F.min(row).alias(row), *[F.first(c).alias(c) for c in marks])
    )
    close = staged(nodes.join(find(nodes.select("node", *marks)), "node").select(row, "node", "root"))
    texts = staged_batches(rows.select(row, F.col(text).cast("binary").alias("text")).join(close, row).select("root", "node", "text"))
    roots = components(links(texts))
    rooted = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    groups = staged(rooted.groupBy("root").agg(F.min("least").alias("least")))
    named = staged(rooted.select("node", "root").join(groups, "root").select("node", "least"))
    return signed.drop(*marks).join(named, "node").select(row, "member", "least")
