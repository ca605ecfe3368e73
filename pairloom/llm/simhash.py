"""SimHash near duplicates by multi-index hashing.

A fingerprint has 64 bits; two link when at most four differ.  It is cut into
three segments.  Of two linked fingerprints either one of the first two segments
differs in one bit at most, or the third is equal (else at least 2 + 2 + 1 bits
differ).  So each fingerprint is listed under its own segment values, looks up
the Hamming balls of radius 1 around the first two and its own third, and every
match is verified over all 64 bits.

Equal fingerprints are one node.  A segment value with very many fingerprints is
cut into blocks, and every pair of blocks is a group of its own, so that no task
takes more than two blocks and none of the pairs is left out.  A group returns a
spanning forest of its links instead of all of them.

Special rows.  A text that is NULL or has no word has fingerprint zero and is
linked like any other.  Repeated rows share fingerprint and component.  A NULL
doc_id never names a component unless its component has no other.

Near texts.  Sixty-four bits are too few for texts that share 80 % of their
shingles: they differ in about a seventh of them, as far as 21 bits.  For these a
text has a long fingerprint of WORDS words over its distinct shingles.  The first
two words are compared as a whole, the others are cut into segments, and two texts
are candidates when a segment is equal and the first two words differ in at most
NEAR_BITS bits.  Exact sets decide afterwards (``minhash.settled``).  At similarity
0.8 a bit differs with probability 0.152 (0.19 for sets of four and five), so a
pair shares no segment with probability (1 - 0.848 ** 12) ** 64, 0.00007 (0.003);
it is missed then, unless a third text links it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm import minhash
from pairloom.llm.common import mix64, schema, slices, staged_batches
from pairloom.llm.graphs import components
from pairloom.session import staged

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: (first bit, bits, radius) of the segments.
SEGMENTS = ((0, 21, 1), (21, 21, 1), (42, 22, 0))
#: Fingerprints in a block of a crowded segment value.
BLOCK = 2048
#: Pairs that a task verifies at once.
PAIRS = 1 << 21
#: Words of a long fingerprint, bits of a segment, bits that may differ in the first two words.
WORDS, SEGMENT_BITS, NEAR_BITS = 14, 12, 38
#: Segments by which groups are put together before all are gone through.
HEAD = 4
#: Shingles whose bits are added up in one byte each.
_BYTE = 255
_SEEDS = mix64(np.arange(1, WORDS + 1, dtype=np.uint64))


def fingerprint(text: bytes) -> int:
    """The unsigned fingerprint of a text: bits set in over half of its shingles' hashes."""
    words = text.lower().split()  # both take ASCII only on bytes
    if not words:
        return 0
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = (ends - [len(w) for w in words]).tolist()
    ends = ends.tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :])], dtype="<u8")
    return _majority(hashes)


def _majority(hashes: np.ndarray) -> int:
    votes = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[part : part + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * votes > len(hashes)).tolist()))


def fingerprints(docs: DataFrame, keep: list[Column], text: str = "text") -> DataFrame:
    """``keep`` columns of every row and ``fp``, its fingerprint as a signed BIGINT."""
    rows = docs.select(*keep, F.col(text).cast("binary").alias("__text"))
    kept = rows.columns[:-1]

    def run(batches):
        for batch in slices(batches, "__text"):
            found = [fingerprint(t or b"") for t in batch.column("__text").to_pylist()]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(signed)], names=[*kept, "fp"])

    return rows.mapInArrow(run, schema(rows, kept, "fp long"))


def _cells(nodes: DataFrame) -> DataFrame:
    """(key, cell, own, fp): fingerprints listed under (own) and looking up each segment value.

    An own row also looks up its own value, which is the centre of its ball.
    Balls hold only values with one more bit set: of two segments that differ in
    one bit, the one without it finds the other.
    """
    listed, balls = [], []
    for s, (first, bits, radius) in enumerate(SEGMENTS):
        value = F.shiftrightunsigned("fp", first).bitwiseAND((1 << bits) - 1)
        listed.append(F.struct(value.bitwiseOR(s << 32).alias("key"), F.lit(True).alias("own")))
        for bit in range(bits if radius else 0):
            near = F.when(value.bitwiseAND(1 << bit) == 0, value.bitwiseOR((s << 32) | (1 << bit)))
            balls.append(F.struct(near.alias("key"), F.lit(False).alias("own")))
    rows = nodes.select("fp", F.explode(F.array(*listed, *balls)).alias("r")).select("r.key", "r.own", "fp")
    rows = rows.where("key IS NOT NULL")
    crowded = rows.groupBy("key").agg(F.count_if("own").alias("_own"), F.count("*").alias("_all"))
    crowded = crowded.where(F.col("_all") > 2 * BLOCK)
    blocks = lambda c: F.ceil(F.coalesce(F.col(c), F.lit(1)) / BLOCK).cast("int")
    # a crowded value that no fingerprint has gives no link, however many look it up
    rows = rows.join(staged(crowded), "key", "left").where("_own IS NULL OR _own > 0").select(
        "key", "own", "fp", blocks("_own").alias("_right"), blocks("_all").alias("_left")
    )
    mine = lambda n: F.pmod(F.xxhash64("fp"), F.col(n)).cast("int")
    looking = rows.select(
        "key", "fp", F.lit(False).alias("own"), F.col("own").alias("centre"), "_right",
        mine("_left").alias("_i"), F.explode(F.sequence(F.lit(0), F.col("_right") - 1)).alias("_j"),
    )
    under = rows.where("own").select(
        "key", "fp", "own", F.lit(True).alias("centre"), "_right",
        F.explode(F.sequence(F.lit(0), F.col("_left") - 1)).alias("_i"), mine("_right").alias("_j"),
    )
    both = looking.unionByName(under)
    return both.select("key", (F.col("_i").cast("long") * F.col("_right") + F.col("_j")).alias("cell"), "own", "centre", "fp")


def links(nodes: DataFrame) -> DataFrame:
    """(a, b): links between different fingerprints of ``nodes`` (fp, unique), a forest per block.

    Components over them are those over all pairs with MAX_BITS or fewer
    differing bits.
    """
    cells = _cells(nodes)

    def verify(batches):
        for table in _whole_groups(batches):
            yield from _verified(table)

    grouped = cells.repartition("key", "cell").sortWithinPartitions("key", "cell", F.col("own").desc())
    return grouped.mapInArrow(verify, "a long, b long")


def _whole_groups(batches):
    """Tables of whole (key, cell) groups out of sorted batches."""
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        size += batch.num_rows
        if size >= 1 << 18:
            whole = pa.concat_tables(held)
            cut = _last_group(whole)
            if cut:
                yield whole.slice(0, cut)
            held, size = [whole.slice(cut)], whole.num_rows - cut
    if size:
        yield pa.concat_tables(held)


def _columns(table: pa.Table) -> dict[str, np.ndarray]:
    return {c: table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in table.column_names}


def _last_group(table: pa.Table) -> int:
    """Where the last group of a sorted table starts; it may go on in the next batch."""
    col = _columns(table.select(["key", "cell"]))
    change = np.flatnonzero((np.diff(col["key"]) != 0) | (np.diff(col["cell"]) != 0))
    return int(change[-1]) + 1 if len(change) else 0


def _verified(table: pa.Table):
    """The forest of links in whole groups; each starts with its own rows."""
    col = _columns(table)
    fp = col["fp"].astype(np.int64)
    fresh = np.concatenate([[True], (np.diff(col["key"]) != 0) | (np.diff(col["cell"]) != 0)])
    group = np.cumsum(fresh) - 1
    owns = np.bincount(group, weights=col["own"]).astype(np.int64)
    start = np.flatnonzero(fresh)
    look = np.flatnonzero(~col["own"] & (owns[group] > 0))
    counts = owns[group[look]]
    ends = np.cumsum(counts)
    at = 0
    while at < len(look):
        stop = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")), at + 1)
        rows, n = look[at:stop], counts[at:stop]
        left = np.repeat(rows, n)
        right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[group[rows]], n)
        x, y = fp[left], fp[right]
        near = np.bitwise_count((x ^ y).view(np.uint64)) <= MAX_BITS
        # at the centre of a ball both sides find each other
        near &= np.where(col["centre"][left], x < y, True)
        a, b = forest(x[near], y[near])
        if len(a):
            yield pa.RecordBatch.from_pydict({"a": a, "b": b})
        at = stop


def forest(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every node to the smallest node of its component."""
    nodes, ends = np.unique(np.concatenate([x, y]), return_inverse=True)
    u, v = ends[: len(x)], ends[len(x) :]
    root = np.arange(len(nodes))
    while True:
        least = root.copy()
        low = np.minimum(root[u], root[v])
        np.minimum.at(least, root[u], low)
        np.minimum.at(least, root[v], low)
        least = least[root]
        least = least[least]
        if (least == root).all():
            break
        root = least
    far = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[far], nodes[root[far]]


def near_duplicates(docs: DataFrame, keep: list[Column], member: str, text: str = "text") -> DataFrame:
    """``keep`` columns (``member`` among them), ``fp``, and ``least``: the smallest ``member`` of the component."""
    marked = staged_batches(fingerprints(docs, keep, text))
    nodes = staged(marked.groupBy("fp").agg(F.min(member).alias("least")))
    roots = components(links(nodes.select("fp")))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # fingerprints without a link keep their own minimum; only the others meet
    linked = staged(rooted.groupBy("root").agg(F.min("least").alias("least")))
    named = staged(rooted.select("fp", "root").join(linked, "root").select("fp", "least"))
    return marked.join(named, "fp")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def long_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """WORDS unsigned words: bits set in over half of the mixed ``hashes`` (distinct, uint64)."""
    votes = np.zeros(64 * WORDS, np.int64)
    for at in range(0, len(hashes), _BYTE):
        mixed = mix64(hashes[at : at + _BYTE, None] ^ _SEEDS).astype("<u8", copy=False)
        bits = np.unpackbits(mixed.view(np.uint8), axis=1, bitorder="little")
        votes += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")


def segment_keys(prints: np.ndarray) -> np.ndarray:
    """For each row of long fingerprints the numbers of its segments' values."""
    bits = np.unpackbits(np.ascontiguousarray(prints[:, 2:]).view(np.uint8), axis=1, bitorder="little")
    values = bits.reshape(len(prints), -1, SEGMENT_BITS).astype(np.int32) @ (1 << np.arange(SEGMENT_BITS, dtype=np.int32))
    return (values | np.arange(values.shape[1], dtype=np.int32) << SEGMENT_BITS).astype(np.int32)


def _long_signed(docs: DataFrame, keep: list[Column], text: str) -> DataFrame:
    """``keep`` columns of every row, ``node`` (a hash of its words), the first two words and the segments of its long fingerprint."""
    rows = docs.select(*keep, F.col(text).cast("binary").alias("__text"))
    kept = rows.columns[:-1]

    def run(batches):
        for batch in slices(batches, "__text"):
            nodes, prints = [], []
            for t in batch.column("__text").to_pylist():
                node, hashes = minhash.shingles(t or b"")
                nodes.append(node)
                prints.append(long_fingerprint(np.unique(hashes)))
            prints = np.array(prints, np.uint64).reshape(-1, WORDS)
            keys = segment_keys(prints)
            listed = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), keys.shape[1])
            first = [pa.array(np.ascontiguousarray(prints[:, k]).view(np.int64)) for k in (0, 1)]
            columns = [pa.array(np.array(nodes, np.uint64).view(np.int64)), *first, listed.cast(pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], names=[*kept, "node", "fp", "more", "keys"])

    return rows.mapInArrow(run, schema(rows, kept, "node long, fp long, more long, keys array<int>"))


def _block(blocks: str) -> Column:
    return F.pmod(F.xxhash64("fp", "more"), F.col(blocks)).cast("long")


def _crowded(rows: DataFrame) -> DataFrame:
    """(key, _n): the segment values that are cut."""
    return staged(rows.groupBy("key").agg(F.count("*").alias("_n")).where(F.col("_n") > 2 * BLOCK))


def _head_cells(nodes: DataFrame) -> DataFrame:
    """(key, cell, fp, more, root) of the first HEAD segments of ``nodes`` (fp, more, keys); every row is in one block only."""
    rows = nodes.select("fp", "more", F.col("fp").alias("root"), F.explode(F.slice("keys", 1, HEAD)).alias("key"))
    blocks = _crowded(rows).select("key", F.ceil(F.col("_n") / BLOCK).alias("_blocks"))
    rows = rows.join(blocks, "key", "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    return rows.select("key", _block("_blocks").alias("cell"), "fp", "more", "root")


def _segment_cells(nodes: DataFrame) -> DataFrame:
    """(key, cell, fp, more, root): a row per segment of ``nodes`` (fp, more, keys, root); a crowded value is cut into pairs of blocks.

    Rows of one root need no comparison.  So the rows of a crowded value's most
    frequent root meet only the others, which meet each other as well.
    """
    rows = nodes.select("fp", "more", "root", F.explode("keys").alias("key"))
    counts = rows.join(_crowded(rows).select("key"), "key").groupBy("key", "root").agg(F.count("*").alias("_n"))
    largest = counts.groupBy("key").agg(F.sum("_n").alias("_n"), F.max(F.struct("_n", "root")).alias("_top"))
    blocks = lambda n: F.ceil(n / BLOCK)
    large = staged(largest.select("key", F.col("_top.root").alias("_main"), blocks(F.col("_top._n")).alias("_mains"), blocks(F.col("_n") - F.col("_top._n")).alias("_rest")))
    rows = rows.join(large, "key", "left").where("_rest IS NULL OR _rest > 0")
    return rows.select("key", F.explode(minhash.block_pairs("root", _block("_mains"), _block("_rest"))).alias("cell"), "fp", "more", "root")


def _searched(cells: DataFrame) -> DataFrame:
    """(a, b): roots of rows of a cell that differ in at most NEAR_BITS bits, a forest per slice of cells."""

    def verify(batches):
        for table in _whole_groups(batches):
            yield from _near(table)

    grouped = cells.repartition("key", "cell").sortWithinPartitions("key", "cell", "root")
    return grouped.mapInArrow(verify, "a long, b long")


def near_links(nodes: DataFrame) -> DataFrame:
    """(a, b): links whose components are those of all links between first words of ``nodes`` (fp, more, keys).

    Two are linked that have an equal segment and at most NEAR_BITS differing bits.
    Groups are put together by a few segments first.  All segments then add only
    links between different groups, so a large group has a few links for each of
    its nodes and not one per segment.
    """
    nodes = staged(nodes.groupBy("fp", "more").agg(F.first("keys").alias("keys")))
    roots = components(_searched(_head_cells(nodes)))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = staged(rooted.select("fp", "more", "keys", F.coalesce("root", "fp").alias("root")))
    return roots.where("node <> root").toDF("a", "b").union(_searched(_segment_cells(rooted)))


def _near(table: pa.Table):
    """The forest of links between different roots among the rows of each whole group; a root's rows lie together."""
    col = _columns(table)
    x, y, root = col["fp"].view(np.uint64), col["more"].view(np.uint64), col["root"]
    fresh = np.concatenate([[True], (np.diff(col["key"]) != 0) | (np.diff(col["cell"]) != 0)])
    end, own = _run_ends(fresh), _run_ends(fresh | np.concatenate([[True], np.diff(root) != 0]))
    counts = end - own  # a row meets those behind its root's
    ends = np.cumsum(counts)
    at, found = 0, []
    while at < len(x):
        stop = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")), at + 1)
        n = counts[at:stop]
        left = np.repeat(np.arange(at, stop), n)
        right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(own[at:stop], n)
        near = np.flatnonzero(np.bitwise_count(x[left] ^ x[right]) <= NEAR_BITS)
        left, right = left[near], right[near]
        near = np.bitwise_count(x[left] ^ x[right]) + np.bitwise_count(y[left] ^ y[right]) <= NEAR_BITS
        found.append(forest(root[left[near]], root[right[near]]))
        at = stop
    a, b = forest(*(np.concatenate(part) for part in zip(*found)))
    if len(a):
        yield pa.RecordBatch.from_pydict({"a": a, "b": b})


def _run_ends(fresh: np.ndarray) -> np.ndarray:
    """For each row the end of its run; runs start where ``fresh``."""
    starts = np.flatnonzero(fresh)
    bounds = np.append(starts, len(fresh))
    return np.repeat(bounds[1:], np.diff(bounds))


def near_candidates(nodes: DataFrame) -> DataFrame:
    """(node, root) of ``nodes`` (node, fp, more, keys) that are linked with another one or have its first word."""
    roots = components(near_links(nodes.select("fp", "more", "keys"))).withColumnRenamed("node", "fp")
    rooted = staged(nodes.select("node", "fp").join(roots, "fp", "left").select("node", F.coalesce("root", "fp").alias("root")))
    several = rooted.groupBy("root").agg(F.count("*").alias("_n")).where("_n > 1")
    return rooted.join(several.select("root"), "root", "left_semi").select("node", "root")


def near_texts(rows: DataFrame, member: Column, text: str = "text", row: str = "row_id") -> DataFrame:
    """(row, member, least) of ``rows``: ``least`` is the smallest ``member`` of the group of texts that share 80 % of their shingles.

    Shingles, limit and the check by exact sets are those of ``minhash``; multi-index
    hashing of long fingerprints finds what is checked.  ``row`` is unique and
    ``rows`` gives the same one each time it is read.
    """
    signed = _long_signed(rows, [F.col(row), member.alias("member")], text)
    return minhash.settled(rows, signed, near_candidates, text, row)
