"""Hard negatives for anchors, by angular triangle filtering.

Every row keeps its length and its angles to a few reference directions.  For an
anchor and a row the angles to one reference bound the angle between the two: it
is at least their difference and at most their sum.  The best of these bounds,
as cosines times both lengths and widened by what rounding can do, is an interval
that holds the score.  A row is scored, in whole numbers, only if its interval
reaches the window that is asked for: for positives, the rows of the anchor's
label above the worst one kept so far; for negatives, the other rows inside a
positive's window and above the worst one kept there.

Rows are written in blocks of BLOCK, rows near the same reference together, each
with the ranges of its angles, its largest length and its labels, so that most
blocks are passed over by their head alone.  A task has ANCHORS anchors at most
and goes through the blocks, the most promising first, reading one at a time and
carrying the best rows along: anchors and rows are never paired in a shuffle, and
only results leave the task.

The references are the mean directions of the most frequent labels in a sample
of SAMPLE rows; they decide how much can be passed over, never the result.

Special rows.  Rows with a NULL label or vector take no part.  Vectors meet only
vectors of their own length; an empty one scores 0.  A row is never its own
positive or negative, but another row with its id is.  Ties go to the smaller
id, NULL ids first; equal rows count each.  Scores are whole numbers below
2 ** 63.  Without anchors the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.session import scratch_path, staged

#: Rows of a block, and anchors that a task handles at once.
BLOCK, ANCHORS = 2048, 512
#: Reference directions, and rows of the sample they come from.
REFERENCES, SAMPLE = 16, 4096
#: References whose angles are compared row by row; a block's head uses all.
COMPARED = 4
#: How far an angle may be off, in radians: stored with 24 bits, and arccos of rounded cosines.
ROUNDING = 1e-5

_HEAD = ["width", "least", "largest", "norm", "labels"]
_DATA = {"ids": np.int64, "known": np.bool_, "rows": np.int64, "label": np.int64, "v": np.int64, "norms": np.float64, "angles": np.float32}
_BLOCKS = "width int, least array<float>, largest array<float>, norm double, labels array<long>, " + ", ".join(f"{c} binary" for c in _DATA)
_FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def references(rows: DataFrame, count: int = REFERENCES, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Reference directions (unit rows) for each vector length of a bounded sample of ``rows``."""
    drawn = rows.select("label", "v").orderBy(F.xxhash64("row")).limit(sample).collect()
    by_width: dict[int, dict[int, list]] = {}
    for row in drawn:
        by_width.setdefault(len(row.v), {}).setdefault(row.label, []).append(row.v)
    out = {}
    for width, labels in by_width.items():
        often = sorted(labels, key=lambda x: (-len(labels[x]), x))[:count]
        means = np.array([np.mean(np.array(labels[x], np.float64), axis=0) for x in often]).reshape(len(often), width)
        length = np.linalg.norm(means, axis=1)
        out[width] = means[length > 0] / length[length > 0, None]
    return out


def _angles(v: np.ndarray, norms: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Angles of rows to references; a zero vector has angle 0 (its scores are 0 whatever the angle)."""
    cosine = (v.astype(np.float64) @ refs.T) / np.where(norms > 0, norms, 1.0)[:, None]
    return np.where(norms[:, None] > 0, np.arccos(np.clip(cosine, -1.0, 1.0)), 0.0).astype(np.float32)


class Vectors:
    """Rows of one vector length with their lengths and angles."""

    def __init__(self, ids, known, rows, label, v, norms, angles):
        self.ids, self.known, self.rows, self.label, self.v, self.norms, self.angles = ids, known, rows, label, v, norms, angles

    @classmethod
    def of(cls, batch: pa.RecordBatch | pa.Table, refs: dict[int, np.ndarray]) -> Iterator[Vectors]:
        """The rows of a batch (vec_id, label, v, row), in their order, one part per vector length."""
        table = pa.table(batch) if isinstance(batch, pa.Table) else pa.Table.from_batches([batch])
        ids, lists = table.column("vec_id").combine_chunks(), table.column("v").combine_chunks()
        offsets, flat = lists.offsets.to_numpy(), lists.flatten().to_numpy(zero_copy_only=False)
        widths = np.diff(offsets)
        known, label, rows = ids.is_valid().to_numpy(zero_copy_only=False), table.column("label").to_numpy(), table.column("row").to_numpy()
        ids = ids.fill_null(0).to_numpy()
        for width in np.unique(widths).tolist():
            mine = np.flatnonzero(widths == width)
            v = flat[(offsets[mine] - offsets[0])[:, None] + np.arange(width)].reshape(len(mine), width).astype(np.int64)
            norms = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
            yield cls(ids[mine], known[mine], rows[mine], label[mine], v, norms, _angles(v, norms, refs.get(width, np.zeros((0, width)))))

    def part(self, at) -> Vectors:
        return Vectors(*(getattr(self, c)[at] for c in _DATA))

    def packed(self) -> dict:
        head = {
            "width": self.v.shape[1], "least": self.angles.min(axis=0).tolist(), "largest": self.angles.max(axis=0).tolist(),
            "norm": float(self.norms.max()), "labels": np.unique(self.label).tolist(),
        }
        return head | {c: np.ascontiguousarray(getattr(self, c), kind).tobytes() for c, kind in _DATA.items()}


class Blocks:
    """The blocks of a folder: all heads, and the rows of one block at a time."""

    def __init__(self, folder: str):
        self.files, base = fs.FileSystem.from_uri(folder)
        found = self.files.get_file_info(fs.FileSelector(base, recursive=True))
        self.open = [pq.ParquetFile(self.files.open_input_file(f.path)) for f in sorted(found, key=lambda f: f.path) if f.path.endswith(".parquet")]
        self.at, self.heads = [], []
        for file in self.open:
            for group in range(file.num_row_groups):
                for number, head in enumerate(file.read_row_group(group, _HEAD).to_pylist()):
                    self.at.append((file, group, number))
                    self.heads.append(head)

    def read(self, block: int) -> Vectors:
        file, group, number = self.at[block]
        row = file.read_row_group(group, list(_DATA)).slice(number, 1).to_pylist()[0]
        flat = {c: np.frombuffer(row[c], kind) for c, kind in _DATA.items()}
        n, width = len(flat["rows"]), self.heads[block]["width"]
        return Vectors(*(x.reshape(n, -1) if c == "angles" and len(x) else x.reshape(n, width) if c == "v" else np.zeros((n, 0)) if c == "angles" else x for c, x in flat.items()))


def write_blocks(rows: DataFrame, refs: dict[int, np.ndarray], block: int = BLOCK) -> str:
    """Write ``rows`` (vec_id, label, v, row, near, angle) in blocks; returns the folder."""
    shared = rows.sparkSession.sparkContext.broadcast(refs)  # REFERENCES directions per vector length

    def pack(batches):
        for batch in batches:
            for part in Vectors.of(batch, shared.value):
                for at in range(0, len(part.rows), block):
                    yield pa.RecordBatch.from_pylist([part.part(slice(at, at + block)).packed()], schema=_ARROW)

    folder = scratch_path(rows.sparkSession, "vectors")
    packed = _arranged(rows, None).mapInArrow(pack, _BLOCKS)
    # a row group per block, so that a block can be read alone
    packed.write.option("parquet.block.row.count.limit", "1").parquet(folder)
    return folder


_ARROW = pa.schema(
    [("width", pa.int32()), ("least", pa.list_(pa.float32())), ("largest", pa.list_(pa.float32())), ("norm", pa.float64()), ("labels", pa.list_(pa.int64()))]
    + [(c, pa.binary()) for c in _DATA]
)


def _arranged(rows: DataFrame, parts: int | None) -> DataFrame:
    """Rows of one length, near the same reference and at a like angle side by side."""
    keys = [F.size("v"), F.col("near"), F.col("angle"), F.col("row")]
    ranged = rows.repartitionByRange(parts, *keys) if parts else rows.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def _with_nearest(rows: DataFrame, refs: dict[int, np.ndarray]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(refs)

    def nearest(batches):
        for batch in batches:
            number = {int(r): i for i, r in enumerate(batch.column("row").to_pylist())}
            near, angle = np.full(batch.num_rows, -1, np.int32), np.zeros(batch.num_rows, np.float64)
            for part in Vectors.of(batch, shared.value):
                if part.angles.shape[1]:
                    at = [number[int(r)] for r in part.rows]
                    near[at], angle[at] = part.angles.argmin(axis=1), part.angles.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near), pa.array(angle)], names=[*batch.schema.names, "near", "angle"])

    return rows.mapInArrow(nearest, "vec_id long, label long, v array<long>, row long, is_anchor boolean, near int, angle double")


def intervals(anchors: Vectors, rows: Vectors) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers (anchor x row) that the scores cannot be below or above."""
    a, x = anchors.angles, rows.angles
    shape = (len(a), len(x))
    near, far = np.zeros(shape, np.float32), np.full(shape, np.pi, np.float32)
    if a.shape[1]:
        # where the two sides differ most, and where they are closest to the reference
        mine, theirs = a.mean(axis=0), x.mean(axis=0)
        apart = np.argsort(-np.abs(mine - theirs))[: COMPARED // 2]
        close = np.argsort(mine + theirs)[: COMPARED - COMPARED // 2]
        for r in np.unique(np.concatenate([apart, close])):
            p, q = a[:, r][:, None], x[:, r][None, :]
            np.maximum(near, np.abs(p - q), out=near)
            np.minimum(far, np.minimum(p + q, 2 * np.pi - p - q), out=far)
    lengths = anchors.norms[:, None] * rows.norms[None, :]
    upper = lengths * np.cos(np.maximum(near - ROUNDING, 0.0))
    lower = lengths * np.cos(np.minimum(far + ROUNDING, np.pi))
    slack = lengths * ROUNDING + 1.0
    return lower - slack, upper + slack


def _best_of_block(anchors: Vectors, head: dict) -> np.ndarray:
    """What no score of a block can be above, per anchor."""
    near = np.zeros(len(anchors.rows))
    if anchors.angles.shape[1]:
        least, largest = np.array(head["least"], np.float32), np.array(head["largest"], np.float32)
        near = np.maximum(np.maximum(anchors.angles - largest, least - anchors.angles), 0).max(axis=1)
    lengths = anchors.norms * head["norm"]
    # a negative bound is largest for the shortest rows, which the head does not tell
    return np.maximum(lengths * np.cos(np.maximum(near - ROUNDING, 0.0)), 0.0) + lengths * ROUNDING + 1.0


def _scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    top = int(np.abs(a).max(initial=0)) * int(np.abs(x).max(initial=0)) * max(a.shape[1], 1)
    kind = np.float64 if top < 1 << 53 else np.int64  # whole numbers are exact in either
    return (a.astype(kind) @ x.astype(kind).T).astype(np.int64)


class _Best:
    """The ``k`` best rows of each of ``n`` questions so far."""

    def __init__(self, n: int, k: int, least: np.ndarray):
        self.k, self.bar = k, least.copy()  # scores below the bar are of no use
        self.found = [np.zeros(0, np.int64) for _ in range(4)]  # question, score, known, id

    def add(self, question: np.ndarray, score: np.ndarray, known: np.ndarray, ids: np.ndarray) -> None:
        if not len(question):
            return
        every = [np.concatenate(c) for c in zip(self.found, (question, score, known.astype(np.int64), ids))]
        order = np.lexsort((every[3], every[2], -every[1], every[0]))
        q = every[0][order]
        starts = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
        place = np.arange(len(q)) - np.repeat(starts, np.diff([*starts, len(q)]))
        self.found = [c[order][place < self.k] for c in every]
        full = place == self.k - 1
        self.bar[q[full]] = np.maximum(self.bar[q[full]], every[1][order][full])


def _search(blocks: Blocks, anchors: Vectors, wanted, ask) -> None:
    """Go through the blocks; ``ask(anchors' rows, block)`` where ``wanted(upper bounds, head)`` names any anchor."""
    width = anchors.v.shape[1]
    mine = [b for b, head in enumerate(blocks.heads) if head["width"] == width]
    tops = {b: _best_of_block(anchors, blocks.heads[b]) for b in mine}
    for b in sorted(mine, key=lambda b: -tops[b].sum()):
        at = np.flatnonzero(wanted(tops[b], blocks.heads[b]))
        if len(at):
            ask(at, blocks.read(b))


def hardest(blocks: Blocks, anchors: Vectors, positives: int, negatives: int, low: int, high: int) -> list[tuple]:
    """Rows of the result for a few anchors: see ``mine``."""
    least = np.iinfo(np.int64).min // 4
    near = _Best(len(anchors.rows), positives, np.full(len(anchors.rows), least))

    def same_label(tops, head):
        return (tops >= near.bar) & np.isin(anchors.label, head["labels"])

    def positive(at, rows):
        few = anchors.part(at)
        _, upper = intervals(few, rows)
        open_ = (few.label[:, None] == rows.label[None, :]) & (few.rows[:, None] != rows.rows[None, :]) & (upper >= near.bar[at][:, None])
        _ask(near, few, rows, open_, lambda q: at[q])

    _search(blocks, anchors, same_label, positive)
    of, score, known, ids = near.found
    if not len(of):
        return []
    # a window per anchor and positive: percentages of the positive's score
    first, last = -((-low * score) // 100), (high * score) // 100
    hard = _Best(len(of), negatives, first)

    def other_label(tops, head):
        reached = np.zeros(len(tops), bool)
        np.logical_or.at(reached, of, (tops[of] >= hard.bar) & (first <= last))
        return reached

    def negative(at, rows):
        few = anchors.part(at)
        lower, upper = intervals(few, rows)
        other = few.label[:, None] != rows.label[None, :]
        back = np.full(len(anchors.rows), -1)
        back[at] = np.arange(len(at))
        asked = np.flatnonzero((back[of] >= 0) & (first <= last))
        reach = np.zeros_like(other)
        np.logical_or.at(reach, back[of[asked]], (upper[back[of[asked]]] >= hard.bar[asked][:, None]) & (lower[back[of[asked]]] <= last[asked][:, None]))
        open_ = other & reach
        rows_at = np.flatnonzero(open_.any(axis=0))
        exact = _scores(few.v, rows.v[rows_at])
        for question in asked:
            i = back[of[question]]
            s = exact[i]
            q = np.flatnonzero(open_[i, rows_at] & (s >= hard.bar[question]) & (s <= last[question]))
            hard.add(np.full(len(q), question), s[q], rows.known[rows_at[q]], rows.ids[rows_at[q]])

    _search(blocks, anchors, other_label, negative)
    out, rank = [], {}
    for question, s, k, i in zip(*(c.tolist() for c in hard.found)):
        rank[question] = rank.get(question, 0) + 1
        anchor = int(of[question])
        out.append(
            (
                int(anchors.ids[anchor]) if anchors.known[anchor] else None, int(ids[question]) if known[question] else None,
                rank[question], i if k else None, int(score[question]), s,
            )
        )
    return out


def _ask(best: _Best, few: Vectors, rows: Vectors, open_: np.ndarray, question) -> None:
    """Score the open pairs and hand on those above the bar."""
    rows_at = np.flatnonzero(open_.any(axis=0))
    if not len(rows_at):
        return
    exact = _scores(few.v, rows.v[rows_at])
    names = question(np.arange(len(few.rows)))
    q, x = np.nonzero(open_[:, rows_at] & (exact >= best.bar[names][:, None]))
    best.add(names[q], exact[q, x], rows.known[rows_at[x]], rows.ids[rows_at[x]])


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    block: int = BLOCK, anchors: int = ANCHORS,
) -> DataFrame:
    """For each anchor row and each of its ``positives`` best rows of the same label, its ``negatives`` best rows of
    other labels that score ``low`` to ``high`` per cent of the positive; ``rows`` are (vec_id, label, v)."""
    kept = rows.where("label IS NOT NULL AND v IS NOT NULL").select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), "v", F.monotonically_increasing_id().alias("row"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    kept = staged(kept)
    refs = references(kept)
    near = staged(_with_nearest(kept, refs))
    folder = write_blocks(near.drop("is_anchor"), refs, block)
    asked = near.where("is_anchor").drop("is_anchor")
    parts = max(-(-asked.count() // anchors), 1)
    shared = rows.sparkSession.sparkContext.broadcast(refs)

    def search(batches):
        blocks = None
        for batch in batches:
            for part in Vectors.of(batch, shared.value):
                blocks = blocks or Blocks(folder)
                for at in range(0, len(part.rows), anchors):
                    found = hardest(blocks, part.part(slice(at, at + anchors)), positives, negatives, low, high)
                    columns = zip(*found) if found else [()] * 6
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RESULT)], schema=_RESULT)

    return _arranged(asked, parts).mapInArrow(search, _FOUND)


_RESULT = pa.schema(
    [("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()), ("negative_id", pa.int64()),
     ("positive_score", pa.int64()), ("negative_score", pa.int64())]
)
