"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

One inserted, deleted or replaced code point moves a word's vector of letter
counts by an L1 distance of at most two: one letter more, one less, or one of
each.  Spark counts the words of all texts.  The words of every length are cut
into cells by a k-d tree over their vectors; a word is searched in the cells of
its own length and of the next length whose boxes such a step can reach.  Inside
a cell a second tree holds the cell's different vectors, searched the same way;
words of the vectors found are compared letter by letter, and a vector with very
many words (anagrams) is probed with the few forms that the step allows.

The trees that cut cells are fitted on a sample of the different words (about
SAMPLE_PER_CELL words a cell, chosen by hash) and only decide where a word lies:
every word is indexed and searched.  Cells with more words than fit (vectors that
no cut parts) are dealt to blocks by hash, each searched.  A cell's words come
first in its task, then the words that are searched there stream by, so a task
holds one block.  A pair of equal length is looked for from one side only.

Special rows.  A NULL text has no word.  Repeated rows count each.  A NULL id
stands as nothing before the colon.  Other columns play no part.  An empty table
gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import slices, staged_batches
from pairloom.session import staged

MIN_CHARS, MIN_COUNT = 7, 2
#: A form occurs at least so many times as often as the word it is the form of.
TIMES = 10
#: One in so many (document, word) pairs is misspelled on purpose.
TYPOS = 31

#: Words, and letters, of a cell at most (twice that before it is cut into blocks).
CELL, CELL_LETTERS = 1 << 15, 32 << 20
#: Words of the sample for each cell.
SAMPLE_PER_CELL = 32
#: Vectors of a leaf of the tree inside a cell.
LEAF = 32
#: Words of one vector above which forms are probed instead of comparing each.
MANY = 64

#: Lower-case letters a-z, then U+00C0 to U+00FF.
_DIMS = 26 + 64
_DIM = np.full(256, 0, np.int64)
_DIM[ord("a") : ord("z") + 1] = np.arange(26)
_DIM[0xC0:] = np.arange(26, _DIMS)
_FAR = 1 << 30


def misspelled(word: str, seed: int) -> str:
    """``word`` without one code point where TYPOS divides its hash; ``seed`` is the crc32 of what stands before it."""
    h = zlib.crc32(word.encode(), seed)
    if h % TYPOS:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def count_words(docs: DataFrame, doc_id: str, text: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """(word, n): every word of all texts and how often it occurs."""
    # a shorter run cannot become a word
    run = re.compile(f"[a-zÀ-ÿ]{{{min_chars},}}")

    def count(batches):
        for batch in slices(batches, "text"):
            total: Counter[str] = Counter()
            for own, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                found = Counter(run.findall((text or "").encode().lower().decode()))
                seed = zlib.crc32(f"{'' if own is None else own}:".encode())
                for word, n in found.items():
                    total[misspelled(word, seed)] += n
            kept = [(w, n) for w, n in total.items() if len(w) >= min_chars]
            words, counts = zip(*kept) if kept else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# --- trees -------------------------------------------------------------------


def _matrix(words: list[str]) -> np.ndarray:
    """The letters of words of one length; all of them have one byte."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _vectors(letters: np.ndarray) -> np.ndarray:
    """How often each letter occurs in each word."""
    n, length = letters.shape
    at = np.repeat(np.arange(n) * _DIMS, length) + _DIM[letters.ravel()]
    kind = np.int16 if length < 1 << 14 else np.int32
    return np.bincount(at, minlength=n * _DIMS).reshape(n, _DIMS).astype(kind)


@dataclass
class Tree:
    """A k-d tree: nodes with a letter and a count to part by, and leaves."""

    dim: list[int] = field(default_factory=list)  # -1 for a leaf
    cut: list[int] = field(default_factory=list)
    down: list[tuple[int, int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0
    held: list[np.ndarray] = field(default_factory=list)  # rows of each leaf

    @classmethod
    def fit(cls, x: np.ndarray, most: float) -> Tree:
        """Cuts ``x`` until no leaf has more than ``most`` rows, or rows that are all equal."""
        tree = cls()
        tree._node(x, np.arange(len(x)), most)
        return tree

    def _node(self, x: np.ndarray, rows: np.ndarray, most: float) -> int:
        me = len(self.dim)
        self.dim.append(-1), self.cut.append(0), self.down.append((-1, -1)), self.leaf.append(-1)
        best = _halves(x[rows]) if len(rows) > most else None
        if best is None:
            self.leaf[me] = self.leaves
            self.leaves += 1
            self.held.append(rows)
            return me
        self.dim[me], self.cut[me] = best
        low = x[rows, best[0]] <= best[1]
        self.down[me] = (self._node(x, rows[low], most), self._node(x, rows[~low], most))
        return me

    def walk(self, x: np.ndarray, more: int, less: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of x): leaves whose box is at most ``more`` letters more and ``less`` letters less away."""
        zero = np.zeros(len(x), np.int64)
        stack = [(0, np.arange(len(x)), zero, zero, {})]
        while stack:
            node, at, up, off, box = stack.pop()
            if not len(at):
                continue
            dim = self.dim[node]
            if dim < 0:
                yield self.leaf[node], at
                continue
            cut, (least, largest), c = self.cut[node], box.get(dim, (0, _FAR)), x[at, dim].astype(np.int64)
            new = off - np.maximum(c - largest, 0) + np.maximum(c - cut, 0)
            go = new <= less
            stack.append((self.down[node][0], at[go], up[go], new[go], {**box, dim: (least, cut)}))
            new = up - np.maximum(least - c, 0) + np.maximum(cut + 1 - c, 0)
            go = new <= more
            stack.append((self.down[node][1], at[go], new[go], off[go], {**box, dim: (cut + 1, largest)}))


def _halves(x: np.ndarray) -> tuple[int, int] | None:
    """The letter and the count that part the rows most evenly; None if all are equal."""
    best, n = None, len(x)
    least, largest = x.min(axis=0), x.max(axis=0)
    for dim in np.flatnonzero(least < largest):
        below = np.cumsum(np.bincount(x[:, dim] - least[dim]))[:-1]
        at = int(np.abs(2 * below - n).argmin())
        if best is None or abs(2 * below[at] - n) < best[0]:
            best = (abs(2 * below[at] - n), int(dim), at + int(least[dim]))
    return best and best[1:]


# --- cells -------------------------------------------------------------------


def _most(length: int, cell: int) -> int:
    return max(min(cell, CELL_LETTERS // length), 1)


@dataclass
class Cells:
    """Where words lie and where they are searched."""

    trees: dict[int, Tree]  # by length; other lengths are one cell
    blocks: dict[tuple[int, int], int]  # of (length, leaf); other cells are one block

    def _at(self, length: int, x: np.ndarray, more: int, less: int):
        if length in self.trees:
            yield from self.trees[length].walk(x, more, less)
        else:
            yield 0, np.arange(len(x))

    def homes(self, length: int, words: list[str], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf and block of each word."""
        leaf, block = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for number, at in self._at(length, x, 0, 0):
            leaf[at] = number
            parts = self.blocks.get((length, number), 1)
            if parts > 1:
                block[at] = [zlib.crc32(words[i].encode()) % parts for i in at]
        return leaf, block

    def searches(self, length: int, x: np.ndarray, home: tuple[np.ndarray, np.ndarray]):
        """(length, leaf, block, rows) of the other cells to search words in."""
        for target, less in ((length, 1), (length + 1, 0)):
            for number, at in self._at(target, x, 1, less):
                for block in range(self.blocks.get((target, number), 1)):
                    later = (home[0][at] < number) | ((home[0][at] == number) & (home[1][at] < block))
                    rows = at if target != length else at[later]
                    if len(rows):
                        yield target, number, block, rows


_ROUTED = "len int, leaf int, block int, asks int, word string, n long"


def _by_length(batch: pa.RecordBatch):
    """(length, rows, words) of a batch of words."""
    words, lengths = batch.column("word").to_pylist(), pc.utf8_length(batch.column("word")).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        yield length, rows, [words[i] for i in rows]


def fit_cells(words: DataFrame, cell: int = CELL) -> Cells:
    """Trees for the lengths that need them, and the cells that are cut into blocks."""
    length = F.length("word").alias("len")
    most = F.greatest(F.least(F.lit(cell), F.floor(F.lit(CELL_LETTERS) / F.col("len"))), F.lit(1))
    # lengths that do not fit one cell: a row for each ``cell`` words at most
    sizes = {r.len: r["count"] for r in words.groupBy(length).count().where(F.col("count") > most).collect()}
    trees = {}
    if sizes:
        chosen = words.select("word", length).where(F.col("len").isin(list(sizes)))
        # one in cell / SAMPLE_PER_CELL words, more of lengths whose cells hold fewer
        share = F.least(F.lit(float(SAMPLE_PER_CELL)) / most, F.lit(1.0))
        drawn = chosen.where(F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < share * (1 << 20))
        sample: dict[int, list[str]] = {}
        for row in drawn.collect():
            sample.setdefault(row.len, []).append(row.word)
        for n, found in sample.items():
            trees[n] = Tree.fit(_vectors(_matrix(sorted(found))), _most(n, cell) * len(found) / sizes[n])
            trees[n].held = []
    cells = Cells(trees, {})
    shared = words.sparkSession.sparkContext.broadcast(cells)  # a node for each few thousand words

    def home(batches):
        for batch in batches:
            for n, rows, found in _by_length(batch):
                leaf, _ = shared.value.homes(n, found, _vectors(_matrix(found)))
                names, counts = np.unique(leaf, return_counts=True)
                columns = [np.full(len(names), n, np.int32), names.astype(np.int32), counts]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["len", "leaf", "count"])

    if sizes:
        counts = words.where(F.length("word").isin(list(sizes))).select("word").mapInArrow(home, "len int, leaf int, count long")
        large = counts.groupBy("len", "leaf").agg(F.sum("count").alias("count")).where(F.col("count") > 2 * most).collect()
        cells.blocks = {(r.len, r.leaf): -(-r["count"] // _most(r.len, cell)) for r in large}
    return cells


def _route(words: DataFrame, cells: Cells) -> DataFrame:
    shared = words.sparkSession.sparkContext.broadcast(cells)

    def route(batches):
        for batch in batches:
            for n, rows, found in _by_length(batch):
                x, mine = _vectors(_matrix(found)), batch.take(pa.array(rows))
                home = shared.value.homes(n, found, x)
                yield _placed(mine, n, *home, 0)
                for target, leaf, block, at in shared.value.searches(n, x, home):
                    yield _placed(mine.take(pa.array(at)), target, np.full(len(at), leaf), np.full(len(at), block), 1)

    return words.select("word", "n").mapInArrow(route, _ROUTED)


def _placed(rows: pa.RecordBatch, length: int, leaf: np.ndarray, block: np.ndarray, asks: int) -> pa.RecordBatch:
    size = rows.num_rows
    numbers = [np.full(size, length), leaf, block, np.full(size, asks)]
    columns = [pa.array(c.astype(np.int32)) for c in numbers] + [rows.column("word"), rows.column("n")]
    return pa.RecordBatch.from_arrays(columns, names=["len", "leaf", "block", "asks", "word", "n"])


class _Cell:
    """A block's words under a tree of their different vectors."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.words, self.n, self.letters = words, n, _matrix(words)
        bag = np.sort(self.letters, axis=1)  # equal for words of equal vectors
        _, first, same = np.unique(bag.view(f"V{bag.shape[1]}").ravel(), return_index=True, return_inverse=True)
        self.vectors = _vectors(self.letters[first])
        self.members, self.sizes = np.argsort(same, kind="stable"), np.bincount(same)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.tree = Tree.fit(self.vectors, LEAF)

    def near(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``words``, row of the cell): all pairs one edit apart; ``words`` are as long or one shorter."""
        letters = _matrix(words)
        equal = letters.shape[1] == self.letters.shape[1]
        x = _vectors(letters)
        used = np.flatnonzero(self.vectors.any(axis=0) | x.any(axis=0))
        mine, theirs = self.vectors[:, used], x[:, used]
        found = [np.zeros((2, 0), np.int64)]
        for leaf, at in self.tree.walk(x, 1, 1 if equal else 0):
            held = self.tree.held[leaf]
            step = max((1 << 22) // (len(held) * len(used)), 1)
            for part in (at[i : i + step] for i in range(0, len(at), step)):
                apart = np.abs(theirs[part][:, None, :] - mine[held][None, :, :]).sum(axis=2)
                q, v = np.nonzero(apart == (2 if equal else 1))
                found.append(self._checked(words, letters, part[q], held[v], equal))
        return tuple(np.concatenate(found, axis=1))

    def _checked(self, words: list[str], letters: np.ndarray, q: np.ndarray, v: np.ndarray, equal: bool) -> np.ndarray:
        few = self.sizes[v] <= MANY
        many = [self._forms(words[i], int(j), equal) for i, j in zip(q[~few], v[~few])]
        probed = [np.repeat(q[~few], [len(m) for m in many]), np.concatenate([np.zeros(0, np.int64), *many])]
        q, v = q[few], v[few]
        sizes = self.sizes[v]
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        w, q = self.members[np.repeat(self.starts[v], sizes) + inside], np.repeat(q, sizes)
        step, ok = max((1 << 23) // self.letters.shape[1], 1), [np.zeros(0, bool)]
        for i in range(0, len(q), step):
            ok.append((_replaced if equal else _inserted)(letters[q[i : i + step]], self.letters[w[i : i + step]]))
        ok = np.concatenate(ok)
        return np.concatenate([np.stack([q[ok], w[ok]]), np.stack(probed).astype(np.int64)], axis=1)

    def _forms(self, word: str, vector: int, equal: bool) -> np.ndarray:
        """Rows of the words of a vector that are one edit from ``word``."""
        held = self._of(vector)
        delta = self.vectors[vector].astype(np.int64) - _vectors(_matrix([word]))[0]
        new = _LETTERS[int(delta.argmax())]
        if equal:
            old = _LETTERS[int(delta.argmin())]
            forms = {word[:i] + new + word[i + 1 :] for i, c in enumerate(word) if c == old}
        else:
            forms = {word[:i] + new + word[i:] for i in range(len(word) + 1)}
        return np.array([held[f] for f in forms if f in held], np.int64)

    def _of(self, vector: int) -> dict[str, int]:
        if not hasattr(self, "_large"):
            self._large: dict[int, dict[str, int]] = {}
        if vector not in self._large:
            rows = self.members[self.starts[vector] : self.starts[vector] + self.sizes[vector]]
            self._large[vector] = {self.words[i]: int(i) for i in rows}
        return self._large[vector]


_LETTERS = [chr(c) for c in [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]]


def _replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def _inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Is ``b`` the word ``a`` with one letter more?"""
    front, back = a == b[:, :-1], (a == b[:, 1:])[:, ::-1]
    run = lambda same: np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1))
    return run(front) + run(back) >= a.shape[1]


def near_words(words: DataFrame, cell: int = CELL) -> DataFrame:
    """(word, near, near_n): both directions of every pair of ``words`` (word, n) one edit apart."""
    routed = _route(words, fit_cells(words, cell))
    place = ["len", "leaf", "block"]

    def search(batches):
        now, held, cell = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in [*place, "asks"]], axis=1)
            turns = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *turns], [*turns, len(keys)]):
                if start == end:
                    continue
                rows, key = batch.slice(start, end - start), tuple(keys[start][:3])
                if key != now:
                    if held and cell is None:
                        yield from _pairs(_built(held), None)
                    now, held, cell = key, [], None
                if not keys[start][3]:
                    held.append(rows)
                elif held:
                    if cell is None:
                        cell = _built(held)
                        yield from _pairs(cell, None)
                    yield from _pairs(cell, rows)
        if held and cell is None:
            yield from _pairs(_built(held), None)

    dealt = routed.repartition(*place).sortWithinPartitions(*place, "asks")
    return dealt.mapInArrow(search, "word string, near string, near_n long")


def _built(held: list[pa.RecordBatch]) -> _Cell:
    table = pa.Table.from_batches(held)
    return _Cell(table.column("word").to_pylist(), table.column("n").to_numpy())


def _pairs(cell: _Cell, rows: pa.RecordBatch | None):
    """What is near in a cell: of its own words, each the other's, or of the words that are searched there."""
    theirs, names = pa.array(cell.words, pa.string()), ["word", "near", "near_n"]
    if rows is None:
        q, w = cell.near(cell.words)
        yield pa.RecordBatch.from_arrays([theirs.take(pa.array(q)), theirs.take(pa.array(w)), pa.array(cell.n[w])], names=names)
        return
    for _, at, words in _by_length(rows):
        q, w = cell.near(words)
        asked, found = pa.array(words, pa.string()).take(pa.array(q)), theirs.take(pa.array(w))
        yield pa.RecordBatch.from_arrays([asked, found, pa.array(cell.n[w])], names=names)
        yield pa.RecordBatch.from_arrays([found, asked, rows.column("n").take(pa.array(at[q]))], names=names)


# --- forms -------------------------------------------------------------------


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of ``links`` (word, form): where a chain of forms ends.

    Every round doubles the steps that a row has gone; forms grow TIMES times as
    frequent with each step, so chains are short.
    """
    now = staged(links.select("word", F.col("form").alias("root")))
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = staged(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"))
        if now.where("next IS NOT NULL").isEmpty():
            return now.select("word", "root")
        now = now.drop("next")


def variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
    cell: int = CELL,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word with ``min_count`` occurrences or more."""
    words = staged_batches(count_words(docs, doc_id, text, min_chars).where(F.col("n") >= min_count))
    near = staged_batches(near_words(words, cell))
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    form = F.when(-F.col("best.less") >= TIMES * F.col("n"), F.col("best.near"))
    formed = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form.alias("form"),
        F.when(form.isNotNull(), -F.col("best.less")).alias("form_n"),
    )
    formed = staged(formed)
    return formed.join(roots(formed.where("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
