"""Greedy longest-match word-piece counts by a linear automaton.

The vocabulary is a trie.  Each node has a failure link: the node that stands
for the same text once its longest leading pieces are taken off, and the number
of pieces that takes off.  A word is read once, sign by sign; where the trie has
no way on, the link is followed and its count added.  No piece is ever built.

A word the vocabulary cannot cover counts as one (unknown) piece.  A NULL or
empty text has no piece.  Repeated rows are counted each; other columns play no
part.
"""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import Words, schema, slices

#: Letters, single digits, or runs of other signs.
PARTS = re.compile(r"[^\W\d_]+|\d|(?:[^\w\s]|_)+")


class Automaton:
    """Counts pieces of byte strings; ``later`` pieces continue a word, ``first`` ones begin it.

    With one vocabulary for both, pass it as ``first`` only.
    """

    def __init__(self, first: Iterable[bytes], later: Iterable[bytes] | None = None):
        self.go: list[dict[int, int]] = [{}]
        ends = self._insert(0, first)
        self.base = 0
        if later is not None:
            self.base = len(self.go)
            self.go.append({})
            ends |= self._insert(self.base, later)
        self.fail, self.pops = [-1] * len(self.go), [0] * len(self.go)
        self._link(ends)

    def _insert(self, root: int, pieces: Iterable[bytes]) -> set[int]:
        ends = set()
        for piece in pieces:
            node = root
            for sign in piece:
                if sign not in self.go[node]:
                    self.go[node][sign] = len(self.go)
                    self.go.append({})
                node = self.go[node][sign]
            if node != root:
                ends.add(node)
        return ends

    def _link(self, ends: set[int]) -> None:
        # by depth, so that links of shorter texts are known
        queue = deque(dict.fromkeys([0, self.base]))
        while queue:
            node = queue.popleft()
            for sign, child in self.go[node].items():
                if child in ends:
                    self.fail[child], self.pops[child] = self.base, 1
                else:
                    to, pops = self.fail[node], self.pops[node]
                    while to >= 0 and sign not in self.go[to]:
                        pops += self.pops[to]
                        to = self.fail[to]
                    if to >= 0:
                        self.fail[child], self.pops[child] = self.go[to][sign], pops
                queue.append(child)

    def count(self, word: bytes) -> int:
        if not word:
            return 0
        go, fail, pops = self.go, self.fail, self.pops
        node = total = 0
        for sign in word:
            while (to := go[node].get(sign)) is None:
                if fail[node] < 0:
                    return 1
                total += pops[node]
                node = fail[node]
            node = to
        while node != self.base:
            if fail[node] < 0:
                return 1
            total += pops[node]
            node = fail[node]
        return total


def byte_pieces(path: str) -> list[bytes]:
    """The vocabulary of a byte-level tokenizer file, without special tokens and word-end marks."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = {t["content"] for t in spec["added_tokens"]}
    mark = spec["model"].get("end_of_word_suffix") or ""
    # byte-level files write printable bytes as themselves and the others from U+0100 on
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in shown}
    signs.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))})
    pieces = set()
    for token in spec["model"]["vocab"]:
        if token not in special:
            pieces.add(bytes(signs[c] for c in (token[: -len(mark)] if mark and token.endswith(mark) else token)))
    return sorted(pieces)


def token_counts(docs: DataFrame, automaton: Automaton, keep: list[Column], text: str = "text") -> DataFrame:
    """``keep`` columns with ``n_parts`` (words as ``PARTS`` cuts lower-cased text) and ``n_tokens``."""
    rows = docs.select(*keep, F.col(text).alias("__text"))
    kept = rows.columns[:-1]
    shared = docs.sparkSession.sparkContext.broadcast(automaton)  # as large as the vocabulary

    def count(batches):
        known: dict[str, int] = {}
        for batch in slices(batches, "__text"):
            words = Words(batch.column("__text"))
            parts, tokens = _counts(shared.value, words.distinct.to_pylist(), known)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(words.sums(parts)), pa.array(words.sums(tokens))],
                names=[*kept, "n_parts", "n_tokens"],
            )
            if len(known) > 500_000:  # a cache: what it forgets is counted again
                known.clear()

    return rows.mapInArrow(count, schema(rows, kept, "n_parts long, n_tokens long"))


def _counts(automaton: Automaton, words: list[str], known: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    n_parts, n_tokens = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    for i, word in enumerate(words):
        parts = PARTS.findall(word.lower())
        total = 0
        for part in parts:
            n = known.get(part)
            if n is None:
                n = known[part] = automaton.count(part.encode())
            total += n
        n_parts[i], n_tokens[i] = len(parts), total
    return n_parts, n_tokens
