"""Spelling variants, hard negatives and line deduplication against brute force."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import linededup, negatives, spelling

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# 11. spelling variants


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def near_pairs(words):
    return {(a, b) for a in words for b in words if one_edit(a, b)}


@pytest.mark.parametrize("cell,many", [(4, 64), (16, 1), (1 << 15, 2)])
def test_near_words_match_brute_force(spark, monkeypatch, cell, many):
    rng = random.Random(cell)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randint(4, 7))) for _ in range(150)}
    words |= {"".join(p) for p in itertools.permutations("abcde")}  # one vector
    words |= {"".join(p) for p in itertools.permutations("abcdx")} | {"z" * 40_000, "z" * 40_001, "y" + "z" * 39_999}
    frame = spark.createDataFrame([(w, len(w)) for w in words], "word string, n long")
    monkeypatch.setattr(spelling, "MANY", many)
    monkeypatch.setattr(spelling, "LEAF", 3)
    got = spelling.near_words(frame, cell).collect()
    assert len(got) == len({(r.word, r.near) for r in got})
    assert {(r.word, r.near) for r in got} == near_pairs(words)
    assert all(r.near_n == len(r.near) for r in got)


def test_cells_cut_and_block(spark):
    words = ["".join(p) for p in itertools.permutations("abcdef")] + ["aaaaaa", "bbbbbb"]
    cells = spelling.fit_cells(spark.createDataFrame([(w, 1) for w in words], "word string, n long"), 16)
    assert cells.trees[6].leaves > 1 and max(cells.blocks.values()) >= 40


def test_tree_walk_reaches_all_within_reach():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 4, (300, spelling._DIMS)) * (rng.random((300, spelling._DIMS)) < 0.08)
    tree = spelling.Tree.fit(x, 5)
    home = np.full(len(x), -1)
    for leaf, at in tree.walk(x, 0, 0):
        assert (home[at] == -1).all()
        home[at] = leaf
    seen = {(int(q), leaf) for leaf, at in tree.walk(x, 1, 1) for q in at}
    for a in range(len(x)):
        for b in range(len(x)):
            more, less = np.maximum(x[b] - x[a], 0).sum(), np.maximum(x[a] - x[b], 0).sum()
            if more <= 1 and less <= 1:
                assert (a, int(home[b])) in seen


def brute_variants(rows, least=7, twice=2):
    import re

    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= least and c >= twice}
    near, out = defaultdict(set), []
    for a, b in near_pairs(n):
        near[a].add(b)
    form = {}
    for w in n:
        best = min(near[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def test_variants_match_brute_force(spark):
    rng = random.Random(5)
    stems = ["Encyclopedia", "Überraschung", "francês", "colourful", "mathematik", "aaaaaaaa"]
    rows = [(i, " ".join(rng.choice(stems) for _ in range(200))) for i in range(12)]
    for k, stem in enumerate(stems):  # chains: rarer words one edit further
        word = stem
        for n in (3, 2):
            word = word[:2] + "q" + word[3:] if n == 3 else word + "x"
            rows.append((100 + k, f" {word}" * n * (10 if n == 3 else 1)))
    rows += [(None, "Encyclopedia encyclopedia"), (7, None), (8, ""), (8, ""), (9, " 123 ×÷×÷×÷× ÀÀÀÀÀÀÀ"), (9, "k" * 50_000 + " " + "k" * 50_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("word", "n", "root", "len", "leaf")})
    got = spelling.variants(frame, cell=8).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_variants(rows), key=str)
    assert any(r.root not in (r.word, r.form) for r in got)  # a chain of two


def test_variants_of_nothing(spark, empty):
    assert spelling.variants(empty).count() == 0


# 12. hard negatives


def brute_negatives(rows):
    out = []
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda s, i: (-s, i is not None, i or 0)
    for at, (i, label, v) in enumerate(rows):
        if label is None or v is None or i is None or i % 50:
            continue
        others = [(score(v, w), j, m) for k, (j, m, w) in enumerate(rows) if k != at and m is not None and w is not None and len(w) == len(v)]
        others.sort(key=lambda o: order(o[0], o[1]))
        for ps, p, _ in [o for o in others if o[2] == label][:5]:
            hard = [o for o in others if o[2] != label and 50 * ps <= 100 * o[0] <= 95 * ps][:3]
            out += [(i, p, rank, j, ps, s) for rank, (s, j, _) in enumerate(hard, 1)]
    return sorted(out, key=str)


def vectors(rng, n, width, big=200):
    centre = rng.integers(-big, big, (4, width))
    rows = []
    for i in range(n):
        label = int(rng.integers(0, 4))
        v = (centre[label] * rng.random() + rng.integers(-big // 4, big // 4 + 1, width)).astype(int).tolist()
        rows.append((i, label, v))
    return rows


@pytest.mark.parametrize("block,anchors,big", [(7, 1, 200), (2048, 512, 200), (16, 2, 50_000_000)])
def test_negatives_match_brute_force(spark, block, anchors, big):
    rng = np.random.default_rng(block)
    rows = vectors(rng, 260, 8, big)
    rows += [(i + 600, lab, v[:3]) for i, lab, v in vectors(rng, 60, 8)]  # of another length
    rows += [(50, 1, rows[3][2]), (0, *rows[0][1:]), (0, *rows[0][1:]), (700, None, rows[1][2]), (750, 2, None), (None, 3, rows[9][2])]
    rows += [(800, 0, []), (801, 0, []), (802, 1, []), (850, 1, [0] * 8), (851, 1, [0] * 8), (852, 2, [0] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, v array<long>").repartition(3)
    frame = frame.withColumns({c: F.lit(1) for c in ("row", "near", "angle", "is_anchor")})
    got = negatives.mine(frame, F.col("vec_id") % 50 == 0, block=block, anchors=anchors).collect()
    assert sorted(map(tuple, got), key=str) == brute_negatives(rows)


def test_intervals_hold_the_scores_and_pass_rows_over():
    rng = np.random.default_rng(1)
    import pyarrow as pa

    rows = vectors(rng, 300, 16)
    refs = {16: rng.standard_normal((8, 16))}
    refs[16] /= np.linalg.norm(refs[16], axis=1)[:, None]
    table = pa.table({"vec_id": [r[0] for r in rows], "label": [r[1] for r in rows], "v": [r[2] for r in rows], "row": [r[0] for r in rows]})
    (part,) = negatives.Vectors.of(table, refs)
    lower, upper = negatives.intervals(part, part)
    exact = part.v @ part.v.T
    assert (lower <= exact).all() and (exact <= upper).all()
    assert (upper < part.norms[:, None] * part.norms[None, :] * 0.9).any()
    best = negatives._best_of_block(part, part.packed())
    assert (exact.max(axis=1) <= best).all()


def test_negatives_of_nothing(spark):
    frame = spark.createDataFrame([], "vec_id long, label int, v array<long>")
    assert negatives.mine(frame, F.col("vec_id") % 50 == 0).count() == 0
    none = spark.createDataFrame([(50, 1, [1, 2])], frame.schema)
    assert negatives.mine(none, F.col("vec_id") % 50 == 0).count() == 0


# 13. line deduplication


def brute_lines(rows, min_chars=20, min_docs=3):
    key = lambda line: "".join(c.lower() if c < "\x80" else c for c in line.strip(" \t\n\v\f\r"))
    docs, out = defaultdict(list), []
    for at, (i, text) in enumerate(rows):
        for k in {key(line) for line in (text or "").split("\n")}:
            docs[k].append(-(1 << 63) if i is None else i)
    for i, text in rows:
        lines = (text or "").split("\n")
        own = -(1 << 63) if i is None else i
        kept = [x for x in lines if len(key(x)) < min_chars or len(docs[key(x)]) < min_docs or max(docs[key(x)]) == own]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_keys,cache", [(4, 1), (1 << 18, 1 << 28)])
def test_lines_match_brute_force(spark, monkeypatch, shard_keys, cache):
    rng = random.Random(shard_keys)
    pool = [f"the line of number {i} that documents share é" for i in range(60)] + ["short", "", "   ", "ÀB" * 9, "ÀB" * 10]
    pool += [f"  {p.upper()} \t\r" for p in pool[:20]] + ["x" * 100_000, "a\x85b c and so on and so on"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 30)))) for i in range(80)]
    rows += [(None, "\n".join(pool)), (None, pool[0]), (3, pool[1]), (3, pool[1]), (5, None), (6, ""), (7, "\n\n"), (200, "\n".join(pool[:9] * 2))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    frame = frame.withColumns({c: F.lit(1) for c in ("hi", "lo", "n", "keeper", "shard", "id")})
    monkeypatch.setattr(linededup, "CACHE_BYTES", cache)
    got = linededup.dedup(frame, [F.col("doc_id"), F.col("hi")], shard_keys=shard_keys).select("doc_id", "kept_text", "n_lines", "n_dropped").collect()
    assert sorted(map(tuple, got), key=str) == brute_lines(rows)
    assert sum(r.n_dropped for r in got) > 100


def test_lines_of_nothing(spark, empty):
    assert linededup.dedup(empty, [F.col("doc_id")]).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 70_000])
def test_perfect_hash_numbers_every_key_once(n):
    rng = np.random.default_rng(n)
    hi, lo = rng.integers(0, 1 << 63, (2, n)).astype(np.uint64)
    lo[: n // 3] = 7  # keys may share a half
    table = linededup.PerfectHash.build(hi, lo)
    assert sorted(table.index(hi, lo)) == list(range(n))
    other = table.index(hi + np.uint64(1), lo)
    assert ((other >= -1) & (other < max(n, 1))).all()
    if n > 1000:
        assert len(table.words) * 64 < 5 * n
