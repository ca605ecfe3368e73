"""Exact top-k by inner product, by no-random-access aggregation over sorted lists.

For a block of candidates each dimension has a list of its values, read from the
largest on for a positive query weight and from the smallest on for a negative
one.  After each step down the lists, a candidate's score lies between two
bounds: what has been read of it, plus for every unread dimension the value just
reached (upper) or the list's end (lower).  A candidate whose upper bound is
below the k-th best lower bound cannot qualify.  When few others are left, their
scores are resolved; at the ends of the lists the bounds are the scores.

Queries and candidates are cut into blocks and every pair of blocks is a group,
so the bounds work on matrices of fixed size; the k best of each group are
ranked together per query.

Special rows.  Vectors that are NULL or hold NULL or non-finite components take
no part.  Vectors meet only vectors of their own length; an empty vector scores
0.  A row is never its own candidate, but another row with its id is.  Ties go to
the smaller id, NULL ids first.  Components and scores are whole numbers below
2 ** 63.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.session import staged

#: Rows of a query block and of a candidate block.
QUERY_BLOCK, BLOCK = 1024, 8192
#: Parts of the lists after which the bounds are compared.
DEPTHS = (0.125, 0.25, 0.5, 0.75)
#: Candidates left, as a multiple of k, at which scores are resolved.
FEW = 8

_FOUND = "query_row long, query_id long, vec_id long, score long"


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component as BIGINT; NULL unless all are finite numbers."""
    real = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    numbers = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return F.when(F.forall(vector, real), numbers)


def search(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows of ``vectors`` (vec_id, v) for each query row."""
    rows = staged(
        vectors.where("v IS NOT NULL").select("vec_id", "v", is_query.alias("is_query"), F.monotonically_increasing_id().alias("row"))
    )
    n, asked = rows.agg(F.count("*"), F.count_if("is_query")).first()
    groups, blocks = max(math.ceil(asked / QUERY_BLOCK), 1), max(math.ceil(n / BLOCK), 1)
    spread = lambda parts: F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = rows.where("is_query").select("row", "vec_id", "v", spread(groups).alias("g"), every(blocks).alias("b"))
    right = rows.select("row", "vec_id", "v", every(groups).alias("g"), spread(blocks).alias("b"))

    def meet(queries: pa.Table, others: pa.Table) -> pa.Table:
        return _meet(queries, others, k)

    found = left.groupBy("g", "b").cogroup(right.groupBy("g", "b")).applyInArrow(meet, _FOUND)
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _meet(queries: pa.Table, others: pa.Table, k: int) -> pa.Table:
    found = [np.zeros((4, 0), np.int64)]
    valid = [pa.array([], pa.bool_())]
    sides = []
    for table in (queries, others):
        v = table.column("v").combine_chunks()
        sides.append((table, np.diff(v.offsets.to_numpy()), v.flatten().to_numpy(zero_copy_only=False), v.offsets.to_numpy()))
    for width in np.intersect1d(sides[0][1], sides[1][1]):
        parts = []
        for table, widths, flat, offsets in sides:
            mine = np.flatnonzero(widths == width)
            at = (offsets[mine] - offsets[0])[:, None] + np.arange(width)
            parts.append((mine, flat[at].reshape(len(mine), width)))
        (qi, q), (ci, x) = parts
        qrow, crow = (s[0].column("row").to_numpy()[i] for s, i in zip(sides, (qi, ci)))
        cid = others.column("vec_id").combine_chunks().take(pa.array(ci))
        known = cid.is_valid().to_numpy(zero_copy_only=False)
        ids = cid.fill_null(0).to_numpy()
        order = np.lexsort((ids, known))  # NULL first, then by id: position breaks ties
        x, crow = x[order], crow[order]
        for i, at, score in aggregate(q, x, qrow, crow, k):
            n = len(at)
            found.append(np.stack([np.full(n, qrow[i]), np.full(n, qi[i]), order[at] + 0, score]))
            found[-1][2] = ci[order[at]]
    rows = np.concatenate(found, axis=1)
    return pa.table(
        {
            "query_row": rows[0],
            "query_id": queries.column("vec_id").combine_chunks().take(pa.array(rows[1])),
            "vec_id": others.column("vec_id").combine_chunks().take(pa.array(rows[2])),
            "score": rows[3],
        }
    )


def aggregate(q: np.ndarray, x: np.ndarray, own_q: np.ndarray, own_x: np.ndarray, k: int):
    """Yields (query, positions in x, scores) with the k best of ``x`` for each row of ``q``.

    Equal scores go to the smaller position.  Rows with equal ``own`` never meet.
    """
    n, width = x.shape
    if not n or not len(q):
        return
    top = int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0)) * max(width, 1)
    kind = np.float64 if top < 1 << 53 else np.int64  # whole numbers are exact in either
    q, x = q.astype(kind), x.astype(kind)
    order = np.argsort(-x, axis=0, kind="stable")
    ranked = np.take_along_axis(x, order, axis=0)  # the lists
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(n)[:, None], order.shape), axis=0)
    open_q = np.arange(len(q))
    for depth in [max(int(n * d), 1) for d in DEPTHS] + [n]:
        if not len(open_q):
            return
        plus, minus = np.maximum(q[open_q], 0), np.minimum(q[open_q], 0)
        read_plus, read_minus = place < depth, place >= n - depth
        upper = _bound(plus, minus, x, read_plus, read_minus, ranked[depth - 1], ranked[n - depth])
        lower = upper if depth == n else _bound(plus, minus, x, read_plus, read_minus, ranked[n - 1], ranked[0])
        own = own_q[open_q][:, None] == own_x[None, :]
        least = np.iinfo(np.int64).min // 2
        upper, lower = np.where(own, least, upper), np.where(own, least, lower)
        bar = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(open_q), least)
        left = (upper >= bar[:, None]) & ~own
        done = (left.sum(axis=1) <= FEW * k) | (depth == n)
        for i in np.flatnonzero(done):
            at = np.flatnonzero(left[i])
            score = (x[at] @ q[open_q[i]]).astype(np.int64)
            best = np.lexsort((at, -score))[:k]
            yield open_q[i], at[best], score[best]
        open_q = open_q[~done]


def _bound(plus, minus, x, read_plus, read_minus, unread_plus, unread_minus) -> np.ndarray:
    """Scores with the given values in place of components that have not been read."""
    return plus @ np.where(read_plus, x, unread_plus).T + minus @ np.where(read_minus, x, unread_minus).T
