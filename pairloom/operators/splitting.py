"""Seeded train/valid splits with an exact number of validation rows.

A row is 'valid' when the digest of its key is among the ``n`` smallest.  The
``n``-th digest is found by refining a histogram of digest prefixes, so nothing
is sorted or shuffled: the split itself is a comparison inside each row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.session import staged

_DIGITS = 3
#: Rows that are few enough to be ranked instead of counted once more.
_FEW = 4096


def key_digest(key: Column, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")))


def valid_rows(total: int, ratio: float) -> int:
    """Validation size: half-even rounding, at least one, never everything."""
    if not 0 <= ratio < 1:
        raise ValueError("valid_ratio must be in [0, 1).")
    if total < 2 or ratio == 0:
        return 0
    return min(max(int(round(total * ratio)), 1), total - 1)


def _cutoff(keys: DataFrame, digest: Column, ratio: float) -> str | None:
    """Largest digest that still belongs to the validation part."""
    prefix, wanted, size = "", None, 0
    while True:
        inside = keys.select(digest.alias("digest")).where(F.col("digest").startswith(prefix))
        width = len(prefix) + _DIGITS
        # at most 16 ** _DIGITS groups, whatever the table size
        bars = sorted(
            (row.head, row.rows)
            for row in inside.groupBy(F.substring("digest", 1, width).alias("head"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .collect()
        )
        if wanted is None:
            wanted = valid_rows(sum(rows for _, rows in bars), ratio)
            if wanted == 0:
                return None
            size = wanted
        for head, rows in bars:
            if wanted <= rows:
                break
            wanted -= rows
        prefix = head
        if rows <= _FEW:
            break
        if width >= 32:
            raise ValueError("Keys repeat at the cut of the split.")
    last = (
        keys.select(digest.alias("digest"))
        .where(F.col("digest").startswith(prefix))
        .orderBy("digest")
        .limit(wanted)
        .agg(F.max("digest"))
    )
    cut = last.first()[0]
    # equal keys would go to one side together, at whatever number of them
    if keys.where(digest <= cut).count() != size:
        raise ValueError("Keys repeat at the cut of the split.")
    return cut


def exact_split(
    df: DataFrame, key: str, ratio: float = 0.1, seed: int = 42, column: str = "split", *, once: bool = False
) -> DataFrame:
    """Mark each row 'train' or 'valid'; ``key`` must be unique.

    ``once`` makes the keys once, for a ``df`` that is costly to make.
    """
    keys = df.select(key)
    return _marked(df, staged(keys) if once else keys, key, ratio, seed, column)


def group_split(
    df: DataFrame, key: str, ratio: float = 0.0, seed: int = 42, column: str = "split"
) -> DataFrame:
    """As ``exact_split``, but whole groups of rows stay together."""
    # read once per step of the search
    return _marked(df, staged(df.select(key).distinct()), key, ratio, seed, column)


def _marked(df, keys, key, ratio, seed, column):
    digest = key_digest(F.col(key), seed)
    cut = _cutoff(keys, digest, ratio)
    part = F.lit("train") if cut is None else F.when(digest <= cut, "valid").otherwise("train")
    return df.withColumn(column, part)
