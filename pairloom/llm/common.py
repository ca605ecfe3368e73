"""Helpers shared by the text operators: word batches, row ids, running totals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pairloom.session import staged

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Text bytes that a task works on at once; a longer document is a slice alone.
SLICE_BYTES = 4 << 20


def word_count(text: Column) -> Column:
    """Number of words as a BIGINT; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def with_row_ids(docs: DataFrame, name: str = "row_id") -> DataFrame:
    """``docs`` written to the shared folder with a number that is unique per row.

    Written, so that a row keeps its number when a task runs again.
    """
    return staged(docs.withColumn(name, F.monotonically_increasing_id()))


def staged_batches(df: DataFrame, most: int = SLICE_BYTES) -> DataFrame:
    """``staged``, while rows go to Python in batches of ``most`` bytes, however long they are."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(key)
    conf.set(key, str(most))
    try:
        return staged(df)
    finally:
        conf.set(key, before)


def schema(df: DataFrame, columns: list[str], more: str) -> StructType:
    """Named columns of ``df``, then the fields of the DDL string ``more``."""
    return StructType([df.schema[c] for c in columns] + StructType.fromDDL(more).fields)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name (case aside)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def kept_with(docs: DataFrame, keep: list[Column], text: str) -> tuple[DataFrame, list[str], str]:
    """``keep`` of ``docs`` and the text, the names kept, and the name of the text.

    A text that is kept under its own name is not carried twice.
    """
    rows = docs.select(*keep)
    kept = rows.columns
    if text in kept:
        return rows, kept, text
    return docs.select(*keep, F.col(text).alias("__text")), kept, "__text"


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that ``column`` has about ``most`` bytes in each."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total, start = 0, 0
        for at, n in enumerate(lengths):
            if total and total + n > most:
                yield batch.slice(start, at - start)
                total, start = 0, at
            total += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)


def release() -> None:
    """Give back what Arrow holds and does not use: a Python worker lives on between slices, tasks and stages."""
    pa.default_memory_pool().release_unused()


class Words:
    """The words of a batch of texts: distinct ones, and each text's run of codes."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        ends = np.asarray(lists.offsets.to_numpy(), dtype=np.int64)
        ends = ends - ends[0]
        empty = pc.index(coded.dictionary, "").as_py()
        if empty >= 0:  # left by white space at either end
            real = codes != empty
            ends = np.concatenate([[0], np.cumsum(real)])[ends]
            codes = codes[real]
        self.distinct: pa.Array = coded.dictionary
        self.codes = codes
        self.offsets = ends

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of ``values`` (one per distinct word) over the words of each text."""
        each = np.concatenate([[0], np.cumsum(values[self.codes])])
        return each[self.offsets[1:]] - each[self.offsets[:-1]]


def mix64(x: np.ndarray) -> np.ndarray:
    """A mixing of 64-bit numbers that loses nothing: different numbers stay different."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def quantiles(df: DataFrame, group: str, value: str, shares: list[float], step: float, name: str) -> DataFrame:
    """(group, name): for each group an array with the ``shares`` quantiles of ``value``, rounded to ``step``.

    Rows fold into a histogram first, so nothing but counts of steps is ordered,
    and a rerun gives the same.  ``group`` must not be NULL; NULL values are left out.
    """
    bars = df.where(F.col(value).isNotNull()).groupBy(group, F.round(F.col(value) / step).cast("long").alias("_bar")).agg(F.count("*").alias("_n"))
    upto = Window.partitionBy(group).orderBy("_bar").rowsBetween(Window.unboundedPreceding, 0)
    summed = bars.withColumns({"_upto": F.sum("_n").over(upto), "_all": F.sum("_n").over(Window.partitionBy(group))})
    found = [F.min(F.when(F.col("_upto") >= F.ceil(F.lit(s) * F.col("_all")), F.col("_bar"))) * F.lit(step) for s in shares]
    return summed.groupBy(group).agg(F.array(*found).alias(name))


def numbered(df: DataFrame, *order: Column, name: str) -> DataFrame:
    """``df`` with 0, 1, .. in ``order`` as column ``name``.

    Range partitions are numbered apart and then moved by the sizes of those
    before, so no task sees all rows.  Equal rows get different numbers.
    """
    part, first = free_name(df, "_part"), free_name(df, "_first")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = staged(df.repartitionByRange(n, *order).withColumn(part, F.spark_partition_id()))
    before = cut.groupBy(part).count().select(
        part, (F.sum("count").over(Window.orderBy(part)) - F.col("count")).alias(first)
    )
    own = F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1
    return (
        cut.withColumn(name, own)
        .join(F.broadcast(before), part)  # a row per partition
        .withColumn(name, (F.col(name) + F.col(first)).cast("long"))
        .drop(part, first)
    )


#: Digits of a hash key that name its bucket in a running total.
_BUCKET_BITS = 12
_KEY_BITS = 60


def hash_key(*parts: Column, seed: int) -> Column:
    """A key of 60 bits, spread evenly, the same on every run."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, _KEY_BITS // 4), 16, 10).cast("long")


def running_total(df: DataFrame, within: str, key: str, ties: list[str], value: str, name: str) -> DataFrame:
    """Sum of ``value`` over the rows of the same ``within`` that come before, in order of ``key``.

    ``key`` is a ``hash_key``: its leading bits cut every group into ranges of
    even size, however large the group is.  Ranges are summed first (partial
    sums, 4096 at most per group), then rows inside a range.  ``within`` must
    not be NULL.
    """
    bucket, base = free_name(df, "_bucket"), free_name(df, "_base")
    df = df.withColumn(bucket, F.shiftright(key, _KEY_BITS - _BUCKET_BITS).cast("int"))
    sums = df.groupBy(within, bucket).agg(F.sum(value).alias(base))
    before = Window.partitionBy(within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn(base, F.coalesce(F.sum(base).over(before), F.lit(0)))
    inner = Window.partitionBy(within, bucket).orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(sums, [within, bucket])
        .withColumn(name, (F.col(base) + F.coalesce(F.sum(value).over(inner), F.lit(0))).cast("long"))
        .drop(bucket, base)
    )
