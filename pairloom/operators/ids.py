"""Dense ids, id maxima and neighbours without a single-partition sort.

``row_number`` over a whole table needs one task.  Here rows go to range
partitions of the key and are numbered where they lie; only the partitions' row
counts, a tiny table, are summed up in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.session import staged

#: Bits of a row's place within its partition in ``monotonically_increasing_id``.
_ROW_BITS = 33


def next_id(df: DataFrame, column: str, default_max: int) -> Column:
    """Scalar subquery: largest id plus one; ``default_max + 1`` when empty."""
    top = F.coalesce(F.max(F.col(column).cast("bigint")), F.lit(default_max).cast("bigint"))
    return df.agg((top + 1).alias("next_id")).scalar()


def next_text_id(texts: DataFrame) -> Column:
    return next_id(texts, "text_id", -1)


def next_image_id(images: DataFrame) -> Column:
    return next_id(images, "image_id", 0)


def next_text_ids(texts: DataFrame) -> DataFrame:
    """``split, next_text_id`` for every split that has rows."""
    return texts.groupBy("split").agg((F.max("text_id") + 1).alias("next_text_id"))


def in_order(df: DataFrame, key: str, parts: int | None = None, within: tuple[str, int] | None = None) -> DataFrame:
    """Partitions that follow each other in ``key`` order, sorted inside.

    Every partition takes an equal stretch between the smallest and the largest
    key, so a row's partition follows from its key alone: only the keys are read
    to find the ends, and whatever stands next to them is computed and moved
    once.  Meant for row numbers; keys that crowd together crowd a partition.
    ``within`` names a column of numbers from 0 and how many there are: each
    number has partitions of its own.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups, number = (within[1], F.col(within[0])) if within else (1, F.lit(0))
    least, largest = df.agg(F.min(key), F.max(key)).first()
    if least is None:
        return df
    each = max(parts // groups, 1)
    width = -(-(largest - least + 1) // each)
    # as doubles, whose rounding keeps the order
    stretch = F.floor((F.col(key).cast("double") - F.lit(float(least))) / F.lit(float(width)))
    place = (number * each + F.least(F.coalesce(stretch, F.lit(0)), F.lit(each - 1))).cast("int")
    return df.repartitionById(groups * each, place).sortWithinPartitions(*([within[0]] if within else []), key)


def _ranged(df: DataFrame, keys: Sequence[str], takes: str | None = None) -> DataFrame:
    """``df`` in range partitions of ``keys``, sorted, with ``__at`` and ``__part``.

    ``__at`` grows with the keys, by one from row to row of a partition, or by
    the row's ``takes``.  Whole keys are cut, so a leading value with very many
    rows is spread.  Written once: a row keeps its place when a task runs again.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    if takes:
        rows = rows.withColumn("__nth", F.explode(F.sequence(F.lit(1), F.col(takes).cast("int"))))
    rows = rows.withColumn("__at", F.monotonically_increasing_id())
    if takes:
        rows = rows.where("__nth = 1").drop("__nth")
    return staged(rows).withColumn("__part", F.shiftright("__at", _ROW_BITS))


def _with_edges(rows: DataFrame, edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join a row per partition to the partition's rows; NULL is a key like any other."""
    named = edges.withColumnsRenamed({k: f"__key{i}" for i, k in enumerate(keys)})
    same = [F.col(k).eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(keys)]
    return rows.join(named, same).drop(*[f"__key{i}" for i in range(len(keys))])


def dense_id(
    df: DataFrame,
    name: str,
    order: Sequence[str],
    *,
    within: Sequence[str] = (),
    start: Column | int = 0,
    takes: str | None = None,
) -> DataFrame:
    """Number rows ``start, start + 1, ..`` by ``order``, a unique key.

    Numbering restarts for every value of ``within``.  Rows move once.  A row
    takes one number, or as many as the column ``takes`` says, which is 1 at
    least; it gets the first of them.
    """
    order, within = list(order), list(within)
    rows, keys = _ranged(df, [*within, *order], takes), [*within, "__part"]
    size = F.sum(takes) if takes else F.count(F.lit(1))
    counts = rows.groupBy(*keys).agg(size.alias("__rows"), F.min("__at").alias("__first"))
    before = Window.partitionBy(*within).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *keys, "__first", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset")
    )
    start = start if isinstance(start, Column) else F.lit(start)
    number = F.col("__at") - F.col("__first") + F.col("__offset") + start
    return _with_edges(rows, offsets, keys).withColumn(name, number.cast("bigint")).drop(
        "__at", "__part", "__first", "__offset"
    )


def neighbours(ids: DataFrame, column: str, within: Sequence[str] = ()) -> DataFrame:
    """``previous_id`` and ``next_id`` of every distinct id, clamped at the ends."""
    within = list(within)
    rows = _ranged(ids.select(*within, F.col(column)).distinct(), [*within, column])
    keys = [*within, "__part"]
    across = Window.partitionBy(*within).orderBy("__part")
    edges = rows.groupBy(*keys).agg(F.min(column).alias("__first"), F.max(column).alias("__last")).select(
        *keys,
        F.lag("__last").over(across).alias("__before"),
        F.lead("__first").over(across).alias("__after"),
    )
    inside = Window.partitionBy(*keys).orderBy(column)
    lagged = rows.withColumns({"__lag": F.lag(column).over(inside), "__lead": F.lead(column).over(inside)})
    return _with_edges(lagged, edges, keys).select(
        *within,
        column,
        F.coalesce("__lag", "__before", column).alias("previous_id"),
        F.coalesce("__lead", "__after", column).alias("next_id"),
    )


def neighbour_of(ids: DataFrame, column: str, current: int, step: int) -> DataFrame:
    """One row ``id``: the neighbour of any number, present or not.

    Both ends clamp, but going forward from above the largest id leads to the
    first one.  Each look is an aggregate whose filter reaches the scan; the
    next one is taken only if nothing is found.
    """
    key, here = F.col(column), F.lit(current)
    beyond = ids.where(key > here).agg(F.min(key)) if step > 0 else ids.where(key < here).agg(F.max(key))
    looks = [beyond, ids.where(key == here).agg(F.max(key)), ids.agg(F.min(key))]
    for look in looks[:-1]:
        if look.first()[0] is not None:
            return look.toDF("id")
    return looks[-1].toDF("id")
