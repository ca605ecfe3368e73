"""Sets of ids as bitmaps: membership and rank without moving the rows that ask.

Ids are cut into runs of 32,768; a run that holds any id is one row with 4 KB of
bits.  Dense ids take a bit each, so the set of a billion is 125 MB in 30,000
rows, small enough for every executor, while a join would send the payload that
stands next to the ids through a shuffle.  The rows are counted before they are
used: a set of more than MOST_ROWS (sparse ids) has no bitmap, and callers join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.session import staged

#: Runs of a set that is sent to every executor: 256 MB of bits at most.
MOST_ROWS = 1 << 16


def id_bitmaps(ids: DataFrame, column: str, within: Sequence[str] = ()) -> DataFrame | None:
    """``within, run, bits`` of the different ids; None if there are more than MOST_ROWS runs.

    NULL ids are in no set.
    """
    run = F.bitmap_bucket_number(F.col(column)).alias("run")
    place = F.bitmap_bit_position(F.col(column))
    maps = staged(ids.where(F.col(column).isNotNull()).groupBy(*within, run).agg(F.bitmap_construct_agg(place).alias("bits")))
    return maps if maps.count() <= MOST_ROWS else None


def _byte(bits: Column, place: Column) -> Column:
    """The byte of a bitmap that holds a bit, as a number."""
    return F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")


def with_member(rows: DataFrame, maps: DataFrame, column: str, within: Sequence[str] = ()) -> DataFrame:
    """The rows whose id is in the set of their ``within``; rows stay where they are."""
    place = F.bitmap_bit_position(F.col(column))
    asked = rows.withColumn("__run", F.bitmap_bucket_number(F.col(column)))
    sets = F.broadcast(maps.select(*within, F.col("run").alias("__run"), F.col("bits").alias("__bits")))  # MOST_ROWS at most
    met = asked.join(sets, [*within, "__run"])
    return met.where(F.getbit(_byte(F.col("__bits"), place), (place % 8).cast("int")) == 1).select(*rows.columns)


def with_rank(rows: DataFrame, maps: DataFrame, column: str, name: str, within: Sequence[str] = ()) -> DataFrame:
    """``rows`` with the number of smaller ids in the set of their ``within``; ids are 1 or more, and in the set."""
    place = F.bitmap_bit_position(F.col(column))
    counted = maps.withColumn("n", F.bitmap_count("bits"))
    # a row per run of ids
    before = Window.partitionBy(*within).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sets = counted.select(
        *within, F.col("run").alias("__run"), F.col("bits").alias("__bits"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before")
    )
    asked = rows.withColumn("__run", F.bitmap_bucket_number(F.col(column)))
    met = asked.join(F.broadcast(sets), [*within, "__run"])  # MOST_ROWS at most
    bits, byte = F.col("__bits"), _byte(F.col("__bits"), place)
    below = F.bit_count(byte.bitwiseAND(F.expr(f"shiftleft(1, cast(bitmap_bit_position({column}) % 8 as int)) - 1")))
    whole = F.bitmap_count(F.substring(bits, F.lit(1), F.floor(place / 8).cast("int")))
    return met.withColumn(name, (F.col("__before") + whole + below).cast("bigint")).select(*rows.columns, name)
