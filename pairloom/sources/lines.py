"""Text files as numbered lines.

Spark cuts a file into blocks and has no line order.  Within a block the row
index is known; the line counts of the blocks, summed up in file order, turn it
into a dense ``ord``.  Only those counts are ever brought together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.session import pin_file_splits, staged

Shape = Callable[[DataFrame], DataFrame]


def _shifts(lines: DataFrame) -> DataFrame:
    """``file, block, shift``: what turns ``at`` into the line's number; a row per block."""
    counts = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("lines"), F.min("at").alias("first"))
    # a folder's part files by task number: names pad it to five digits only
    folder = F.regexp_extract("file", "^(.*/)", 1)
    task = F.regexp_extract("file", r"/part-(\d+)[^/]*$", 1).try_cast("bigint")
    earlier = Window.orderBy(folder, task, "file", "block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("lines").over(earlier), F.lit(0))
    return counts.select("file", "block", (before - F.col("first")).alias("shift"))


def numbered_lines(
    spark: SparkSession,
    paths: str | list[str],
    keep: Column | None = None,
    *,
    shape: Shape | None = None,
    once: bool = False,
) -> DataFrame:
    """``value, file, ord`` of the lines for which ``keep`` holds.

    ``shape`` makes other columns of ``value``, row by row, and leaves the rest.  The files are read
    twice, for the counts and for the lines, and must be cut in the same way
    both times.  With ``once`` they are read by one job, now: the shaped lines
    go to the shared folder as Parquet, the counts come from three narrow
    columns of it, and whoever reads the result later reads the columns it
    selects and not the files.
    """
    if not once:
        pin_file_splits(spark)
    raw = spark.read.option("recursiveFileLookup", True).text(paths)
    lines = raw.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    if keep is not None:
        lines = lines.where(keep)
    lines = lines.withColumn("at", F.monotonically_increasing_id())
    if shape is not None:
        lines = shape(lines)
    if once:
        lines = staged(lines)
    numbered = lines.join(_shifts(lines), ["file", "block"])
    return numbered.withColumn("ord", F.col("at") + F.col("shift")).drop("block", "at", "shift")
