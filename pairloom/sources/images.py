"""Image tables (id, tab, base64) and image files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.images import data_url, encode_image, is_image_path
from pairloom.schema import IMAGES
from pairloom.sources import paths
from pairloom.sources.lines import numbered_lines


def _fields(lines: DataFrame) -> DataFrame:
    cut = F.split("value", "\t", 2)
    fields = {"fields": F.size(cut), "raw_id": F.get(cut, F.lit(0)), "image_b64": F.get(cut, F.lit(1))}
    return lines.withColumns(fields).drop("value")


def _checked_id() -> Column:
    where = F.concat("file", F.lit(", record "), (F.col("ord") + 1).cast("string"))
    raw_id = F.col("raw_id")
    number = F.coalesce(
        raw_id.try_cast("bigint"),
        F.raise_error(F.concat(F.lit("Invalid image_id in "), where, F.lit(": "), raw_id)),
    )
    checked = F.when(F.col("fields") == 2, number).otherwise(
        F.raise_error(F.concat(F.lit("Invalid TSV row in "), where))
    )
    return checked.cast("bigint").alias("image_id")


def read_images(spark: SparkSession, path: str | list[str], split: str, *, once: bool = False) -> DataFrame:
    """Images of one split in line order.

    A line without a tab, or whose first field is not a number, is an error.
    ``once`` reads the files now and once (see ``numbered_lines``).
    """
    lines = numbered_lines(spark, path, F.col("value") != "", shape=_fields, once=once)
    return lines.select(F.lit(split).alias("split"), "ord", _checked_id(), "image_b64")


def read_image_ids(spark: SparkSession, path: str | list[str], split: str) -> DataFrame:
    """Image ids of one split in line order; the files are read once, and only ids are kept of them."""
    ids = lambda lines: _fields(lines).drop("image_b64")
    lines = numbered_lines(spark, path, F.col("value") != "", shape=ids, once=True)
    return lines.select(F.lit(split).alias("split"), "ord", _checked_id())


def empty_images(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], IMAGES)


def images_path(folder: str, split: str) -> str:
    return f"{folder}/{split}_imgs.tsv"


def image_files(spark: SparkSession, patterns: str | list[str]) -> DataFrame:
    """``path, name, content`` of supported files matching glob patterns."""
    files = spark.read.format("binaryFile").load(patterns)
    return files.where(is_image_path(F.col("path"))).select(
        "path", F.regexp_extract("path", r"([^/]*)\z", 1).alias("name"), "content"
    )


def load_images(spark: SparkSession, path: str) -> DataFrame:
    """``path, name, src`` for one image file or one folder, by file name."""
    if not paths.exists(spark, path):
        raise FileNotFoundError(f"Path not found: {path}")
    target = f"{path}/*" if paths.is_dir(spark, path) else path
    if not paths.matches(spark, target):
        raise FileNotFoundError(f"No supported images found: {path}")
    files = image_files(spark, target)
    if files.select("path").isEmpty():
        raise FileNotFoundError(f"No supported images found: {path}")
    return files.select("path", "name", data_url(encode_image(F.col("content"))).alias("src")).orderBy("name")
