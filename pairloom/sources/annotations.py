"""Annotation exports: one JSON document and an image folder per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.schema import ANNOTATION_EXPORT
from pairloom.sources import paths

_DOCUMENT = "annotations/instances_default.json"


def read_exports(spark: SparkSession, folders: list[str]) -> DataFrame:
    """``source_ord, root, images, annotations``: one row per export.

    A document is parsed by one task; exports are read side by side.
    """
    for folder in folders:
        paths.require(spark, f"{folder}/{_DOCUMENT}")
        paths.require(spark, f"{folder}/images")
    docs = (
        spark.read.schema(ANNOTATION_EXPORT)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json([f"{folder}/{_DOCUMENT}" for folder in folders])
        .select("*", paths.plain(paths.decoded(F.col("_metadata.file_path"))).alias("path"))
    )
    order = spark.createDataFrame(
        [(at, paths.qualified(spark, folder)) for at, folder in enumerate(folders)],
        "source_ord bigint, root string",
    )
    root = F.regexp_extract("path", rf"\A(.*)/{_DOCUMENT}\z", 1)
    return docs.withColumn("root", root).join(order, "root").select(
        "source_ord", "root", "images", "annotations"
    )


def source_name(root: Column) -> Column:
    return F.regexp_extract(root, r"([^/]*)\z", 1)


def export_images(exports: DataFrame) -> DataFrame:
    rows = exports.select("source_ord", "root", F.posexplode_outer("images").alias("pos", "image"))
    return rows.where(F.col("image").isNotNull()).select(
        "source_ord",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("image.id").cast("bigint").alias("export_image_id"),
        F.col("image.file_name").alias("file_name"),
        F.concat("root", F.lit("/images/"), "image.file_name").alias("path"),
        source_name(F.col("root")).alias("source"),
    )


def export_annotations(exports: DataFrame) -> DataFrame:
    rows = exports.select("source_ord", F.posexplode_outer("annotations").alias("ord", "note"))
    return rows.where(F.col("note").isNotNull()).select(
        "source_ord",
        F.col("ord").cast("bigint").alias("ord"),
        F.col("note.image_id").cast("bigint").alias("export_image_id"),
        F.col("note.attributes.txt").alias("txt"),
    )


def export_files(spark: SparkSession, folders: list[str], *, content: bool = False) -> DataFrame:
    """``path`` (and bytes) of every file below the exports' image folders."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load([f"{folder}/images" for folder in folders])
    )
    return files.select(paths.plain(F.col("path")).alias("path"), *(["content"] if content else []))
