"""Query folders: ``<number>/query.txt`` and ``<number>/pos_images/*``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from pairloom.functions.images import is_image_path
from pairloom.operators.build import FOLDERS
from pairloom.sources import paths


def _numeric(rows: DataFrame) -> DataFrame:
    """Keep folders named by digits, and give their number."""
    return rows.where(F.col("sample").rlike(r"\A\d+\z")).withColumn(
        "sample_id", F.col("sample").cast("bigint")
    )


#: File names of 1 to 19 digits, as many as a BIGINT has.
_DIGITS = "{" + ",".join("[0-9]" * n for n in range(1, 20)) + "}"


def _below(path: Column, root: str) -> Column:
    """The names on the way from ``root`` to a file; empty for files elsewhere."""
    inside = F.split(F.substring(path, len(root) + 2, 1 << 30), "/")
    return F.when(path.startswith(f"{root}/"), inside).otherwise(F.expr("cast(array() as array<string>)"))


def _files(spark: SparkSession, pattern: str) -> DataFrameReader:
    """A reader of files in any depth whose names match; Spark lists them, folder by folder and in its tasks."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)


def read_queries(spark: SparkSession, root: str) -> DataFrame:
    """``sample_id, sample, query`` of every ``root/<digits>/query.txt``; none where there is no ``root``."""
    if not paths.exists(spark, root):
        return spark.createDataFrame([], "sample_id bigint, sample string, query string")
    path = paths.plain(paths.decoded(F.col("_metadata.file_path")))
    rows = _files(spark, "query.txt").text(root, wholetext=True)
    rows = rows.select(_below(path, paths.qualified(spark, root)).alias("inside"), F.col("value").alias("query"))
    rows = rows.where(F.size("inside") == 2).select(F.get("inside", F.lit(0)).alias("sample"), "query")
    return _numeric(rows).select("sample_id", "sample", "query")


def folder_files(files: DataFrame, root: str) -> DataFrame:
    """Supported images right below ``root/<digits>/<folder>`` of ``files`` (path, ..).

    Adds ``sample_id, sample, folder, name``; files at any other depth are left out.
    """
    inside = _below(F.col("path"), root)
    step = lambda n: F.get(inside, F.lit(n))
    rows = files.where(
        (F.size(inside) == 3) & step(1).isin(*FOLDERS) & is_image_path(F.col("path"))
    ).select(step(0).alias("sample"), step(1).alias("folder"), step(2).alias("name"), *files.columns)
    return _numeric(rows).select("sample_id", "sample", "folder", "name", *files.columns)


def read_folder_files(spark: SparkSession, root: str, *, content: bool = False) -> DataFrame:
    """``sample_id, sample, folder, name, path`` (and bytes) of supported images.

    Spark lists the files; bytes are read only where the path passes.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    files = files.select(paths.plain(F.col("path")).alias("path"), *(["content"] if content else []))
    return folder_files(files, paths.qualified(spark, root))


def read_samples(spark: SparkSession, root: str) -> DataFrame:
    """``sample_id, sample`` of every numbered folder.

    Empty folders count too, which no listing of files has.  Files that are
    named like a folder do not.
    """
    path = paths.plain(F.col("path"))
    files = _files(spark, _DIGITS).format("binaryFile").load(root)
    files = files.select(_below(path, paths.qualified(spark, root)).alias("inside")).where(F.size("inside") == 1)
    names = paths.child_names(spark, root).withColumnRenamed("name", "sample")
    names = names.join(files.select(F.get("inside", F.lit(0)).alias("sample")), "sample", "left_anti")
    return _numeric(names).select("sample_id", "sample")
