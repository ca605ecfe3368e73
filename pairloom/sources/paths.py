"""Small file-system questions, answered by Hadoop's FileSystem API."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where a Hadoop job keeps its input paths.
_INPUT_PATHS = "mapreduce.input.fileinputformat.inputdir"
_SLASHES = r"\A([a-z][a-z0-9]*):/+"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where) and fs.getFileStatus(where).isDirectory()


def matches(spark: SparkSession, pattern: str) -> bool:
    """Does a glob pattern match anything?"""
    fs, where = _fs(spark, pattern)
    found = fs.globStatus(where)
    return found is not None and len(found) > 0


def child_names(spark: SparkSession, root: str) -> DataFrame:
    """``name`` of whatever lies right below a folder, empty folders too.

    The JVM lists the folder and hands the paths to Spark as the one string in
    which Hadoop keeps a job's input paths (commas between, those of names
    escaped): a few calls, however many names there are.
    """
    jvm = spark.sparkContext._jvm
    fs, where = _fs(spark, root)
    found = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(where))
    job = jvm.org.apache.hadoop.mapred.JobConf(spark.sparkContext._jsc.hadoopConfiguration())
    if len(found):
        jvm.org.apache.hadoop.mapred.FileInputFormat.setInputPaths(job, found)
    joined = job.get(_INPUT_PATHS) if len(found) else ""
    rows = spark.createDataFrame([(joined,)], "paths string")
    names = rows.select(F.explode(F.split("paths", r"(?<!\\),")).alias("path"))
    return names.select(F.regexp_extract("path", r"([^/]+)\z", 1).alias("name")).where("name <> ''")


def qualified(spark: SparkSession, path: str) -> str:
    """Full path in the form ``plain`` gives to scanned files."""
    fs, where = _fs(spark, path)
    return re.sub(_SLASHES, r"\1:/", fs.makeQualified(where).toString())


def plain(path: Column) -> Column:
    """One spelling of ``file:///x`` and ``file:/x``."""
    return F.regexp_replace(path, _SLASHES, "$1:/")


def decoded(path: Column) -> Column:
    """``_metadata.file_path`` is URL-encoded; undo that (a plus is a plus)."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def is_filled(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where) and len(fs.listStatus(where)) > 0


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder into place of another; an absent one leaves an empty folder there."""
    fs, where = _fs(spark, target)
    _, old = _fs(spark, source)
    fs.delete(where, True)
    if not fs.exists(old):
        fs.mkdirs(where)
    elif not fs.rename(old, where):
        raise OSError(f"cannot move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file under another name and move it into place; False if the place is taken."""
    fs, where = _fs(spark, path)
    if fs.exists(where):
        return False
    folder, _, name = path.rpartition("/")
    _, hidden = _fs(spark, f"{folder}/.{name}.tmp")
    out = fs.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    return fs.rename(hidden, where)


def content(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    return spark.read.text(path, wholetext=True).first()[0]


def require(spark: SparkSession, path: str) -> str:
    if not exists(spark, path):
        raise FileNotFoundError(f"Missing file: {path}")
    return path


def require_free(spark: SparkSession, path: str, overwrite: bool) -> None:
    """Refuse a non-empty output folder unless told to overwrite it."""
    if is_filled(spark, path) and not overwrite:
        raise FileExistsError(f"Output directory is not empty: {path}. Use overwrite=True to replace files.")
