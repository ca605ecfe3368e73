"""Session defaults and the shared folder for staged data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even when that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "pairloom", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a
    cluster a machine-local path would not survive a lost executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pairloom-"))
    return spark.sparkContext.getCheckpointDir()


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from there.

    Used where one costly frame feeds several branches of a plan.  Parquet,
    so that a branch reads only the columns it needs; the files outlive any
    executor and go away with the application.
    """
    return staged_apart(df)[0]


def staged_apart(df: DataFrame) -> tuple[DataFrame, str]:
    """``staged``, and the scratch folder, for frames that are dropped before the application ends."""
    path = scratch_path(df.sparkSession, "stage")
    _write_and_free(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path.rpartition("/")[0]


def _write_and_free(df: DataFrame, path: str) -> None:
    """Write ``df``; the shuffles of the write, which nothing reads again, leave the disk when it ends."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


#: Rows that a task groups at once.
TASK_ROWS = 1 << 18


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt out by ``keys``, TASK_ROWS of its ``rows`` to a task, for a grouping by them and more.

    Where nearly every row is a group of its own, a partial aggregate before the
    shuffle folds nothing and holds all that its task scans; this way a task
    holds its share whatever the size of the files.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // TASK_ROWS)), *keys)


#: Folders in the shared folder that this process made and has not dropped.
_folders: list[str] = []


def scratch_folders() -> list[str]:
    """The scratch folders there are, oldest first."""
    return list(_folders)


def drop_scratch(spark: SparkSession, folders: list[str]) -> None:
    """Delete scratch folders that no frame in use reads any more."""
    for folder in folders:
        where, files = _place(spark, folder)
        files.delete(where, True)
        _folders.remove(folder)


def _place(spark: SparkSession, folder: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the application ends."""
    folder = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    where, files = _place(spark, folder)
    _folders.append(folder)
    # only a folder that exists can be marked for deletion
    files.mkdirs(where)
    files.deleteOnExit(where)
    return f"{folder}/data"


def pin_file_splits(spark: SparkSession) -> None:
    """Make the cut of files into scan partitions repeatable in this session.

    The cut depends on the number of cores when ``minPartitionNum`` is unset,
    which changes while executors come and go.  The line numbering scans a file
    twice and needs the same cut both times.
    """
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(max(spark.sparkContext.defaultParallelism, 1)))
