"""Whole datasets: both files of every split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pairloom.schema import SPLITS
from pairloom.sources import paths
from pairloom.sources.images import empty_images, images_path, read_images
from pairloom.sources.snapshots import visible
from pairloom.sources.texts import empty_texts, read_texts, texts_path


def present_splits(spark: SparkSession, folder: str, splits=SPLITS) -> list[str]:
    """Splits that have both files."""
    return [
        s
        for s in splits
        if paths.exists(spark, texts_path(folder, s)) and paths.exists(spark, images_path(folder, s))
    ]


def read_dataset(
    spark: SparkSession,
    folder: str,
    splits=SPLITS,
    required: tuple[str, ...] = (),
    *,
    extras: bool = True,
    once: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Captions and images of all splits that exist.

    A split named in ``required`` must exist; at least one must.  Unknown keys
    of caption rows are kept (``extras``).  Appended batches count from their
    commit on.  ``once`` reads every file now and once, for frames that several
    jobs use; without it nothing is read before a job asks.
    """
    have = present_splits(spark, folder, splits)
    for split in required:
        if split not in have:
            paths.require(spark, texts_path(folder, split))
            paths.require(spark, images_path(folder, split))
    if not have:
        raise FileNotFoundError(f"No train/valid files found in {folder}")
    texts, images = empty_texts(spark), empty_images(spark)
    for split in have:
        files = {named: visible(spark, folder, named(folder, split), split) for named in (texts_path, images_path)}
        rows = read_texts(spark, files[texts_path], split, extras=extras, once=once)
        texts = texts.unionByName(rows, allowMissingColumns=True)
        images = images.unionByName(read_images(spark, files[images_path], split, once=once))
    return texts, images
