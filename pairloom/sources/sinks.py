"""Writers for caption and image files and for whole datasets.

Every output is a folder of part files; sorted by name they hold the rows in
``ord`` order, which is how the readers take them.  Appended batches lie beside
them and count from their commit on (see ``snapshots``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.operators.ids import in_order
from pairloom.schema import SPLITS
from pairloom.session import staged
from pairloom.sources import paths, snapshots
from pairloom.sources.images import images_path
from pairloom.sources.texts import texts_path

_TEXT_KEYS = ("text_id", "text", "image_ids", "source_text_id")


def _in_order(df: DataFrame, ordered: bool) -> DataFrame:
    return in_order(df, "ord") if ordered else df


def text_json(texts: DataFrame) -> Column:
    """One JSON object per row; NULL keys are left out.

    A map column ``extras`` (see ``read_texts``) is written next to the rest.
    """
    own = F.struct(*(c for c in _TEXT_KEYS if c in texts.columns))
    if "extras" not in texts.columns:
        return F.to_json(own)
    known = F.from_json(F.to_json(own), "map<string,variant>")
    return F.to_json(F.map_concat(known, F.coalesce("extras", F.expr("cast(map() as map<string,variant>)"))))


def write_texts(texts: DataFrame, path: str, *, ordered: bool = True, mode: str = "errorifexists") -> None:
    _in_order(texts.select("ord", text_json(texts).alias("value")), ordered).select("value").write.mode(mode).text(path)


def image_line() -> Column:
    return F.concat_ws("\t", F.col("image_id").cast("string"), "image_b64")


def write_images(images: DataFrame, path: str, *, ordered: bool = True, mode: str = "errorifexists") -> None:
    rows = _in_order(images.select("ord", "image_id", "image_b64"), ordered)
    rows.select(image_line().alias("value")).write.mode(mode).text(path)


def append_rows(texts: DataFrame, images: DataFrame, folder: str, split: str = "train", batch: str | None = None) -> bool:
    """Append to a stored split: readers see both files' new rows or neither's.

    Both are written to hidden folders first; the commit that names them comes
    last.  An append that broke off is not seen, and running it again appends
    once.  ``batch`` names the append: a batch of that name that is committed
    already is not appended again, and the result is False.
    """
    spark = texts.sparkSession
    done = snapshots.commits(spark, folder)
    if batch is not None and any(c.batch == batch and c.split == split for c in done):
        return False
    number = done[-1].number + 1 if done else 1
    # the ends of the row numbers are read before the rows are laid out
    texts, images = staged(texts), staged(images)
    write_images(images, snapshots.batch_path(images_path(folder, split), number), mode="overwrite")
    write_texts(texts, snapshots.batch_path(texts_path(folder, split), number), mode="overwrite")
    snapshots.commit(spark, folder, snapshots.Commit(number, batch or uuid.uuid4().hex, split))
    return True


def write_review(rows: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).text(path)


def write_dataset(
    texts: DataFrame,
    images: DataFrame,
    folder: str,
    splits=SPLITS,
    *,
    overwrite: bool = False,
    ordered: bool = True,
) -> None:
    """One caption and one image folder per split."""
    spark, names, hidden = texts.sparkSession, list(splits), {}
    paths.require_free(spark, folder, overwrite)
    place = (F.array_position(F.array(*map(F.lit, names)), F.col("split")) - 1).alias("place")
    for rows, line, named in ((texts, text_json(texts), texts_path), (images, image_line(), images_path)):
        # one job for all splits, whatever it takes to make the rows
        hidden[named] = f"{folder}/_write-{uuid.uuid4().hex}"
        kept = rows.where(F.col("split").isin(names)).select(place, "split", "ord", line.alias("value"))
        laid = in_order(kept, "ord", within=("place", len(names))) if ordered else kept
        laid.select("place", "value").write.partitionBy("place").text(hidden[named])
    # then each split's files get their names; batches of the old files are gone with them
    paths.remove(spark, f"{folder}/{snapshots.COMMITS}")
    for named, parts in hidden.items():
        for number, split in enumerate(names):
            paths.replace(spark, f"{parts}/place={number}", named(folder, split))
        paths.remove(spark, parts)


def with_other_splits(done: DataFrame, source: DataFrame, splits: list[str]) -> DataFrame:
    """Processed splits plus the untouched rows of all others."""
    return done.unionByName(source.where(~F.col("split").isin(*splits)), allowMissingColumns=True)
