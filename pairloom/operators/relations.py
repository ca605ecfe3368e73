"""Lookups in both directions, summaries and picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.images import data_url
from pairloom.operators.filtering import links
from pairloom.operators.splitting import key_digest


def last_image_rows(images: DataFrame) -> DataFrame:
    """One row per (split, image id): the last one written."""
    return images.groupBy("split", "image_id").agg(
        F.max_by("image_b64", "ord").alias("image_b64")
    )


def text_images(texts: DataFrame, images: DataFrame, *, unique: bool = True) -> DataFrame:
    """Images of every caption in array order, as data URLs.

    A caption that cites an image its split does not have is an error.  With
    ``unique=False`` the last of several image rows with one id counts.
    """
    stock = images if unique else last_image_rows(images)
    stock = stock.select("split", "image_id", data_url(F.col("image_b64")).alias("url"))
    found = links(texts).join(stock, ["split", "image_id"], "left")
    src = F.coalesce(
        "url",
        F.raise_error(
            F.concat(F.lit("image_id "), "image_id", F.lit(" not found in split "), "split")
        ),
    )
    return found.select("split", "text_id", "pos", "image_id", src.alias("src"))


def image_texts(texts: DataFrame, images: DataFrame) -> DataFrame:
    """Captions of every image; one that cites it twice shows up twice."""
    stock = images.select("split", "image_id").distinct()
    cites = texts.select(
        "split", "text_id", "text", "ord", F.posexplode_outer("image_ids").alias("pos", "image_id")
    )
    return stock.join(cites, ["split", "image_id"]).select(
        "split", "image_id", "ord", "pos", "text_id", "text"
    )


def get_text(texts: DataFrame, images: DataFrame, split: str, text_id: int) -> DataFrame:
    """Images of one caption; the last row counts if the id repeats."""
    hits = texts.where((F.col("split") == split) & (F.col("text_id") == text_id))
    one = hits.groupBy("split", "text_id").agg(
        F.max("ord").alias("ord"), F.max_by("image_ids", "ord").alias("image_ids")
    )
    _require(one, f"text_id {text_id} not found in split {split}")
    return text_images(one, images.where(F.col("split") == split), unique=False).orderBy("pos")


def get_image(
    texts: DataFrame, images: DataFrame, split: str, image_id: int, edges: DataFrame | None = None
) -> DataFrame:
    """Captions of one image in row order.

    With a stored ``link_table`` as ``edges`` its filter on the image id reaches
    the scan, and no id list is searched.
    """
    hit = images.where((F.col("split") == split) & (F.col("image_id") == image_id))
    _require(hit, f"image_id {image_id} not found in split {split}")
    mine = texts.where(F.col("split") == split)
    if edges is None:
        mine = mine.where(F.array_contains("image_ids", F.lit(image_id)))
    else:
        citing = edges.where((F.col("split") == split) & (F.col("image_id") == image_id))
        mine = mine.join(citing.select("text_id"), "text_id", "left_semi")
    return image_texts(mine, hit).orderBy("ord", "pos")


def _require(df: DataFrame, message: str) -> None:
    if df.isEmpty():
        raise KeyError(message)


def link_table(texts: DataFrame) -> DataFrame:
    """Edge list to store: ``split, image_id, text_id, pos``."""
    return links(texts).select("split", "image_id", "text_id", "pos")


def summary(texts: DataFrame, images: DataFrame) -> DataFrame:
    """Distinct caption and image ids per split."""
    t = texts.select("split", F.lit("texts").alias("kind"), F.col("text_id").alias("id"))
    i = images.select("split", F.lit("images").alias("kind"), F.col("image_id").alias("id"))
    per_kind = t.unionByName(i).distinct().groupBy("split", "kind").agg(
        F.count(F.lit(1)).alias("ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )
    return per_kind


def sorted_ids(df: DataFrame, column: str) -> DataFrame:
    return df.select("split", column).distinct().orderBy("split", column)


def random_pick(ids: DataFrame, column: str, seed: int = 42) -> DataFrame:
    """One id per split, each equally likely over seeds."""
    return (
        ids.select("split", F.col(column).alias("id"))
        .groupBy("split")
        .agg(F.min_by("id", _roll(F.col("id"), seed)).alias("id"))
    )


def _roll(key: Column, seed: int) -> Column:
    """60 bits of the key digest as a number, so the aggregate stays a hash one."""
    return F.conv(F.substring(key_digest(key, seed), 1, 15), 16, 10).cast("bigint")
