"""Length filter that also drops images nobody refers to any more."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.text import or_empty
from pairloom.operators.bitmaps import id_bitmaps, with_member


def text_len(text: str = "text") -> Column:
    return F.length(or_empty(F.col(text))).cast("bigint")


def short_texts(texts: DataFrame, max_len: int = 120) -> DataFrame:
    return texts.where(text_len() <= max_len)


def links(texts: DataFrame) -> DataFrame:
    """One row per caption-image reference, in array order; a NULL reference is one too."""
    # the outer form keeps Spark from copying the array expression into a filter
    return (
        texts.select("split", "ord", "text_id", F.posexplode_outer("image_ids").alias("pos", "image_id"))
        .where(F.col("pos").isNotNull())
    )


def referenced_ids(texts: DataFrame) -> DataFrame:
    return links(texts).select("split", "image_id").distinct()


def keep_referenced(images: DataFrame, texts: DataFrame) -> DataFrame:
    """Images cited by a caption of the same split; duplicate rows stay.

    The cited ids are a bitmap that goes to the images, so payload is not
    shuffled; ids too sparse for that are joined.
    """
    cited = links(texts).select("split", "image_id")
    maps = id_bitmaps(cited, "image_id", ["split"])
    if maps is None:
        return images.join(cited.distinct(), ["split", "image_id"], "left_semi")
    return with_member(images, maps, "image_id", ["split"])


def filter_long(
    texts: DataFrame, images: DataFrame, max_len: int = 120
) -> tuple[DataFrame, DataFrame]:
    kept = short_texts(texts, max_len)
    return kept, keep_referenced(images, kept)


def filter_report(texts: DataFrame, images: DataFrame, max_len: int = 120) -> DataFrame:
    """Rows before and after per split, from one pass over each table."""
    counts = texts.groupBy("split").agg(
        F.count(F.lit(1)).alias("texts_before"),
        F.count_if(text_len() <= max_len).alias("texts_after"),
    )
    owned = images.select("split", "image_id", F.lit(1).alias("rows"), F.lit(0).alias("refs"))
    cited = links(short_texts(texts, max_len)).select(
        "split", "image_id", F.lit(0).alias("rows"), F.lit(1).alias("refs")
    )
    per_id = (
        owned.unionByName(cited)
        .groupBy("split", "image_id")
        .agg(F.sum("rows").alias("rows"), F.max("refs").alias("refs"))
    )
    kept = per_id.groupBy("split").agg(
        F.sum("rows").alias("images_before"),
        F.sum(F.col("rows") * F.col("refs")).alias("images_after"),
    )
    both = counts.join(kept, "split", "full_outer").na.fill(0)
    return both.select(
        "split",
        "texts_before",
        "texts_after",
        (F.col("texts_before") - F.col("texts_after")).alias("texts_removed"),
        "images_before",
        "images_after",
        (F.col("images_before") - F.col("images_after")).alias("images_removed"),
    )
