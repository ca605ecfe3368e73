"""Collection quotas and how far a dataset fills them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.attributes import with_attrs_only
from pairloom.functions.lexicon import CHINESE, Lexicon
from pairloom.functions.text import once_per_text


def checklist_items(checklist: DataFrame) -> DataFrame:
    """One row per item with its target range as numbers."""
    items = checklist.select(F.explode_outer("items").alias("item")).select("item.*")
    return with_target_range(items)


def with_target_range(items: DataFrame) -> DataFrame:
    bounds = F.split("target_images", "-")
    return items.withColumns(
        {"target_lo": bounds[0].cast("bigint"), "target_hi": bounds[1].cast("bigint")}
    )


def example_queries(items: DataFrame) -> DataFrame:
    return items.select("id", F.posexplode_outer("queries").alias("pos", "query")).where("query is not null")


def quotas(items: DataFrame) -> DataFrame:
    return items.groupBy("priority", "category").agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("target_lo").alias("target_lo"),
        F.sum("target_hi").alias("target_hi"),
    )


def attribute_images(texts: DataFrame, lex: Lexicon = CHINESE, wanted: DataFrame | None = None) -> DataFrame:
    """``label, images``: distinct images per colour and object in captions.

    With ``wanted`` (``label``) only those labels meet the captions' id lists.
    """

    def named(captions: DataFrame) -> DataFrame:
        # several phrases of a caption may have one label
        labels = F.transform("attrs", lambda p: F.regexp_extract(p, f"{lex.colour_pattern}.*", 0))
        return with_attrs_only(captions, lex=lex).select("text", F.array_distinct(labels).alias("labels"))

    rows = once_per_text(texts.select("split", "text", "image_ids"), named)
    labels = rows.select("split", "image_ids", F.explode_outer("labels").alias("label")).where(F.col("label") != "")
    if wanted is not None:
        labels = labels.join(wanted.select("label").distinct(), "label", "left_semi")
    cited = labels.select("split", "label", F.explode_outer("image_ids").alias("image_id"))
    return (
        cited.where(F.col("image_id").isNotNull())
        .distinct()
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("images"))
    )


def coverage(texts: DataFrame, items: DataFrame, lex: Lexicon = CHINESE) -> DataFrame:
    """Each item with its image count and what is still missing."""
    wanted = items.withColumn("label", F.concat("color", "attribute"))
    have = wanted.join(attribute_images(texts, lex, wanted), "label", "left").na.fill(0, ["images"])
    return have.withColumn("missing", F.greatest(F.col("target_lo") - F.col("images"), F.lit(0)))
