"""Manual review round trips and caption updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.lexicon import CHINESE
from pairloom.functions.text import collapse_blanks, contains_any, or_empty, strip
from pairloom.operators.filtering import text_len


def needs_review(min_len: int = 120, keywords: Sequence[str] = CHINESE.review_keywords) -> Column:
    """Long, or containing one of the non-empty keywords."""
    words = [k for k in keywords if k]
    long = text_len() >= min_len
    return long | contains_any(or_empty(F.col("text")), words) if words else long


def review_rows(
    texts: DataFrame, min_len: int = 120, keywords: Sequence[str] = CHINESE.review_keywords
) -> DataFrame:
    return texts.where(needs_review(min_len, keywords)).select(
        "split",
        "text_id",
        text_len().alias("text_len"),
        F.size(F.coalesce("image_ids", F.expr("array()"))).cast("bigint").alias("image_count"),
        "image_ids",
        or_empty(F.col("text")).alias("text"),
        or_empty(F.col("text")).alias("clean_text"),
    )


def review_report(
    texts: DataFrame, min_len: int = 120, keywords: Sequence[str] = CHINESE.review_keywords
) -> DataFrame:
    return texts.groupBy("split").agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if(needs_review(min_len, keywords)).alias("review_rows"),
    )


def _or_fail(good: Column, value: Column, message: Column) -> Column:
    return F.when(good, value).otherwise(F.raise_error(message))


def _label() -> Column:
    return F.concat(F.lit("split="), "split", F.lit(" text_id="), F.col("text_id").cast("string"))


def last_edits(edits: DataFrame) -> DataFrame:
    """``split, text_id, new_text``: the latest edit of every caption."""
    clean = collapse_blanks(F.col("clean_text"))
    checked = edits.select(
        "split",
        _or_fail(
            F.col("text_id").isNotNull(), F.col("text_id"), F.lit("Missing text_id in review row")
        ).alias("text_id"),
        _or_fail(clean != "", clean, F.concat(F.lit("Empty clean_text for "), _label())).alias("new_text"),
        "ord",
    )
    return checked.groupBy("split", "text_id").agg(F.max_by("new_text", "ord").alias("new_text"))


def apply_review(texts: DataFrame, edits: DataFrame) -> DataFrame:
    """Captions with their edits; ``changed`` tells which ones differ."""
    joined = texts.join(last_edits(edits), ["split", "text_id"], "left")
    changed = F.col("new_text").isNotNull() & ~F.col("text").eqNullSafe(F.col("new_text"))
    return joined.withColumns(
        {"changed": changed, "text": F.coalesce("new_text", "text")}
    ).select(*texts.columns, "changed")


def apply_report(applied: DataFrame, edits: DataFrame) -> DataFrame:
    """One row: edited captions asked for and captions changed."""
    asked = last_edits(edits).agg(F.count(F.lit(1)).alias("n")).scalar()
    return applied.agg(F.count_if("changed").alias("changed_texts")).select(
        asked.alias("edit_rows"), "changed_texts"
    )


def update_texts(texts: DataFrame, updates: DataFrame) -> DataFrame:
    """Set captions by id: ``split, text_id, text, ord`` (later ones win).

    Where an id repeats, only its last row changes.  Empty texts and unknown
    ids are errors.
    """
    text = strip(or_empty(F.col("text")))
    wanted = (
        updates.select(
            "split",
            "text_id",
            _or_fail(text != "", text, F.lit("text cannot be empty")).alias("new_text"),
            "ord",
        )
        .groupBy("split", "text_id")
        .agg(F.max_by("new_text", "ord").alias("new_text"))
    )
    last = texts.groupBy("split", "text_id").agg(F.max("ord").alias("ord"))
    targets = wanted.join(last, ["split", "text_id"], "left").select(
        "split",
        _or_fail(
            F.col("ord").isNotNull(), F.col("ord"), F.concat(F.lit("text not found: "), _label())
        ).alias("ord"),
        "new_text",
    )
    return (
        texts.join(targets, ["split", "ord"], "left")
        .withColumn("text", F.coalesce("new_text", "text"))
        .select(*texts.columns)
    )
