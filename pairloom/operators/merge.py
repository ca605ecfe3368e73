"""Append one dataset to another with new ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.operators.bitmaps import id_bitmaps, with_rank
from pairloom.operators.build import split_rank
from pairloom.operators.filtering import links
from pairloom.operators.ids import dense_id, next_image_id
from pairloom.operators.validate import duplicate_images, id_tally, missing_references
from pairloom.schema import SPLITS
from pairloom.session import staged

NO_IDS = "cast(array() as array<bigint>)"


def image_id_map(
    base_images: DataFrame,
    added_images: DataFrame,
    splits: Sequence[str] = SPLITS,
    *,
    dense_ord: bool = False,
) -> DataFrame:
    """``split, ord, image_id, new_image_id``: old to new id, in row order.

    With ``dense_ord`` the row numbers already run 0, 1, .. in every split (the
    file readers give them that way) and the new id is plain arithmetic.
    """
    narrow = added_images.select("split", "ord", "image_id")
    numbered = with_new_ids(narrow, base_images, splits, dense_ord=dense_ord)
    return numbered.select("split", "ord", "image_id", "new_image_id")


def with_new_ids(rows: DataFrame, base_images: DataFrame, splits: Sequence[str] = SPLITS, *, dense_ord: bool = False) -> DataFrame:
    """``rows`` (split, ord, ..) with ``new_image_id``, in row order, split after split.

    A row's number is the rows of the splits before plus its place among the
    ``ord`` of its own, looked up in a bitmap, so rows stay where they are with
    all they carry; numbers too sparse for that are ranked by a shuffle.
    """
    start = next_image_id(base_images)
    keys = rows.select("split", "ord").withColumn("rank", split_rank(splits))
    # one row per split, summed up in one small window
    sizes = staged(keys.groupBy("split", "rank").agg(F.count(F.lit(1)).alias("rows"), F.min("ord").alias("least")))
    earlier = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(sizes.select("split", "least", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("skip")))
    if dense_ord:
        placed = rows.join(offsets.drop("least"), "split").withColumn("place", F.col("ord"))
    else:
        lifted = lambda df: df.join(offsets, "split").withColumn("__ord", F.col("ord") - F.col("least") + 1)
        maps = id_bitmaps(lifted(keys.select("split", "ord")), "__ord", ["split"])
        if maps is None:
            return dense_id(rows.withColumn("rank", split_rank(splits)), "new_image_id", ["rank", "ord"], start=start).drop("rank")
        placed = with_rank(lifted(rows), maps, "__ord", "place", ["split"]).drop("__ord", "least")
    return placed.withColumn("new_image_id", (start + F.col("skip") + F.col("place")).cast("bigint")).drop("skip", "place")


def remap_image_ids(texts: DataFrame, id_map: DataFrame) -> DataFrame:
    """Replace every element of ``image_ids``, order kept; unknown ids fail."""
    table = id_map.select("image_id", "new_image_id")
    found = links(texts).join(table, "image_id", "left")
    new_id = F.coalesce(
        "new_image_id",
        F.raise_error(
            F.concat(
                F.lit("text_id "), "text_id", F.lit(" of split "), "split",
                F.lit(" references missing image_id "), "image_id",
            )
        ).cast("bigint"),
    )
    # a row's list is as long as the list it came from
    lists = (
        found.select("split", "ord", "pos", new_id.alias("new_id"))
        .groupBy("split", "ord")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "new_id"))).alias("pairs"))
        .select("split", "ord", F.col("pairs.new_id").alias("new_ids"))
    )
    return (
        texts.join(lists, ["split", "ord"], "left")
        .withColumn("image_ids", F.coalesce("new_ids", F.expr(NO_IDS)))
        .drop("new_ids")
    )


def merge_datasets(
    base_texts: DataFrame,
    base_images: DataFrame,
    added_texts: DataFrame,
    added_images: DataFrame,
    splits: Sequence[str] = SPLITS,
    *,
    dense_ord: bool = False,
    check: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Base rows unchanged, then the added rows under new ids.

    Text ids go on per split, image ids over the whole base dataset.  Both
    results carry ``origin`` ('base' or 'added').
    """
    if check:
        require_unique_images(added_images)
    id_map = image_id_map(base_images, added_images, splits, dense_ord=dense_ord)
    ends = base_texts.groupBy("split").agg(
        (F.max("text_id") + 1).alias("first_id"), (F.max("ord") + 1).alias("first_ord")
    )
    numbered = remap_image_ids(dense_id(added_texts, "place", ["ord"], within=["split"]), id_map)
    new_texts = numbered.join(ends, "split", "left").withColumns(
        {
            "text_id": F.coalesce("first_id", F.lit(0)) + F.col("place"),
            "ord": F.coalesce("first_ord", F.lit(0)) + F.col("place"),
        }
    )
    texts = _stack(base_texts, new_texts, _every(base_texts, added_texts))

    image_ends = base_images.groupBy("split").agg((F.max("ord") + 1).alias("first_ord"))
    # payload takes its new ids where it lies
    moved = with_new_ids(added_images.drop("image_id"), base_images, splits, dense_ord=dense_ord)
    moved = moved.withColumnRenamed("new_image_id", "image_id")
    moved = moved.join(F.broadcast(image_ends), "split", "left").withColumn(
        "ord", F.coalesce("first_ord", F.lit(0)) + F.col("ord")
    )
    images = _stack(base_images, moved, _every(base_images, added_images))
    return texts, images


def _every(base: DataFrame, added: DataFrame) -> list[str]:
    """The columns of either side, unknown ones too."""
    return list(dict.fromkeys([*base.columns, *added.columns]))


def _stack(base: DataFrame, added: DataFrame, columns: Sequence[str]) -> DataFrame:
    have = [c for c in columns if c in base.columns]
    return (
        base.select(*have, F.lit("base").alias("origin"))
        .unionByName(
            added.select(*(c for c in columns if c in added.columns), F.lit("added").alias("origin")),
            allowMissingColumns=True,
        )
    )


def require_unique_images(images: DataFrame) -> None:
    """Image ids must be unique over all splits of the added dataset."""
    over_all = images.select(F.lit("all").alias("split"), "image_id")
    bad = duplicate_images(over_all).orderBy("image_id").limit(10).collect()
    if bad:
        raise ValueError(f"duplicate image_id in added images: {[r.image_id for r in bad]}")


def require_consistent(texts: DataFrame, images: DataFrame) -> None:
    """Output check of a merge: no duplicate ids, no dangling references.

    One tally tells whether there is any; only then are they looked for.
    """
    nowhere = F.col("split").isNull() | F.col("image_id").isNull()  # joins nothing
    cited = F.col("citations") > 0
    wrong = (F.col("image_rows") > 1) | (cited & ((F.col("image_rows") == 0) | nowhere))
    if not id_tally(texts, images).agg(F.count_if(wrong)).first()[0]:
        return
    twice = duplicate_images(images).orderBy("split", "image_id").limit(10).collect()
    if twice:
        raise ValueError(f"duplicate image_id in output: {[(r.split, r.image_id) for r in twice]}")
    gone = missing_references(texts, images).orderBy("split", "text_id", "pos").limit(10).collect()
    if gone:
        raise ValueError(f"output references missing image_ids: {[(r.text_id, r.image_id) for r in gone]}")


def merge_report(merged: DataFrame, id_column: str) -> DataFrame:
    return merged.groupBy("split", "origin").agg(
        F.count(F.lit(1)).alias("rows"), F.min(id_column).alias("first_id"), F.max(id_column).alias("last_id")
    )
