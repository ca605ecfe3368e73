"""Referential integrity between captions and images.

All set checks share one tally per (split, image id): how many image rows carry
the id and how many captions cite it.  It is a plain aggregate with partial
sums, so an id that is cited or copied very often costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.filtering import links


def id_tally(texts: DataFrame, images: DataFrame) -> DataFrame:
    """``split, image_id, image_rows, citations``."""
    owned = images.select("split", "image_id", F.lit(1).alias("i"), F.lit(0).alias("c"))
    cited = links(texts).select("split", "image_id", F.lit(0).alias("i"), F.lit(1).alias("c"))
    return (
        owned.unionByName(cited)
        .groupBy("split", "image_id")
        .agg(F.sum("i").alias("image_rows"), F.sum("c").alias("citations"))
    )


def duplicate_images(images: DataFrame) -> DataFrame:
    return (
        images.groupBy("split", "image_id")
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )


def missing_images(texts: DataFrame, images: DataFrame) -> DataFrame:
    return id_tally(texts, images).where("image_rows = 0").select("split", "image_id", "citations")


def unused_images(texts: DataFrame, images: DataFrame) -> DataFrame:
    return id_tally(texts, images).where("citations = 0").select("split", "image_id")


def missing_references(texts: DataFrame, images: DataFrame) -> DataFrame:
    """Every dangling reference with the caption that makes it."""
    known = images.select("split", "image_id").distinct()
    return links(texts).join(known, ["split", "image_id"], "left_anti").select(
        "split", "text_id", "pos", "image_id"
    )


def shared_images(images: DataFrame, splits: Sequence[str]) -> DataFrame:
    """Ids that a split shares with an earlier one of the list."""
    rank = F.array_position(F.array(*map(F.lit, splits)), F.col("split"))
    present = images.where(F.col("split").isin(*splits)).select(rank.alias("rank"), "image_id")
    # the set holds split numbers only, so it is as short as the split list
    seen = present.groupBy("image_id").agg(F.sort_array(F.collect_set("rank")).alias("ranks"))
    later = seen.where(F.size("ranks") > 1).select(
        "image_id", F.explode_outer(F.expr("slice(ranks, 2, size(ranks))")).alias("rank")
    )
    names = F.array(*map(F.lit, splits))
    return later.select(F.element_at(names, F.col("rank").cast("int")).alias("split"), "image_id")


def violations(
    texts: DataFrame,
    images: DataFrame,
    splits: Sequence[str] = ("train", "valid"),
    *,
    allow_unused: bool = False,
    allow_shared: bool = False,
) -> DataFrame:
    """``check, split, image_id`` for every broken rule."""
    texts = texts.where(F.col("split").isin(*splits))
    images = images.where(F.col("split").isin(*splits))
    # one row per id with the counts of every split, so rows move once for all checks
    names = list(dict.fromkeys(splits))
    owned = images.select("split", "image_id", F.lit(1).alias("i"), F.lit(0).alias("c"))
    cited = links(texts).select("split", "image_id", F.lit(0).alias("i"), F.lit(1).alias("c"))
    of = lambda split, n: F.sum(F.when(F.col("split") == split, F.col(n)).otherwise(0))
    tally = owned.unionByName(cited).groupBy("image_id").agg(
        *[of(s, n).alias(f"{n}{k}") for k, s in enumerate(names) for n in ("i", "c")]
    )
    checks, earlier = [], F.lit(False)
    for k, split in enumerate(names):
        rows, uses = F.col(f"i{k}"), F.col(f"c{k}")
        kinds = {"duplicate": rows > 1, "missing": (rows == 0) & (uses > 0)}
        if not allow_unused:
            kinds["unused"] = (rows > 0) & (uses == 0)
        if not allow_shared:
            kinds["shared"] = (rows > 0) & earlier
            earlier = earlier | (rows > 0)
        checks += [F.when(met, F.struct(F.lit(kind).alias("check"), F.lit(split).alias("split"))) for kind, met in kinds.items()]
    found = tally.select("image_id", F.array_compact(F.array(*checks)).alias("found")).where(F.size("found") > 0)
    return found.select("image_id", F.explode_outer("found").alias("found")).select("found.check", "found.split", "image_id")


def require_valid(texts, images, splits=("train", "valid"), **allow) -> None:
    """Raise on the first broken rule, naming up to ten ids."""
    order = F.array_position(F.array(*map(F.lit, ("duplicate", "missing", "unused", "shared"))), F.col("check"))
    rank = F.array_position(F.array(*map(F.lit, splits)), F.col("split"))
    first = (
        violations(texts, images, splits, **allow)
        .orderBy(F.when(F.col("check") == "shared", 1).otherwise(0), rank, order, "image_id")
        .limit(10)
        .collect()
    )
    if first:
        head = first[0]
        same = [r.image_id for r in first if (r.check, r.split) == (head.check, head.split)]
        raise ValueError(f"{head.check} image_id in split {head.split}: {same}")


def split_report(texts: DataFrame, images: DataFrame) -> DataFrame:
    """``split, texts, images, refs``."""
    t = texts.groupBy("split").agg(
        F.count(F.lit(1)).alias("texts"),
        F.coalesce(F.sum(F.size(F.coalesce("image_ids", F.expr("array()")))), F.lit(0)).alias("refs"),
    )
    i = images.groupBy("split").agg(F.count(F.lit(1)).alias("images"))
    return t.join(i, "split", "full_outer").na.fill(0).select("split", "texts", "images", "refs")


def first_offenders(found: DataFrame, top: int = 10) -> DataFrame:
    """The lowest ids of a violations table, for a message."""
    return found.orderBy("check", "split", "image_id").limit(top)
