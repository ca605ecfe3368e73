"""Datasets from annotation exports and from query folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.images import encode_image
from pairloom.functions.text import collapse_blanks, or_empty, strip
from pairloom.operators.bitmaps import id_bitmaps, with_rank
from pairloom.operators.ids import dense_id
from pairloom.operators.splitting import exact_split, group_split
from pairloom.schema import SPLITS
from pairloom.session import staged

# Skip reasons of the two folder builders.
EMPTY_QUERY, NO_IMAGES = "empty or missing query.txt", "no positive images"
EMPTY_QUERY_ONE, NO_IMAGE_ONE = "missing query.txt or empty query", "no pos image"
FOLDERS = ("pos_images", "pos")


def split_rank(splits: Sequence[str] = SPLITS) -> Column:
    """0 for the first split of the list, 1 for the next, .."""
    rank = F.array_position(F.array(*map(F.lit, splits)), F.col("split")) - 1
    return rank.cast("bigint")


# --- annotation exports ----------------------------------------------------


def image_captions(annotations: DataFrame, joiner: str = "；") -> DataFrame:
    """Distinct texts of each image in first-seen order, as one caption."""
    texts = annotations.withColumn("txt", collapse_blanks(F.col("txt")))
    # repeated texts fold together before anything is collected
    first = (
        texts.groupBy("source_ord", "export_image_id", "txt")
        .agg(F.min("ord").alias("ord"))
        .where(F.col("txt") != "")
    )
    listed = F.sort_array(F.collect_list(F.struct("ord", "txt")))
    return first.groupBy("source_ord", "export_image_id").agg(strip(F.array_join(listed["txt"], joiner)).alias("caption"))


def export_images(images: DataFrame) -> DataFrame:
    """One row per image id: place of its first entry, data of its last."""
    return (
        images.groupBy("source_ord", "export_image_id")
        .agg(
            F.min("pos").alias("pos"),
            F.max_by("file_name", "pos").alias("file_name"),
            F.max_by("path", "pos").alias("path"),
        )
        .where(or_empty(F.col("file_name")) != "")
    )


def caption_samples(
    images: DataFrame,
    annotations: DataFrame,
    files: DataFrame | None = None,
    *,
    joiner: str = "；",
    keep_empty: bool = False,
) -> DataFrame:
    """``source_ord, export_image_id, pos, file_name, path, caption`` of usable images.

    ``files`` lists the ``path`` of every image file that exists.
    """
    rows = export_images(images)
    if files is not None:
        rows = rows.join(files.select("path"), "path", "left_semi")
    kind = "left" if keep_empty else "inner"
    joined = rows.join(image_captions(annotations, joiner), ["source_ord", "export_image_id"], kind)
    captions = joined.withColumn("caption", or_empty(F.col("caption")))
    return captions if keep_empty else captions.where(F.col("caption") != "")


def uid(prefix: Column, image_id: Column) -> Column:
    return F.concat_ws("__", F.translate(prefix, "\t", " "), image_id.cast("string"))


def number_samples(samples: DataFrame) -> DataFrame:
    """Image ids 1, 2, .. over all exports in argument order."""
    # the cut into ranges looks at the rows before it moves them
    return dense_id(staged(samples), "image_id", ["source_ord", "pos"], start=1)


def with_places(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (split, image_id, ..) numbered 0, 1, .. in every split, in order of their unique ids from 1.

    A place is looked up in a bitmap, so rows stay where they are with all they
    carry; ids too sparse for that are ranked by a shuffle.
    """
    maps = id_bitmaps(rows.select("split", "image_id"), "image_id", ["split"])
    if maps is None:
        return dense_id(rows, name, ["image_id"], within=["split"])
    return with_rank(rows, maps, "image_id", name, ["split"])


def build_from_annotations(
    images: DataFrame,
    annotations: DataFrame,
    files: DataFrame | None = None,
    *,
    joiner: str = "；",
    keep_empty: bool = False,
    ratio: float = 0.1,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """Texts, and images without payload (``path`` instead)."""
    samples = caption_samples(images, annotations, files, joiner=joiner, keep_empty=keep_empty)
    rows = exact_split(number_samples(samples), "image_id", ratio, seed, once=True)
    texts = with_places(rows, "text_id").select(
        "split",
        F.col("text_id").alias("ord"),
        "text_id",
        F.col("caption").alias("text"),
        F.array("image_id").alias("image_ids"),
        F.lit(None).cast("bigint").alias("source_text_id"),
    )
    stock = rows.select("split", F.col("image_id").alias("ord"), "image_id", "path")
    return texts, stock


# --- query folders ---------------------------------------------------------


def sample_status(
    samples: DataFrame,
    queries: DataFrame,
    files: DataFrame,
    reasons: tuple[str, str] = (EMPTY_QUERY, NO_IMAGES),
) -> DataFrame:
    """Every sample with its stripped query, file count and skip reason.

    A folder is known by its name: ``2`` and ``000002`` are two samples.
    """
    counts = files.groupBy("sample").agg(F.count(F.lit(1)).alias("files"))
    rows = (
        samples.join(queries.select("sample", "query"), "sample", "left")
        .join(counts, "sample", "left")
        .withColumn("query", strip(or_empty(F.col("query"))))
    )
    no_query, no_files = reasons
    reason = F.when(F.col("query") == "", no_query).when(F.col("files").isNull(), no_files)
    return rows.withColumn("skip_reason", reason)


def positives_status(
    samples: DataFrame, queries: DataFrame, files: DataFrame, *, ratio: float = 0.0, seed: int = 42
) -> DataFrame:
    """``sample_status`` with a split, over the images of the first folder."""
    files = files.where(F.col("folder") == FOLDERS[0])
    return sample_status(group_split(samples, "sample", ratio, seed), queries, files)


def skipped_samples(status: DataFrame) -> DataFrame:
    return status.where(F.col("skip_reason").isNotNull()).select("split", "sample", "skip_reason")


def build_all_positives(
    samples: DataFrame,
    queries: DataFrame,
    files: DataFrame,
    *,
    text_start: int = 0,
    image_start: int = 0,
    ratio: float = 0.0,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Texts, images (``sample_id, name, path``) and skipped samples.

    ``files`` holds the images of the first folder only.  The split is drawn
    over all samples, skipped ones included.  Ids of the second split go on
    after those of the first.
    """
    # feeds both outputs and the skips
    status = staged(positives_status(samples, queries, files, ratio=ratio, seed=seed))
    files = files.where(F.col("folder") == FOLDERS[0])
    skipped = skipped_samples(status)
    kept = status.where(F.col("skip_reason").isNull()).withColumn("rank", split_rank())

    images = files.select("sample_id", "sample", "name", "path").join(kept.select("sample", "split", "rank"), "sample")
    images = dense_id(images, "image_id", ["rank", "sample_id", "sample", "name"], start=image_start)
    # ids of a sample are consecutive: its list is a range, nothing to collect
    spans = images.groupBy("sample").agg(
        F.min("image_id").alias("lo"), F.max("image_id").alias("hi")
    )
    texts = dense_id(kept, "text_id", ["rank", "sample_id", "sample"], start=text_start).join(spans, "sample")
    texts = texts.select(
        "split",
        F.col("text_id").alias("ord"),
        "text_id",
        F.col("query").alias("text"),
        F.sequence("lo", "hi").alias("image_ids"),
        F.lit(None).cast("bigint").alias("source_text_id"),
    )
    stock = images.select("split", F.col("image_id").alias("ord"), "image_id", "sample_id", "sample", "name", "path")
    return texts, stock, skipped


def fallback_files(files: DataFrame) -> DataFrame:
    """Files of the first folder that has any, per sample."""
    ranked = files.withColumn("folder_rank", F.array_position(F.array(*map(F.lit, FOLDERS)), F.col("folder")))
    ranked = ranked.where("folder_rank > 0")
    best = ranked.groupBy("sample").agg(F.min("folder_rank").alias("folder_rank"))
    return ranked.join(best, ["sample", "folder_rank"]).drop("folder_rank")


def first_positive(files: DataFrame) -> DataFrame:
    """``sample, folder, name, path``: first file by folder, then by name."""
    rank = F.array_position(F.array(*map(F.lit, FOLDERS)), F.col("folder"))
    best = (
        files.where(rank > 0)
        .groupBy("sample")
        .agg(F.min(F.struct(rank.alias("rank"), "name", "folder", "path")).alias("best"))
    )
    return best.select("sample", "best.folder", "best.name", "best.path")


def build_one_positive(
    samples: DataFrame,
    queries: DataFrame,
    files: DataFrame,
    *,
    start: Column | int,
    end: Column | int,
    text_start: Column | int = 0,
    image_start: Column | int = 0,
    split: str = "train",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One caption and one image per zero-padded folder in ``start..end``."""
    # lpad cuts longer ids, so pad only up to the id's own width
    padded = F.lpad(F.col("sample_id").cast("string"), 6, "0")
    name = F.when(F.col("sample_id") < 1_000_000, padded).otherwise(F.col("sample_id").cast("string"))
    chosen = samples.where(F.col("sample_id").between(start, end) & (F.col("sample") == name))
    first = first_positive(files)
    status = sample_status(chosen, queries, first, (EMPTY_QUERY_ONE, NO_IMAGE_ONE))
    skipped = status.where(F.col("skip_reason").isNotNull()).select(
        F.lit(split).alias("split"), "sample", "skip_reason"
    )
    kept = status.where(F.col("skip_reason").isNull()).join(first, "sample")
    kept = dense_id(kept, "place", ["sample_id"])
    shift = lambda by: (F.col("place") + (by if isinstance(by, Column) else F.lit(by))).cast("bigint")
    rows = kept.select(
        F.lit(split).alias("split"),
        F.col("place").alias("ord"),
        shift(text_start).alias("text_id"),
        F.col("query").alias("text"),
        shift(image_start).alias("image_id"),
        "sample_id",
        "folder",
        "name",
        "path",
    )
    texts = rows.select(
        "split", "ord", "text_id", "text", F.array("image_id").alias("image_ids"),
        F.lit(None).cast("bigint").alias("source_text_id"),
    )
    return texts, rows.select("split", "ord", "image_id", "sample_id", "folder", "name", "path"), skipped


def attach_payload(images: DataFrame, files: DataFrame) -> DataFrame:
    """Read the bytes of ``path, content`` rows into ``image_b64``.

    All id work runs without the payload; this join is the one place it moves.
    A listed image whose file is gone is an error.
    """
    gone = F.raise_error(F.concat(F.lit("No file for a listed image: "), F.col("path")))
    content = F.coalesce(F.col("content"), gone.cast("binary"))
    return images.join(files.select("path", "content"), "path", "left").select(
        "split", "ord", "image_id", encode_image(content).alias("image_b64")
    )


def build_report(texts: DataFrame, images: DataFrame, skipped: DataFrame) -> DataFrame:
    """``split, kind, rows, first_id, last_id``; skips count per reason."""

    def counts(df: DataFrame, kind: Column, key: Column) -> DataFrame:
        return df.groupBy("split", kind.alias("kind")).agg(
            F.count(F.lit(1)).alias("rows"), F.min(key).alias("first_id"), F.max(key).alias("last_id")
        )

    return (
        counts(texts, F.lit("texts"), F.col("text_id"))
        .unionByName(counts(images, F.lit("images"), F.col("image_id")))
        .unionByName(counts(skipped, F.col("skip_reason"), F.lit(None).cast("bigint")))
    )
