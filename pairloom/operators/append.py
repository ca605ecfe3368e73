"""Add a batch of annotated images, reusing rows that already exist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.images import content_hash, encode_image, is_image_path, parse_data_url
from pairloom.functions.text import or_empty, strip
from pairloom.operators.filtering import keep_referenced, links
from pairloom.operators.ids import dense_id, next_image_id, next_text_id
from pairloom.session import staged

#: Content of a cited image that is not there (fixed value).
_NO_CONTENT = "0" * 64


def content_index(images: DataFrame) -> DataFrame:
    """``image_id, content``: the hash of every image's payload, the last row's for a repeated id.

    Stored once, it spares appends the payload of the dataset.
    """
    hashed = images.select("image_id", "ord", content_hash(F.col("image_b64")).alias("content"))
    return hashed.groupBy("image_id").agg(F.max_by("content", "ord").alias("content"))


def _keys(pieces: DataFrame, row: str) -> DataFrame:
    """``row, digest, files`` of ``pieces`` (row, content): one digest for a row's set of contents, in any order.

    Four hashes of each different content are folded together, so a row with
    very many images is partial results and never a list.
    """
    different = pieces.groupBy(row, "content").agg(F.count(F.lit(1)).alias("n"))
    folded = [F.bit_xor(_mixed(F.col("content"), k)) for k in range(_FOLDS)]
    files = F.sum("n")
    return different.groupBy(row).agg(_digest(folded, F.count(F.lit(1)), files).alias("digest"), files.alias("files"))


_FOLDS = 4


def _mixed(content: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), content)


def _digest(folded: list[Column], kinds: Column, files: Column) -> Column:
    return F.concat_ws(":", *[c.cast("string") for c in (*folded, kinds, files)])


def _list_keys(batch: DataFrame) -> DataFrame:
    """``batch_ord, text, digest, files`` of rows that hold their images as a list; the digest of ``_keys``, made in place."""
    hashes = F.transform("images", lambda x: F.coalesce(content_hash(x), F.lit(_NO_CONTENT)))

    def fold(contents: Column) -> Column:
        zero = F.lit(0).cast("bigint")
        folded = [F.aggregate(contents, zero, lambda acc, x: acc.bitwiseXOR(_mixed(x, k))) for k in range(_FOLDS)]
        return _digest(folded, F.size(contents).cast("bigint"), F.size("images").cast("bigint"))

    # a list of one list, so that its hashes are made once
    digest = F.transform(F.array(F.array_distinct(hashes)), fold)[0]
    return batch.select("batch_ord", "text", digest.alias("digest"), F.size("images").cast("bigint").alias("files"))


def _key(text: Column) -> Column:
    """Text, set of contents and number of images as 32 bytes."""
    return F.unhex(F.sha2(F.concat_ws(":", "digest", text), 256)).alias("key")


def _existing(train_texts: DataFrame, train_images: DataFrame, contents: DataFrame | None, wanted: DataFrame) -> DataFrame:
    """First train row of every (text, set of contents, number of images) as ``key``."""
    stripped = train_texts.withColumn("text", strip(or_empty(F.col("text"))))
    # only captions the batch asks for, and the images they cite, are worth looking at
    asked = stripped.join(wanted.select("text").distinct(), "text", "left_semi")
    asked = staged(asked.select("split", "ord", "text_id", "text", "image_ids"))
    contents = content_index(keep_referenced(train_images, asked)) if contents is None else contents
    cited = links(asked).select("ord", "image_id").join(contents, "image_id", "left")
    sets = _keys(cited.select("ord", F.coalesce("content", F.lit(_NO_CONTENT)).alias("content")), "ord")
    keyed = asked.join(sets, "ord").select(_key(F.col("text")), "ord", "text_id", "image_ids")
    return keyed.groupBy("key").agg(
        F.min_by("text_id", "ord").alias("old_text_id"), F.min_by("image_ids", "ord").alias("old_image_ids")
    )


def batch_pieces(batch: DataFrame) -> DataFrame:
    """``batch_ord, pos, image``: a row per image of a batch whose ``images`` are arrays."""
    return batch.select("batch_ord", F.posexplode_outer("images").alias("pos", "image")).where(F.col("pos").isNotNull())


def from_uploads(batch: DataFrame) -> DataFrame:
    """``batch`` whose ``images`` are (name, data URL) structs, with bare base64 instead."""
    return batch.withColumn("images", F.transform("images", lambda x: parse_data_url(x["src"])))


def file_pieces(batch: DataFrame, files: DataFrame) -> DataFrame:
    """``batch_ord, pos, image`` from ``batch_ord, paths`` and the listing ``path, content``.

    A path without a file, or of an unsupported kind, is an error.
    """
    wrong = F.raise_error(F.concat(F.lit("No image file of a supported kind: "), F.col("path")))
    content = F.when(is_image_path(F.col("path")), F.col("content"))
    asked = batch.select("batch_ord", F.posexplode_outer("paths").alias("pos", "path")).where(F.col("pos").isNotNull())
    return asked.join(files.select("path", "content"), "path", "left").select(
        "batch_ord", "pos", F.coalesce(encode_image(content), wrong.cast("string")).alias("image")
    )


def from_files(batch: DataFrame, files: DataFrame) -> DataFrame:
    """``batch_ord, text, images`` with arrays, for rows of few files; see ``file_pieces``."""
    lists = file_pieces(batch, files).groupBy("batch_ord").agg(F.sort_array(F.collect_list(F.struct("pos", "image"))).alias("read"))
    return batch.join(lists, "batch_ord", "left").select(
        "batch_ord", "text", F.transform("read", lambda x: x["image"]).alias("images")
    )


def append_annotations(
    texts: DataFrame,
    images: DataFrame,
    batch: DataFrame,
    split: str = "train",
    *,
    pieces: DataFrame | None = None,
    contents: DataFrame | None = None,
) -> DataFrame:
    """Resolve a batch ``batch_ord, text, images`` (arrays of base64).

    One row per batch row: ``batch_ord, text, text_id, image_ids, existing``.
    Rows are treated as if they came one after the other, so a repeat inside
    the batch is 'existing' too.  ``pieces`` (batch_ord, pos, image) stands for
    the arrays if given, and ``contents`` (see ``content_index``) for the payload
    of the stored images of the split.
    """
    text = strip(or_empty(F.col("text")))
    train_texts, train_images = texts.where(F.col("split") == split), images.where(F.col("split") == split)
    # hashes and texts are all that is compared and moved
    if pieces is None:
        keyed = _list_keys(batch)
    else:
        hashed = F.coalesce(content_hash(F.col("image")), F.lit(_NO_CONTENT)).alias("content")
        keyed = batch.select("batch_ord", "text").join(_keys(pieces.select("batch_ord", hashed), "batch_ord"), "batch_ord", "left")
    empty = F.raise_error(F.lit("images cannot be empty"))
    keyed = staged(
        keyed.withColumn("text", F.when(text == "", F.raise_error(F.lit("text cannot be empty"))).otherwise(text))
        .select("batch_ord", "text", F.coalesce(F.when(F.col("files") > 0, F.col("files")), empty.cast("bigint")).alias("files"), _key(F.col("text")))
    )
    known = _existing(train_texts, train_images, contents, keyed)
    firsts = keyed.groupBy("key").agg(F.min("batch_ord").alias("first_ord"), F.first("files").alias("files"))
    resolved = staged(firsts.join(known, "key", "left"))
    fresh = resolved.where(F.col("old_text_id").isNull()).select("first_ord", "files")

    numbered = dense_id(fresh, "new_text_id", ["first_ord"], start=next_text_id(train_texts))
    slots = fresh.select(
        "first_ord", F.explode_outer(F.sequence(F.lit(1), F.col("files"))).alias("slot")
    )
    placed = dense_id(slots, "image_id", ["first_ord", "slot"], start=next_image_id(images))
    spans = placed.groupBy("first_ord").agg(
        F.sequence(F.min("image_id"), F.max("image_id")).alias("new_image_ids")
    )
    new = numbered.drop("files").join(spans, "first_ord")
    answers = resolved.join(new, "first_ord", "left").select(
        "key",
        "first_ord",
        F.coalesce("old_text_id", "new_text_id").alias("text_id"),
        F.coalesce("old_image_ids", "new_image_ids").alias("image_ids"),
        F.col("old_text_id").isNotNull().alias("known"),
    )
    existing = F.col("known") | (F.col("batch_ord") != F.col("first_ord"))
    return keyed.join(answers, "key").select(
        "batch_ord", "text", "text_id", "image_ids", existing.alias("existing")
    )


def new_rows(
    resolved: DataFrame,
    batch: DataFrame,
    texts: DataFrame,
    images: DataFrame,
    split: str = "train",
    *,
    pieces: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Text and image rows to append to the stored dataset."""
    fresh = resolved.where(~F.col("existing"))

    def after(df: DataFrame) -> Column:
        top = F.coalesce(F.max("ord") + 1, F.lit(0).cast("bigint"))
        return df.where(F.col("split") == split).agg(top.alias("o")).scalar()

    new_texts = fresh.select(
        F.lit(split).alias("split"),
        (after(texts) + F.col("text_id") - next_text_id(texts.where(F.col("split") == split))).alias("ord"),
        "text_id",
        "text",
        "image_ids",
        F.lit(None).cast("bigint").alias("source_text_id"),
    )
    # payloads travel for the new rows only, one by one; a row's ids are consecutive
    first = fresh.select("batch_ord", F.array_min("image_ids").alias("first_id"))
    pairs = (batch_pieces(batch) if pieces is None else pieces).join(first, "batch_ord")
    image_id = F.col("first_id") + F.col("pos")
    new_images = pairs.select(
        F.lit(split).alias("split"),
        (after(images) + image_id - next_image_id(images)).alias("ord"),
        image_id.alias("image_id"),
        F.col("image").alias("image_b64"),
    )
    return new_texts, new_images
