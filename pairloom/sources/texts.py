"""Caption files: one JSON object per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.functions.text import strip
from pairloom.schema import TEXT_LINE, TEXTS
from pairloom.sources import paths
from pairloom.sources.lines import numbered_lines

_BAD = "__bad"
_KNOWN = ("text_id", "text", "image_ids", "source_text_id")


def _parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    return lines.withColumn("row", F.from_json("value", full, options))


def _checked(value: Column) -> Column:
    """The parsed row; a broken line is an error that names file and line."""
    message = F.concat(
        F.lit("Invalid JSON in "), "file", F.lit(", record "),
        (F.col("ord") + 1).cast("string"), F.lit(": "), f"row.{_BAD}",
    )
    return F.when(F.col(f"row.{_BAD}").isNull(), value).otherwise(F.raise_error(message))


def _present(value: Column, what: str) -> Column:
    """``value``; NULL is an error that names file and line."""
    place = F.concat("file", F.lit(", record "), (F.col("ord") + 1).cast("string"))
    return F.coalesce(value, F.raise_error(F.concat(F.lit(f"No {what} in "), place)).cast("string"))


def read_texts(
    spark: SparkSession, path: str | list[str], split: str, *, extras: bool = True, once: bool = False
) -> DataFrame:
    """Captions of one split in line order, blank lines skipped.

    ``extras`` holds the unknown keys of every row as MAP<STRING, VARIANT>; it
    costs nothing where it is not selected.  ``once`` reads the files now and
    once (see ``numbered_lines``).
    """

    def shape(lines: DataFrame) -> DataFrame:
        rows = _parsed(lines, TEXT_LINE)
        if extras:
            every = F.from_json("value", "map<string,variant>")
            rows = rows.withColumn("extras", F.map_filter(every, lambda k, v: ~k.isin(*_KNOWN)))
        return rows.drop("value")

    parsed = numbered_lines(spark, path, strip(F.col("value")) != "", shape=shape, once=once)
    columns = [
        F.lit(split).alias("split"),
        "ord",
        _checked(_present(F.col("row.text_id"), "text_id")).cast("bigint").alias("text_id"),
        F.coalesce("row.text", F.lit("")).alias("text"),
        F.coalesce(
            F.transform("row.image_ids", lambda x: _present(x, "element of image_ids").cast("bigint")),
            F.expr("cast(array() as array<bigint>)"),
        ).alias("image_ids"),
        F.col("row.source_text_id").cast("bigint").alias("source_text_id"),
    ]
    if extras:
        columns.append("extras")
    return parsed.select(*columns)


def bad_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Report of lines that are not JSON: ``file, line_no, value``."""
    parsed = _parsed(numbered_lines(spark, path), TEXT_LINE)
    first = parsed.where((strip(F.col("value")) != "") & F.col(f"row.{_BAD}").isNotNull())
    return first.select("file", (F.col("ord") + 1).alias("line_no"), "value")


def read_refs(spark: SparkSession, path: str | list[str], split: str) -> DataFrame:
    """Every referenced image id, repeats included."""
    return (
        read_texts(spark, path, split)
        .select("split", F.posexplode_outer("image_ids").alias("pos", "image_id"))
        .where(F.col("pos").isNotNull())
        .select("split", "image_id")
    )


def read_edits(spark: SparkSession, path: str | list[str], default_split: str) -> DataFrame:
    """Review rows; ``clean_text`` falls back to ``text`` only if it is absent."""
    schema = T.StructType(
        [T.StructField(n, T.StringType()) for n in ("split", "text_id", "text", "clean_text")]
    )
    parsed = _parsed(numbered_lines(spark, path, strip(F.col("value")) != ""), schema)
    has = lambda key: F.array_contains(F.json_object_keys("value"), key)
    return parsed.select(
        F.when(has("split"), F.col("row.split")).otherwise(F.lit(default_split)).alias("split"),
        _checked(_present(F.col("row.text_id"), "text_id")).cast("bigint").alias("text_id"),
        F.when(has("clean_text"), F.col("row.clean_text"))
        .otherwise(F.coalesce("row.text", F.lit("")))
        .alias("clean_text"),
        "ord",
    )


def resolve_splits(split: str) -> list[str]:
    return ["train", "valid"] if split == "all" else [split]


def empty_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], TEXTS)


def texts_path(folder: str, split: str) -> str:
    return f"{folder}/{split}_texts.jsonl"


def has_texts(spark: SparkSession, folder: str, split: str) -> bool:
    return paths.exists(spark, texts_path(folder, split))
