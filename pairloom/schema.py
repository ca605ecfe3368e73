"""Row layouts shared by every operator.

``ord`` is the line order made explicit: a BIGINT that is unique inside one
split.  The file readers deliver it dense (0, 1, 2, ..); tables that already
have a unique key can use that key instead.
"""

from pyspark.sql import types as T

IDS = T.ArrayType(T.LongType())

TEXTS = T.StructType(
    [
        T.StructField("split", T.StringType()),
        T.StructField("ord", T.LongType()),
        T.StructField("text_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("image_ids", IDS),
        T.StructField("source_text_id", T.LongType()),
    ]
)

IMAGES = T.StructType(
    [
        T.StructField("split", T.StringType()),
        T.StructField("ord", T.LongType()),
        T.StructField("image_id", T.LongType()),
        T.StructField("image_b64", T.StringType()),
    ]
)

EDITS = T.StructType(
    [
        T.StructField("split", T.StringType()),
        T.StructField("text_id", T.LongType()),
        T.StructField("clean_text", T.StringType()),
        T.StructField("ord", T.LongType()),
    ]
)

# JSON ids may be numbers or numeric strings, so they are read as strings.
TEXT_LINE = T.StructType(
    [
        T.StructField("text_id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("image_ids", T.ArrayType(T.StringType())),
        T.StructField("source_text_id", T.StringType()),
    ]
)

ANNOTATION_EXPORT = T.StructType(
    [
        T.StructField(
            "images",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.StringType()),
                        T.StructField("file_name", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField(
            "annotations",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("image_id", T.StringType()),
                        T.StructField(
                            "attributes",
                            T.StructType([T.StructField("txt", T.StringType())]),
                        ),
                    ]
                )
            ),
        ),
    ]
)

CHECKLIST = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.LongType()),
                        T.StructField("priority", T.StringType()),
                        T.StructField("category", T.StringType()),
                        T.StructField("attribute", T.StringType()),
                        T.StructField("color", T.StringType()),
                        T.StructField("target_images", T.StringType()),
                        T.StructField("queries", T.ArrayType(T.StringType())),
                        T.StructField("note", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)

SPLITS = ("train", "valid")
