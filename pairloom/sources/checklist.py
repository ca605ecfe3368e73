"""Collection checklists: one nested JSON document."""

from pyspark.sql import DataFrame, SparkSession

from pairloom.schema import CHECKLIST


def read_checklist(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHECKLIST).option("multiLine", True).option("mode", "FAILFAST").json(path)
