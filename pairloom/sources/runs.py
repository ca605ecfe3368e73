"""Runs that resume: named steps in one folder, each written once.

A run folder holds ``run.json``, which tells what the run is made of, a Parquet
folder per step, and ``done/<step>.json`` with a step's schema for every step
that is whole.  That mark is made under another name and moved into place when
the step's last row is written.  A run that broke off is started again on the
same folder: steps that are done are read, what a broken step left is replaced.
A folder belongs to one run; other settings or changed inputs are refused.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.sources import paths


class Run:
    def __init__(self, spark: SparkSession, folder: str, identity: dict):
        self.spark, self.folder = spark, folder
        said = json.dumps(identity, sort_keys=True, ensure_ascii=False)
        place = f"{folder}/run.json"
        if not paths.create(spark, place, said) and paths.content(spark, place) != said:
            raise ValueError(f"{folder} holds a run of other settings or inputs")

    def _mark(self, name: str) -> str:
        return f"{self.folder}/done/{name}.json"

    def is_done(self, name: str) -> bool:
        return paths.exists(self.spark, self._mark(name))

    def step(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The rows of step ``name``, made unless it is done."""
        return self.steps([name], lambda: (make(),))[0]

    def steps(self, names: Sequence[str], make: Callable[[], Sequence[DataFrame]]) -> tuple[DataFrame, ...]:
        """Several steps of one making, written one after another."""
        if not all(self.is_done(name) for name in names):
            for name, rows in zip(names, make(), strict=True):
                if not self.is_done(name):
                    rows.write.mode("overwrite").parquet(f"{self.folder}/{name}")
                    paths.create(self.spark, self._mark(name), rows.schema.json())
        return tuple(self._stored(name) for name in names)

    def _stored(self, name: str) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(paths.content(self.spark, self._mark(name))))
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def once(self, name: str, action: Callable[[], None]) -> None:
        """A step without rows: a check or a write to elsewhere."""
        if not self.is_done(name):
            action()
            paths.create(self.spark, self._mark(name), "{}")


def listing_key(spark: SparkSession, roots: list[str]) -> str:
    """A key of the names, sizes and times of all files below ``roots``; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots)
    mixed = F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)")
    n, total = files.agg(F.count(F.lit(1)), F.sum(mixed)).first()
    return f"{n}:{total}"
