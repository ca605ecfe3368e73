"""Snapshots of a stored dataset: which appended batches its readers see.

Appended rows go to folders named ``_batch-<number>`` beside the files they
follow.  Spark passes over names with an underscore, so a batch is not seen by
anyone until a commit names it: one small file ``_commits/<number>.json``, made
under another name and moved into place when all files of the batch are written.
A run that breaks before that leaves the old state to readers, and the next
append of that number replaces what it left.  One writer at a time; any number
of readers.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

from pairloom.sources.paths import _fs, create

COMMITS = "_commits"


@dataclass(frozen=True)
class Commit:
    """A batch that counts: its number, what its caller calls it, and its split."""

    number: int
    batch: str
    split: str


def _place(folder: str, number: int) -> str:
    return f"{folder}/{COMMITS}/{number:012d}.json"


def commits(spark: SparkSession, folder: str) -> list[Commit]:
    """All commits in order; a row per append."""
    files, where = _fs(spark, f"{folder}/{COMMITS}")
    if not files.exists(where):
        return []
    names = [s.getPath().toString() for s in files.listStatus(where) if s.getPath().getName().endswith(".json")]
    lines = spark.read.text(names, wholetext=True).collect() if names else []
    return sorted((Commit(**json.loads(line.value)) for line in lines), key=lambda c: c.number)


def batch_path(path: str, number: int) -> str:
    """Where batch ``number`` of the files under ``path`` lies; sorts after them, and by number."""
    return f"{path}/_batch-{number:012d}"


def visible(spark: SparkSession, folder: str, path: str, split: str) -> list[str]:
    """The folders that hold a split's rows under ``path``, in line order."""
    return [path, *(batch_path(path, c.number) for c in commits(spark, folder) if c.split == split)]


def commit(spark: SparkSession, folder: str, entry: Commit) -> None:
    """Make a written batch count; fails if its number is taken."""
    if not create(spark, _place(folder, entry.number), json.dumps(asdict(entry))):
        raise FileExistsError(f"commit {entry.number} of {folder} is taken")


def drop_uncommitted(spark: SparkSession, folder: str, path: str) -> list[str]:
    """Delete batches under ``path`` that no commit names; returns their names."""
    known = {f"_batch-{c.number:012d}" for c in commits(spark, folder)}
    files, where = _fs(spark, path)
    left = [s.getPath() for s in files.listStatus(where) if s.getPath().getName().startswith("_batch-")]
    left = [p for p in left if p.getName() not in known]
    for place in left:
        files.delete(place, True)
    return sorted(p.getName() for p in left)
