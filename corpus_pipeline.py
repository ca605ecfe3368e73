"""A training corpus from raw documents, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; its
result is written as Parquet and is the next stage's ``docs``.  So a stage that
begins may delete what the stage before it staged.  All stages but the last
return the columns of ``docs``, whatever other columns there are.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import langid, mixing, packing, perplexity, queries, simhash
from pairloom.llm.common import WORD, with_row_ids
from pairloom.session import drop_scratch, scratch_folders, staged

#: All columns of a document in one, so that no name can clash.
_ROW = "__row"


def _rows(docs: DataFrame) -> DataFrame:
    named = ["doc_id", "text", "lang", "source"]
    return docs.select(F.struct("*").alias(_ROW), *[F.col(c).alias(f"doc_{c}") for c in named])


def _plain(docs: DataFrame) -> tuple[DataFrame, list[Column], dict[str, str]]:
    """``docs`` under the names c0, c1, .. that nothing clashes with, the columns to keep, and the names of the known ones."""
    named = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*named.values()), [F.col(c) for c in named.values()], named


#: Scratch folders of the last stage that was called.
_left: list[str] = []


def _stage(function):
    @wraps(function)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_scratch(spark, _left)
        _left.clear()
        before = set(scratch_folders())
        out = function(spark, docs, sf_dir)
        _left.extend(f for f in scratch_folders() if f not in before)
        return out

    return stage


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, with ``lang`` set to it.

    Learns from every document that names its language.
    """
    rows, keep, named = _plain(docs)
    judged = langid.identify(rows, F.lit(True), keep, text=named["text"], lang=named["lang"]).where("NOT rejected")
    return judged.select(*[F.col("lang_pred" if c == "lang" else n).alias(c) for c, n in named.items()])


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the perplexity band of their language."""
    rows, keep, named = _plain(docs)
    judged = perplexity.judge(rows, keep, text=named["text"], lang=named["lang"]).where("kept")
    return judged.select(*[F.col(n).alias(c) for c, n in named.items()])


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest doc_id, NULL last.

    Near duplicates share 80 % of their runs of five words (Jaccard similarity).
    Multi-index hashing of SimHash fingerprints finds them, the runs decide.
    """
    rows = with_row_ids(_rows(docs))
    member = F.struct(F.col("doc_doc_id").isNull().alias("last"), F.col("doc_doc_id").alias("id"), "row_id").alias("member")
    near = simhash.near_texts(rows, member, text="doc_text")
    kept = near.where("member = least").select("row_id")
    return rows.join(kept, "row_id", "left_semi").select(f"{_ROW}.*")


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    The document at which a source's budget ends gives only its first words,
    parted by single spaces.
    """
    rows = with_row_ids(_rows(docs))
    sized = mixing.sized(rows, [F.col("row_id"), F.col("doc_doc_id").alias("doc_id"), F.col("doc_source").alias("source")], "doc_text")
    taken = mixing.mix(sized).where("taken > 0").select(
        "row_id", F.floor(F.col("taken") / F.col("size")).alias("whole"), (F.col("taken") % F.col("size")).alias("part")
    )
    words = F.slice(F.regexp_extract_all("doc_text", F.lit(f"({WORD})")), F.lit(1), F.col("part").cast("int"))
    times = F.sequence(F.lit(1).cast("long"), F.col("whole") + F.when(F.col("part") > 0, 1).otherwise(0))
    out = rows.join(taken, "row_id").withColumn("time", F.explode(times))
    cut = F.col("time") > F.col("whole")
    text = F.when(cut, F.array_join(words, " ")).otherwise(F.col("doc_text"))
    row = F.col(_ROW).withField("text", text)
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.when(cut, F.length(text).cast("long")).otherwise(F.col(f"{_ROW}.n_chars")))
    return out.select(row.alias(_ROW)).select(f"{_ROW}.*")


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents' tokens in full sequences, one row per piece."""
    return packing.pack(docs, queries.tokenizer("word_bpe_49k.json")).drop("row_id")


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("pack", pack),
]

#: Language models, fingerprints and token ids are beyond SQL; the tests hold brute force against each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, read = queries.read(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
        drop_scratch(spark, read)
        read = scratch_folders()[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
