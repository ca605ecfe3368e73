"""Mixing sources to target weights.

Every source gets a target number of words.  The documents of a source are put
in the order of a hash-random key; the mix takes them from the start, cut at the
source's exact budget, over again (an epoch more) when the budget is larger than
the source.  Prefix sums are made range by range, so a source of any size is
spread over many tasks.

Special rows.  A NULL text has size 0.  A NULL source is a source of its own,
numbered last.  Rows are taken one by one, also when they repeat; rows of equal
doc_id follow each other.  Sources without a word have target 0.  An empty table
gives an empty result.  Columns besides the named ones are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import hash_key, numbered, running_total, word_count
from pairloom.session import staged

WEIGHTS = (1, 2, 3)
#: A target is at most so many times what its source has.
MAX_EPOCHS = 3
SEED = 42


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_no, source_size, target) from (source, source_size), one row per source.

    The sum of all sizes is shared by weight.  A target above ``cap`` times its
    source's size is set to that, and what is over goes to the others by weight,
    until none is above.
    """
    order = [F.col("source").isNull(), F.col("source")]
    known = staged(numbered(sizes, *order, name="source_no"))
    turn = F.pmod("source_no", F.lit(len(weights))).cast("int")
    known = known.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1))
    most = F.col("source_size") * cap
    total, weight = known.agg(F.sum("source_size"), F.sum("weight").cast("long")).first()
    level, capped = (total / weight if weight else 0.0), None
    while True:  # at most once for every source that meets its cap
        above = most <= F.lit(level) * F.col("weight")
        held, rest = known.agg(
            F.sum(F.when(above, most).otherwise(0)), F.sum(F.when(~above, F.col("weight")).otherwise(0)).cast("long")
        ).first()
        if (held, rest) == capped or not rest:
            break
        capped, level = (held, rest), (total - held) / rest
    target = F.when(most <= F.lit(level) * F.col("weight"), most.cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return known.select("source", "source_no", "source_size", target.alias("target"))


def mix(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``sized`` (doc_id, source, size, ..) with source_size, target and ``taken``.

    ``taken`` is the number of the document's words in the mix: whole epochs, and
    what the last, cut epoch takes of it from its start.  Targets are rounded to
    whole words.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = staged(targets(sizes, weights, cap))
    rows = sized.join(plan, sized["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    rows = rows.withColumn("_key", hash_key(F.col("doc_id"), seed=seed))
    rows = running_total(rows, "source_no", "_key", ["doc_id", "size"], "size", "_before")
    budget = F.floor(F.col("target") + 0.5)
    full = F.coalesce(F.floor(F.try_divide(budget, F.col("source_size"))), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), budget - full * F.col("source_size") - F.col("_before")))
    return rows.withColumn("taken", (full * F.col("size") + part).cast("long")).drop("_key", "_before", "source_no")


def sized(docs: DataFrame, keep: list[Column], text: str = "text") -> DataFrame:
    """``keep`` columns and ``size``, the number of words; written, as it is read more than once."""
    return staged(docs.select(*keep, word_count(F.col(text)).alias("size")))
