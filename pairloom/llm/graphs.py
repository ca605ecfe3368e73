"""Connected components of a graph of integer nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.session import staged


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; ``root`` is the component's smallest node.

    Large-star and small-star steps in turn: every node hands its larger (then
    its smaller) neighbours to the smallest node it knows, until each component
    is a star.  Minima are aggregates with partial sums; a node with very many
    neighbours only makes a skewed join.  Each round is written to the shared
    folder, so no round depends on the ones before.
    """
    pairs = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = staged(pairs.distinct())
    seen, state = None, _state(now)
    while state != seen:  # stars are left as they are
        now = staged(_small(staged(_large(now))))  # small steps read their edges three times
        seen, state = state, _state(now)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select("v", "v").distinct()).toDF("node", "root")


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large(pairs: DataFrame) -> DataFrame:
    """Edges u > v; every node links its larger neighbours to its smallest neighbour or itself."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))  # the smallest neighbour of nodes that have a smaller one
    # for edge u > v: v links u to the least node that v knows
    known = pairs.join(least.withColumnRenamed("u", "v"), "v", "left")
    return known.select("u", F.coalesce("m", "v").alias("v")).distinct()


def _small(pairs: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    linked = pairs.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).distinct()
