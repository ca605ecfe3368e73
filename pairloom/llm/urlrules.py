"""URL filter: given host and path rules, then mined association rules.

Given rules decide first.  URLs that none of them fits are judged by rules
mined with FP-growth from labelled URLs: sets of URL tokens that occur together
often enough (support) and whose URLs are bad often enough (confidence).  Rules
of one token are counted for all tokens, and need MIN_COUNT bad URLs however many
URLs are labelled, so a host of twenty bad pages is found in any table.  Of tokens
that occur in the very same labelled URLs (a host's parts, the words of a site's
template) the first in code-point order stands for all: sets of the others hold
the same URLs, and FP-growth would list every one of them.  A rule that a smaller
one with at least its confidence already covers is dropped.
Rules are indexed by their rarest token; a URL looks up its tokens and keeps the
rules it contains whole.

Special rows.  A URL that is NULL or has no ``://`` has empty host and path, no
token, and is allowed.  Labels that are NULL count as good.  Without labelled
URLs, or without rules, every URL that no given rule fits is allowed.  Repeated
rows are judged alike, each on its own; other columns play no part.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import with_row_ids
from pairloom.session import staged

#: (host, path, verdict) in no order: the longest that fits wins.
GIVEN = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
MIN_SUPPORT, MIN_CONFIDENCE = 0.002, 0.6
#: Bad URLs a rule must hold for at least, however few are labelled.
MIN_COUNT = 20

_BAD = "verdict=block"


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def given_rule(host: Column, path: Column, rules=GIVEN) -> Column:
    """Struct (rule, verdict) of the longest given rule that fits, or NULL."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: the host, its parts, path words, file ending, query keys and fragment."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    words = F.filter(F.split(path, r"[/._-]"), lambda x: (x != "") & ~x.rlike(r"^\d+$"))
    query = F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&")
    keys = F.filter(F.transform(query, lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")
    named = lambda kind, items: F.transform(items, lambda x: F.concat(F.lit(kind), x))
    fragment = F.when(F.instr(url, "#") > 0, F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))
    whole = F.when(host != "", F.array(F.concat(F.lit("host="), host))).otherwise(F.array().cast("array<string>"))
    every = F.concat(whole, named("label=", labels), named("word=", words), named("key=", keys), fragment)
    return F.when(host != "", F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(rule_id, items, key, confidence, support) from ``labelled`` (tokens, bad)."""
    # written, so that a row keeps its number
    rows = staged(labelled.select("tokens", F.coalesce("bad", F.lit(False)).alias("bad"), F.monotonically_increasing_id().alias("row")))
    n = rows.count()
    empty = labelled.sparkSession.createDataFrame([], "rule_id long, items array<string>, key string, confidence double, support double")
    if not n:
        return empty
    each = rows.select("row", "bad", F.explode("tokens").alias("item"))
    same = F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("same")
    counts = each.groupBy("item").agg(F.count(F.lit(1)).alias("freq"), F.count_if("bad").alias("hits"), same)
    single = staged(counts.groupBy("freq", "hits", "same").agg(F.min("item").alias("item")).drop("same"))

    support = min(max(min_support, MIN_COUNT / n), 1.0)
    lists = each.join(single.where(F.col("freq") >= support * n), "item").groupBy("row").agg(F.collect_list("item").alias("kept"))
    kept = F.coalesce("kept", F.array().cast("array<string>"))
    sets = rows.join(lists, "row", "left").select(F.when(F.col("bad"), F.array_append(kept, _BAD)).otherwise(kept).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(sets)
    rules = model.associationRules.where((F.col("consequent")[0] == _BAD) & (F.size("antecedent") > 1))
    rules = rules.select(F.array_sort("antecedent").alias("items"), "confidence", "support")
    alone = single.where((F.col("hits") >= MIN_COUNT) & (F.col("hits") >= min_confidence * F.col("freq")))
    alone = alone.select(F.array("item").alias("items"), (F.col("hits") / F.col("freq")).alias("confidence"), (F.col("hits") / n).alias("support"))
    numbered = staged(rules.unionByName(alone).withColumn("rule_id", F.xxhash64("items")))
    of_item = numbered.select("rule_id", F.explode("items").alias("item")).join(single.select("item", "freq"), "item")
    key = of_item.groupBy("rule_id").agg(F.min(F.struct("freq", "item"))["item"].alias("key"))
    # a rule is idle when a smaller one, found through its key token, is as sure
    keyed = staged(numbered.join(key, "rule_id"))
    small = keyed.select(F.col("key").alias("item"), F.col("items").alias("small"), F.col("confidence").alias("sure"))
    met = keyed.select("rule_id", "items", "confidence", F.explode("items").alias("item")).join(small, "item")
    idle = met.where(
        (F.size("small") < F.size("items")) & (F.col("sure") >= F.col("confidence"))
        & (F.size(F.array_except("small", "items")) == 0)
    )
    kept = keyed.join(idle.select("rule_id").distinct(), "rule_id", "left_anti")
    return kept.select("rule_id", "items", "key", "confidence", "support")


def judge(pages: DataFrame, labels: DataFrame, given=GIVEN) -> DataFrame:
    """(page_id, host, path, rule, verdict, confidence) of every row of ``pages`` (page_id, url).

    ``labels`` (page_id, bad) names good and bad pages; a page that several rows
    label is bad if one of them says so.
    """
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = with_row_ids(rows.withColumn("tokens", tokens(F.col("url"), F.col("host"), F.col("path"))).drop("url"))
    bad = labels.groupBy("page_id").agg(F.max(F.coalesce("bad", F.lit(False))).alias("bad"))
    rules = staged(mine(rows.where(F.size("tokens") > 0).join(bad, "page_id").select("tokens", "bad")))
    looked = rows.select("row_id", "tokens", F.explode("tokens").alias("key")).join(rules, "key")
    sure = looked.where(F.size(F.array_except("items", "tokens")) == 0).groupBy("row_id").agg(F.max("confidence").alias("confidence"))
    fitting = given_rule(F.col("host"), F.col("path"), given)
    out = rows.join(sure, "row_id", "left").withColumn("given", fitting)
    verdict = F.coalesce("given.verdict", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", F.col("given.rule").alias("rule"), verdict.alias("verdict"), "confidence")
