"""Caption expansion with first-seen deduplication.

Both operators give every emitted caption one BIGINT rank (row order, then
slot).  Duplicates fold in an aggregate that keeps the smallest rank, which is
combined before the shuffle: a caption repeated in a third of all rows leaves
every task as one row.  A digest stands for the id list there, which may be very
long; the list itself joins the emissions that are left.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.attributes import with_attribute_queries
from pairloom.functions.lexicon import CHINESE, Lexicon
from pairloom.functions.text import once_per_text, tidy_queries, tidy_query
from pairloom.functions.variants import with_variants
from pairloom.operators.ids import dense_id
from pairloom.operators.merge import NO_IDS
from pairloom.session import drop_scratch, staged, staged_apart


def _list_key(ids: Column) -> Column:
    """128 bits that stand for an id list."""
    return F.unhex(F.md5(F.array_join(ids.cast("array<string>"), ",", "-")))


def _with_lists(emitted: DataFrame, texts: DataFrame) -> DataFrame:
    """``emitted`` with the ``image_ids`` of the row (``source_ord``) that each comes from."""
    lists = texts.select(
        F.col("split").alias("_split"), F.col("ord").alias("_ord"),
        F.coalesce("image_ids", F.expr(NO_IDS)).alias("image_ids"),
    )
    same = F.col("split").eqNullSafe(F.col("_split")) & (F.col("source_ord") == F.col("_ord"))
    return emitted.join(lists, same).drop("_split", "_ord")


def _emissions(df: DataFrame, slots, per_row: int) -> DataFrame:
    """Explode ``slots`` and rank each element; empty texts are left out."""
    # outer, because Spark would copy the whole expression into a size filter
    keyed = df.withColumn("ids_key", _list_key(F.col("image_ids")))
    rows = keyed.select(
        "split", "ord", "text_id", "ids_key", F.posexplode_outer(slots).alias("slot", "emitted")
    )
    return rows.where(F.col("emitted.text") != "").select(
        "split",
        "ids_key",
        F.col("emitted.text").alias("text"),
        F.col("emitted.derived").alias("derived"),
        F.when(F.col("emitted.derived"), F.col("text_id")).alias("source_text_id"),
        (F.col("ord") * per_row + F.col("slot")).alias("rank"),
    )


def _slot(text, derived: bool):
    return F.struct(text.alias("text"), F.lit(derived).alias("derived"))


def _attribute_slots(captions: DataFrame, max_new: int, keep_original: bool, lex: Lexicon) -> DataFrame:
    """``text, slots``: the tidied caption, unless it is left out, and its queries."""
    asked = with_attribute_queries(captions, max_new=max_new, lex=lex)
    derived = F.transform(tidy_queries(F.col("queries"), lex), lambda q: _slot(q, True))
    own = F.array(_slot(tidy_query(F.col("text"), lex), False))
    return asked.select("text", (F.concat(own, derived) if keep_original else derived).alias("slots"))


def attribute_emissions(
    texts: DataFrame, max_new: int = 8, keep_original: bool = True, lex: Lexicon = CHINESE
) -> DataFrame:
    """First emission of every (caption, images) pair: its rank, the row it comes from, and whether it is derived."""
    rows = texts.select(
        "split", "ord", "text_id", "text", F.coalesce("image_ids", F.expr(NO_IDS)).alias("image_ids")
    )
    rows = once_per_text(rows, lambda captions: _attribute_slots(captions, max_new, keep_original, lex))
    first = (
        _emissions(rows, F.col("slots"), max_new + 1)
        .groupBy("split", "text", "ids_key")
        .agg(
            F.min("rank").alias("rank"),
            F.min_by("source_text_id", "rank").alias("source_text_id"),
        )
    )
    derived = (F.col("rank") % (max_new + 1) > 0) if keep_original else F.lit(True)
    return first.select(
        "split", "text", "rank", "source_text_id", derived.alias("derived"),
        F.expr(f"rank div {max_new + 1}").alias("source_ord"),
    )


#: Captions that go through a shuffle at once: what one slice leaves on disk goes before the next is begun.
SLICE_ROWS = 1 << 24


def _slices(df: DataFrame, rows: int, by: str) -> list[DataFrame]:
    number = max(1, -(-rows // SLICE_ROWS))
    place = F.pmod(F.xxhash64(by), F.lit(number))
    return [df.where(place == at) if number > 1 else df for at in range(number)]


def _with_shared(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with ``shared``, whether other rows of the split have the same id list, and how many share theirs."""
    keyed = rows.withColumn("ids_key", _list_key(F.col("image_ids")))
    lists = keyed.groupBy(F.col("split").alias("_split"), F.col("ids_key").alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    lists = staged(lists.where("_rows > 1"))
    same = F.col("split").eqNullSafe(F.col("_split")) & (F.col("ids_key") == F.col("_key"))
    marked = keyed.join(lists, same, "left").withColumn("shared", F.col("_rows").isNotNull())
    return marked.drop("ids_key", "_split", "_key", "_rows"), lists.agg(F.sum("_rows")).first()[0] or 0


def _first_texts(rows: DataFrame, per_row: int) -> DataFrame:
    """``split, ord, same, places, number``: where a row has texts that no row of the same images has before it.

    A text and its images are shuffled as 128 bits.  Without an ``ord`` every
    text has a row of its own.
    """
    key = F.unhex(F.md5(F.concat(F.hex("ids_key"), F.col("text"))))
    emitted = rows.select(
        "split", "ord", "same", _list_key(F.col("image_ids")).alias("ids_key"), F.posexplode("texts").alias("place", "text")
    ).select("split", key.alias("key"), (F.col("ord") * per_row + F.col("place")).alias("rank"), "same")
    first = emitted.groupBy("split", "key").agg(F.min("rank").alias("rank"), F.min_by("same", "rank").alias("same"))
    return (
        first.select(
            "split",
            F.expr(f"(rank - pmod(rank, {per_row})) div {per_row}").alias("ord"),
            F.coalesce("same", F.xxhash64("key")).alias("same"),
            F.pmod("rank", F.lit(per_row)).cast("int").alias("place"),
        )
        .groupBy("split", "ord", "same")
        .agg(F.sort_array(F.collect_list("place")).alias("places"), F.count(F.lit(1)).cast("int").alias("number"))
    )


def expand_attributes(
    texts: DataFrame, max_new: int = 8, keep_original: bool = True, lex: Lexicon = CHINESE
) -> DataFrame:
    """Originals and attribute queries, renumbered from 0 in every split.

    ``ord`` equals the new id; ``source_ord`` is the input row.  A caption stays
    one row with the array of its texts; only rows that share their id list have
    texts to compare.  Arrays are taken apart at the end, without a shuffle.
    Steps are written slice by slice, so the disk holds the captions with their
    texts and the shuffles of one slice.  ``texts`` is read once per slice.
    """
    spark, per_row = texts.sparkSession, max_new + 1
    rows = texts.select(
        "split", "ord", "text_id", "text", F.coalesce("image_ids", F.expr(NO_IDS)).alias("image_ids")
    )
    marked, sharing = _with_shared(rows.withColumn("same", F.hash("text", "image_ids")))

    def emitted(captions: DataFrame) -> DataFrame:
        slots = _attribute_slots(captions, max_new, keep_original, lex)
        own = F.get("slots", F.lit(0))["text"] != "" if keep_original else F.lit(False)
        return slots.select(
            "text", F.array_distinct(F.filter("slots.text", lambda t: t != "")).alias("texts"), own.alias("own")
        )

    asked = []
    for part in _slices(marked, texts.count(), "text"):
        done = once_per_text(part, emitted).drop("text").withColumn("number", F.size("texts"))
        frame, folder = staged_apart(done)
        # ``same`` tells rows of an equal ``ord`` apart; the slice stands above the bits of the hash
        same = F.col("same").cast("bigint") + (len(asked) << 32)
        # filtered when it is written: Spark would copy all the rules into the filter
        asked.append((frame.where("number > 0").withColumn("same", same), folder))

    every = reduce(DataFrame.unionAll, [frame for frame, _ in asked])
    firsts = [staged_apart(_first_texts(part, per_row)) for part in _slices(every.where("shared"), sharing, "image_ids")]
    alone = every.where("not shared").select("split", "ord", "same", F.expr("cast(null as array<int>)").alias("places"), "number")
    known = reduce(DataFrame.unionAll, [frame for frame, _ in firsts], alone)
    numbered = dense_id(known, "first_id", ["ord", "same"], within=["split"], takes="number")
    drop_scratch(spark, [folder for _, folder in firsts])

    grown = []
    for at, (frame, folder) in enumerate(asked):
        low = (at << 32) - (1 << 31)
        grown.append(staged(_with_first(frame, numbered.where(F.col("same").between(low, low + (1 << 32) - 1)))))
        drop_scratch(spark, [folder])
    named = reduce(DataFrame.unionAll, grown).select("*", F.posexplode("texts").alias("pos", "new_text"))
    new_id, derived = F.col("first_id") + F.col("pos"), ~F.col("own") | (F.col("pos") > 0)
    return named.select(
        "split",
        new_id.alias("ord"),
        new_id.alias("text_id"),
        F.col("new_text").alias("text"),
        "image_ids",
        F.when(derived, F.col("text_id")).alias("source_text_id"),
        derived.alias("derived"),
        F.col("ord").alias("source_ord"),
    )


def _with_first(rows: DataFrame, numbered: DataFrame) -> DataFrame:
    """``rows`` with the texts that they have first, the id of the first of them, and whether that is their ``own``."""
    numbered = numbered.select(
        F.col("split").alias("_split"), F.col("ord").alias("_ord"), F.col("same").alias("_same"), "places", "first_id"
    )
    row = F.col("split").eqNullSafe(F.col("_split")) & (F.col("ord") == F.col("_ord")) & (F.col("same") == F.col("_same"))
    some = F.transform("places", lambda place: F.get("texts", place))
    return rows.join(numbered, row).select(
        "split", "ord", "text_id", "image_ids", "first_id",
        (F.col("own") & (F.coalesce(F.get("places", F.lit(0)), F.lit(0)) == 0)).alias("own"),
        F.when(F.col("places").isNull() | (F.size("places") == F.col("number")), F.col("texts")).otherwise(some).alias("texts"),
    )


def expansion_histogram(texts: DataFrame, expanded: DataFrame) -> DataFrame:
    """``split, new_rows, inputs``: how many inputs gained how many rows.

    ``expanded`` may be the expansion or just its emissions.
    """
    inputs = texts.select("split", F.col("ord").alias("source_ord"), F.lit(0).alias("new"))
    gained = expanded.where("derived").select("split", "source_ord", F.lit(1).alias("new"))
    per_input = inputs.unionByName(gained).groupBy("split", "source_ord").agg(F.sum("new").alias("new_rows"))
    return per_input.groupBy("split", "new_rows").agg(F.count(F.lit(1)).alias("inputs"))


def expansion_stats(texts: DataFrame, expanded: DataFrame) -> DataFrame:
    """Input, output and derived rows, and mean gain, per split.

    ``expanded`` may be the expansion or just its emissions.
    """
    before = texts.groupBy("split").agg(F.count(F.lit(1)).alias("input_rows"))
    after = expanded.groupBy("split").agg(
        F.count(F.lit(1)).alias("output_rows"), F.count_if("derived").alias("expanded_rows")
    )
    mean = F.bround(F.col("expanded_rows") / F.greatest("input_rows", F.lit(1)), 2)
    return before.join(after, "split", "left").na.fill(0).withColumn("avg_new_per_input", mean)


def expand_variants(
    texts: DataFrame,
    *,
    max_new: int = 2,
    min_len: int = 8,
    max_len: int = 55,
    single_image_only: bool = False,
    split_subjects: bool = False,
    lex: Lexicon = CHINESE,
) -> DataFrame:
    """All originals unchanged, then new variants with ids after the maximum.

    A variant equal to any tidied original with the same images is left out;
    the cut to ``max_new`` comes before that check.
    """
    rows = texts.select(
        "split", "ord", "text_id", "text", F.coalesce("image_ids", F.expr(NO_IDS)).alias("image_ids")
    )

    def varied(captions: DataFrame) -> DataFrame:
        return with_variants(
            captions, max_new=max_new, min_len=min_len, max_len=max_len, split_subjects=split_subjects, lex=lex
        )

    rows = once_per_text(rows, varied)
    new = F.transform("variants", lambda v: _slot(v, True))
    if single_image_only:
        new = F.when(F.size("image_ids") == 1, new).otherwise(F.slice(new, 1, 0))
    slots = F.concat(F.array(_slot(F.col("tidied"), False)), new)
    first = (
        _emissions(rows, slots, max_new + 1)
        .groupBy("split", "text", "ids_key")
        .agg(F.min("rank").alias("rank"), F.bool_and("derived").alias("unseen"))
        .where("unseen")
        .select("split", "text", "rank", F.expr(f"rank div {max_new + 1}").alias("source_ord"))
    )
    added = _with_lists(dense_id(first, "place", ["rank"], within=["split"]), texts)
    ends = texts.groupBy("split").agg(
        (F.max("text_id") + 1).alias("first_id"), (F.max("ord") + 1).alias("first_ord")
    )
    added = added.join(ends, "split").select(
        "split",
        (F.col("first_ord") + F.col("place")).alias("ord"),
        (F.col("first_id") + F.col("place")).alias("text_id"),
        "text",
        "image_ids",
    )
    return texts.unionByName(added, allowMissingColumns=True)
