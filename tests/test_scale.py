"""Skew, partition counts and plan shapes."""

import os
import re
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as contract
from pairloom import session
from pairloom.functions import text as text_functions
from pairloom.operators import append, bitmaps, build, coverage, expand, filtering, ids, merge, validate
from pairloom.plans import bindings, catalogue
from pairloom.session import staged

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot_texts(spark, rows=900):
    """A third of all rows is one caption with one image list."""
    text = F.when(F.col("id") % 3 == 0, "穿黑色的上衣的人，地上有水").otherwise(
        F.concat(F.lit("穿白色的裤子的人"), F.col("id").cast("string"))
    )
    return spark.range(rows).select(
        F.lit("train").alias("split"), F.col("id").alias("ord"), F.col("id").alias("text_id"), text.alias("text"),
        F.when(F.col("id") % 3 == 0, F.array(F.lit(1).cast("bigint"))).otherwise(F.array("id")).alias("image_ids"),
    )


def test_expansion_with_a_hot_caption(spark):
    texts = hot_texts(spark)
    out = expand.expand_attributes(texts).collect()
    keys = [(r.text, tuple(r.image_ids)) for r in out]
    assert len(keys) == len(set(keys))
    assert sorted(r.text_id for r in out) == list(range(len(out)))
    hot = sorted((r.text_id, r.text) for r in out if r.image_ids == [1] and r.source_ord == 0)
    assert hot[0] == (0, "穿黑色的上衣的人，地上有水") and len([k for k in keys if k[0] == hot[0][1]]) == 1
    grown = expand.expand_variants(texts).collect()
    assert len([r for r in grown if r.ord < 900]) == 900
    assert len([r for r in grown if r.text == "穿黑色上衣的人，地上有水" and r.image_ids == [1]]) == 1


def mixed_texts(spark, rows=240):
    """Captions of few wordings and few lists, some NULL, over three splits."""
    wordings = F.array(*(F.lit(t) for t in (
        "穿黑色的上衣的人，地上有水", "一个戴着白色头盔穿着黑色的短袖的人，骑着红色的电动车", "穿黑色上衣的人", "", "人", "戴白色头盔的人，骑红色的电动车",
    )), F.lit(None).cast("string"))
    at = F.xxhash64("id")
    return spark.range(rows).select(
        F.get(F.array(F.lit("train"), F.lit("valid"), F.lit(None).cast("string")), F.pmod(at, F.lit(3)).cast("int")).alias("split"),
        (F.col("id") * 7 % rows * 1000).alias("ord"), (F.col("id") + 50).alias("text_id"),
        F.get(wordings, F.pmod(F.shiftright(at, 8), F.lit(7)).cast("int")).alias("text"),
        F.when(F.col("id") % 11 > 0, F.array_repeat(F.when(F.col("id") % 5 > 0, F.col("id") % 13), 1 + (F.col("id") % 2).cast("int"))).alias("image_ids"),
    )


@pytest.mark.parametrize("keep", [True, False])
def test_expansion_in_slices(spark, monkeypatch, keep):
    monkeypatch.setattr(expand, "SLICE_ROWS", 70)
    texts = staged(mixed_texts(spark))
    got = expand.expand_attributes(texts, 5, keep)
    assert "Exchange" not in plan(got)  # neither texts nor lists are in a shuffle of the result
    first = expand.attribute_emissions(texts, 5, keep)
    number = F.row_number().over(Window.partitionBy("split").orderBy("rank")) - 1
    lists = texts.select(F.col("ord").alias("source_ord"), F.coalesce("image_ids", F.array().cast("array<bigint>")).alias("image_ids"))
    want = first.withColumn("text_id", number.cast("bigint")).join(lists, "source_ord")
    names = ["split", "text_id", "text", "image_ids", "source_text_id", "derived", "source_ord"]
    key = lambda rows: sorted(map(str, rows))
    assert key(got.select(names).collect()) == key(want.select(names).collect()) and got.count() > 100
    assert got.where("ord <> text_id").isEmpty()


def test_repeated_and_unnumbered_rows_of_an_expansion(spark):
    schema = "split string, ord bigint, text_id bigint, text string, image_ids array<bigint>"
    rows = [("train", 1, 1, "穿黑色上衣的人", [1]), ("train", 1, 1, "穿黑色上衣的人", [1]), ("train", None, 2, "穿白色上衣的人", [2]), ("train", 1, 3, "穿红色上衣的人", [3])]
    got = expand.expand_attributes(spark.createDataFrame(rows, schema)).select("text", "image_ids").collect()
    # a repeated row is there as often as before, a row without a place has none to stand at
    assert sorted(map(tuple, got)) == [("穿红色上衣的人", [3]), ("穿黑色上衣的人", [1]), ("穿黑色上衣的人", [1])]


def test_expansion_compares_only_rows_that_share_their_images(spark, monkeypatch, texts):
    seen, real = [], expand._first_texts
    monkeypatch.setattr(expand, "_first_texts", lambda rows, per_row: seen.append(rows.count()) or real(rows, per_row))
    out = expand.expand_attributes(texts(*(("train", k, "穿黑色上衣的人", [k // 8 if k > 90 else 1000 + k]) for k in range(96))))
    assert seen == [5] and out.where("not derived").count() == 92  # 91 lists of their own, one of five rows


def test_numbers_of_rows_that_take_several(spark):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("n"), (F.col("id") % 4 + 1).alias("size"))
    got = ids.dense_id(df, "first", ["n"], takes="size")
    before = F.sum("size").over(Window.orderBy("n").rowsBetween(Window.unboundedPreceding, -1))
    assert got.count() == 500 and got.withColumn("want", F.coalesce(before, F.lit(0))).where("first <> want").isEmpty()


def test_staging_frees_its_shuffles(spark):
    jvm = spark.sparkContext._jvm
    disk = jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = jvm.scala.jdk.javaapi.CollectionConverters.asJava(disk.getAllFiles())
        return {f.getName() for f in found if f.getName().endswith(".data")}

    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", files()
    setting = spark.conf.get(key)
    frame = staged(spark.range(20000).groupBy((F.col("id") % 7000).alias("k")).count())
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before and frame.count() == 7000 and spark.conf.get(key) == setting


def test_merge_with_a_hot_image(spark):
    texts = hot_texts(spark)
    images = spark.range(900).select(
        F.lit("train").alias("split"), F.col("id").alias("ord"), F.col("id").alias("image_id"),
        F.col("id").cast("string").alias("image_b64"),
    )
    out, stock = merge.merge_datasets(texts, images, texts, images)
    added = out.where("origin = 'added'").collect()
    assert len(added) == 900
    assert all(r.image_ids == ([901] if (r.text_id - 900) % 3 == 0 else [r.text_id]) for r in added)
    assert validate.missing_images(out, stock).count() == 0


def test_append_with_a_hot_row(spark):
    none = hot_texts(spark).limit(0)
    images = spark.createDataFrame([], "split string, ord bigint, image_id bigint, image_b64 string")
    batch = spark.range(600).select(
        F.col("id").alias("batch_ord"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"),
        F.array(F.lit("A"), F.lit("B")).alias("images"),
    )
    got = append.append_annotations(none, images, batch).orderBy("batch_ord").collect()
    assert [r.batch_ord for r in got] == list(range(600))
    assert got[0].image_ids == [1, 2] and not got[0].existing and got[3].existing and got[3].text_id == 0
    fresh = [r for r in got if not r.existing]
    assert [r.text_id for r in fresh] == list(range(401))
    assert [i for r in fresh for i in r.image_ids] == list(range(1, 803))


@pytest.mark.parametrize("order", [["n"], ["k", "s"], ["s", "k"]])
def test_dense_id_equals_row_number(spark, order):
    # a third of the rows share the leading key
    df = spark.range(1000).select(
        (F.col("id") * 37 % 1000).alias("n"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 90).cast("bigint").alias("k"),
        F.format_string("%05d", F.col("id") * 37 % 1000).alias("s"),
    )
    got = ids.dense_id(df, "dense", order).withColumn("want", F.row_number().over(Window.orderBy(*order)) - 1)
    assert got.count() == 1000 and got.where("dense <> want").count() == 0


def test_ranges_split_a_hot_leading_key(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), "id")
    sizes = ids._ranged(df, ["k", "id"]).groupBy("__part").count()
    assert sizes.count() == 8 and sizes.agg(F.max("count")).first()[0] < 20000 // 4


def test_sparse_ids_are_numbered_by_partition(spark):
    df = spark.range(500).select((F.col("id") * 2**40).alias("n"))
    assert ids._ranged(df, ["n"]).select("__part").distinct().count() <= 8
    assert ids.dense_id(df, "id", ["n"]).where(F.col("id") * 2**40 != F.col("n")).count() == 0
    near = ids.neighbours(df, "n").where((F.col("next_id") - F.col("n") != 2**40) | (F.col("n") - F.col("previous_id") != 2**40))
    assert sorted(r.n for r in near.collect()) == [0, 499 * 2**40]


def test_in_order_gives_ordered_even_parts(spark):
    df = spark.range(5000).select((F.col("id") * 37 % 5000).alias("ord"))
    parts = ids.in_order(df, "ord", 6).select(F.spark_partition_id().alias("p"), "ord").groupBy("p").agg(
        F.min("ord").alias("lo"), F.max("ord").alias("hi"), F.count("*").alias("n")
    ).orderBy("p").collect()
    assert sum(r.n for r in parts) == 5000 and len(parts) > 4
    assert all(a.hi < b.lo for a, b in zip(parts, parts[1:]))
    assert max(r.n for r in parts) < 2500


def test_neighbours_cross_partitions(spark):
    df = spark.range(0, 100, 3).select("id")
    got = {r.id: (r.previous_id, r.next_id) for r in ids.neighbours(df, "id").collect()}
    assert got == {n: (max(n - 3, 0), min(n + 3, 99)) for n in range(0, 100, 3)}


@pytest.mark.parametrize("name", ["expand_attributes", "merge_texts", "folder_texts", "texts_file_round_trip"])
def test_results_do_not_depend_on_partitions(spark, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    seen = set()
    try:
        for parts in ("1", "2", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            rows = contract.queries()[name](spark, SF).collect()
            seen.add(hash(tuple(sorted(map(str, rows)))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(seen) == 1


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_no_query_crosses_rows(spark):
    for name, fn in contract.queries().items():
        shape = plan(fn(spark, SF))
        assert "CartesianProduct" not in shape and "NestedLoopJoin" not in shape, name


def test_scans_are_pruned_and_filtered(spark):
    shape = plan(contract.queries()["validate_duplicates"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in shape
    update = plan(contract.queries()["summary"](spark, SF))
    assert "p_name" not in update.split("part.parquet")[0].rsplit("FileScan", 1)[-1]
    caption = plan(contract.queries()["annotation_images"](spark, SF))
    assert "BatchEvalPython" not in caption and "ArrowEvalPython" not in caption


def shuffled(spark, df):
    """What each shuffle and sort of the plan says about itself, its columns included."""
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    parts = re.split(r"\n\n(?=\(\d+\) )", df._jdf.queryExecution().explainString(mode))
    return [p for p in parts if re.match(r"\(\d+\) (Exchange|ShuffleQueryStage|Sort)\b", p)]


def test_bitmaps_hold_and_rank(spark):
    import random

    rng = random.Random(2)
    ids = {s: sorted({rng.randrange(1, 200_000) for _ in range(3000)}) for s in "ab"}
    frame = spark.createDataFrame([(s, i) for s, own in ids.items() for i in own], "s string, id bigint")
    maps = bitmaps.id_bitmaps(frame.union(frame), "id", ["s"])
    asked = spark.createDataFrame([(s, i) for s in "abc" for i in [*range(0, 200_000, 7), -3, None]], "s string, id bigint")
    got = {(r.s, r.id) for r in bitmaps.with_member(asked, maps, "id", ["s"]).collect()}
    assert got == {(s, i) for s, own in ids.items() for i in own if i % 7 == 0}
    ranks = {(r.s, r.id): r.at for r in bitmaps.with_rank(frame, maps, "id", "at", ["s"]).collect()}
    assert ranks == {(s, i): k for s, own in ids.items() for k, i in enumerate(own)}


def test_signed_ids_are_members(spark):
    frame = spark.createDataFrame([(i,) for i in (-70_000, -32_768, -1, 0, 1, 32_768, 32_769, 2**40)], "id bigint")
    maps = bitmaps.id_bitmaps(frame, "id")
    asked = spark.createDataFrame([(i,) for i in (-70_000, -70_001, -32_768, -2, -1, 0, 1, 2, 32_767, 32_768, 32_769, 2**40)], "id bigint")
    assert bitmaps.with_member(asked, maps, "id").count() == 8


def test_sparse_ids_are_joined(spark, monkeypatch, texts, images):
    monkeypatch.setattr(bitmaps, "MOST_ROWS", 1)
    t = texts(("train", 1, "a", [5, 10**9]), ("valid", 2, "b", [10**6]))
    i = images(("train", 5, "A"), ("train", 10**9, "B"), ("train", 10**6, "C"), ("valid", 10**6, "D"))
    assert sorted(r.image_b64 for r in filtering.keep_referenced(i, t).collect()) == ["A", "B", "D"]
    _, merged = merge.merge_datasets(t, i, t, i.where("image_b64 <> 'D'").withColumn("ord", F.col("ord") * 10**6))
    assert sorted((r.image_id, r.image_b64) for r in merged.where("origin = 'added'").collect()) == [(10**9 + 1, "A"), (10**9 + 2, "B"), (10**9 + 3, "C")]


@pytest.mark.parametrize("name", ["filter_long_images", "merge_images"])
def test_payload_is_not_shuffled(spark, name):
    parts = shuffled(spark, contract.queries()[name](spark, SF))
    assert not [p for p in parts if "image_b64" in p or "p_name" in p]


def batch_of(spark, *rows):
    return spark.createDataFrame([(k, t, i) for k, (t, i) in enumerate(rows)], "batch_ord bigint, text string, images array<string>")


def test_append_of_a_row_with_very_many_images(spark, texts, images):
    t, i = texts(("train", 4, "old", [7, 8])), images(("train", 7, "AA=="), ("train", 8, "BB=="))
    many = 100_000
    pieces = spark.range(many).select(F.lit(0).cast("bigint").alias("batch_ord"), F.col("id").cast("int").alias("pos"), F.concat(F.lit("P"), F.col("id")).alias("image"))
    again = pieces.select((F.col("batch_ord") + 1).alias("batch_ord"), (many - 1 - F.col("pos")).alias("pos"), "image")
    batch = spark.createDataFrame([(0, "big"), (1, "big"), (2, " old ")], "batch_ord bigint, text string")
    every = pieces.union(again).union(spark.createDataFrame([(2, 0, "BB=="), (2, 1, "AA==")], pieces.schema))
    got = append.append_annotations(t, i, batch, pieces=every)
    rows = {r.batch_ord: r for r in got.collect()}
    assert [(rows[k].text_id, rows[k].existing) for k in range(3)] == [(5, False), (5, True), (4, True)]
    assert rows[0].image_ids == list(range(9, 9 + many)) and rows[2].image_ids == [7, 8]
    _, stock = append.new_rows(got, batch, t, i, pieces=every)
    assert stock.count() == many and stock.where(F.col("image_b64") != F.concat(F.lit("P"), F.col("image_id") - 9)).count() == 0


def test_append_joins_on_one_binary_key(spark, texts, images):
    t, i = texts(("train", 0, "a", [1, 2])), images(("train", 1, "AA=="), ("train", 2, "BB=="))
    got = append.append_annotations(t, i, batch_of(spark, ("a", ["BB==", "AA=="]), ("b", ["CC=="])))
    assert got.schema["image_ids"].dataType.simpleString() == "array<bigint>"
    keys = [p for p in shuffled(spark, got) if "hashpartitioning(" in p]
    assert keys and not any("contents" in p or "image_b64" in p or "images" in p for p in keys)


def test_append_tells_sets_and_numbers_apart(spark, texts, images):
    t = texts(("train", 0, "a", [1, 2]), ("train", 1, "a", [1, 1]), ("train", 2, "a", [3]), ("train", 3, "a", []))
    i = images(("train", 1, "AA=="), ("train", 2, "BB=="))
    batch = batch_of(spark, ("a", ["BB==", "AA=="]), ("a", ["AA==", "AA=="]), ("a", ["AA=="]), ("a", ["AA==", "BB==", "BB=="]), ("a:", ["AA==", "BB=="]))
    stored = staged(append.content_index(i))
    for contents in (None, stored):
        got = append.append_annotations(t, i, batch, contents=contents).orderBy("batch_ord").collect()
        assert [(r.text_id, r.existing) for r in got] == [(0, True), (1, True), (4, False), (5, False), (6, False)]


@pytest.mark.parametrize("text,pictures,message", [(" ", ["A"], "text cannot be empty"), ("a", [], "images cannot be empty"), ("a", None, "images cannot be empty")])
def test_append_refuses_empty_rows(spark, texts, images, text, pictures, message):
    with pytest.raises(Exception, match=message):
        append.append_annotations(texts(("train", 0, "x", [1])), images(("train", 1, "A")), batch_of(spark, (text, pictures))).collect()


def test_line_items_are_dealt_out_before_they_are_grouped(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    rows = bindings.table(spark, SF, "lineitem").count()
    assert bindings.items(spark, SF).rdd.getNumPartitions() >= rows // 100
    shown = plan(bindings.texts(spark, SF))
    assert shown.count("Exchange hashpartitioning(order_key") <= 2  # the lines, and the orders that they join


@pytest.mark.parametrize("module, rules, run", [
    (expand, "with_attribute_queries", lambda texts: expand.expand_attributes(texts)),
    (expand, "with_variants", lambda texts: expand.expand_variants(texts)),
    (coverage, "with_attrs_only", lambda texts: coverage.attribute_images(texts)),
])
def test_rules_see_every_text_once(spark, monkeypatch, module, rules, run):
    seen, real = [], getattr(module, rules)
    monkeypatch.setattr(module, rules, lambda rows, **kw: seen.append(rows.count()) or real(rows, **kw))
    run(hot_texts(spark)).collect()
    assert seen == [601]  # 300 of the 900 rows are one caption


def test_phrases_of_repeated_texts(spark, monkeypatch):
    seen, real = [], catalogue.attributes.with_attributes
    monkeypatch.setattr(catalogue.attributes, "with_attributes", lambda rows, **kw: seen.append(rows.count()) or real(rows, **kw))
    monkeypatch.setattr(bindings, "texts", lambda spark, sf: hot_texts(spark))
    found = catalogue.attribute_phrases(spark, SF).groupBy("text_id").count().count()
    assert seen == [601] and found == 900


def test_once_per_text_keeps_every_row(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, None), (5, "")], "id long, text string")
    out = text_functions.once_per_text(rows, lambda d: d.withColumn("n", F.coalesce(F.length("text"), F.lit(-1))))
    assert sorted(map(tuple, out.select("id", "n").collect())) == [(1, 1), (2, -1), (3, 1), (4, -1), (5, 0)]


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_all_checks_of_a_dataset_take_one_shuffle(spark, texts, images):
    t, i = texts(("train", 1, "a", [1, 9]), ("valid", 2, "b", [2])), images(("train", 1, "x"), ("train", 2, "x"), ("valid", 2, "x"), ("valid", 2, "x"))
    found = validate.violations(t, i)
    assert exchanges(found) == 1
    assert sorted(found.collect()) == [("duplicate", "valid", 2), ("missing", "train", 9), ("shared", "valid", 2), ("unused", "train", 2)]


def test_places_need_no_shuffle_of_the_rows(spark):
    rows = spark.range(1, 40).selectExpr("if(id % 3 = 0, 'valid', 'train') split", "id image_id", "'p' caption")
    placed = build.with_places(rows, "text_id")
    assert exchanges(placed.select("caption", "image_id", "text_id")) <= 1  # of the bitmaps' counts
    want = rows.selectExpr("split", "image_id", "row_number() over (partition by split order by image_id) - 1 text_id")
    assert sorted(placed.select("split", "image_id", "text_id").collect()) == sorted(want.collect())


def test_captions_sort_without_a_lambda(spark):
    plan = bindings.texts(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort" not in plan
