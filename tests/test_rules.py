"""Rules that must hold at every size and for NULLs."""

import json

import pytest
from pyspark.sql import functions as F

from pairloom.functions.images import parse_data_url
from pairloom.operators import append, expand, relations
from pairloom.operators.build import attach_payload
from pairloom.operators.filtering import links
from pairloom.operators.ids import dense_id
from pairloom.operators.merge import merge_datasets
from pairloom.operators.splitting import exact_split
from pairloom.sources.lines import numbered_lines
from pairloom.sources.texts import read_texts


@pytest.mark.parametrize("n", [10, 4000, 5000])
def test_equal_keys_never_split(spark, n):
    with pytest.raises(ValueError, match="Keys repeat"):
        exact_split(spark.range(n).select(F.lit(7).alias("k")), "k", 0.5)


def test_ranks_keep_their_order(spark):
    ranks = [0, 1, 131071, 131072, 262144, 2**31 - 1]
    rows = spark.createDataFrame([(r, p) for r in ranks for p in (0, 5)], "source_ord long, pos long")
    got = dense_id(rows, "id", ["source_ord", "pos"]).orderBy("id").collect()
    assert [(r.source_ord, r.pos) for r in got] == [(r, p) for r in ranks for p in (0, 5)]


def test_part_files_by_number(spark, tmp_path):
    for n in (99999, 100000, 7):
        (tmp_path / f"part-{n:05d}-x.txt").write_text(f"{n}\n")
    got = numbered_lines(spark, str(tmp_path)).orderBy("ord").collect()
    assert [(r.ord, r.value) for r in got] == [(0, "7"), (1, "99999"), (2, "100000")]


def test_null_keys_stay(spark):
    rows = spark.createDataFrame([(None, 4), ("a", None), ("a", 2), (None, 9)], "split string, k long")
    got = dense_id(rows, "id", ["k"], within=["split"]).collect()
    assert sorted((str(r.split), r.id) for r in got) == [("None", 0), ("None", 1), ("a", 0), ("a", 1)]


def test_null_references_are_links(texts):
    got = links(texts(("train", 1, "x", [None, 7]), ("train", 2, "y", []))).orderBy("pos").collect()
    assert [(r.pos, r.image_id) for r in got] == [(0, None), (1, 7)]


@pytest.mark.parametrize("row", [{"text": "no id"}, {"text_id": 1, "image_ids": [None, 7]}])
def test_rows_without_ids_are_errors(spark, tmp_path, row):
    (tmp_path / "t.jsonl").write_text(json.dumps(row) + "\n")
    with pytest.raises(Exception, match="No (text_id|element of image_ids) in"):
        read_texts(spark, str(tmp_path / "t.jsonl"), "train").collect()


def test_merge_keeps_unknown_columns(texts, images):
    base = texts(("train", 0, "a", [1])).withColumn("mine", F.lit(1))
    added = texts(("train", 0, "b", [1])).withColumn("theirs", F.lit(2))
    merged, _ = merge_datasets(base, images(("train", 1, "x")), added, images(("train", 1, "y")))
    assert sorted((r.text, r.mine, r.theirs) for r in merged.collect()) == [("a", 1, None), ("b", None, 2)]


def test_a_missing_file_is_an_error(spark):
    listed = spark.createDataFrame([("train", 0, 1, "gone.png")], "split string, ord long, image_id long, path string")
    with pytest.raises(Exception, match="No file for a listed image"):
        attach_payload(listed, spark.createDataFrame([], "path string, content binary")).collect()


@pytest.mark.parametrize("b64, good", [("", True), ("QUJD", True), ("QUI=", True), ("QQ==", True), ("QU JD\n", True), ("QUJ", False), ("Q", False)])
def test_data_url_is_readable(spark, b64, good):
    one = spark.createDataFrame([(f"data:image/png;base64,{b64}",)], "u string").select(parse_data_url(F.col("u")).alias("b"))
    if good:
        assert one.first().b == b64
    else:
        with pytest.raises(Exception, match="readable image"):
            one.collect()


def test_batches_from_files_and_uploads(spark):
    files = spark.createDataFrame([("x/a.png", b"ABC"), ("x/b.jpg", b"DE")], "path string, content binary")
    batch = spark.createDataFrame([(1, "t", ["x/b.jpg", "x/a.png", "x/b.jpg"]), (2, "u", [])], "batch_ord long, text string, paths array<string>")
    got = {r.batch_ord: r.images for r in append.from_files(batch, files).collect()}
    assert got == {1: ["REU=", "QUJD", "REU="], 2: None}
    for bad in ("x/none.png", "x/a.txt"):
        rows = spark.createDataFrame([(1, "t", [bad])], "batch_ord long, text string, paths array<string>")
        with pytest.raises(Exception, match="No image file"):
            append.from_files(rows, files).collect()
    sent = spark.createDataFrame([(1, "t", [("a", "data:image/png;base64,QUJD")])], "batch_ord long, text string, images array<struct<name:string,src:string>>")
    assert append.from_uploads(sent).first().images == ["QUJD"]


def test_append_hashes_cited_images_only(spark):
    texts = spark.createDataFrame([("train", 0, 0, "t", [7])], "split string, ord long, text_id long, text string, image_ids array<long>")
    images = spark.createDataFrame([("train", 0, 7, "QUJD"), ("train", 1, 8, "REU=")], "split string, ord long, image_id long, image_b64 string")
    wanted = spark.createDataFrame([("t",)], "text string")
    known = append._existing(texts, images, None, wanted)
    plan = known._jdf.queryExecution().optimizedPlan().toString()
    # the hash stands above the filter that leaves cited images
    assert plan.rindex("sha2(") < plan.index("getbit(")
    batch = spark.createDataFrame([(0, "t", ["QUJD"]), (1, "t", ["REU="])], "batch_ord long, text string, images array<string>")
    keys = {r.batch_ord: r.key for r in append._list_keys(batch).select("batch_ord", append._key(F.col("text"))).collect()}
    assert [(r.old_text_id, r.key) for r in known.collect()] == [(0, keys[0])] and keys[0] != keys[1] and len(keys[0]) == 32


def test_captions_of_an_image_by_stored_links(spark, tmp_path):
    texts = spark.createDataFrame([("train", 0, 0, "a", [1, 2, 2]), ("train", 1, 1, "b", [1]), ("valid", 0, 0, "c", [2])],
                                  "split string, ord long, text_id long, text string, image_ids array<long>")
    images = spark.createDataFrame([("train", 0, 1, "x"), ("train", 1, 2, "y"), ("valid", 0, 2, "z")], "split string, ord long, image_id long, image_b64 string")
    relations.link_table(texts).write.parquet(f"{tmp_path}/links")
    edges = spark.read.parquet(f"{tmp_path}/links")
    found = relations.get_image(texts, images, "train", 2, edges)
    assert [r.text for r in found.collect()] == [r.text for r in relations.get_image(texts, images, "train", 2).collect()] == ["a", "a"]
    assert "EqualTo(image_id,2)" in found._jdf.queryExecution().executedPlan().toString()


def test_id_lists_do_not_shuffle_with_captions(spark):
    texts = spark.createDataFrame([("train", 0, 0, "一个穿着黑色的上衣的人", [1, 2]), ("train", 1, 1, "一个穿着黑色的上衣的人", [1, 2]), ("train", 2, 2, "一个穿着黑色的上衣的人", [12])],
                                  "split string, ord long, text_id long, text string, image_ids array<long>")
    first = expand.attribute_emissions(texts)
    assert "image_ids" not in first.columns
    out = expand.expand_attributes(texts).orderBy("text_id").collect()
    # the second row repeats the first; the third has other images
    assert {r.source_ord for r in out} == {0, 2} and {tuple(r.image_ids) for r in out} == {(1, 2), (12,)}
