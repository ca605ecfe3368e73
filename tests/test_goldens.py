"""Small inputs with results traced by hand."""

import pytest
from pyspark.sql import functions as F

from pairloom.functions import attributes, images as pictures, text, variants
from pairloom.operators import append, build, coverage, expand, filtering, ids, merge, relations, review, splitting, validate


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def one(spark, fn, value):
    return spark.createDataFrame([(value,)], "x string").select(fn(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "total, ratio, want", [(10, 0.1, 1), (25, 0.1, 2), (3, 0.1, 1), (2, 0.9, 1), (1, 0.5, 0), (4, 0, 0)]
)
def test_split_sizes(spark, total, ratio, want):
    assert splitting.valid_rows(total, ratio) == want
    marked = splitting.exact_split(spark.range(total), "id", ratio)
    assert marked.where("split = 'valid'").count() == want


def test_split_ratio_out_of_range():
    with pytest.raises(ValueError):
        splitting.valid_rows(10, 1)


def test_split_needs_unique_keys(spark):
    with pytest.raises(ValueError):
        splitting.exact_split(spark.range(9000).select(F.lit(1).alias("id")), "id", 0.5)


def test_group_split_keeps_groups(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("g"), "id")
    marked = splitting.group_split(df, "g", 0.3)
    per_group = marked.groupBy("g").agg(F.count_distinct("split").alias("n"))
    assert per_group.where("n > 1").count() == 0
    assert marked.where("split = 'valid'").select("g").distinct().count() == 3


@pytest.mark.parametrize(
    "current, step, want",
    [(5, 1, 9), (9, 1, 9), (3, -1, 3), (4, 1, 5), (4, -1, 3), (1, 1, 3), (1, -1, 3), (10, -1, 9), (10, 1, 3)],
)
def test_neighbour_of(spark, current, step, want):
    stock = spark.createDataFrame([(3,), (5,), (9,)], "id bigint")
    assert ids.neighbour_of(stock, "id", current, step).first().id == want


def test_captions(spark):
    stock = spark.createDataFrame(
        [(0, 0, 1, "a.jpg", "a"), (0, 1, 2, "b.jpg", "b"), (0, 2, 3, None, None)],
        "source_ord bigint, pos bigint, export_image_id bigint, file_name string, path string",
    )
    notes = spark.createDataFrame(
        [(0, 1, 0, " x  y "), (0, 1, 1, "z"), (0, 1, 2, "x y"), (0, 2, 3, None), (0, 9, 4, "dangling")],
        "source_ord bigint, export_image_id bigint, ord bigint, txt string",
    )
    files = spark.createDataFrame([("a",), ("b",)], "path string")

    def made(**options):
        return rows(
            build.number_samples(build.caption_samples(stock, notes, files, **options)).select("image_id", "caption"),
            "image_id",
        )

    assert made() == [(1, "x y；z")]
    assert made(keep_empty=True) == [(1, "x y；z"), (2, "")]
    gone = files.where("path = 'b'")
    assert build.caption_samples(stock, notes, gone).count() == 0


def _merge_parts(texts, images):
    base = texts(("train", 0, "a", [1]), ("train", 1, "b", [2]), ("valid", 0, "c", [3]))
    stock = images(("train", 1, "A"), ("train", 2, "B"), ("valid", 3, "C"))
    more = texts(("train", 0, "d", [1, 0]), ("valid", 1, "e", [2]))
    return base, stock, more, images(("train", 0, "D"), ("train", 1, "E"), ("valid", 2, "F"))


def test_merge(texts, images):
    new_texts, new_images = merge.merge_datasets(*_merge_parts(texts, images))
    added = new_texts.where("origin = 'added'").select("split", "text_id", "text", "image_ids")
    assert rows(added, "split") == [("train", 2, "d", [5, 4]), ("valid", 1, "e", [6])]
    moved = new_images.where("origin = 'added'").select("image_id", "image_b64")
    assert rows(moved, "image_id") == [(4, "D"), (5, "E"), (6, "F")]
    merge.require_consistent(new_texts, new_images)
    assert new_texts.groupBy("split", "ord").count().where("count > 1").count() == 0


def test_merge_with_dense_row_numbers(spark, texts, images):
    base, stock, more, added = _merge_parts(texts, images)
    dense = added.withColumn("ord", F.when(F.col("split") == "valid", 0).otherwise(F.col("ord")).cast("bigint"))
    id_map = merge.image_id_map(stock, dense, dense_ord=True)
    assert rows(id_map.select("image_id", "new_image_id"), "image_id") == [(0, 4), (1, 5), (2, 6)]


def test_merge_errors(texts, images):
    base, stock, more, added = _merge_parts(texts, images)
    with pytest.raises(ValueError, match="duplicate image_id"):
        merge.merge_datasets(base, stock, more, images(("train", 0, "x"), ("valid", 0, "y")))
    bad, _ = merge.merge_datasets(base, stock, texts(("train", 0, "d", [7])), added)
    with pytest.raises(Exception, match="missing image_id"):
        bad.collect()


def test_merge_into_empty_base(texts, images):
    none, nothing = texts().limit(0), images().limit(0)
    new_texts, new_images = merge.merge_datasets(none, nothing, *_merge_parts(texts, images)[2:])
    assert rows(new_texts.select("split", "text_id", "image_ids"), "split") == [("train", 0, [2, 1]), ("valid", 0, [3])]


def test_next_ids_of_empty(spark, texts, images):
    start = spark.range(1).select(ids.next_text_id(texts().limit(0)), ids.next_image_id(images().limit(0)))
    assert tuple(start.first()) == (0, 1)


RIDER = "一个穿着黑色的上衣的男子，骑着电动车，地上有积水。"


def test_variants(texts):
    out = expand.expand_variants(texts(("train", 5, RIDER, [1])), min_len=6, max_len=45)
    assert rows(out.select("text_id", "text"), "ord") == [
        (5, RIDER), (6, "穿黑色上衣的男子，骑着电动车，地上有积水"), (7, "穿黑色上衣的男子，骑着电动车"),
    ]


def test_variants_seen_and_cut(texts):
    known = "穿黑色上衣的男子，骑着电动车，地上有积水"
    out = expand.expand_variants(texts(("train", 0, RIDER, [1]), ("train", 1, known, [1])), max_new=1)
    # the one variant allowed is an original already, and no other takes its place
    assert out.where("text_id > 1").count() == 1
    both = expand.expand_variants(texts(("train", 0, RIDER, [1]), ("train", 0, RIDER, [1])))
    assert both.where(F.col("text") == RIDER).count() == 2
    many = expand.expand_variants(texts(("train", 0, RIDER, [1, 2])), single_image_only=True)
    assert many.count() == 1


def test_subject_parts(spark):
    got = one(spark, variants.subject_parts, "一个男子骑车，旁边有女子走路；还有小孩，看手机")
    assert got == ["男子骑车", "女子走路", "小孩，看手机"]


def test_attributes(texts):
    caption = "一个戴着白色头盔穿着黑色的短袖的人，骑着红色的电动车，地上有积水。"
    out = expand.expand_attributes(texts(("train", 7, caption, [1])))
    assert rows(out.select("text_id", "text", "source_text_id"), "text_id") == [
        (0, "戴着白色头盔穿黑色的短袖的人，骑红色的电动车，地上有积水", None),
        (1, "戴着白色头盔穿黑色的短袖的人，骑红色的电动车", 7),
        (2, "戴白色头盔的人", 7),
        (3, "穿黑色短袖的人", 7),
        (4, "骑红色电动车的人", 7),
        (5, "戴白色头盔穿黑色短袖的人", 7),
        (6, "穿黑色短袖骑红色电动车的人", 7),
        (7, "戴白色头盔骑红色电动车的人", 7),
    ]


def test_attributes_drop_repeats_and_short(texts):
    out = expand.expand_attributes(
        texts(("train", 0, "黑色上衣的人", [1]), ("train", 1, "黑色上衣的人", [1]), ("train", 2, "人", [1]))
    )
    assert out.where("not derived").count() == 1
    assert out.where("source_text_id = 1").count() == 0
    bare = expand.expand_attributes(texts(("train", 3, "黑色上衣的人", [1])), keep_original=False)
    assert set(r.source_text_id for r in bare.collect()) == {3}


def test_masks_after_a_verb_come_first(spark):
    df = spark.createDataFrame([("白色口罩，戴黑口罩，抽烟的人",)], "text string")
    got = attributes.with_attributes(df).first()
    assert got.role_mask == ["戴黑色口罩", "戴白色口罩"]
    assert got.role_action == []


def test_lean_attributes_agree(spark):
    captions = ["红电动车骑着黑自行车，有蓝挡风被，背白书包，拿灰色手提袋", "穿黑色有白色口罩图标的短袖的男子", "", "黑裤子白鞋"]
    df = spark.createDataFrame([(c,) for c in captions], "text string")
    full = {r.text: (r.attrs, r.subject, r.main) for r in attributes.with_attributes(df).collect()}
    lean = {r.text: (r.attrs, r.subject, r.main) for r in attributes.with_attrs_only(df).collect()}
    assert full == lean
    # a logo between colour and object is skipped, and what it shows is found too
    assert full[captions[1]][0] == ["戴白色口罩", "穿黑色短袖"]


def test_expansion_stats(texts):
    source = texts(("train", 0, "黑色上衣的人", [1]), ("train", 1, "黑色上衣的人", [1]))
    out = expand.expand_attributes(source)
    histogram = rows(expand.expansion_histogram(source, out).select("new_rows", "inputs"), "new_rows")
    assert histogram[0] == (0, 1) and sum(n for _, n in histogram) == 2
    stats = expand.expansion_stats(source, out).first()
    assert (stats.input_rows, stats.output_rows) == (2, out.count())


def test_text_edges(spark):
    assert one(spark, text.tidy_caption, "甲，，，乙") == "甲，，乙"
    assert one(spark, text.collapse_blanks, "a　b c\n") == "a b c"
    assert one(spark, text.collapse_blanks, "a​b") == "a​b"
    assert one(spark, text.collapse_blanks, None) == ""
    assert one(spark, text.strip, " 　a b\n ") == "a b"
    assert one(spark, text.tidy_query, "一个黑") == ""
    assert one(spark, text.squeeze_caption, "，带着 帽子的的。") == "戴帽子的"
    assert one(spark, attributes.main_subject, "行人和老人") == "人"
    assert one(spark, attributes.main_subject, "车") == "人"
    assert one(spark, attributes.main_subject, "女子和人") == "女子"


def test_image_helpers(spark):
    import base64

    def mime(data):
        return one(spark, pictures.mime_type, base64.b64encode(data).decode())

    assert mime(b"\x89PNG\r\n") == "image/png"
    assert mime(b"RIFF\0\0\0\0WEBPxx") == "image/webp"
    assert mime(b"RIFF\0\0\0\0WAVExx") == "image/jpeg"
    assert mime(b"BMxx") == "image/bmp"
    assert one(spark, pictures.mime_type, "%%%") == "image/jpeg"
    assert one(spark, pictures.parse_data_url, "data:image/png;base64,QUJD") == "QUJD"
    with pytest.raises(Exception, match="Invalid uploaded"):
        one(spark, pictures.parse_data_url, "data:text/plain,QUJD")
    long = spark.createDataFrame([(bytes(range(256)),)], "c binary").select(pictures.encode_image(F.col("c"))).first()[0]
    assert long == base64.b64encode(bytes(range(256))).decode()
    names = ["a.JPG", "b.webp", ".png", "c.txt", "d", "e..bmp"]
    kept = spark.createDataFrame([(f"/x.png/{n}",) for n in names], "p string").where(pictures.is_image_path(F.col("p")))
    assert sorted(r.p[7:] for r in kept.collect()) == ["a.JPG", "b.webp", "e..bmp"]


def test_validation(texts, images):
    t = texts(("train", 0, "a", [1, 5]))
    stock = images(("train", 1, ""), ("train", 2, ""), ("train", 2, ""))
    assert rows(validate.violations(t, stock), "check", "image_id") == [
        ("duplicate", "train", 2), ("missing", "train", 5), ("unused", "train", 2),
    ]
    both = images(("train", 1, ""), ("train", 2, ""), ("valid", 2, ""), ("valid", 3, ""))
    t = texts(("train", 0, "a", [1, 2]), ("valid", 0, "b", [2, 3]))
    assert rows(validate.violations(t, both), "check") == [("shared", "valid", 2)]
    assert validate.violations(t, both, allow_shared=True).count() == 0
    with pytest.raises(ValueError, match="shared image_id in split valid"):
        validate.require_valid(t, both)
    one_used = texts(("train", 0, "a", [1]))
    lone = images(("train", 1, ""), ("train", 2, ""))
    assert validate.violations(one_used, lone, allow_unused=True).count() == 0
    with pytest.raises(ValueError, match="unused"):
        validate.require_valid(one_used, lone)


def test_filter_keeps_duplicate_images(texts, images):
    kept, stock = filtering.filter_long(
        texts(("train", 0, "abc", [1]), ("train", 1, "abcdef", [2]), ("valid", 0, "ab", [2])),
        images(("train", 1, "A"), ("train", 1, "B"), ("train", 2, "C"), ("valid", 2, "D")),
        3,
    )
    assert rows(stock.select("image_b64"), "image_b64") == [("A",), ("B",), ("D",)]
    assert kept.count() == 2


def test_review(spark, texts):
    t = texts(("train", 1, "画面中的人", [1]), ("train", 2, "short", []), ("train", 3, "x" * 120, None))
    assert [r.text_id for r in review.review_rows(t).orderBy("text_id").collect()] == [1, 3]
    assert [r.text_id for r in review.review_rows(t, keywords=()).collect()] == [3]
    edits = spark.createDataFrame(
        [("train", 1, "one", 0), ("train", 1, " two  words ", 1), ("valid", 9, "gone", 2)],
        "split string, text_id bigint, clean_text string, ord bigint",
    )
    applied = review.apply_review(t, edits)
    assert rows(applied.where("changed").select("text_id", "text"), "text_id") == [(1, "two words")]
    empty = spark.createDataFrame([("train", 1, " ", 0)], edits.schema)
    with pytest.raises(Exception, match="Empty clean_text"):
        review.apply_review(t, empty).collect()


def test_update_texts(spark, texts):
    t = texts(("train", 1, "a", []), ("train", 1, "b", []), ("train", 2, "c", []))
    schema = "split string, text_id bigint, text string, ord bigint"
    done = review.update_texts(t, spark.createDataFrame([("train", 1, " new ", 0)], schema))
    assert rows(done.select("ord", "text"), "ord") == [(0, "a"), (1, "new"), (2, "c")]
    with pytest.raises(Exception, match="not found"):
        review.update_texts(t, spark.createDataFrame([("train", 8, "x", 0)], schema)).collect()
    with pytest.raises(Exception, match="empty"):
        review.update_texts(t, spark.createDataFrame([("train", 1, " ", 0)], schema)).collect()


def test_append(spark, texts, images):
    t = texts(("train", 4, " cat ", [1, 2]), ("train", 5, "dog", [1, 9]))
    stock = images(("train", 1, "A"), ("train", 2, "B"), ("valid", 7, "V"))
    batch = spark.createDataFrame(
        [(0, "cat", ["B", "A"]), (1, "cat", ["A"]), (2, "dog", ["A", "X"]), (3, " dog", ["X", "A"]), (4, "dog", ["A", "A", "X"])],
        "batch_ord bigint, text string, images array<string>",
    )
    got = append.append_annotations(t, stock, batch)
    assert rows(got.select("batch_ord", "text_id", "image_ids", "existing"), "batch_ord") == [
        (0, 4, [1, 2], True), (1, 6, [8], False), (2, 7, [9, 10], False), (3, 7, [9, 10], True), (4, 8, [11, 12, 13], False),
    ]
    new_texts, new_images = append.new_rows(got, batch, t, stock)
    assert rows(new_images.select("image_id", "image_b64"), "image_id") == [
        (8, "A"), (9, "A"), (10, "X"), (11, "A"), (12, "A"), (13, "X"),
    ]
    assert rows(new_texts.select("ord", "text_id", "text"), "ord") == [(2, 6, "cat"), (3, 7, "dog"), (4, 8, "dog")]
    for bad in ([(0, " ", ["A"])], [(0, "x", [])]):
        with pytest.raises(Exception, match="cannot be empty"):
            append.append_annotations(t, stock, spark.createDataFrame(bad, batch.schema)).collect()


def test_lookups(texts, images):
    t = texts(("train", 1, "a", [2, 1, 2]), ("train", 1, "b", [1]), ("valid", 1, "c", []))
    stock = images(("train", 1, "QQ=="), ("train", 1, "Qg=="), ("train", 2, "Qw=="))
    assert [r.src[-4:] for r in relations.get_text(t, stock, "train", 1).collect()] == ["Qg=="]
    assert [r.text for r in relations.get_image(t, stock, "train", 2).collect()] == ["a", "a"]
    with pytest.raises(KeyError):
        relations.get_text(t, stock, "train", 3)
    with pytest.raises(Exception, match="image_id 9 not found"):
        relations.text_images(texts(("train", 1, "a", [9])), stock).collect()
    assert relations.summary(t, stock).where("kind = 'texts' and split = 'train'").first().ids == 1


def test_quotas(spark):
    items = spark.createDataFrame([("P1", "头盔颜色", "30-50", "绿色", "头盔"), ("P1", "头盔颜色", "10-20", "红色", "头盔")],
                                  "priority string, category string, target_images string, color string, attribute string")
    ranged = coverage.with_target_range(items)
    assert rows(coverage.quotas(ranged), "priority") == [("P1", "头盔颜色", 2, 40, 70)]
    captions = spark.createDataFrame([("train", "戴绿色头盔的人", [1, 2]), ("train", "绿头盔", [2])],
                                     "split string, text string, image_ids array<bigint>")
    done = coverage.coverage(captions, ranged)
    assert rows(done.select("color", "images", "missing"), "images") == [("红色", 0, 10), ("绿色", 2, 28)]
