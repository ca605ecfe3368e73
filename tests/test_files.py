"""Readers, writers and the whole way from files to files."""

import json

import pytest
from pyspark.sql import functions as F

from pairloom.operators import build, coverage, expand, filtering, merge, prepare, review, validate
from pairloom.sources import annotations, checklist, datasets, folders, images, paths, runs, sinks, snapshots, texts


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_read_texts(spark, tmp_path):
    path = write(
        tmp_path / "train_texts.jsonl",
        '{"text_id": "3", "text": "一", "image_ids": ["1", 2], "note": {"k": 1}}\n\n  \n{"text_id": 4}\n',
    )
    got = texts.read_texts(spark, path, "train", extras=True).orderBy("ord").collect()
    assert [(r.ord, r.text_id, r.text, r.image_ids) for r in got] == [(0, 3, "一", [1, 2]), (1, 4, "", [])]
    assert list(got[0].extras) == ["note"] and not got[1].extras
    assert texts.read_refs(spark, path, "train").count() == 2
    out = str(tmp_path / "again")
    sinks.write_texts(texts.read_texts(spark, path, "train", extras=True), out)
    lines = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert {"text_id": 3, "text": "一", "image_ids": [1, 2], "note": {"k": 1}} in lines
    assert all("source_text_id" not in line for line in lines)


def test_broken_json_names_file_and_line(spark, tmp_path):
    path = write(tmp_path / "t.jsonl", '{"text_id": 1}\n\n{"text_id": \n')
    with pytest.raises(Exception, match="Invalid JSON in .*t.jsonl, record 2"):
        texts.read_texts(spark, path, "train").collect()
    assert [(r.line_no, r.value) for r in texts.bad_lines(spark, path).collect()] == [(3, '{"text_id": ')]


def test_line_order_over_many_blocks(spark, tmp_path):
    path = write(tmp_path / "i.tsv", "".join(f"{i * 7 % 1000}\tabc\n" for i in range(1000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = images.read_images(spark, path, "train").orderBy("ord").collect()
        assert images.read_images(spark, path, "train").rdd.getNumPartitions() > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(r.ord, r.image_id) for r in got] == [(i, i * 7 % 1000) for i in range(1000)]


def test_files_are_read_once(spark, tmp_path):
    """With ``once`` nothing later needs the files, nor the same cut of them; the rows are those of two reads."""
    t = write(tmp_path / "train_texts.jsonl", "".join(json.dumps({"text_id": i, "text": f"t{i}", "image_ids": [i], "k": [i]}) + "\n\n" for i in range(200)))
    i = write(tmp_path / "train_imgs.tsv", "".join(f"{i * 7 % 200}\t{'A' * (i % 50)}\n" for i in range(200)))
    plain = lambda f: f.withColumn("extras", F.to_json("extras")) if "extras" in f.columns else f
    rows = lambda f: [tuple(r) for r in plain(f).orderBy("ord").collect()]
    lazy = [rows(f) for f in datasets.read_dataset(spark, str(tmp_path))]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        eager = datasets.read_dataset(spark, str(tmp_path), once=True)
        ids = images.read_image_ids(spark, i, "train")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for path in (t, i):
        paths.remove(spark, path)
    assert [rows(f) for f in eager] == lazy and [r[0] for r in lazy[0][:3]] == ["train"] * 3
    assert [r.image_id for r in ids.orderBy("ord").collect()] == [k * 7 % 200 for k in range(200)]
    plan = eager[1].select("image_id")._jdf.queryExecution().executedPlan().toString()
    assert "image_b64" not in plan.replace("image_b64#", "") and "FileFormat: Text" not in plan


def test_files_read_once_name_broken_lines(spark, tmp_path):
    path = write(tmp_path / "t.jsonl", '{"text_id": 1}\n\n{"text_id": \n')
    with pytest.raises(Exception, match='Invalid JSON in .*t.jsonl, record 2: {"text_id": '):
        texts.read_texts(spark, path, "train", once=True).collect()
    with pytest.raises(Exception, match="Invalid TSV row in .*b.tsv, record 1"):
        images.read_images(spark, write(tmp_path / "b.tsv", "1 AA\n"), "train", once=True).collect()
    none = write(tmp_path / "n.tsv", "\n")
    assert images.read_images(spark, none, "train", once=True).count() == 0


def test_read_images(spark, tmp_path):
    good = write(tmp_path / "a.tsv", "1\tAA\tBB\n\n2\tCC\n")
    got = images.read_images(spark, good, "train").orderBy("ord").collect()
    assert [(r.image_id, r.image_b64) for r in got] == [(1, "AA\tBB"), (2, "CC")]
    with pytest.raises(Exception, match="Invalid TSV row"):
        images.read_images(spark, write(tmp_path / "b.tsv", "1 AA\n"), "train").collect()
    with pytest.raises(Exception, match="Invalid image_id"):
        images.read_image_ids(spark, write(tmp_path / "c.tsv", "x\tAA\n"), "train").collect()


def test_read_edits(spark, tmp_path):
    path = write(
        tmp_path / "r.jsonl",
        '{"text_id": 1, "text": "a"}\n{"split": "valid", "text_id": 2, "text": "b", "clean_text": null}\n',
    )
    got = texts.read_edits(spark, path, "train").orderBy("ord").collect()
    assert [(r.split, r.text_id, r.clean_text) for r in got] == [("train", 1, "a"), ("valid", 2, None)]


def test_splits(spark, tmp_path):
    assert texts.resolve_splits("all") == ["train", "valid"] and texts.resolve_splits("x") == ["x"]
    with pytest.raises(FileNotFoundError):
        datasets.read_dataset(spark, str(tmp_path))
    write(tmp_path / "train_texts.jsonl", '{"text_id": 1, "image_ids": [1]}\n')
    write(tmp_path / "train_imgs.tsv", "1\tAA\n")
    t, i = datasets.read_dataset(spark, str(tmp_path))
    assert (t.count(), i.count()) == (1, 1)
    with pytest.raises(FileNotFoundError):
        datasets.read_dataset(spark, str(tmp_path), required=("train", "valid"))


def test_write_append_and_guard(spark, tmp_path):
    out = str(tmp_path / "data")
    schema = "split string, ord bigint, text_id bigint, text string, image_ids array<bigint>"
    t = spark.createDataFrame([("train", n, n, f"t{n}", [n]) for n in range(50)], schema)
    i = spark.createDataFrame([("train", n, n, "AA") for n in range(50)], "split string, ord bigint, image_id bigint, image_b64 string")
    sinks.write_dataset(t.repartition(5), i, out)
    with pytest.raises(FileExistsError):
        sinks.write_dataset(t, i, out)
    sinks.append_rows(
        t.limit(0).unionByName(spark.createDataFrame([("train", 50, 50, "new", [50])], schema)),
        i.limit(0).unionByName(spark.createDataFrame([("train", 50, 50, "BB")], i.schema)),
        out,
    )
    back, stock = datasets.read_dataset(spark, out)
    assert [r.text_id for r in back.where("split = 'train'").orderBy("ord").collect()] == list(range(51))
    assert [r.image_id for r in stock.where("split = 'train'").orderBy("ord").collect()] == list(range(51))
    assert [r.ord for r in stock.where("split = 'train'").orderBy("ord").collect()] == list(range(51))


def stored(spark, out, n=20):
    schema = "split string, ord bigint, text_id bigint, text string, image_ids array<bigint>"
    make = lambda split, ids: spark.createDataFrame([(split, k, k, f"t{k}", [k]) for k in ids], schema)
    stock = lambda split, ids: spark.createDataFrame([(split, k, k, f"B{k}") for k in ids], "split string, ord bigint, image_id bigint, image_b64 string")
    sinks.write_dataset(make("train", range(n)).unionByName(make("valid", [3, 1])), stock("train", range(n)).unionByName(stock("valid", [3, 1])), out)
    return make, stock


def seen(spark, out, split="train"):
    return tuple([r[0] for r in f.where(F.col("split") == split).orderBy("ord").select(c).collect()] for f, c in zip(datasets.read_dataset(spark, out), ("text_id", "image_id")))


def test_append_shows_both_files_or_neither(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "data")
    make, stock = stored(spark, out)
    whole, write_texts = sinks.write_texts, sinks.write_texts

    def broken(*args, **kwargs):
        raise RuntimeError("between the two files")

    monkeypatch.setattr(sinks, "write_texts", broken)
    with pytest.raises(RuntimeError):
        sinks.append_rows(make("train", [20, 21]), stock("train", [20, 21]), out, batch="a")
    assert seen(spark, out) == (list(range(20)), list(range(20)))
    monkeypatch.setattr(sinks, "write_texts", whole)
    # the texts are there, the commit is not
    monkeypatch.setattr(snapshots, "commit", broken)
    with pytest.raises(RuntimeError):
        sinks.append_rows(make("train", [20, 21]), stock("train", [20, 21]), out, batch="a")
    assert seen(spark, out) == (list(range(20)), list(range(20)))
    monkeypatch.undo()
    assert sinks.append_rows(make("train", [20, 21]), stock("train", [20, 21]), out, batch="a")
    assert not sinks.append_rows(make("train", [20, 21]), stock("train", [20, 21]), out, batch="a")  # a retry after all
    assert sinks.append_rows(make("valid", [9]), stock("valid", [9]), out, "valid")
    assert sinks.append_rows(make("train", [22]), stock("train", [22]), out, batch="b")
    assert seen(spark, out) == (list(range(23)), list(range(23)))
    assert seen(spark, out, "valid") == ([1, 3, 9], [1, 3, 9])
    assert [(c.number, c.split) for c in snapshots.commits(spark, out)] == [(1, "train"), (2, "valid"), (3, "train")]


def test_uncommitted_batches_can_be_dropped(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "data")
    make, stock = stored(spark, out)
    assert sinks.append_rows(make("train", [20]), stock("train", [20]), out)
    monkeypatch.setattr(snapshots, "commit", lambda *a: None)
    sinks.append_rows(make("train", [21]), stock("train", [21]), out)
    path = f"{out}/train_texts.jsonl"
    assert snapshots.drop_uncommitted(spark, out, path) == ["_batch-000000000002"]
    assert snapshots.drop_uncommitted(spark, out, path) == []
    assert seen(spark, out)[0] == list(range(21))


def test_overwrite_forgets_batches(spark, tmp_path):
    out = str(tmp_path / "data")
    make, stock = stored(spark, out)
    sinks.append_rows(make("train", [20]), stock("train", [20]), out)
    sinks.write_dataset(make("train", [5, 2]), stock("train", [5, 2]), out, overwrite=True)
    assert seen(spark, out) == ([2, 5], [2, 5]) and seen(spark, out, "valid") == ([], [])


def test_both_splits_are_written_from_one_scan(spark, tmp_path, monkeypatch):
    """Every payload file is read once for all splits."""
    for k in range(6):
        write(tmp_path / "files" / f"{k}.jpg", f"J{k}")
    files = spark.read.format("binaryFile").load(str(tmp_path / "files"))
    reads = spark.sparkContext.accumulator(0)

    @F.udf("binary")
    def counted(content):
        reads.add(1)
        return content

    names = files.select(F.regexp_extract("path", r"(\d)\.jpg", 1).cast("bigint").alias("k"), "path")
    rows = names.select(F.when(F.col("k") % 2 == 0, "train").otherwise("valid").alias("split"), F.col("k").alias("ord"), F.col("k").alias("image_id"), "path")
    images = build.attach_payload(rows, files.select("path", counted("content").alias("content")))
    texts = rows.select("split", "ord", F.col("ord").alias("text_id"), F.lit("t").alias("text"), F.array("image_id").alias("image_ids"))
    out = str(tmp_path / "data")
    sinks.write_dataset(texts, images, out)
    assert reads.value == 6
    assert seen(spark, out) == ([0, 2, 4], [0, 2, 4]) and seen(spark, out, "valid") == ([1, 3, 5], [1, 3, 5])


def export(root, entries, notes):
    write(
        root / "annotations" / "instances_default.json",
        json.dumps(
            {
                "categories": [{"id": 1, "name": "c"}],
                "images": [{"id": i, "file_name": f} for i, f in entries],
                "annotations": [{"image_id": i, "category_id": 1, "attributes": a} for i, a in notes],
            },
            ensure_ascii=False,
        ),
    )
    for _, name in entries:
        if name and name != "gone.jpg":
            write(root / "images" / name, "JPEG" + name)
    return str(root)


def sample(root, number, query, **files):
    (root / number).mkdir(parents=True, exist_ok=True)
    if query is not None:
        write(root / number / "query.txt", query)
    for folder, names in files.items():
        for name in names:
            write(root / number / folder / name, number + name)


def test_exports(spark, tmp_path):
    a = export(tmp_path / "z 任务", [(1, "a.jpg"), (2, "gone.jpg"), (3, None)], [(1, {"txt": " x  y "}), (1, None), (1, {"txt": 5})])
    b = export(tmp_path / "a_task", [(1, "sub/b.jpg")], [(1, {"txt": "q"})])
    got = annotations.read_exports(spark, [a, b])
    stock = annotations.export_images(got)
    assert sorted((r.source_ord, r.export_image_id, r.file_name, r.source) for r in stock.collect() if r.file_name) == [
        (0, 1, "a.jpg", "z 任务"), (0, 2, "gone.jpg", "z 任务"), (1, 1, "sub/b.jpg", "a_task"),
    ]
    notes = annotations.export_annotations(got)
    assert sorted((r.source_ord, r.ord, r.txt or "") for r in notes.collect()) == [
        (0, 0, " x  y "), (0, 1, ""), (0, 2, "5"), (1, 0, "q"),
    ]
    files = annotations.export_files(spark, [a, b])
    assert stock.join(files, "path", "left_semi").count() == 2
    with pytest.raises(FileNotFoundError):
        annotations.read_exports(spark, [str(tmp_path)])


def test_query_folders(spark, tmp_path):
    sample(tmp_path, "000002", " ask \n", pos_images=["b.JPG", "a.png", "x.txt"], pos=["z.jpg"])
    sample(tmp_path, "10", "ten", pos=["p.bmp"])
    sample(tmp_path, "abc", "no", pos_images=["a.jpg"])
    sample(tmp_path, "000003", None)
    assert sorted(r.sample_id for r in folders.read_samples(spark, str(tmp_path)).collect()) == [2, 3, 10]
    assert {(r.sample_id, r.query) for r in folders.read_queries(spark, str(tmp_path)).collect()} == {(2, " ask \n"), (10, "ten")}
    found = folders.read_folder_files(spark, str(tmp_path), content=True)
    assert sorted((r.sample_id, r.folder, r.name) for r in found.collect()) == [
        (2, "pos", "z.jpg"), (2, "pos_images", "a.png"), (2, "pos_images", "b.JPG"), (10, "pos", "p.bmp"),
    ]
    empty = tmp_path / "none"
    empty.mkdir()
    assert folders.read_queries(spark, str(empty)).count() == 0
    assert folders.read_folder_files(spark, str(empty)).count() == 0


def test_query_folders_of_odd_names(spark, tmp_path):
    """Empty folders count; files named like folders, deeper queries and other depths do not."""
    root = tmp_path / "a b%2B+c"
    for k in range(40):
        sample(root, str(k), f"q{k}", pos_images=["x y.jpg"])
    (root / "77").mkdir()
    write(root / "78", "a file")
    write(root / "79" / "pos_images" / "5", "a file of digits further down")
    write(root / "80" / "more" / "query.txt", "too deep")
    write(root / "query.txt", "too high")
    got = sorted(r.sample_id for r in folders.read_samples(spark, str(root)).collect())
    assert got == [*range(40), 77, 79, 80]
    assert sorted((r.sample_id, r.query) for r in folders.read_queries(spark, str(root)).collect()) == [(k, f"q{k}") for k in range(40)]
    assert folders.read_folder_files(spark, str(root)).count() == 40
    assert folders.read_queries(spark, str(tmp_path / "absent")).count() == 0
    (tmp_path / "none").mkdir()
    assert folders.read_samples(spark, str(tmp_path / "none")).count() == 0


def test_load_images(spark, tmp_path):
    write(tmp_path / "b.png", "B")
    write(tmp_path / "a.JPG", "A")
    write(tmp_path / "c.txt", "C")
    assert [r.name for r in images.load_images(spark, str(tmp_path)).collect()] == ["a.JPG", "b.png"]
    assert images.load_images(spark, str(tmp_path / "b.png")).first().src == "data:image/jpeg;base64,Qg=="
    for bad in (tmp_path / "c.txt", tmp_path / "nothing"):
        with pytest.raises(FileNotFoundError):
            images.load_images(spark, str(bad))


def test_checklist(spark, tmp_path):
    path = write(
        tmp_path / "list.json",
        json.dumps({"name": "n", "items": [
            {"id": 1, "priority": "P1", "category": "c", "attribute": "头盔", "color": "绿色", "target_images": "30-50",
             "queries": ["q1", "q2"], "note": "x"}]}),
    )
    items = coverage.checklist_items(checklist.read_checklist(spark, path))
    assert [(r.id, r.target_lo, r.target_hi) for r in items.collect()] == [(1, 30, 50)]
    assert coverage.example_queries(items).count() == 2


def test_prepare_dataset(spark, tmp_path):
    caption = "一个穿着黑色的上衣的男子，骑着电动车，地上有积水。"
    entries = [(n, f"{n}.jpg") for n in range(1, 21)]
    a = export(tmp_path / "task1", entries, [(n, {"txt": caption}) for n in range(1, 20)] + [(20, {"txt": "长" * 60})])
    root = tmp_path / "samples"
    for n in range(1, 11):
        sample(root, f"{n:06d}", f"问题{n}", pos_images=["a.jpg", "b.jpg"])
    out = str(tmp_path / "out")
    prepare.prepare_dataset(spark, [a], str(root), out)
    t, i = datasets.read_dataset(spark, out)
    report = {r.split: (r.texts, r.images, r.refs) for r in validate.split_report(t, i).collect()}
    train = t.where("split = 'train'")
    assert i.count() == 19 + 20 and validate.violations(t, i).count() == 0
    assert train.where(F.col("text") == "穿黑色上衣的男子，骑着电动车").count() == train.where(F.col("text") == caption).count()
    assert set(report) == {"train", "valid"}
    assert sorted(r.image_id for r in i.collect())[0] == 1
    from base64 import b64decode
    bodies = {b64decode(r.image_b64).decode() for r in i.collect()}
    assert "JPEG1.jpg" in bodies and "000001a.jpg" in bodies and "JPEG20.jpg" not in bodies
    with pytest.raises(FileExistsError):
        prepare.prepare_dataset(spark, [a], str(root), out)
    assert paths.is_filled(spark, out)


def test_broken_run_goes_on(spark, tmp_path, monkeypatch):
    """A run that broke at any step ends as one that did not, and makes no step twice."""
    caption = "一个穿着黑色的上衣的男子，骑着电动车，地上有积水。"
    a = export(tmp_path / "task", [(n, f"{n}.jpg") for n in range(1, 9)], [(n, {"txt": caption}) for n in range(1, 9)])
    root = tmp_path / "samples"
    for n in range(1, 4):
        sample(root, f"{n:06d}", f"问题{n}", pos_images=["a.jpg"])
    prepare.prepare_dataset(spark, [a], str(root), str(tmp_path / "whole"))
    out, work = str(tmp_path / "out"), str(tmp_path / "work")
    again = lambda **more: prepare.prepare_dataset(spark, [a], str(root), out, work=work, **more)
    calls = []

    def counted(name):
        made = getattr(prepare, name)
        monkeypatch.setattr(prepare, name, lambda *args, **kw: (calls.append(name), made(*args, **kw))[1])

    def breaks(name):
        def broken(*args, **kw):
            raise RuntimeError(name)

        with monkeypatch.context() as patch, pytest.raises(RuntimeError, match=name):
            patch.setattr(prepare, name, broken)
            again()

    for name in ("build_from_annotations", "merge_datasets", "expand_variants", "write_dataset"):
        counted(name)
    for name in ("filter_long", "merge_datasets", "require_valid", "attach_payload"):
        breaks(name)
    # the last step breaks between the two files
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(sinks.paths, "replace", lambda *args: (_ for _ in ()).throw(RuntimeError("moving")))
        again()
    t, i = again()
    assert calls == ["build_from_annotations", "merge_datasets", "expand_variants", "write_dataset", "write_dataset"]
    again()
    assert len(calls) == 5  # a run that ended does nothing
    rows = lambda f: [tuple(r) for r in datasets.read_dataset(spark, f)[0].drop("extras").orderBy("split", "ord").collect()]
    assert rows(out) == rows(str(tmp_path / "whole")) and t.count() == len(rows(out))
    assert datasets.read_dataset(spark, out)[1].count() == i.count() == 11
    with pytest.raises(ValueError, match="other settings or inputs"):
        again(settings=prepare.PrepareSettings(seed=7))
    sample(root, "000009", "neu", pos_images=["a.jpg"])
    with pytest.raises(ValueError, match="other settings or inputs"):
        again()


def test_a_step_that_broke_is_written_anew(spark, tmp_path):
    run = runs.Run(spark, str(tmp_path / "run"), {"a": 1})
    spark.range(5).write.parquet(str(tmp_path / "run" / "rows"))  # no mark: not whole
    assert run.step("rows", lambda: spark.range(3)).count() == 3
    fails = lambda: pytest.fail("made again")
    assert runs.Run(spark, str(tmp_path / "run"), {"a": 1}).step("rows", fails).count() == 3
    assert run.step("none", lambda: spark.range(0)).count() == 0
    with pytest.raises(ValueError):
        runs.Run(spark, str(tmp_path / "run"), {"a": 2})


def test_unknown_keys_go_through(spark, tmp_path):
    """Kept from reader to writer: through filter, review, merge and expansion."""
    line = {"text_id": 0, "text": "一个穿着黑色的上衣的男子，骑着电动车，地上有积水。", "image_ids": [1], "note": {"k": [1, None]}, "by": "me"}
    for folder, extra in (("a", {}), ("b", {"more": 2.5})):
        write(tmp_path / folder / "train_texts.jsonl", json.dumps(line | extra, ensure_ascii=False) + '\n{"text_id": 1, "text": "x"}\n')
        write(tmp_path / folder / "train_imgs.tsv", "1\tAA\n")
    read = lambda f: datasets.read_dataset(spark, str(tmp_path / f))
    t, i = merge.merge_datasets(*filtering.filter_long(*read("a"), 55), *read("b"))
    t = expand.expand_variants(t.drop("origin"))
    edits = spark.createDataFrame([("train", 1, "edited", 0)], "split string, text_id bigint, clean_text string, ord bigint")
    t = review.apply_review(t, edits).drop("changed")
    sinks.write_dataset(t, i.drop("origin"), str(tmp_path / "c"))
    got = {r["text_id"]: r for r in (json.loads(r.value) for r in spark.read.text(f"{tmp_path}/c/train_texts.jsonl").collect())}
    assert got[0] == line and got[1] == {"text_id": 1, "text": "edited", "image_ids": []}
    assert got[2] == line | {"text_id": 2, "image_ids": [2], "more": 2.5} and got[3]["text"] == "x"
    assert got[4]["text"] == "穿黑色上衣的男子，骑着电动车，地上有积水" and set(got[4]) == {"text_id", "text", "image_ids"}


def test_folders_of_one_number_are_two_samples(spark, tmp_path):
    root = tmp_path / "queries"
    sample(root, "2", "two", pos_images=["a.jpg", "b.jpg"])
    sample(root, "000002", "padded", pos_images=["c.jpg"], pos=["z.jpg"])
    sample(root, "7", None, pos_images=["d.jpg"])
    sample(root, "0007", "no images")
    made = [f(spark, str(root)) for f in (folders.read_samples, folders.read_queries, folders.read_folder_files)]
    status = {r.sample: (r.query, r.files, r.skip_reason) for r in build.sample_status(*made[:2], made[2].where("folder = 'pos_images'")).collect()}
    assert status == {"2": ("two", 2, None), "000002": ("padded", 1, None), "7": ("", 1, build.EMPTY_QUERY), "0007": ("no images", None, build.NO_IMAGES)}
    texts, stock, skipped = build.build_all_positives(*made)
    assert {(r.text, tuple(r.image_ids)) for r in texts.collect()} == {("padded", (0,)), ("two", (1, 2))}
    assert [(r.image_id, r.sample, r.name) for r in stock.orderBy("image_id").collect()] == [(0, "000002", "c.jpg"), (1, "2", "a.jpg"), (2, "2", "b.jpg")]
    assert sorted(r.sample for r in skipped.collect()) == ["0007", "7"]
    one, _, _ = build.build_one_positive(*made, start=1, end=5)
    assert [r.text for r in one.collect()] == ["padded"]
