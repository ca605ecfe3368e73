"""Every text operator against brute force, and on the odd rows its docstring names."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import compare, duck
from pairloom.llm import langid, licenses, minhash, mixing, packing, perplexity, queries, simhash, topk, urlrules, warc, wordpiece
from pairloom.llm.common import Words
from pairloom.llm.graphs import components
from pairloom.session import scratch_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977} and" for i in range(30_000))
ODD = [
    (1, "the cat sat on the mat with the other cat", "en", "a", 1),
    (1, "the cat sat on the mat with the other cat", "en", "a", 1),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, " \t\n ", "de", "b", 4),
    (5, "die Katze sitzt auf der Matte mit der anderen Katze", "de", None, 1),
    (None, "Licensed under the Apache License, Version 2.0. <|endoftext|> <|ENDOFTEXT|> don't $$$", None, "b", 1),
    (6, LONG, "en", "b", len(LONG)),
    (7, "12345 !!!", "en", "c", 9),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ODD, DOCS)
    # names that operators use themselves
    return rows.withColumns({c: F.lit(1) for c in ("row_id", "size", "taken", "score", "fp", "least", "slot", "kept", "member")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    assert compare(spark, duck(SF), queries.QUERIES[name], queries.SQL[name], SF) is None


def test_words_split_at_ascii_white_space_only():
    texts = ["  a b  c\x1cd\te\x0bf ", "", None, "g"]
    words = Words(pa.array(texts))
    got = [[words.distinct[int(c)].as_py().encode() for c in words.codes[a:b]] for a, b in zip(words.offsets, words.offsets[1:])]
    assert got == [words_of(t) for t in texts]


# 1. licenses


def test_licenses_match_exact_containment(spark):
    rng = random.Random(1)
    long = licenses.MIT_GRANT.split()
    rows = []
    for i in range(60):
        noise = [f"n{rng.randrange(400)}" for _ in range(rng.randrange(5, 120))]
        copy = list(long)
        for _ in range(i % 12):  # some of these stay above the limit
            copy[rng.randrange(len(copy))] = "changed"
        cut = rng.randrange(len(noise))
        rows.append((i, " ".join(noise[:cut] + (copy if i % 3 else []) + noise[cut:]), None, None, 0))
    got = {(r.doc_id, r.license) for r in licenses.scan(spark.createDataFrame(rows, DOCS)).collect()}

    def grams(text):
        w = [x for x in re.split(r"[\W_]+", text.lower()) if x]
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    sets = [(name, grams(t)) for name, t in licenses.TEMPLATES]

    def told(name, own, text):
        near = [own - g for other, g in sets if other != name and 10 * len(own & g) > 6 * len(own)]
        return all(2 * len(apart & text) >= len(apart) for apart in near)

    want = {
        (i, name)
        for i, text, *_ in rows
        for name, own in sets
        if len(own & grams(text)) >= licenses.MIN_CONTAINMENT * len(own) and told(name, own, grams(text))
    }
    assert got == want and want


def test_licenses_are_told_apart(spark):
    """Notices that are not the templates' own wording, and versions that share most of it."""
    gnu = licenses.GNU_NOTICE
    bsd = "Copyright (c) 2001 A B. {} 1. {} 2. {}"
    conditions = re.split(r"(?=Redistributions )", licenses.BSD_CONDITIONS)
    cases = [
        (f"{licenses.MIT_GRANT}\n\n{licenses.MIT_DISCLAIMER}", {"MIT"}),
        (bsd.format(*conditions) + licenses.BSD_DISCLAIMER, {"BSD-2-Clause"}),
        (bsd.format(*conditions) + "3. " + licenses.BSD_THIRD + " " + licenses.BSD_DISCLAIMER, {"BSD-3-Clause"}),
        ("/* " + gnu.format(work="program", name="GNU General Public License", version="2") + " */", {"GPL-2.0"}),
        (gnu.format(work="program", name="GNU General Public License", version="3").replace(":", ";"), {"GPL-3.0"}),
        (gnu.format(work="library", name="GNU Lesser General Public License", version="2.1"), {"LGPL-2.1"}),
        (gnu.format(work="library", name="GNU Lesser General Public License", version="3"), {"LGPL-3.0"}),
        (gnu.format(work="program", name="GNU Affero General Public License", version="3"), {"AGPL-3.0"}),
        ("This file is licensed under the MIT License (see LICENSE).", {"MIT"}),
        ("Our code is distributed under the GNU General Public License, version 2.", {"GPL-2.0"}),
        ("Our code is distributed under the GNU General Public License, version 4.", set()),
        ("# SPDX-License-Identifier: BSD-3-Clause", {"BSD-3-Clause"}),
        ("// SPDX-License-Identifier: GPL-2.0-or-later", {"GPL-2.0"}),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", {"CC-BY-SA-4.0"}),
        ("This work is licensed under a Creative Commons Attribution 3.0 Unported License.", {"CC-BY-3.0"}),
        ("Text released under CC BY-NC-SA 3.0, see below.", {"CC-BY-NC-SA-3.0"}),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
         "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", {"MPL-2.0"}),
        ("A license to kill is not a license. This work is licensed under a strange one.", set()),
    ]
    found = licenses.scan(spark.createDataFrame([(i, t, None, None, 0) for i, (t, _) in enumerate(cases)], DOCS)).collect()
    got = [{r.license for r in found if r.doc_id == i} for i in range(len(cases))]
    assert got == [want for _, want in cases]


def test_licenses_odd_rows(odd, empty):
    assert {(r.doc_id, r.license) for r in licenses.scan(odd).collect()} == {(None, "Apache-2.0")}
    assert licenses.scan(empty).count() == 0


# 2. top-k


def test_aggregate_is_exact():
    rng = np.random.default_rng(3)
    q, x = rng.integers(-9, 9, (15, 8)), rng.integers(-9, 9, (700, 8))
    x[300:500] = x[300]  # ties
    own_q, own_x = np.arange(15), np.arange(700)
    found = {int(i): (at.tolist(), s.tolist()) for i, at, s in topk.aggregate(q, x, own_q, own_x, 20)}
    for i in range(15):
        score = x @ q[i]
        order = [j for j in np.lexsort((own_x, -score)).tolist() if j != i][:20]
        assert found[i] == (order, score[order].tolist())


def test_search_odd_rows(spark):
    rows = [(20, [1.0, 0.5]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [float("nan"), 1.0]), (4, None), (5, [None, 1.0]), (6, []),
            (7, [1.0]), (20, [0.0, 0.0]), (None, [0.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, e array<float>").select("vec_id", topk.whole(F.col("e"), 64).alias("v"))
    got = topk.search(vectors, F.coalesce(F.col("vec_id") == 20, F.lit(False)), 3).collect()
    best = [(r["rank"], r.vec_id, r.score) for r in got if r.score > 0]
    assert sorted(best) == [(1, 1, 6144), (2, 2, 6144)]
    assert len(got) == 6
    assert topk.search(vectors.limit(0), F.lit(True), 3).count() == 0


# 3. language ID and 9. perplexity


def test_language_id_held_out(spark):
    got = queries.op3_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    held = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert held[0] >= 0.97 and held[1] > 10


def test_language_id_odd_rows(odd, empty):
    rows = [r for r in langid.identify(odd, F.lit(True), [F.col("doc_id"), F.col("text")]).collect()]
    assert len(rows) == len(ODD)
    for r in rows:
        assert (r.lang_pred == "und") == (not re.search(r"[^\W\d_]", r.text or "")) and 0 <= r.score <= 1
    assert langid.identify(empty, F.lit(True), [F.col("doc_id")]).count() == 0
    unlearned = langid.identify(odd, F.lit(False), [F.col("doc_id")]).collect()
    assert {r.lang_pred for r in unlearned} == {"und"}


def test_statistics_match_brute_force(odd, empty):
    got = perplexity.judge(odd, [F.col("doc_id"), F.col("text")]).collect()
    assert len(got) == len(ODD)
    for r in got:
        w = words_of(r.text)
        triples = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        again = {i + k for i, t in enumerate(triples) if triples.count(t) > 1 for k in range(3)} if len(w) < 500 else None
        lines = (r.text or "").split("\n")
        assert r.n_words == len(w) and r.word_chars == sum(len(x.decode()) for x in w)
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", r.text or ""))
        assert r.n_dup_lines == sum(bool(words_of(x)) and x in lines[:i] for i, x in enumerate(lines))
        assert again is None or r.n_repeat_words == len(again)
        assert r.base_failed == (len(w) < 50 or 100 * r.n_repeat_words > 50 * len(w))
        assert not (r.base_failed and r.kept)
    assert perplexity.judge(empty, [F.col("doc_id")]).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_repeat_words(seed):
    rng = random.Random(seed)
    w = [rng.randrange(3) for _ in range(rng.randrange(12))]
    t = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    assert perplexity.repeat_words(np.array(w, np.int32)) == len({i + k for i, x in enumerate(t) if t.count(x) > 1 for k in range(3)})


# 4. token counts


@pytest.mark.parametrize("seed", range(40))
def test_automaton_is_greedy_longest_match(seed):
    rng = random.Random(seed)
    some = lambda n: {bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 5))) for _ in range(n)}
    first, later = some(6), some(4) if seed % 2 else None
    automaton = wordpiece.Automaton(first, later)
    for _ in range(50):
        word = bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 12)))
        at, n, pieces = 0, 0, first
        while at < len(word):
            ends = [e for e in range(len(word), at, -1) if word[at:e] in pieces]
            if not ends:
                n = 1
                break
            at, n, pieces = ends[0], n + 1, first if later is None else later
        assert automaton.count(word) == n


def test_token_counts_odd_rows(odd, empty):
    automaton = wordpiece.Automaton(wordpiece.byte_pieces(queries.tokenizer("word_bpe_49k.json")))
    got = wordpiece.token_counts(odd, automaton, [F.col("text")]).collect()
    assert len(got) == len(ODD) and all((r.n_tokens == 0) == (not words_of(r.text)) for r in got)
    assert all(r.n_tokens >= r.n_parts for r in got)
    assert wordpiece.token_counts(empty, automaton, [F.col("doc_id")]).count() == 0


# 5. URL filter


def test_url_rules(spark):
    urls = [
        ("http://A.B.net/x", "net/", "block"), ("https://m.example.net/en/1", "example.net/en/", "allow"),
        ("http://example.com/de/1?q#f", "example.com/de/", "block"), ("http://notexample.com/de/1", None, "allow"),
        ("http://x.org/fr/", "org/fr/", "allow"), ("http://x.net", None, "allow"), ("nothing", None, "allow"), (None, None, "allow"),
    ]
    pages = spark.createDataFrame([(i, u) for i, (u, _, _) in enumerate(urls)], "page_id long, url string")
    labels = spark.createDataFrame([], "page_id long, bad boolean")
    got = {r.page_id: r for r in urlrules.judge(pages, labels).collect()}
    assert [(got[i].rule, got[i].verdict) for i in range(len(urls))] == [(rule, verdict) for _, rule, verdict in urls]
    assert (got[0].host, got[0].path, got[5].path, got[6].host) == ("a.b.net", "/x", "", "")
    assert urlrules.judge(pages.limit(0), labels).count() == 0


def test_mined_rules_match_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, f"http://{rng.choice(['good', 'bad'])}.com/{rng.choice(['casino', 'news'])}/{i}") for i in range(400)]
    bad = {i for i, u in rows if "bad.com/casino" in u}
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, i in bad) for i, _ in rows[:300]], "page_id long, bad boolean")
    got = {r.page_id for r in urlrules.judge(pages, labels, given=()).collect() if r.verdict == "block"}
    assert got == bad


def test_words_of_a_site_template_are_one_item(spark):
    """A template's words make no sets of their own; a rule of one token needs no share of the table."""
    words = "/".join(f"w{k}" for k in range(24))
    rows = [(i, f"http://site.example/{words}/{i}") for i in range(60)]
    rows += [(60 + i, f"http://h{i % 997}.org/a{i % 991}/") for i in range(15000)]
    rows += [(20000 + i, f"http://bad.org/a{i}/") for i in range(22)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    bad = {i for i, u in rows if "site.example" in u or "bad.org" in u}
    labels = spark.createDataFrame([(i, i in bad) for i, _ in rows], "page_id long, bad boolean")
    assert {r.page_id for r in urlrules.judge(pages, labels, given=()).collect() if r.verdict == "block"} == bad
    tokens = spark.createDataFrame([(["host=a", "label=a", "word=x"], True)] * 25 + [(["word=x"], False)] * 25, "tokens array<string>, bad boolean")
    assert [(r["items"], r.confidence) for r in urlrules.mine(tokens).collect()] == [(["host=a"], 1.0)]
    nulls = spark.createDataFrame([(["word=x"], None)] * 25, "tokens array<string>, bad boolean")
    assert urlrules.mine(nulls).count() == 0


# 6. mixing


def test_mixing_odd_rows(odd, empty):
    sized = mixing.sized(odd, [F.col("doc_id"), F.col("source")])
    got = mixing.mix(sized).collect()
    assert len(got) == len(ODD)
    total = sum(r["size"] for r in got)
    by = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"] and r["size"] >= 0
        by.setdefault(r.source, []).append(r)
    assert sum(rows[0].target for rows in by.values()) == pytest.approx(total)
    for rows in by.values():
        assert sum(r.taken for r in rows) == round(rows[0].target)
        assert rows[0].target <= 3 * rows[0].source_size
    again = mixing.mix(mixing.sized(odd.repartition(3), [F.col("doc_id"), F.col("source")])).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    assert mixing.mix(mixing.sized(empty, [F.col("doc_id"), F.col("source")])).count() == 0


# 7. packing


def check_pieces(pieces, docs, window=2048):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer("word_bpe_49k.json"))
    ids = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for _, t in docs]
    by_row, by_sequence = {}, {}
    for p in pieces:
        by_row.setdefault(p.row_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    found = []
    for own in by_row.values():
        own.sort(key=lambda p: p.start)
        assert [p.start for p in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
        assert sum(p.length for p in own) == own[0].doc_tokens
        found.append((own[0].doc_id, tuple((p.start, p.length, p.ids_crc32) for p in own)))
    want = list(docs)
    for doc_id, cut in found:
        at = next(i for i, (d, _) in enumerate(want) if d == doc_id and all(
            zlib.crc32(ids[i][a : a + n].tobytes()) == c for a, n, c in cut) and sum(n for _, n, _ in cut) == len(ids[i]))
        del want[at], ids[at]
    assert not want
    fill = []
    for n, own in by_sequence.items():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
        fill.append(sum(p.length for p in own))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert sum(f < window for f in fill) <= 1 and max(fill, default=0) <= window


def test_packing_odd_rows(odd, empty):
    pieces = packing.pack(odd, queries.tokenizer("word_bpe_49k.json")).collect()
    check_pieces(pieces, [(r[0], r[1]) for r in ODD])
    assert packing.pack(empty, queries.tokenizer("word_bpe_49k.json")).count() == 0


def test_packing_follows_the_shares(spark):
    rows = [(i, "one two three four five " * 40, None, "abb"[i % 3], 0) for i in range(240)]
    docs = spark.createDataFrame(rows, DOCS)
    pieces = packing.pack(docs, queries.tokenizer("word_bpe_49k.json"), shares={"a": 0.5, "b": 0.5}).collect()
    source = {i: s for i, _, _, s, _ in rows}
    for n in range(5):  # both queues still have tokens
        assert sum(p.length for p in pieces if p.sequence_id == n and source[p.doc_id] == "a") == pytest.approx(1024, abs=packing.UNIT)


# 8. SimHash


def test_fingerprint():
    rng = random.Random(1)
    import xxhash

    for n in (0, 1, 3, 4, 5, 70):
        text = " ".join(rng.choice(["Ab", "cD", "é"]) for _ in range(n)).encode()
        w = text.lower().split()
        hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, n - 3))] if n else []
        assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("block", [2048, 8])
def test_links_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)  # 8: nearly every value is crowded
    rng = random.Random(block)
    fps = {0, 1, 31, -1}
    for _ in range(40):
        centre = rng.getrandbits(64)
        for _ in range(12):
            fps.add(np.uint64(centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(7)))).astype(np.int64).item())
    fps = sorted(fps)
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(fps):
        for y in fps[i + 1 :]:
            if ((x ^ y) & (1 << 64) - 1).bit_count() <= 4:
                a, b = sorted((find(x), find(y)))
                root[b] = a
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    got = {r.node: r.root for r in components(edges).collect()}
    assert {f: got.get(f, f) for f in fps} == {f: find(f) for f in fps}


def test_values_that_are_only_looked_up_make_no_group(spark, monkeypatch):
    """Neighbours of one segment value that no fingerprint has itself."""
    monkeypatch.setattr(simhash, "BLOCK", 4)
    shared = 0b111  # the value looked up: one bit more than each of these
    fps = [(k << 42) | (k << 21) | near for k in range(1, 40) for near in (0b011, 0b101, 0b110)]
    groups = simhash._cells(spark.createDataFrame([(f,) for f in fps], "fp long")).groupBy("key", "cell").count()
    assert groups.where(F.col("key") == shared).count() == 0
    assert groups.agg(F.max("count")).first()[0] <= 4 * simhash.BLOCK


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 900: 900, 901: 900}


def test_simhash_odd_rows(odd, empty):
    got = simhash.near_duplicates(odd, [F.col("doc_id")], "doc_id").collect()
    assert len(got) == len(ODD)
    assert {r.least for r in got if r.fp == 0} == {2}
    assert simhash.near_duplicates(empty, [F.col("doc_id")], "doc_id").count() == 0


# 10. WARC


def test_warc_round_trip(spark):
    page = "<p>é</p>" * 30
    rows = [(5, "http://a/ü\r\nX: 1", page), (3, None, page), (3, None, page), (9, "b", page), (None, "c", page), (1, "d", None),
            (2, "e", "short"), (4, "f", "short"), (8, "g", "<a>" * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    files = []
    for parts in (1, 4):
        root = scratch_path(spark, "warc")
        manifest = warc.write(pages.repartition(parts), root, file_bytes=600, per_shard=3)
        files.append(sorted((r.file, r.sha256, r.records) for r in manifest.collect()))
    assert files[0] == files[1] and sum(f[2] for f in files[0]) == len(rows)
    got = warc.read(spark, root).collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in got) == sorted(
        (str(i), len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in rows
    )
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in got if r.payload_bytes == len(page.encode()))
    assert kinds == [("3", "response", None), ("3", "revisit", 3), ("5", "revisit", 3), ("9", "revisit", 3), ("None", "revisit", 3)]
    assert all(r.record_type == "response" for r in got if r.payload_bytes != len(page.encode()))


def test_warc_empty(spark):
    root = scratch_path(spark, "warc")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), root)
    assert warc.read(spark, root).count() == 0


# the stage of near duplicates


def word_sets(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def groups_of(rows):
    """The smallest id of each (id, text)'s group, from all pairs."""
    sets = {i: word_sets(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("block", [1024, 4])
def test_near_duplicates_stage_finds_planted_copies(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)  # 4: components are cut into many cells
    rng = random.Random(9)
    texts = ["", None, " \n", "one two", "One  two", "one three"]
    for _ in range(12):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([8, 60, 200]))]
        for edits in (0, 0, 1, 1, 2, 3, 4, 6):
            copy = list(words)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(3000)}"
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    want = groups_of(list(enumerate(texts)))
    assert 20 < len(set(want.values())) < len(texts) - 20
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], DOCS)
    got = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(set(want.values()))
    assert all(r.text == texts[r.doc_id] for r in got)


def test_band_keys_find_pairs_at_the_limit():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(500):
        h = rng.integers(0, 1 << 63, 100, dtype=np.uint64)
        sets += [h[:90], np.concatenate([h[:80], h[90:]])]  # 80 of 100
    keys = minhash.band_keys(sets)
    assert (keys[0::2] == keys[1::2]).any(axis=1).all()


def test_stage_finds_candidates_by_simhash(spark, monkeypatch):
    """The stage goes through multi-index hashing of fingerprints, checked by exact sets."""
    called = []
    for name in ("near_candidates", "near_links"):
        real = getattr(simhash, name)
        monkeypatch.setattr(simhash, name, lambda nodes, name=name, real=real: called.append(name) or real(nodes))
    words = [f"w{k}" for k in range(200)]
    texts = [" ".join(words), " ".join(["x", *words[1:]]), " ".join(words[:100])]
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], DOCS)
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()) == [0, 2]
    assert called == ["near_candidates", "near_links"]


def test_long_fingerprints_find_pairs_at_the_limit():
    rng = np.random.default_rng(5)
    prints = []
    for size in (9, 18, 90, 900):
        for _ in range(200):
            h = rng.integers(0, 1 << 63, size // 9 * 10, dtype=np.uint64)
            prints += [h[:size], np.concatenate([h[: size // 9 * 8], h[size:]])]  # 8 of 10
    votes = [[2 * sum(int(v) >> b & 1 for v in simhash.mix64(h ^ simhash._SEEDS[3])) > len(h) for b in range(64)] for h in prints[:40]]
    prints = np.array([simhash.long_fingerprint(h) for h in prints])
    assert [[int(p[3]) >> b & 1 for b in range(64)] for p in prints[:40]] == votes
    keys = simhash.segment_keys(prints)
    assert (keys[0::2] == keys[1::2]).any(axis=1).mean() > 0.998
    assert (np.bitwise_count(prints[0::2, :2] ^ prints[1::2, :2]).sum(axis=1) <= simhash.NEAR_BITS).mean() > 0.998


@pytest.mark.parametrize("block", [2048, 4])
def test_near_links_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)  # 4: crowded values are cut
    rng = np.random.default_rng(block)
    rows = []
    for _ in range(20):
        centre = rng.integers(0, 1 << 63, 2)
        for _ in range(6):
            flips = [sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 17), replace=False)) for _ in range(2)]
            rows.append((*(int(c) ^ f for c, f in zip(centre, flips)), sorted({int(k) for k in rng.integers(0, 12, 3)})))
    links = {(min(a[0], b[0]), max(a[0], b[0])) for a in rows for b in rows
             if a[0] != b[0] and set(a[2]) & set(b[2]) and sum((a[k] ^ b[k]).bit_count() for k in (0, 1)) <= simhash.NEAR_BITS}
    nodes = spark.createDataFrame(rows, "fp long, more long, keys array<int>")
    want = components(spark.createDataFrame(sorted(links), "a long, b long"))
    got = components(simhash.near_links(nodes))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and len(links) > 50


def test_a_large_group_of_near_copies_has_few_links(spark, monkeypatch):
    """Links grow with a group's nodes, not with its segments or its pairs of blocks."""
    n, rng = 400, np.random.default_rng(8)
    bits = rng.integers(0, 2, 64 * simhash.WORDS, np.uint8) ^ (rng.random((n, 64 * simhash.WORDS)) < 0.05)
    prints = np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view("<u8")
    rows = [(*map(int, p.view(np.int64)[:2]), k.tolist()) for p, k in zip(prints, simhash.segment_keys(prints))]
    nodes = spark.createDataFrame(rows, "fp long, more long, keys array<int>")
    for block in (2048, 16):
        monkeypatch.setattr(simhash, "BLOCK", block)
        links = simhash.near_links(nodes).collect()
        roots = components(spark.createDataFrame(links, "a long, b long")).collect()
        assert len(links) < 4 * n
        assert {(r.node, r.root) for r in roots} == {(r[0], min(rows)[0]) for r in rows}


def test_a_large_group_of_near_texts_has_few_links(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 32)
    words = [f"w{k}" for k in range(200)]
    near = [" ".join([*words[:k], "x", *words[k + 1 :]]) for k in range(200)]
    apart = [" ".join(f"y{k}{i}" for i in range(20)) for k in range(3)]
    rows = [(0, k, t.encode()) for k, t in enumerate(near + apart)]
    links = minhash.links(spark.createDataFrame(rows, "root long, node long, text binary")).collect()
    assert len(links) < 2 * len(rows)
    roots = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert roots == {k: 0 for k in range(200)}


# the pipeline


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"row_id": F.lit(1), "taken": F.lit(2)})
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "quality", "near_duplicates", "mix", "pack"]
    now, counts = docs.toPandas(), {}
    frame = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, SF).toPandas()
        counts[name] = len(out)
        if name == "near_duplicates":
            groups = groups_of([(r.doc_id, r.text) for r in now.itertuples()])
            assert sorted(out.doc_id) == sorted(set(groups.values()))
        if name == "mix":
            sized = mixing.mix(mixing.sized(frame, [F.col("doc_id"), F.col("source")])).toPandas()
            assert out.text.map(lambda t: len(words_of(t))).groupby(out.doc_id).sum().to_dict() == {
                r.doc_id: r.taken for r in sized.itertuples() if r.taken
            }
        if name == "pack":
            check = [(r.doc_id, r.text) for r in now.itertuples()]
            assert out.groupby("sequence_id")["length"].sum().iloc[:-1].eq(2048).all()
            assert len(set(zip(out.doc_id, out.doc_tokens))) >= len({d for d, _ in check})
        else:
            assert list(out.columns) == docs.columns
            now, frame = out, spark.createDataFrame(out, docs.schema)
    assert counts["language"] > 0.95 * docs.count() and counts["quality"] > 0.8 * counts["language"]


def test_stages_take_odd_and_empty_tables(spark, odd, empty):
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            rows = out.collect()
            assert docs is odd or not rows
            if name != "pack":
                assert out.columns == docs.columns


def test_warc_cuts_one_id_with_many_rows(spark):
    rows = [(7, f"u{i % 5}", f"<p>{i % 40}</p>" * 20) for i in range(400)] + [(None, None, f"<p>{i % 3}</p>" * 40) for i in range(30)]
    pages = spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id long, url string, html string, shard int, digest int")
    root = scratch_path(spark, "warc")
    manifest = warc.write(pages.repartition(7), root, per_shard=50).collect()
    assert len({r.shard for r in manifest}) >= 8 and max(r.records for r in manifest) <= 60
    got = warc.read(spark, root, payloads=False).collect()
    assert sum(r.record_type == "response" for r in got) == 70 and len(got) == 430  # none of those without an id is named
    assert sorted((str(r.page_id), r.payload_digest) for r in got) == sorted((str(i), hashlib.sha256(h.encode()).hexdigest()) for i, _, h in rows)
    assert all(r.payload is None for r in got)


def test_encoder_joins_plain_words_only(monkeypatch):
    from tokenizers import Tokenizer

    path = queries.tokenizer("word_bpe_49k.json")
    texts = ["straße être naïve don't İstanbul x÷y ñandú ab", "A.B c3po Å 漢字 été", " ".join(f"wörd{'abc' * (i % 7)}{chr(97 + i % 26)}" for i in range(900))]
    for joined in (256, 2):
        monkeypatch.setattr(packing, "_JOINED", joined)
        ids, bounds = packing.Encoder(path, 1)(pa.array(texts))
        want = [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids + [1] for t in texts]
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want
