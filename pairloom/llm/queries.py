"""One query per text operator over the test tables, with SQL where SQL can express it."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import langid, licenses, linededup, mixing, negatives, packing, perplexity, simhash, spelling, topk, urlrules, warc, wordpiece
from pairloom.session import scratch_path

_ROOT = str(Path(__file__).resolve().parents[2])


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    # Python workers import this package, wherever the session was started from
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", topk.whole(F.col("embedding"), 64).alias("v"))
    return topk.search(vectors, F.coalesce(F.col("vec_id") % 20 == 0, F.lit(False)), 20)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return langid.identify(docs, ~held_out, [F.col("doc_id"), held_out.alias("held_out")])


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    automaton = wordpiece.Automaton(wordpiece.byte_pieces(tokenizer("word_bpe_49k.json")))
    return wordpiece.token_counts(read(spark, sf_dir, "documents"), automaton, [F.col("doc_id")])


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels")
    # a page's path ends in the id of its document
    doc_id = F.regexp_extract(urlrules.parts(F.col("url"))[1], r"/(\d+)(?:\.[a-z]+)?/?$", 1).try_cast("long")
    bad = labels.select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    labelled = pages.select("page_id", doc_id.alias("doc_id")).join(bad, "doc_id")
    return urlrules.judge(pages.select("page_id", "url"), labelled.select("page_id", "bad"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = mixing.sized(read(spark, sf_dir, "documents"), [F.col("doc_id"), F.col("source")])
    return mixing.mix(sized).select("doc_id", "size", "source_size", "target", "taken")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json")).drop("row_id")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(read(spark, sf_dir, "documents"), [F.col("doc_id")], "doc_id")
    return near.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), F.col("least").alias("component_id"))


def op9_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = perplexity.judge(read(spark, sf_dir, "documents"), [F.col("doc_id")])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "band_failed", "kept",
        "perplexity",
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "warc")
    warc.write(read(spark, sf_dir, "pages"), root)
    return warc.read(spark, root, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), topk.whole(F.col("embedding"), 256).alias("v"))
    return negatives.mine(vectors, F.col("vec_id") % 50 == 0)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup(read(spark, sf_dir, "documents"), [F.col("doc_id")])
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::BIGINT AS weight
  FROM sized GROUP BY source
), prefixes AS (
  -- if the k sources of the smallest caps are capped, the others share the rest
  SELECT *, 3 * source_size AS most,
         CAST(sum(3 * source_size) OVER by_cap AS BIGINT) AS held, CAST(sum(weight) OVER by_cap AS BIGINT) AS used,
         CAST(sum(source_size) OVER () AS BIGINT) AS total, CAST(sum(weight) OVER () AS BIGINT) AS weights
  FROM sources WINDOW by_cap AS (ORDER BY 3.0::DOUBLE * source_size / weight, source IS NULL, source ROWS UNBOUNDED PRECEDING)
), levels AS (
  SELECT 0::BIGINT AS held, 0::BIGINT AS used, any_value(total)::BIGINT AS total, any_value(weights)::BIGINT AS weights FROM prefixes
  UNION ALL SELECT held, used, total, weights FROM prefixes
), level AS (
  SELECT arg_min((total - held)::DOUBLE / (weights - used), used) AS level FROM levels l WHERE weights > used AND NOT EXISTS (
    SELECT 1 FROM prefixes p WHERE p.used > l.used AND p.most <= (l.total - l.held)::DOUBLE / (l.weights - l.used) * p.weight)
), targets AS (
  SELECT source, source_size, CASE WHEN 3 * source_size <= level * weight THEN (3 * source_size)::DOUBLE ELSE level * weight END AS target
  FROM sources, level
), keyed AS (
  SELECT doc_id, size, t.source_size, target, floor(target + 0.5)::BIGINT AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT,
                                  doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size * size
        + greatest(0, least(size, budget % source_size - before)) END)::BIGINT AS taken
FROM keyed
"""

_TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 64)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

_WARC_SQL = """
WITH paid AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), first AS (
  SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS response FROM paid
)
SELECT page_id, n AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN response = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM first
"""

_SPELLING_SQL = r"""
WITH RECURSIVE crc AS (  -- the table of the reflected polynomial
  SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT range AS i FROM range(256))
), runs AS (
  SELECT doc_id, run, count(*) AS n, doc_id || ':' || run AS named FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents)
  WHERE length(run) >= 7 GROUP BY doc_id, run
), signs AS (
  SELECT run, n, list_transform(range(1, length(named) + 1), lambda i: unicode(substr(named, i, 1))::BIGINT) AS s FROM runs
), hashed AS (
  SELECT run, n, xor(list_reduce([4294967295] || flatten(list_transform(s, lambda c: CASE WHEN c < 128 THEN [c] ELSE [195, c - 64] END)),
                                 lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
  FROM signs, crc
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word, n
    FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cuts AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1))::INTEGER AS i FROM words)
), longer AS (
  SELECT DISTINCT w.word AS short, w.n AS short_n, c.word AS long, c.n AS long_n FROM cuts c JOIN words w ON w.word = c.rest
), near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT short, long, long_n FROM longer
  UNION ALL SELECT long, short, short_n FROM longer
), best AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form,
         CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word
), chain AS (
  SELECT word, word AS at, form AS next FROM formed
  UNION ALL SELECT c.word, c.next, f.form FROM chain c JOIN formed f ON f.word = c.next
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""

_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
       s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 100 * s.score BETWEEN 50 * positive_score AND 95 * positive_score
QUALIFY rank <= 3
"""

_LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, coalesce(doc_id <> keeper, false) AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_exact_topk": op2_exact_topk,
    "op3_language_id": op3_language_id,
    "op4_token_counts": op4_token_counts,
    "op5_url_filter": op5_url_filter,
    "op6_mixing": op6_mixing,
    "op7_packing": op7_packing,
    "op8_simhash": op8_simhash,
    "op9_perplexity": op9_perplexity,
    "op10_warc": op10_warc,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_line_dedup": op13_line_dedup,
    "pipeline": pipeline,
}

SQL = {
    "op2_exact_topk": _TOPK_SQL,
    "op6_mixing": _MIXING_SQL,
    "op10_warc": _WARC_SQL,
    "op11_spelling_variants": _SPELLING_SQL,
    "op12_hard_negatives": _NEGATIVES_SQL,
    "op13_line_dedup": _LINES_SQL,
}
