"""The operators' inputs, derived from the given tables.

Captions are built from the line items of an order (verb, colour and object
come from the part name), images are parts, query folders are conversations.
Every view covers its whole tables.  ``*_SQL`` is the same view as a SQL
common table expression, for checking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.session import spread, staged

# Part-name words in caption language.
COLOURS = {
    "red": "红色", "blue": "蓝色", "large": "白色", "small": "黑色",
    "hot": "橙色", "cold": "灰色", "new": "绿色", "old": "棕色",
}
NOUNS = {
    "widget": "上衣", "ring": "裤子", "plate": "鞋子", "rod": "电动车",
    "gear": "头盔", "bolt": "背包", "anvil": "挡风被", "gizmo": "口罩",
}
VERBS = {"rod": "骑着", "gear": "戴着", "gizmo": "戴着", "bolt": "背着", "anvil": "有"}
CLAUSES = {
    f"{adjective} {noun}": f"{VERBS.get(noun, '穿着')}{COLOURS[adjective]}的{NOUNS[noun]}"
    for adjective in COLOURS
    for noun in NOUNS
}
TAILS = {"F": "，地上有积水。", "O": "，旁边有小孩。"}
# Leading bytes per part type, as hex, and what they stand for.
LEADS = {
    "ECONOMY": "89504E470D0A1A0A", "SMALL": "FFD8FFE0", "STANDARD": "524946460000000057454250", "PROMO": "424D",
}
OTHER_LEAD = "52494646"
MIME_OF_LEAD = {
    "89504E470D0A1A0A": "image/png", "524946460000000057454250": "image/webp", "424D": "image/bmp",
}
LINE = 1 << 40


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _case(key: Column, values: dict[str, str], default: str) -> Column:
    out = F.lit(default)
    for word, value in reversed(values.items()):
        out = F.when(key == word, F.lit(value)).otherwise(out)
    return out


def part_words(part: DataFrame) -> DataFrame:
    words = F.split("p_name", " ")
    return part.withColumns(
        {
            "colour": _case(words[0], COLOURS, ""),
            "noun": _case(words[1], NOUNS, ""),
            "verb": _case(words[1], VERBS, "穿着"),
        }
    )


def order_split(priority: Column) -> Column:
    return F.when(priority == "1-URGENT", F.lit("valid")).otherwise(F.lit("train"))


def items(spark: SparkSession, sf: str) -> DataFrame:
    """``order_key, part_key, ord, code, txt`` of every line item, dealt out by order.

    ``code`` is the place of the part's clause in ``CLAUSES``.
    """
    part = part_words(table(spark, sf, "part")).select(
        F.col("p_partkey").alias("part_key"),
        F.array_position(F.array(*map(F.lit, CLAUSES)), F.col("p_name")).cast("int").alias("code"),
        F.col("p_name").alias("txt"),
    )
    every = table(spark, sf, "lineitem")
    lines = every.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_partkey").alias("part_key"),
        (F.col("l_linenumber").cast("bigint") * LINE + F.col("l_partkey")).alias("ord"),
    )
    return spread(lines.join(part, "part_key"), every.count(), "order_key")


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """One caption per order: its distinct clauses in line order."""
    # repeats fold first; an entry is a number and a code, little more than the
    # image id that the caption row has to hold anyway
    cited = items(spark, sf).groupBy("order_key", "part_key", "code").agg(F.min("ord").alias("ord"))
    # sort_array and field access are compiled, array_sort and a lambda are not
    lists = cited.groupBy("order_key").agg(
        F.sort_array(F.collect_list(F.struct("ord", "code"))).alias("cited"), F.sort_array(F.collect_list("part_key")).alias("image_ids")
    )
    words = F.array(*(F.lit(clause) for clause in CLAUSES.values()))
    codes = F.array_distinct("cited.code")
    lists = lists.select(
        "order_key",
        F.array_join(F.transform(codes, lambda code: F.get(words, code - 1)), "，").alias("body"),
        "image_ids",
    )
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_key"), "o_orderpriority", "o_orderstatus"
    )
    text = F.concat(F.lit("一个"), "body", F.lit("的人"), _case(F.col("o_orderstatus"), TAILS, ""))
    # an order without a known part has a caption too: no clause, no image
    orders = orders.join(lists, "order_key", "left").withColumns(
        {"body": F.coalesce("body", F.lit("")), "image_ids": F.coalesce("image_ids", F.array().cast("array<bigint>"))}
    )
    return orders.select(
        order_split(F.col("o_orderpriority")).alias("split"),
        F.col("order_key").alias("ord"),
        F.col("order_key").alias("text_id"),
        text.alias("text"),
        "image_ids",
        F.col("o_orderstatus").alias("status"),
    )


def stored_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The captions as a written table, for operators that read them often."""
    return staged(texts(spark, sf))


def part_images(spark: SparkSession, sf: str) -> DataFrame:
    """Every part as an image of the split its size puts it in."""
    return table(spark, sf, "part").select(
        F.when(F.col("p_size") <= 10, "valid").otherwise("train").alias("split"),
        F.col("p_partkey").alias("ord"),
        F.col("p_partkey").alias("image_id"),
        F.translate(F.base64(F.encode("p_name", "utf-8")), "\r\n", "").alias("image_b64"),
    )


def shared_images(spark: SparkSession, sf: str) -> DataFrame:
    """Every part as an image of both splits."""
    both = F.explode(F.array(F.lit("train"), F.lit("valid")))
    return part_images(spark, sf).withColumn("split", both)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.when(F.col("lang") == "en", "valid").otherwise("train").alias("split"),
        F.col("doc_id").alias("ord"),
        F.col("doc_id").alias("text_id"),
        "text",
        F.array("doc_id").alias("image_ids"),
    )


def citing_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One caption per order that cites its parts in line order, repeats included."""
    # an order has a few lines only
    lists = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("cited")
    )
    return table(spark, sf, "orders").join(lists, "o_orderkey", "left").select(
        F.lit("train").alias("split"),
        F.col("o_orderkey").alias("ord"),
        F.col("o_orderkey").alias("text_id"),
        F.col("o_orderpriority").alias("text"),
        F.coalesce(F.col("cited.l_partkey"), F.array().cast("array<bigint>")).alias("image_ids"),
    )


def edits(spark: SparkSession, sf: str) -> DataFrame:
    """A first edit for every labelled document, a later one if it is poor."""
    labelled = table(spark, sf, "labels").join(
        documents(spark, sf).withColumnRenamed("text_id", "doc_id"), "doc_id"
    )
    first = labelled.select(
        "split", F.col("doc_id").alias("text_id"), F.concat(F.lit("edited  "), "text").alias("clean_text"),
        F.lit(0).cast("bigint").alias("ord"),
    )
    later = labelled.where("quality = 0").select(
        "split", F.col("doc_id").alias("text_id"), F.lit("rewritten\ntext").alias("clean_text"),
        F.lit(1).cast("bigint").alias("ord"),
    )
    return first.unionByName(later)


def export(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Images, annotations and files of five exports, one per priority.

    Pending orders have no image file.
    """
    orders = table(spark, sf, "orders")
    source = F.substring("o_orderpriority", 1, 1).cast("bigint") - 1
    name = F.concat(F.col("o_orderkey").cast("string"), F.lit(".jpg"))
    images = spread(orders, orders.count(), "o_orderkey").select(
        source.alias("source_ord"),
        F.col("o_orderkey").alias("pos"),
        F.col("o_orderkey").alias("export_image_id"),
        name.alias("file_name"),
        name.alias("path"),
        F.col("o_orderpriority").alias("source"),
    )
    keys = orders.select(source.alias("source_ord"), F.col("o_orderkey").alias("order_key"))
    notes = items(spark, sf).join(keys, "order_key").select(
        "source_ord", F.col("order_key").alias("export_image_id"), "ord",
        F.concat(F.lit(" "), F.regexp_replace("txt", " ", "  ")).alias("txt"),
    )
    files = orders.where("o_orderstatus <> 'P'").select(name.alias("path"))
    return images, notes, files


def samples(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Conversations as query folders.

    The first user turn is the query, assistant turns are the positives,
    system turns fill the second folder.
    """
    number = F.col("conv_id").alias("sample_id")
    sample = F.when(F.col("conv_id") < 1_000_000, F.lpad(F.col("conv_id").cast("string"), 6, "0")).otherwise(F.col("conv_id").cast("string"))
    turns = table(spark, sf, "conversations")
    folders = turns.select(number, sample.alias("sample")).distinct()
    queries = turns.where("role = 'user'").groupBy(number, sample.alias("sample")).agg(F.min_by("text", "turn").alias("query"))
    name = F.concat(F.lpad(F.col("turn").cast("string"), 6, "0"), F.lit(".jpg"))
    folder = F.when(F.col("role") == "assistant", "pos_images").otherwise("pos")
    files = turns.where("role in ('assistant', 'system')").select(
        number,
        sample.alias("sample"),
        folder.alias("folder"),
        name.alias("name"),
        F.concat_ws("/", F.col("conv_id").cast("string"), folder, name).alias("path"),
    )
    return folders, queries, files


ROOT = "file:/queries"


def sample_paths(spark: SparkSession, sf: str) -> DataFrame:
    """A file path for every turn: some too deep, some without an image's ending."""
    name = F.concat(F.col("turn").cast("string"), F.when(F.col("role") == "user", ".txt").otherwise(".JPG"))
    folder = F.when(F.col("turn") % 3 == 2, "pos_images/more").when(F.col("role") == "system", "pos").otherwise("pos_images")
    return table(spark, sf, "conversations").select(
        F.concat_ws("/", F.lit(ROOT), F.format_string("%06d", "conv_id"), folder, name).alias("path")
    )


def export_documents(spark: SparkSession, sf: str) -> DataFrame:
    """An export document per order, as JSON: one image, two notes."""
    key = F.col("o_orderkey").cast("string")
    note = lambda text: F.concat(
        F.lit('{"image_id":'), key, F.lit(',"attributes":{"txt":"'), text, F.lit('","colour":1}}')
    )
    document = F.concat(
        F.lit('{"categories":[],"images":[{"id":'), key, F.lit(',"file_name":"'), key, F.lit('.jpg"}],"annotations":['),
        note(F.col("o_orderpriority")), F.lit(","), note(F.col("o_orderstatus")), F.lit("]}"),
    )
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("source_ord"),
        F.concat(F.lit("/exports/"), "o_orderpriority", F.lit("_"), key).alias("root"),
        document.alias("document"),
    )


def captioned_export(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The five exports with an order's caption as the one annotation of its image."""
    images, _, files = export(spark, sf)
    keys = images.select("source_ord", "export_image_id")
    notes = texts(spark, sf).select(F.col("text_id").alias("export_image_id"), "ord", F.col("text").alias("txt"))
    return images, notes.join(keys, "export_image_id"), files


def with_status(texts: DataFrame) -> DataFrame:
    """Captions with unknown keys: a word, and a nested number."""
    known = F.to_json(F.struct("status", F.struct(F.size("image_ids").alias("images")).alias("seen")))
    return texts.withColumn("extras", F.from_json(known, "map<string,variant>"))


#: Items of a checklist document, parts of an image sheet.
ITEMS, SHEET = 500, 100


def checklist_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Checklists as JSON, one per row: the parts of a stretch of keys, with their words as queries."""
    size = F.col("p_size").cast("string")
    item = F.struct(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("priority"), F.col("p_type").alias("category"),
        F.col("noun").alias("attribute"), F.col("colour").alias("color"),
        F.concat(size, F.lit("-"), (F.col("p_size") + 20).cast("string")).alias("target_images"),
        F.split("p_name", " ").alias("queries"),
    )
    parts = part_words(table(spark, sf, "part")).groupBy(F.expr(f"p_partkey div {ITEMS}").alias("part_block"))
    lists = parts.agg(F.array_sort(F.collect_list(item)).alias("items"))
    return lists.select("part_block", F.to_json(F.struct(F.lit("stock").alias("name"), "items")).alias("value"))


def image_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """One image per row: the names of a stretch of parts."""
    parts = table(spark, sf, "part").groupBy(F.expr(f"p_partkey div {SHEET}").alias("sheet"))
    names = parts.agg(F.array_sort(F.collect_list(F.struct("p_partkey", "p_name"))).alias("names"))
    return names.select("sheet", F.array_join("names.p_name", ";").alias("value"))


def header_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """``part_key, content``: part names behind the header of some format."""
    lead = _case(F.col("p_type"), LEADS, OTHER_LEAD)
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("part_key"),
        F.concat(F.unhex(lead), F.encode("p_name", "utf-8")).alias("content"),
    )


# --- the same views in SQL -------------------------------------------------


def sql_case(key: str, values: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items())
    return f"CASE {key} {whens} ELSE '{default}' END"


ITEMS_SQL = f"""
words AS (
  SELECT p_partkey, p_name,
    {sql_case("split_part(p_name, ' ', 1)", COLOURS, "")} AS colour,
    {sql_case("split_part(p_name, ' ', 2)", NOUNS, "")} AS noun,
    {sql_case("split_part(p_name, ' ', 2)", VERBS, "穿着")} AS verb
  FROM part),
items AS (
  SELECT l_orderkey AS order_key, l_partkey AS part_key,
    l_linenumber::BIGINT * {LINE} + l_partkey AS ord,
    verb || colour || '的' || noun AS clause, p_name AS txt
  FROM lineitem JOIN words ON l_partkey = p_partkey)"""

TEXTS_SQL = f"""{ITEMS_SQL},
bodies AS (
  SELECT order_key, string_agg(clause, '，' ORDER BY ord) AS body
  FROM (SELECT order_key, clause, min(ord) AS ord FROM items GROUP BY ALL) GROUP BY order_key),
refs AS (
  SELECT order_key, list_sort(list(DISTINCT part_key)) AS image_ids FROM items GROUP BY order_key),
texts AS (
  SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'valid' ELSE 'train' END AS split,
    o_orderkey AS ord, o_orderkey AS text_id,
    '一个' || coalesce(body, '') || '的人' || {sql_case("o_orderstatus", TAILS, "")} AS text,
    coalesce(image_ids, []) AS image_ids, o_orderstatus AS status
  FROM orders LEFT JOIN bodies ON o_orderkey = bodies.order_key LEFT JOIN refs ON o_orderkey = refs.order_key),
links AS (
  SELECT split, ord, text_id, status, unnest(image_ids) AS image_id,
    generate_subscripts(image_ids, 1) - 1 AS pos
  FROM texts)"""

IMAGES_SQL = """
images AS (
  SELECT CASE WHEN p_size <= 10 THEN 'valid' ELSE 'train' END AS split,
    p_partkey AS ord, p_partkey AS image_id, base64(encode(p_name)) AS image_b64
  FROM part)"""

SHARED_IMAGES_SQL = """
images AS (
  SELECT unnest(['train', 'valid']) AS split,
    p_partkey AS ord, p_partkey AS image_id, base64(encode(p_name)) AS image_b64
  FROM part)"""

DOCUMENTS_SQL = """
docs AS (
  SELECT CASE WHEN lang = 'en' THEN 'valid' ELSE 'train' END AS split, doc_id AS text_id, text
  FROM documents)"""
