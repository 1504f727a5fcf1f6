"""Records of the early stages derived from the given tables by whole-number arithmetic.

The given tables hold no positioned spans and no detected regions, so each document stands for a page:
its lines are spans, and regions, contents lines, blocks and scores follow from its id. Every
derivation exists twice, as DataFrame and as SQL text, so that both engines start from equal records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.session import spread, table

def _d():
    return F.col("doc_id")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.split("text", "\n").alias("l"))
    return docs.select("doc_id", F.size("l").cast("bigint").alias("n"), F.posexplode("l").alias("i", "line"))


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, n, length = F.col("i").cast("bigint"), F.col("n"), F.char_length("line")
    x0 = 100 + 1200 * F.pmod(i * 7 + _d(), F.lit(2)) + 10 * F.pmod(i + _d(), F.lit(5))
    y0 = 100 + 40 * F.pmod(i * 5 + _d(), n)
    k = F.pmod(_d() * 31 + i * 17, F.lit(10))
    size = F.when(k == 0, 14.0).when(k.isin(1, 2), 12.0).when(k == 3, None).otherwise(9.0)
    out = _lines(spark, sf_dir).select("doc_id", _d().cast("int").alias("page_index"), F.col("i").cast("int").alias("region_idx"), F.trim("line").alias("text"), size.cast("double").alias("size"), x0.cast("int").alias("x0"), y0.cast("int").alias("y0"), (x0 + 200 + F.pmod(length * 7, F.lit(800))).cast("int").alias("x1"), (y0 + 30).cast("int").alias("y1"))
    return out.where("text <> ''")


SPANS = """lines AS (SELECT doc_id AS d, len(l)::BIGINT AS n, unnest(range(len(l)::BIGINT)) AS i, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
spans AS (SELECT d AS doc_id, d::INT AS page_index, i::INT AS region_idx, trim(line, ' ') AS text,
  CASE (d * 31 + i * 17) % 10 WHEN 0 THEN 14e0 WHEN 1 THEN 12e0 WHEN 2 THEN 12e0 WHEN 3 THEN NULL ELSE 9e0 END AS size,
  (100 + 1200 * ((i * 7 + d) % 2) + 10 * ((i + d) % 5))::INT AS x0, (100 + 40 * ((i * 5 + d) % n))::INT AS y0,
  (300 + 1200 * ((i * 7 + d) % 2) + 10 * ((i + d) % 5) + (length(line) * 7) % 800)::INT AS x1, (130 + 40 * ((i * 5 + d) % n))::INT AS y1
  FROM lines WHERE trim(line, ' ') <> '')"""

LABELS = ("text", "paragraph_title", "table", "footer", "number", "image", "aside_text", "figure_title", "content")


def raw_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions before the confidence filter, as columns (score, label, x0..y1)."""
    docs = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.size(F.split("text", "\n")).cast("bigint").alias("n"), F.explode(F.sequence(F.lit(0), F.lit(5))).alias("k"))
    k, n = F.col("k").cast("bigint"), F.col("n")
    label = F.element_at(F.array(*map(F.lit, LABELS)), (F.pmod(_d() * 3 + k * 5, F.lit(9)) + 1).cast("int"))
    x0 = 60 + 1200 * F.pmod(_d() + k, F.lit(2))
    y0 = 90 + 40 * F.pmod(_d() * 13 + k * 29, n)
    return docs.select("doc_id", _d().cast("int").alias("page_index"), F.col("k").alias("layout_idx"), label.alias("label"), (F.pmod(_d() * 37 + k * 53, F.lit(100)) / 100.0).cast("double").alias("confidence"), x0.cast("int").alias("x0"), y0.cast("int").alias("y0"), (x0 + 1150).cast("int").alias("x1"), (y0 + 60 * (1 + F.pmod(_d() + k, F.lit(3)))).cast("int").alias("y1"))


RAW_LAYOUT = """raw_layout AS (SELECT d AS doc_id, d::INT AS page_index, k::INT AS layout_idx,
  (['text','paragraph_title','table','footer','number','image','aside_text','figure_title','content'])[(d * 3 + k * 5) % 9 + 1] AS label,
  ((d * 37 + k * 53) % 100)::DOUBLE / 100e0 AS confidence, (60 + 1200 * ((d + k) % 2))::INT AS x0, (90 + 40 * ((d * 13 + k * 29) % n))::INT AS y0,
  (1210 + 1200 * ((d + k) % 2))::INT AS x1, (90 + 40 * ((d * 13 + k * 29) % n) + 60 * (1 + (d + k) % 3))::INT AS y1
  FROM (SELECT doc_id AS d, len(string_split(text, chr(10)))::BIGINT AS n, unnest(range(6)) AS k FROM documents WHERE text IS NOT NULL))"""
LAYOUT = f"""{RAW_LAYOUT},
layout AS (SELECT * FROM raw_layout WHERE confidence >= 0.5e0 OR label IN ('footer', 'number', 'aside_text', 'image'))"""


def noisy_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with one kind of noise each, by their id."""
    t, k = F.col("text"), F.pmod(_d(), F.lit(8))
    noisy = (
        F.when(k == 0, F.replace(t, F.lit("th"), F.lit("t- h")))
        .when(k == 1, F.replace(t, F.lit(", "), F.lit(" — ")))
        .when(k == 2, F.replace(t, F.lit(". "), F.lit(".\n\n\n\n")))
        .when(k == 3, F.replace(t, F.lit(" "), F.lit(" \t")))
        .when(k == 4, F.concat(F.replace(t, F.lit("on"), F.lit("ﬁ")), F.lit("…")))
        .when(k == 5, F.concat(F.lit("“"), F.replace(t, F.lit("a"), F.lit("a\x07")), F.lit("”")))
        .when(k == 6, F.replace(t, F.lit("\n"), F.lit("\n• ▪ ")))
        .otherwise(F.concat(F.lit(" "), t, F.lit("\n")))
    )
    # characters beyond ASCII in the given texts would need compatibility composition in DuckDB too
    return spread(table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text")).select("doc_id", F.regexp_replace(noisy, "[^\\x00-\\x7f“”—ﬁ…•▪]", "?").alias("text"))


NOISY = """noisy AS (SELECT doc_id, regexp_replace(CASE doc_id % 8 WHEN 0 THEN replace(text, 'th', 't- h') WHEN 1 THEN replace(text, ', ', ' — ') WHEN 2 THEN replace(text, '. ', '.' || repeat(chr(10), 4))
  WHEN 3 THEN replace(text, ' ', ' ' || chr(9)) WHEN 4 THEN replace(text, 'on', 'ﬁ') || '…' WHEN 5 THEN '“' || replace(text, 'a', 'a' || chr(7)) || '”'
  WHEN 6 THEN replace(text, chr(10), chr(10) || '• ▪ ') ELSE ' ' || text || chr(10) END, '[^\\x00-\\x7f“”—ﬁ…•▪]', '?', 'g') AS text FROM documents WHERE text IS NOT NULL)"""


def toc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of contents pages in reading order: (doc_id, toc_seq, text, size)."""
    docs = table(spark, sf_dir, "documents").where("text is not null")
    base = F.trim(F.substring_index("text", "\n", 1))
    seq, k = F.pmod(_d(), F.lit(20)), F.pmod(_d(), F.lit(5))
    text = (
        F.when(k == 1, (10 + F.pmod(_d(), F.lit(90))).cast("string"))
        .when(k == 3, base)
        .when(k == 4, F.concat(base, F.lit("....")))
        .otherwise(F.concat(base, F.repeat(F.lit("."), (2 + F.pmod(_d(), F.lit(6))).cast("int")), F.lit(" "), (1 + F.pmod(_d(), F.lit(200))).cast("string")))
    )
    size = F.element_at(F.array(F.lit(18.0), F.lit(14.0), F.lit(11.0)), (F.pmod(_d() * 7, F.lit(3)) + 1).cast("int"))
    return docs.select(F.floor(_d() / 20).cast("bigint").alias("doc_id"), seq.cast("int").alias("toc_seq"), text.alias("text"), size.alias("size"))


TOC_LINES = """toc_lines AS (SELECT d // 20 AS doc_id, (d % 20)::INT AS toc_seq,
  CASE d % 5 WHEN 1 THEN (10 + d % 90)::VARCHAR WHEN 3 THEN b WHEN 4 THEN b || '....' ELSE b || repeat('.', (2 + d % 6)::INT) || ' ' || (1 + d % 200)::VARCHAR END AS text,
  ([18e0, 14e0, 11e0])[(d * 7) % 3 + 1] AS size
  FROM (SELECT doc_id AS d, trim(split_part(text, chr(10), 1), ' ') AS b FROM documents WHERE text IS NOT NULL))"""


def outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions and nations as an outline of document 0, some titles twice: entries with their paths."""
    region = table(spark, sf_dir, "region").select(F.lit(0).cast("bigint").alias("doc_id"), (F.col("r_regionkey") * 100).cast("int").alias("toc_seq"), F.col("r_name").alias("title"), F.lit(None).cast("int").alias("page_start"), F.lit(0).alias("level"))
    nation = table(spark, sf_dir, "nation").select(F.lit(0).cast("bigint").alias("doc_id"), (F.col("n_regionkey") * 100 + 1 + F.col("n_nationkey")).cast("int").alias("toc_seq"), F.col("n_name").alias("title"), (F.col("n_nationkey") * 3 + 1).cast("int").alias("page_start"), F.lit(1).alias("level"))
    again = nation.withColumn("toc_seq", F.col("toc_seq") + 50).withColumn("page_start", F.col("page_start") - 1)
    return region.unionByName(nation).unionByName(again)


OUTLINE = """outline AS (SELECT 0::BIGINT AS doc_id, (r_regionkey * 100)::INT AS toc_seq, r_name AS title, NULL::INT AS page_start, 0 AS level FROM region
  UNION ALL SELECT 0, (n_regionkey * 100 + 1 + n_nationkey)::INT, n_name, (n_nationkey * 3 + 1)::INT, 1 FROM nation
  UNION ALL SELECT 0, (n_regionkey * 100 + 51 + n_nationkey)::INT, n_name, (n_nationkey * 3)::INT, 1 FROM nation)"""


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of document 0, two a page."""
    docs = noisy_text(spark, sf_dir)
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("nk"), "n_name")
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("bigint").alias("rk"), "r_name")
    # two lookup tables of 25 and 5 rows by definition
    rows = docs.join(F.broadcast(nation), F.pmod(_d() * 7, F.lit(25)) == F.col("nk")).join(F.broadcast(region), F.pmod(_d(), F.lit(5)) == F.col("rk"))
    title = F.when(F.pmod(_d(), F.lit(4)).isin(0, 1), None).when(F.pmod(_d(), F.lit(4)) == 2, F.concat(F.upper("n_name"), F.lit("!"))).when(F.pmod(_d(), F.lit(8)) == 3, F.col("r_name")).otherwise(F.concat(F.lit("Note "), F.pmod(_d(), F.lit(6)).cast("string")))
    page, order, is_table = F.floor(_d() / 2).cast("int") + 1, F.pmod(_d(), F.lit(2)).cast("int"), F.pmod(_d(), F.lit(11)) == 10
    return rows.select(
        F.lit(0).cast("bigint").alias("doc_id"), F.format_string("%s_%d_%05d", F.when(is_table, "tbl").otherwise("blk"), page, order).alias("block_id"), order.alias("order_id"), page.alias("page"),
        F.when(is_table, "table").otherwise("text").alias("type"), F.when(~is_table, F.col("text")).alias("text"), title.alias("title"), F.when(is_table, F.format_string("crops/tbl_%d_%05d.png", page, order)).alias("image_crop"),
    )


BLOCKS = f"""{NOISY},
blocks_in AS (SELECT 0::BIGINT AS doc_id, printf('%s_%d_%05d', CASE WHEN d % 11 = 10 THEN 'tbl' ELSE 'blk' END, d // 2 + 1, d % 2) AS block_id, (d % 2)::INT AS order_id, (d // 2 + 1)::INT AS page,
  CASE WHEN d % 11 = 10 THEN 'table' ELSE 'text' END AS type, CASE WHEN d % 11 <> 10 THEN text END AS text,
  CASE WHEN d % 4 IN (0, 1) THEN NULL WHEN d % 4 = 2 THEN upper(n_name) || '!' WHEN d % 8 = 3 THEN r_name ELSE 'Note ' || (d % 6)::VARCHAR END AS title,
  CASE WHEN d % 11 = 10 THEN printf('crops/tbl_%d_%05d.png', d // 2 + 1, d % 2) END AS image_crop
  FROM (SELECT doc_id AS d, text FROM noisy) JOIN nation ON n_nationkey = (d * 7) % 25 JOIN region ON r_regionkey = d % 5)"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score matrices for the order model, a region for each line: (doc_id, page_index, row, col, score)."""
    docs = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.size(F.split("text", "\n")).alias("m"))
    rows = docs.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("m") - 1))).withColumn("col", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    return rows.select("doc_id", _d().cast("int").alias("page_index"), "row", "col", (F.pmod(_d() * 7 + F.col("row") * 13 + F.col("col") * 29, F.lit(101)) / 101.0).cast("double").alias("score"))


SCORES = """scores AS (SELECT doc_id, doc_id::INT AS page_index, r::INT AS "row", c::INT AS col, ((doc_id * 7 + r * 13 + c * 29) % 101)::DOUBLE / 101e0 AS score
  FROM (SELECT doc_id, m, r, unnest(range(m)) AS c FROM (SELECT doc_id, m, unnest(range(m)) AS r FROM (SELECT doc_id, len(string_split(text, chr(10))) AS m FROM documents WHERE text IS NOT NULL))))"""


def model_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table blocks with a stub's answer: whole, keys missing, nulls, no JSON, a list at the top."""
    tables = blocks(spark, sf_dir).where("type = 'table'")
    k = F.pmod(F.col("page"), F.lit(5))
    answer = (
        F.when(k == 0, F.format_string('{"columns": ["A", "B"], "rows": [{"A": "%d", "B": "x"}, {"A": "2", "B": null}], "description": "page %d"}', "page", "page"))
        .when(k == 1, F.lit("{}"))
        .when(k == 2, F.lit('{"columns": null, "rows": null, "description": null}'))
        .when(k == 3, F.lit('```json\n{"columns": []}\n```'))
        .otherwise(F.lit('[{"columns": ["A"]}]'))
    )
    return tables.withColumn("answer", answer)


MODEL_ANSWERS = f"""{BLOCKS},
answers AS (SELECT *, CASE page % 5 WHEN 0 THEN printf('{{"columns": ["A", "B"], "rows": [{{"A": "%d", "B": "x"}}, {{"A": "2", "B": null}}], "description": "page %d"}}', page, page)
  WHEN 1 THEN '{{}}' WHEN 2 THEN '{{"columns": null, "rows": null, "description": null}}' WHEN 3 THEN '```json' || chr(10) || '{{"columns": []}}' || chr(10) || '```' ELSE '[{{"columns": ["A"]}}]' END AS answer
  FROM blocks_in WHERE type = 'table')"""
