"""The document stages over the given library: many books, late and repeated rows, outlines in volumes."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.operators import attach, nested, outline, sections, tables
from pagemill.plans import oracles as o
from pagemill.session import materialize, table
from pagemill.sources import records


def blocks(spark, sf_dir):
    """Blocks as they were loaded last; the book is the document."""
    rows = table(spark, sf_dir, "blocks").withColumnRenamed("book_id", "doc_id")
    return records.latest(rows, ["doc_id", "block_id"], "loaded_at").drop("parsed_at", "loaded_at")


def entries(spark, sf_dir):
    """Outline entries of every book: its volumes one after another, each from top to bottom."""
    tocs = table(spark, sf_dir, "book_tocs").dropDuplicates(["toc_id"])
    nodes = nested.outline_nodes(tocs)
    at = tocs.select(F.col("toc_id").alias("record_id"), F.col("volume").cast("bigint").alias("volume"))
    place = F.col("volume") * 1_000_000 + F.col("position")
    return nodes.join(at, "record_id").select(F.col("book_id").alias("doc_id"), place.alias("toc_seq"), "title", F.expr("try_cast(page_start as int)").alias("page_start"), (F.col("depth") - 1).alias("level"))


def _outline(spark, sf_dir):
    return materialize(outline.tree(outline.inherit_pages(entries(spark, sf_dir))), "library-outline")


def _blocks(spark, sf_dir):
    return materialize(blocks(spark, sf_dir), "library-blocks")


def _joined(name):
    return F.array_join(F.col(name), " / ").alias(name)


def book_outline(spark, sf_dir):
    return outline.tree(outline.inherit_pages(entries(spark, sf_dir))).select("doc_id", "toc_seq", "title", "page_start", "level", "parent_seq", _joined("path"))


def book_blocks_text(spark, sf_dir):
    rows = attach.text_blocks(_blocks(spark, sf_dir), _outline(spark, sf_dir))
    return rows.select("doc_id", "block_id", "page", "order_id", "title", _joined("toc"), "text")


def book_blocks_tables(spark, sf_dir):
    rows = attach.table_blocks(_blocks(spark, sf_dir), _outline(spark, sf_dir))
    return rows.select("doc_id", "block_id", "page", "order_id", "title", _joined("toc"), "image_crop")


def book_sections(spark, sf_dir):
    rows = sections.sections(attach.text_blocks(_blocks(spark, sf_dir), _outline(spark, sf_dir)))
    return rows.select("doc_id", "section_id", _joined("toc"), _joined("headings"), "text", F.array_join(F.transform("pages", lambda x: x.cast("string")), ",").alias("pages"), _joined("block_ids"))


def book_pages(spark, sf_dir):
    """Pages of each book with their number of blocks; a page whose image was cached has no size."""
    made = table(spark, sf_dir, "book_pages").withColumnRenamed("book_id", "doc_id").distinct()
    count = blocks(spark, sf_dir).groupBy("doc_id", (F.col("page") - 1).alias("page_index")).agg(F.count("*").alias("n_blocks"))
    return made.join(count, ["doc_id", "page_index"], "left").select("doc_id", "page_index", "image_path", F.col("width").isNull().alias("cached"), F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"))


def book_tables(spark, sf_dir):
    """Cells of the extracted tables of every book, with the path of their block."""
    rows = table(spark, sf_dir, "extracted_tables").withColumnRenamed("book_id", "doc_id").dropDuplicates(["doc_id", "table_id"])
    return tables.table_cells(rows)


def book_tables_due(spark, sf_dir):
    """Table blocks that no extracted table answers."""
    due = blocks(spark, sf_dir).where("type = 'table'").select("doc_id", "block_id", "page", "order_id")
    done = table(spark, sf_dir, "extracted_tables").select(F.col("book_id").alias("doc_id"), F.col("table_id").alias("block_id"))
    return records.pending(due, done, ["doc_id", "block_id"])


_FUNCTIONS = (book_outline, book_blocks_text, book_blocks_tables, book_sections, book_pages, book_tables, book_tables_due)
QUERIES = {f.__name__: f for f in _FUNCTIONS}

_LATEST = "given AS (SELECT book_id AS doc_id, * EXCLUDE (book_id, parsed_at, loaded_at) FROM blocks QUALIFY row_number() OVER (PARTITION BY book_id, block_id ORDER BY loaded_at DESC) = 1)"
# outlines walked by recursion over the JSON: children are a list, one object, or nothing
_ENTRIES = """
tops AS (SELECT book_id, toc_id, volume, CASE WHEN json_type(j) = 'ARRAY' THEN j ELSE j->'toc' END AS a FROM (SELECT DISTINCT book_id, toc_id, volume, toc_json::JSON AS j FROM book_tocs)),
walked AS (
  SELECT book_id, toc_id, volume, [i] AS place, json_extract(a, '$[' || i || ']') AS node FROM (SELECT *, unnest(range(json_array_length(a)::BIGINT)) AS i FROM tops)
  UNION ALL
  SELECT book_id, toc_id, volume, list_append(place, i), CASE WHEN many THEN json_extract(c, '$[' || i || ']') ELSE c END
  FROM (SELECT book_id, toc_id, volume, place, node->'children' AS c, json_type(node->'children') = 'ARRAY' AS many,
               unnest(range(CASE json_type(node->'children') WHEN 'ARRAY' THEN json_array_length(node->'children')::BIGINT WHEN 'OBJECT' THEN 1 ELSE 0 END)) AS i FROM walked)),
entries AS (SELECT book_id AS doc_id, volume::BIGINT * 1000000 + row_number() OVER (PARTITION BY toc_id ORDER BY place) - 1 AS toc_seq, node->>'title' AS title, try_cast(node->>'page_start' AS INT) AS page_start, (len(place) - 1)::INT AS level FROM walked)"""
_OUTLINE = f"{_ENTRIES}, {o.TREE.format(entries='entries')}, {o.PAGES}"
_ATTACHED = f"""WITH RECURSIVE {_LATEST}, {_OUTLINE},
keyed AS (SELECT e.doc_id, e.toc_seq, {o.title_key('e.title')} AS key, g.page_start, p.path FROM entries e JOIN pages g USING (doc_id, toc_seq) JOIN paths p USING (doc_id, toc_seq)),
matched AS (SELECT b.doc_id, b.block_id, arg_min(k.path, k.toc_seq) AS matched_path FROM given b JOIN keyed k ON k.doc_id = b.doc_id AND b.title <> '' AND {o.title_key('b.title')} = k.key AND (k.page_start IS NULL OR b.page IS NULL OR b.page >= k.page_start) GROUP BY ALL),
carried AS (SELECT b.*, coalesce(last_value(m.matched_path IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY page NULLS FIRST, order_id NULLS FIRST, block_id ROWS UNBOUNDED PRECEDING), []) AS toc FROM given b LEFT JOIN matched m USING (doc_id, block_id))"""
_TEXTS = f"""{_ATTACHED},
grouped AS (SELECT *, row_number() OVER w AS n, sum((coalesce(title, '') <> '')::INT) OVER (w ROWS UNBOUNDED PRECEDING) AS g FROM carried WHERE type = 'text' WINDOW w AS (PARTITION BY doc_id ORDER BY page NULLS FIRST, order_id NULLS FIRST, block_id)),
cleaned AS (SELECT * REPLACE ({o.clean(o.compatible('text'))} AS text) FROM grouped),
texts AS (SELECT doc_id, arg_min(block_id, n) AS block_id, arg_min(page, n) AS page, arg_min(order_id, n) AS order_id, arg_min(title, n) FILTER (WHERE title IS NOT NULL) AS title, arg_min(toc, n) AS toc, coalesce(string_agg(text, chr(10) || chr(10) ORDER BY n), '') AS text
  FROM cleaned GROUP BY doc_id, CASE WHEN g = 0 THEN n ELSE -g END)"""
_SECTIONS = f"""{_TEXTS},
filled AS (SELECT * REPLACE ({o.strip('text')} AS text) FROM texts WHERE {o.strip('text')} <> ''),
headed AS (SELECT *, coalesce(title, '') <> '' AND len(toc) > 0 AND coalesce(toc[-1], '') <> '' AND {o.title_key('title')} <> {o.title_key('toc[-1]')} AS is_heading FROM filled),
marked AS (SELECT * REPLACE (CASE WHEN is_heading THEN '<<<HEADING: ' || title || ' >>>' || chr(10) || chr(10) || text ELSE text END AS text), row_number() OVER w AS n, (lag(toc) OVER w IS DISTINCT FROM toc OR row_number() OVER w = 1)::INT AS o FROM headed WINDOW w AS (PARTITION BY doc_id ORDER BY page NULLS FIRST, order_id NULLS FIRST, block_id)),
placed AS (SELECT *, sum(o) OVER (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING) - 1 AS s FROM marked),
heads AS (SELECT *, CASE WHEN is_heading AND lag(title) OVER (PARTITION BY doc_id, s, is_heading ORDER BY n) IS DISTINCT FROM title THEN title END AS head, row_number() OVER (PARTITION BY doc_id, s, page ORDER BY n) = 1 AS new_page FROM placed)"""

ORACLES = {
    "book_outline": f"WITH RECURSIVE {_OUTLINE} SELECT e.doc_id, e.toc_seq, e.title, g.page_start, e.level, p.parent_seq, array_to_string(h.path, ' / ') AS path FROM entries e JOIN pages g USING (doc_id, toc_seq) JOIN parents p USING (doc_id, toc_seq) JOIN paths h USING (doc_id, toc_seq)",
    "book_blocks_text": f"{_TEXTS} SELECT doc_id, block_id, page, order_id, title, array_to_string(toc, ' / ') AS toc, text FROM texts",
    "book_blocks_tables": f"{_ATTACHED} SELECT doc_id, block_id, page, order_id, title, array_to_string(toc, ' / ') AS toc, image_crop FROM carried WHERE type = 'table'",
    "book_sections": f"""{_SECTIONS} SELECT doc_id, printf('sec_%06d', s::BIGINT) AS section_id, array_to_string(arg_min(toc, n), ' / ') AS toc, coalesce(string_agg(head, ' / ' ORDER BY n), '') AS headings, string_agg(text, chr(10) || chr(10) ORDER BY n) AS text,
  string_agg(page::VARCHAR, ',' ORDER BY n) FILTER (WHERE new_page) AS pages, string_agg(block_id, ' / ' ORDER BY n) AS block_ids FROM heads GROUP BY doc_id, s""",
    "book_pages": f"WITH {_LATEST}, n AS (SELECT doc_id, page - 1 AS page_index, count(*) AS n_blocks FROM given GROUP BY ALL) SELECT doc_id, page_index, image_path, width IS NULL AS cached, coalesce(n_blocks, 0) AS n_blocks FROM (SELECT DISTINCT book_id AS doc_id, * EXCLUDE (book_id) FROM book_pages) LEFT JOIN n USING (doc_id, page_index)",
    "book_tables": """SELECT doc_id, table_id, r::INT AS "row", e.key AS "column", e.value AS value
FROM (SELECT doc_id, table_id, r, unnest(map_entries(m)) AS e FROM (SELECT doc_id, table_id, i - 1 AS r, l[i] AS m FROM (SELECT doc_id, table_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT book_id AS doc_id, table_id, any_value("rows") AS l FROM extracted_tables GROUP BY ALL))))""",
    "book_tables_due": f"WITH {_LATEST} SELECT doc_id, block_id, page, order_id FROM given WHERE type = 'table' AND (doc_id, block_id) NOT IN (SELECT (book_id, table_id) FROM extracted_tables)",
}
