"""Queries over nested outlines and tables (problem 3)."""

from __future__ import annotations

from pagemill.operators import nested
from pagemill.session import table


def p3_found(spark, sf_dir):
    return nested.links(table(spark, sf_dir, "book_tocs"), table(spark, sf_dir, "extracted_tables"))


def p3_nodes(spark, sf_dir):
    return nested.outline_nodes(table(spark, sf_dir, "book_tocs")).select("book_id", "record_id", "position", "parent_position", "depth", "title").distinct()


def p3_columns(spark, sf_dir):
    return nested.list_elements(table(spark, sf_dir, "extracted_tables")).distinct()


def p3_rows(spark, sf_dir):
    return nested.map_rows(table(spark, sf_dir, "extracted_tables")).distinct()


def p3_cells(spark, sf_dir):
    return nested.map_cells(table(spark, sf_dir, "extracted_tables")).select("book_id", "record_id", "row_position", "key", "value").distinct()


QUERIES = {f.__name__: f for f in (p3_found, p3_nodes, p3_columns, p3_rows, p3_cells)}

_NODES = """
raw AS (SELECT DISTINCT book_id, toc_id, toc_json::JSON AS j FROM book_tocs),
tops AS (SELECT book_id, toc_id, CASE WHEN json_type(j) = 'ARRAY' THEN j ELSE j->'toc' END AS a FROM raw),
n AS (
  SELECT book_id, toc_id, [i] AS path, json_extract(a, '$[' || i || ']') AS node
  FROM (SELECT book_id, toc_id, a, unnest(range(json_array_length(a)::BIGINT)) AS i FROM tops)
  UNION ALL
  SELECT book_id, toc_id, list_append(path, i), CASE WHEN many THEN json_extract(c, '$[' || i || ']') ELSE c END
  FROM (SELECT book_id, toc_id, path, node->'children' AS c, json_type(node->'children') = 'ARRAY' AS many,
               unnest(range(CASE json_type(node->'children') WHEN 'ARRAY' THEN json_array_length(node->'children')::BIGINT WHEN 'OBJECT' THEN 1 ELSE 0 END)) AS i
        FROM n)
),
placed AS (SELECT book_id, toc_id, path, node, row_number() OVER (PARTITION BY book_id, toc_id ORDER BY path) - 1 AS position FROM n),
nodes AS (SELECT c.book_id, c.toc_id AS record_id, c.position::INT AS position, p.position::INT AS parent_position, len(c.path)::INT AS depth, c.node->>'title' AS title
          FROM placed c LEFT JOIN placed p ON p.book_id = c.book_id AND p.toc_id = c.toc_id AND p.path = c.path[:-2])
"""
_NODES = _NODES.replace("c.path[:-2]", "c.path[1:len(c.path) - 1]")
_COLUMNS = "SELECT DISTINCT book_id, table_id AS record_id, (i - 1)::INT AS position, columns[i] AS value FROM (SELECT book_id, table_id, columns, unnest(range(1, len(columns) + 1)) AS i FROM extracted_tables)"
_ROWS = "SELECT DISTINCT book_id, table_id AS record_id, (i - 1)::INT AS position FROM (SELECT book_id, table_id, unnest(range(1, len(\"rows\") + 1)) AS i FROM extracted_tables)"
_CELLS = "SELECT DISTINCT book_id, record_id, row_position, e.key AS key, e.value AS value FROM (SELECT book_id, record_id, row_position, unnest(map_entries(r)) AS e FROM (SELECT book_id, table_id AS record_id, (i - 1)::INT AS row_position, \"rows\"[i] AS r FROM (SELECT book_id, table_id, \"rows\", unnest(range(1, len(\"rows\") + 1)) AS i FROM extracted_tables)))"

ORACLES = {
    "p3_nodes": f"WITH RECURSIVE {_NODES} SELECT * FROM nodes",
    "p3_columns": _COLUMNS,
    "p3_rows": _ROWS,
    "p3_cells": _CELLS,
    "p3_found": f"""WITH RECURSIVE {_NODES}
SELECT book_id, record_id, 'node' AS link, parent_position::VARCHAR AS parent_key, position::VARCHAR AS child_key FROM nodes WHERE parent_position IS NOT NULL
UNION SELECT book_id, record_id, 'column', record_id, position::VARCHAR FROM ({_COLUMNS})
UNION SELECT book_id, record_id, 'row', record_id, position::VARCHAR FROM ({_ROWS})
UNION SELECT book_id, record_id, 'cell', row_position::VARCHAR, key FROM ({_CELLS})""",
}
