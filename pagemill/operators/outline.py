"""Outline of a document from the lines of its contents page.

Entries keep their place ``toc_seq``; the tree is an adjacency (``parent_seq``) with paths. The entries of
one document meet in one task: they are the lines of its contents pages.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.functions.text import WS, rstrip, strip

def _by_doc():
    return Window.partitionBy("doc_id").orderBy("toc_seq")


def _so_far():
    return _by_doc().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before():
    return _by_doc().rowsBetween(Window.unboundedPreceding, -1)


def levels(lines: DataFrame) -> DataFrame:
    """Lines with ``level``: rank of their font size, the largest is 0. All lines of the page count."""
    return lines.withColumn("level", F.dense_rank().over(Window.partitionBy("doc_id").orderBy(F.col("size").desc())) - 1)


def entries(lines: DataFrame) -> DataFrame:
    """Outline entries of contents lines.

    A line of digits alone gives the entry before it its page, if that has none and no such line came
    in between; it is no entry itself. A page that doesn't fit an INT stays null.
    """
    bare = rstrip(F.regexp_replace(strip(F.col("text")), rf"\.{{2,}}{WS}*\z", ""))
    rows = levels(lines).withColumn("_t", bare).withColumn("_digits", F.col("_t").rlike(r"\A\p{Nd}+\z"))
    rows = rows.withColumn("_entry", F.sum(F.when(~F.col("_digits"), 1).otherwise(0)).over(_so_far()))
    later = F.min_by(F.when(F.col("_digits"), F.expr("try_cast(_t as int)")), F.when(F.col("_digits"), F.col("toc_seq"))).over(Window.partitionBy("doc_id", "_entry"))
    pattern = rf"\A([^\n]+?)\.{{2,}}{WS}*(\p{{Nd}}+)\z"
    parsed = F.col("_t").rlike(pattern)
    title = F.when(parsed, strip(F.regexp_extract("_t", pattern, 1))).otherwise(F.col("_t"))
    page = F.when(parsed, F.expr(r"try_cast(regexp_extract(_t, '([0-9]+)\\z', 1) as int)"))
    out = rows.withColumn("_later", later).where("not _digits")
    return out.select("doc_id", "toc_seq", title.alias("title"), F.coalesce(page, "_later").alias("page_start"), "level")


def tree(found: DataFrame) -> DataFrame:
    """Entries with ``parent_seq``, the nearest entry before with a smaller level, and ``path``, the titles from the top.

    One pass over the entries of a document with a stack of the open ones, linear in their number.
    """
    seq = found.schema["toc_seq"].dataType
    added = T.StructType([T.StructField("parent_seq", seq), T.StructField("path", T.ArrayType(T.StringType()))])

    def walk(entries: pa.Table) -> pa.Table:
        entries = entries.sort_by("toc_seq")
        parents, paths = [], []
        open_at: list[tuple[int, int, list]] = []  # level, place, path
        for place, level, title in zip(*(entries.column(c).to_pylist() for c in ("toc_seq", "level", "title")), strict=True):
            while open_at and open_at[-1][0] >= level:
                open_at.pop()
            _, parent, path = open_at[-1] if open_at else (None, None, [])
            open_at.append((level, place, [*path, title]))
            parents.append(parent)
            paths.append(open_at[-1][2])
        kept = entries.append_column("parent_seq", pa.array(parents, entries.schema.field("toc_seq").type))
        return kept.append_column("path", pa.array(paths, pa.list_(pa.string())))

    return found.groupBy("doc_id").applyInArrow(walk, T.StructType([*found.schema.fields, *added.fields]))


def inherit_pages(found: DataFrame) -> DataFrame:
    """Entries without a page take that of their first child, which may have taken its own.

    First children in a row form a stretch of rising levels, so this is the first page from the entry to
    the end of its stretch.
    """
    rise = F.col("level") > F.lag("level").over(_by_doc())
    rows = found.withColumn("_stretch", F.sum(F.when(F.coalesce(rise, F.lit(False)), 0).otherwise(1)).over(_so_far()))
    onward = Window.partitionBy("doc_id", "_stretch").orderBy("toc_seq").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return rows.withColumn("page_start", F.first("page_start", ignorenulls=True).over(onward)).drop("_stretch")


def outline(lines: DataFrame) -> DataFrame:
    """The whole chain: lines to entries with pages, parents and paths."""
    return tree(inherit_pages(entries(lines)))


def nested_json(found: DataFrame) -> DataFrame:
    """One JSON text per document: nodes with title, page_start, level and children."""
    import json

    import pandas as pd

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("toc_seq")
        nodes: dict[int, dict] = {}
        top = []
        for r in rows.itertuples(index=False):
            node = {"title": r.title, "page_start": None if pd.isna(r.page_start) else int(r.page_start), "level": int(r.level), "children": []}
            nodes[r.toc_seq] = node
            (top if pd.isna(r.parent_seq) else nodes[int(r.parent_seq)]["children"]).append(node)
        return pd.DataFrame({"doc_id": [rows["doc_id"].iloc[0]], "toc_json": [json.dumps(top, ensure_ascii=False)]})

    return found.select("doc_id", "toc_seq", "title", "page_start", "level", "parent_seq").groupBy("doc_id").applyInPandas(build, "doc_id bigint, toc_json string")
