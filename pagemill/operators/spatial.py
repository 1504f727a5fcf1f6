"""Spatial joins of spans and layout regions of one page.

Each is an equi-join on document and page with the overlap as residual condition; a page has tens of
regions, so the candidate pairs stay near the number of spans. "First" means first in list order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions.geometry import box, covers
from pagemill.schema import CONTENT_LABEL, TABLE_LABEL

PAGE_KEYS = ("doc_id", "page_index")
SPAN_KEYS = (*PAGE_KEYS, "region_idx")


def _on_page(spans: DataFrame, layout: DataFrame, how: str, min_overlap: float) -> DataFrame:
    s, r = spans.alias("s"), layout.alias("r")
    same = (F.col("s.doc_id") == F.col("r.doc_id")) & (F.col("s.page_index") == F.col("r.page_index"))
    return s.join(r, same & covers(box(alias="s"), box(alias="r"), min_overlap), how)


def overlap_pairs(spans: DataFrame, layout: DataFrame, min_overlap: float = 0.3) -> DataFrame:
    """All pairs of a span and a region that covers enough of it."""
    pairs = _on_page(spans, layout, "inner", min_overlap)
    return pairs.select("s.doc_id", "s.page_index", "s.region_idx", "r.layout_idx", "r.label")


def first_matches(spans: DataFrame, layout: DataFrame, min_overlap: float = 0.3) -> DataFrame:
    """Spans with ``label`` of the first covering region and ``table_idx`` of the first covering table.

    The tens of regions of a page are put together once, in list order, and each span looks through
    them: no pairs, no aggregation over spans, and where the spans already lie by page they don't move.
    """
    region = F.struct("layout_idx", "label", "x0", "y0", "x1", "y1")
    of_page = layout.groupBy(*PAGE_KEYS).agg(F.array_sort(F.collect_list(region)).alias("_regions"))
    over = lambda r: covers(box(), tuple(r[c] for c in ("x0", "y0", "x1", "y1")), min_overlap)
    found = spans.join(of_page, list(PAGE_KEYS), "left").withColumn("_over", F.filter("_regions", over))
    first = F.try_element_at("_over", F.lit(1))
    table = F.try_element_at(F.filter("_over", lambda r: r["label"] == TABLE_LABEL), F.lit(1))
    return found.select(*spans.columns, first["label"].alias("label"), table["layout_idx"].alias("table_idx"))


def content_spans(spans: DataFrame, layout: DataFrame, min_overlap: float = 0.3) -> DataFrame:
    """Spans that some content region covers."""
    return _on_page(spans, layout.where(F.col("label") == CONTENT_LABEL), "left_semi", min_overlap)
