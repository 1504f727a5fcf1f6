"""What to draw over a page image, as rows; drawing itself is left to the reader of these rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions.geometry import box, centre
from pagemill.operators.spatial import SPAN_KEYS

PALETTE = 20


def order_overlay(spans: DataFrame, order: DataFrame | None = None) -> DataFrame:
    """Boxes of all spans; those with a place in ``order`` (SPAN_KEYS, seq) carry it as label near the middle."""
    cx, cy = centre(box())
    rows = spans.join(order.select(*SPAN_KEYS, "seq"), list(SPAN_KEYS), "left") if order is not None else spans.withColumn("seq", F.lit(None).cast("int"))
    there = F.col("seq").isNotNull()
    return rows.select(*SPAN_KEYS, "x0", "y0", "x1", "y1", F.col("seq").cast("string").alias("label"), F.when(there, cx - 10).alias("label_x"), F.when(there, cy + 10).alias("label_y"))


def layout_overlay(layout: DataFrame) -> DataFrame:
    """Polygons of regions with label text, its place, and the palette index of the label on its page."""
    rank = F.dense_rank().over(Window.partitionBy("doc_id", "page_index").orderBy("label")) - 1
    point = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    return layout.select(
        "doc_id",
        "page_index",
        "layout_idx",
        F.array(point("x0", "y0"), point("x1", "y0"), point("x1", "y1"), point("x0", "y1")).alias("polygon"),
        F.pmod(rank, F.lit(PALETTE)).alias("palette_index"),
        F.format_string("%s (%.2f)", "label", "confidence").alias("label_text"),
        F.col("x0").alias("label_x"),
        F.greatest(F.lit(10), F.col("y0") - 5).alias("label_y"),
    )
