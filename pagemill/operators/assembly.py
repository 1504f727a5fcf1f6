"""Assembly of the spans of a page into titled text and table blocks.

The page is cut into islands: titles and first spans of a table are boundaries, text between two
boundaries is one block. Everything is one window per page over one sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions.geometry import box, padded
from pagemill.operators.ordering import reading_order
from pagemill.operators.spatial import PAGE_KEYS, first_matches
from pagemill.schema import NOISE_LABELS, TITLE_LABELS

def _by_page():
    return Window.partitionBy(*PAGE_KEYS).orderBy("seq")


def _so_far():
    return _by_page().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def font_neighbours(ordered: DataFrame) -> DataFrame:
    """Font sizes before and after each span, noise and titles included."""
    return ordered.withColumn("prev_size", F.lag("size").over(_by_page())).withColumn("next_size", F.lead("size").over(_by_page()))


def classify(spans: DataFrame, layout: DataFrame, columns: int = 2, prose_font: float | None = 9.0, min_overlap: float = 0.3) -> DataFrame:
    """Spans in reading order with ``kind``: noise, title, table or prose. The first rule that holds counts."""
    matched = first_matches(reading_order(spans, columns), layout, min_overlap)
    near = font_neighbours(matched)
    alone = ~F.col("prev_size").eqNullSafe(F.col("size")) & ~F.col("next_size").eqNullSafe(F.col("size"))
    by_font = F.lit(False) if not prose_font else F.coalesce((F.col("size") > F.lit(float(prose_font))) & alone, F.lit(False))
    kind = F.when(F.col("label").isin(*NOISE_LABELS), "noise").when(F.col("label").isin(*TITLE_LABELS), "title").when(F.col("table_idx").isNotNull(), "table").when(by_font, "title").otherwise("prose")
    return near.withColumn("kind", kind)


def carry_titles(classified: DataFrame) -> DataFrame:
    """With ``title``: the last title before the span on its page; of titles in a row the last counts."""
    own = F.when(F.col("kind") == "title", F.col("text"))
    return classified.withColumn("title", F.last(own, ignorenulls=True).over(_so_far()))


def _assembled(spans: DataFrame, layout: DataFrame, columns: int, prose_font: float | None, min_overlap: float, crop_dir: str) -> DataFrame:
    """Blocks with ``page_index`` and, for tables, ``layout_idx`` of their region."""
    rows = carry_titles(classify(spans, layout, columns, prose_font, min_overlap)).where("kind <> 'noise'")
    of_table = Window.partitionBy(*PAGE_KEYS, "table_idx", "kind").orderBy("seq")
    rows = rows.withColumn("opens", (F.col("kind") == "table") & (F.row_number().over(of_table) == 1) & F.col("table_idx").isNotNull())
    rows = rows.withColumn("island", F.sum(F.when((F.col("kind") == "title") | F.col("opens"), 1).otherwise(0)).over(_so_far()))
    kept = rows.where("kind = 'prose' or opens")
    words = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), " ")
    runs = kept.groupBy(*PAGE_KEYS, "island", F.when(F.col("opens"), "table").otherwise("text").alias("type")).agg(F.min("seq").alias("first_seq"), words.alias("words"), F.min_by("title", "seq").alias("title"), F.min_by("table_idx", "seq").alias("table_idx"))
    order = F.row_number().over(Window.partitionBy(*PAGE_KEYS).orderBy("first_seq")) - 1
    named = runs.withColumn("order_id", order).withColumn("page", F.col("page_index") + 1)
    is_text = F.col("type") == "text"
    block_id = F.format_string("%s_%d_%05d", F.when(is_text, "blk").otherwise("tbl"), "page", "order_id")
    named = named.withColumn("block_id", block_id)
    crop = F.when(~is_text, F.concat(F.lit(crop_dir + "/"), "block_id", F.lit(".png")))
    return named.select("doc_id", "block_id", "order_id", "page", "type", F.when(is_text, F.col("words")).alias("text"), "title", crop.alias("image_crop"), "page_index", F.when(~is_text, F.col("table_idx")).alias("layout_idx"))


def assemble(spans: DataFrame, layout: DataFrame, columns: int = 2, prose_font: float | None = 9.0, min_overlap: float = 0.3, crop_dir: str = "crops") -> DataFrame:
    """Blocks of every page. Each table region gives one block where its first span is read."""
    return _assembled(spans, layout, columns, prose_font, min_overlap, crop_dir).drop("page_index", "layout_idx")


def table_regions(spans: DataFrame, layout: DataFrame, columns: int = 2, prose_font: float | None = 9.0, min_overlap: float = 0.3, crop_dir: str = "crops") -> DataFrame:
    """(doc_id, page_index, block_id, image_crop, x0 .. y1): the region of every table block."""
    made = _assembled(spans, layout, columns, prose_font, min_overlap, crop_dir).where("type = 'table'")
    regions = layout.select(*PAGE_KEYS, "layout_idx", "x0", "y0", "x1", "y1")
    return made.join(regions, [*PAGE_KEYS, "layout_idx"]).select(*PAGE_KEYS, "block_id", "image_crop", "x0", "y0", "x1", "y1")


def crop_boxes(regions: DataFrame, width: int | str = "width", height: int | str = "height", padding: int = 8) -> DataFrame:
    """Regions with the box to cut out of the page image."""
    w, h = (F.lit(x) if isinstance(x, int) else F.col(x) for x in (width, height))
    cut = padded(box(), w, h, padding)
    return regions.withColumns({f"crop_{n}": c for n, c in zip(("x0", "y0", "x1", "y1"), cut, strict=True)})
