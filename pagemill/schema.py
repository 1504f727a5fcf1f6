"""Record schemas exchanged by the stages. Every table carries its document and its order."""

from __future__ import annotations

from pyspark.sql import types as T

BBOX = "struct<x0:int,y0:int,x1:int,y1:int>"
PAGE = "doc_id bigint, page_index int, width int, height int, dpi int, image_path string"
RAW_SPAN = "struct<text:string,size:double,bbox:array<double>>"
RAW_PAGE = f"doc_id bigint, page_index int, blocks array<struct<type:int,lines:array<struct<spans:array<{RAW_SPAN}>>>>>"
SPAN = "doc_id bigint, page_index int, region_idx int, text string, size double, x0 int, y0 int, x1 int, y1 int"
RAW_LAYOUT = "doc_id bigint, page_index int, boxes array<struct<score:double,label:string,coordinate:array<double>>>"
LAYOUT = "doc_id bigint, page_index int, layout_idx int, label string, confidence double, x0 int, y0 int, x1 int, y1 int"
OUTLINE_ENTRY = "doc_id bigint, toc_seq int, title string, page_start int, level int"
BLOCK = "doc_id bigint, block_id string, order_id int, page int, type string, text string, title string, image_crop string"
TEXT_BLOCK = "doc_id bigint, block_id string, page int, order_id int, title string, toc array<string>, text string"
TABLE_BLOCK = "doc_id bigint, block_id string, page int, order_id int, title string, toc array<string>, image_crop string"
SECTION = "doc_id bigint, section_id string, toc array<string>, headings array<string>, text string, pages array<int>, block_ids array<string>"
EXTRACTED = "doc_id bigint, table_id string, toc array<string>, title string, page int, description string, columns array<string>, rows array<map<string,string>>, image_crop string, status string"

# Labels the stages tell apart.
NOISE_LABELS = ("footer", "number", "image", "aside_text")
TITLE_LABELS = ("paragraph_title", "figure_title")
TABLE_LABEL = "table"
CONTENT_LABEL = "content"


def struct(ddl: str) -> T.StructType:
    """A DDL string as a type; needs no session for the simple kinds used above."""
    return T.StructType.fromDDL(ddl)
