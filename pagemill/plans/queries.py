"""One query per operator of the early and late stages, each with its DuckDB equivalent.

Arrays are flattened to text on both sides, so that results compare by value.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import functions as F

from pagemill.functions import geometry as g
from pagemill.functions import text as tx
from pagemill.operators import assembly, attach, ordering, outline, overlay, sections, spatial, tables
from pagemill.plans import fixtures as fx
from pagemill.session import own_folder, table
from pagemill.sources import pages, records

SKIPPED = (1, 2, 177, 178, 179)


def _layout(spark, sf_dir):
    return pages.keep_regions(fx.raw_layout(spark, sf_dir))


def _joined(name):
    return F.array_join(F.col(name), " / ").alias(name)


def _numbers(name):
    return F.array_join(F.transform(F.col(name), lambda x: x.cast("string")), ",").alias(name)


# sources


def page_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.size(F.split("text", "\n")).alias("page_count"))
    return pages.page_manifest(docs)


def _raw_pages(spark, sf_dir):
    """Spans as recognition gives them: points, nested into blocks and lines, with blank spans and a picture block."""
    s = fx.spans(spark, sf_dir)
    point = lambda c: (F.col(c) * F.lit(0.24)).cast("double")
    span = F.struct(F.concat(F.lit(" "), "text", F.lit("\t")).alias("text"), F.col("size"), F.array(point("x0"), point("y0"), point("x1"), point("y1")).alias("bbox"))
    per_page = s.groupBy("doc_id", "page_index").agg(F.transform(F.array_sort(F.collect_list(F.struct("region_idx", span.alias("span")))), lambda x: x["span"]).alias("all"))
    blank = F.struct(F.lit(" \n").alias("text"), F.lit(9.0).alias("size"), F.array(*[F.lit(0.0)] * 4).alias("bbox"))
    n = F.size("all")
    half = F.ceil(n / 2).cast("int")
    lines = F.array(F.struct(F.slice("all", F.lit(1), half).alias("spans")), F.struct(F.array(blank).alias("spans")), F.struct(F.slice("all", half + 1, n).alias("spans")))
    picture = F.array(F.struct(F.slice("all", F.lit(1), F.lit(1)).alias("spans")))
    return per_page.select("doc_id", "page_index", F.array(F.struct(F.lit(1).alias("type"), picture.alias("lines")), F.struct(F.lit(0).alias("type"), lines.alias("lines"))).alias("blocks"))


def ocr_unnest(spark, sf_dir):
    return pages.unnest_spans(_raw_pages(spark, sf_dir))


def ocr_scale(spark, sf_dir):
    s = fx.spans(spark, sf_dir)
    return s.select("doc_id", "region_idx", *(g.to_pixels(F.col(c) * F.lit(0.24)).alias(c) for c in ("x0", "y0", "x1", "y1")))


def layout_filter(spark, sf_dir):
    return pages.keep_regions(fx.raw_layout(spark, sf_dir), 0.8)


# order


def page_extent(spark, sf_dir):
    return ordering.page_extent(fx.spans(spark, sf_dir))


def norm_boxes(spark, sf_dir):
    return ordering.normalized_boxes(fx.spans(spark, sf_dir))


def column_assign(spark, sf_dir):
    return ordering.assign_columns(fx.spans(spark, sf_dir), 3).select("doc_id", "region_idx", "col_idx")


def reading_order(spark, sf_dir):
    return ordering.reading_order(fx.spans(spark, sf_dir)).select("doc_id", "page_index", "region_idx", "seq")


def model_inputs(spark, sf_dir):
    rows = ordering.model_inputs(fx.spans(spark, sf_dir))
    return rows.select("doc_id", "page_index", _numbers("input_ids"), _numbers("attention_mask"), F.array_join(F.transform("bbox", lambda b: F.array_join(F.transform(b, lambda x: x.cast("string")), ",")), ";").alias("bbox"))


def assign_collisions(spark, sf_dir):
    return ordering.collisions(fx.scores(spark, sf_dir)).select("doc_id", "page_index", "position", _numbers("rows"))


def assign_order(spark, sf_dir):
    return ordering.assign_order(fx.scores(spark, sf_dir))


# space


def overlap_pairs(spark, sf_dir):
    return spatial.overlap_pairs(fx.spans(spark, sf_dir), _layout(spark, sf_dir))


def first_layout_match(spark, sf_dir):
    return spatial.first_matches(fx.spans(spark, sf_dir), _layout(spark, sf_dir)).select("doc_id", "region_idx", "label")


def first_table_match(spark, sf_dir):
    return spatial.first_matches(fx.spans(spark, sf_dir), _layout(spark, sf_dir)).where("table_idx is not null").select("doc_id", "region_idx", "table_idx")


def toc_content_semi(spark, sf_dir):
    return spatial.content_spans(fx.spans(spark, sf_dir), _layout(spark, sf_dir)).select("doc_id", "region_idx", "text")


def crop_boxes(spark, sf_dir):
    rows = assembly.crop_boxes(_layout(spark, sf_dir).where("label = 'table'"), 1500, 900)
    return rows.select("doc_id", "layout_idx", "crop_x0", "crop_y0", "crop_x1", "crop_y1")


# assembly


def font_neighbors(spark, sf_dir):
    return assembly.font_neighbours(ordering.reading_order(fx.spans(spark, sf_dir))).select("doc_id", "region_idx", "seq", "prev_size", "next_size")


def classify_regions(spark, sf_dir):
    return assembly.classify(fx.spans(spark, sf_dir), _layout(spark, sf_dir)).select("doc_id", "region_idx", "seq", "kind")


def title_carry(spark, sf_dir):
    return assembly.carry_titles(assembly.classify(fx.spans(spark, sf_dir), _layout(spark, sf_dir))).select("doc_id", "region_idx", "seq", "title")


def assemble_blocks(spark, sf_dir):
    return assembly.assemble(fx.spans(spark, sf_dir), _layout(spark, sf_dir))


# outline


def toc_levels(spark, sf_dir):
    return outline.levels(fx.toc_lines(spark, sf_dir)).select("doc_id", "toc_seq", "level")


def toc_entries(spark, sf_dir):
    return outline.entries(fx.toc_lines(spark, sf_dir))


def toc_tree(spark, sf_dir):
    return outline.tree(outline.entries(fx.toc_lines(spark, sf_dir))).select("doc_id", "toc_seq", "parent_seq")


def toc_paths(spark, sf_dir):
    return outline.tree(outline.entries(fx.toc_lines(spark, sf_dir))).select("doc_id", "toc_seq", _joined("path"))


def toc_propagate(spark, sf_dir):
    return outline.inherit_pages(outline.entries(fx.toc_lines(spark, sf_dir))).select("doc_id", "toc_seq", "page_start")


def toc_pipeline(spark, sf_dir):
    return outline.outline(fx.toc_lines(spark, sf_dir)).select("doc_id", "toc_seq", "title", "page_start", "level", "parent_seq", _joined("path"))


def toc_json(spark, sf_dir):
    return outline.nested_json(outline.outline(fx.toc_lines(spark, sf_dir)))


# attaching


def _outline(spark, sf_dir):
    return outline.tree(fx.outline(spark, sf_dir))


def skip_pages(spark, sf_dir):
    return attach.skip_pages(fx.blocks(spark, sf_dir), SKIPPED).select("block_id", "page")


def toc_match(spark, sf_dir):
    return attach.match_outline(fx.blocks(spark, sf_dir), _outline(spark, sf_dir)).select("block_id", "matched_seq")


def toc_carry(spark, sf_dir):
    rows = attach.carry_paths(attach.match_outline(attach.skip_pages(fx.blocks(spark, sf_dir), SKIPPED), _outline(spark, sf_dir)))
    return rows.select("block_id", _joined("toc"))


def _text_blocks(spark, sf_dir):
    return attach.text_blocks(fx.blocks(spark, sf_dir), _outline(spark, sf_dir), SKIPPED)


def serialize_text(spark, sf_dir):
    return _text_blocks(spark, sf_dir).select("block_id", "page", "order_id", "title", _joined("toc"), "text")


def serialize_tables(spark, sf_dir):
    return attach.table_blocks(fx.blocks(spark, sf_dir), _outline(spark, sf_dir), SKIPPED).select("block_id", "page", "order_id", "title", _joined("toc"), "image_crop")


def section_headings(spark, sf_dir):
    return sections.mark_headings(_text_blocks(spark, sf_dir)).select("block_id", "is_heading", "text")


def section_table(spark, sf_dir):
    return sections.sections(_text_blocks(spark, sf_dir))


def section_rows(spark, sf_dir):
    return flat_sections(section_table(spark, sf_dir))


def flat_sections(rows):
    return rows.select("section_id", _joined("toc"), _joined("headings"), "text", _numbers("pages"), _joined("block_ids"))


# text


def _over(column, source):
    def query(spark, sf_dir):
        return source(spark, sf_dir).select("doc_id", column(F.col("text")).alias("text"))

    return query


def normalize_title(spark, sf_dir):
    rows = fx.blocks(spark, sf_dir).select("block_id", tx.normalize_title(F.concat_ws(" ", F.lit("CHAPTER 1: "), "title", F.lit("  (Sub_chapter)"))).alias("key"))
    return rows


def b64_payload(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.base64_of(F.col("text").cast("binary")).alias("payload"))


# tables


def prompt_context(spark, sf_dir):
    rows = attach.table_blocks(fx.blocks(spark, sf_dir), _outline(spark, sf_dir))
    path, title = tables.context(F.col("toc"), F.col("title"))
    return rows.select("block_id", path.alias("path"), title.alias("title"))


def table_prompt(spark, sf_dir):
    rows = attach.table_blocks(fx.blocks(spark, sf_dir), _outline(spark, sf_dir))
    return rows.select("block_id", tables.prompt(F.col("toc"), F.col("title")).alias("prompt"))


def table_parse(spark, sf_dir):
    rows = tables.parse_answers(fx.model_answers(spark, sf_dir))
    return rows.select("block_id", "description", _joined("columns"), F.size("rows").alias("n_rows"), "status")


class StubClient:
    """Answers without a model: what the prompt says about the place, for some prompts after a broken answer."""

    def __init__(self):
        self.asked = 0

    def ask(self, system, prompt, image, max_tokens):
        self.asked += 1
        if max_tokens == tables.TOKEN_SCHEDULE[0] and len(prompt) % 3 == 0:
            return "not yet"
        said = dict(line.split(": ", 1) for line in prompt.split("\n")[:2])
        return json.dumps({"columns": list(said), "rows": [said], "description": "stub"})


def table_extract(spark, sf_dir):
    rows = tables.extract_tables(attach.table_blocks(fx.blocks(spark, sf_dir), _outline(spark, sf_dir)), StubClient, wait=_no_wait)
    return rows.select("table_id", "page", "title", "description", _joined("columns"), F.size("rows").alias("n_rows"), _cells("rows"), "status")


def _cells(rows):
    one = F.element_at(rows, 1)
    return F.array_join(F.transform(F.array(F.lit("Path"), F.lit("Title")), lambda k: F.concat(k, F.lit("="), F.element_at(one, k))), ", ").alias("cells")


def _no_wait(_seconds):
    return None


def table_cells(spark, sf_dir):
    parsed = tables.parse_answers(fx.model_answers(spark, sf_dir)).withColumnRenamed("block_id", "table_id")
    return tables.table_cells(parsed).select("table_id", "row", "column", "value")


# records


def resume_anti(spark, sf_dir):
    work = fx.blocks(spark, sf_dir).select("block_id", "page", "order_id")
    done = work.where("page % 2 = 0").withColumn("made", F.lit("before"))
    return records.resume(work, done, ["block_id"], lambda rest: rest.withColumn("made", F.lit("now")))


def blocks_roundtrip(spark, sf_dir):
    path = f"{own_folder(spark)}/blocks-{time.time_ns()}"
    records.write_blocks(fx.blocks(spark, sf_dir), path)
    return records.read_blocks(spark, path)


# overlays


def overlay_order(spark, sf_dir):
    s = fx.spans(spark, sf_dir)
    order = ordering.reading_order(s).where("seq % 3 <> 1")
    return overlay.order_overlay(s, order).select("doc_id", "region_idx", "label", "label_x", "label_y")


def overlay_layout(spark, sf_dir):
    rows = overlay.layout_overlay(_layout(spark, sf_dir))
    corner = lambda p: F.concat_ws(",", p["x"].cast("string"), p["y"].cast("string"))
    return rows.select("doc_id", "layout_idx", F.array_join(F.transform("polygon", corner), ";").alias("polygon"), "palette_index", "label_text", "label_x", "label_y")


_FUNCTIONS = (
    page_manifest, ocr_unnest, ocr_scale, layout_filter, page_extent, norm_boxes, column_assign, reading_order, model_inputs, assign_collisions, assign_order, overlap_pairs, first_layout_match, first_table_match, toc_content_semi, crop_boxes,
    font_neighbors, classify_regions, title_carry, assemble_blocks, toc_levels, toc_entries, toc_tree, toc_paths, toc_propagate, toc_pipeline, toc_json, skip_pages, toc_match, toc_carry, serialize_text, serialize_tables, section_headings,
    normalize_title, b64_payload, prompt_context, table_prompt, table_parse, table_extract, table_cells, resume_anti, blocks_roundtrip, overlay_order, overlay_layout,
)
QUERIES = {f.__name__: f for f in _FUNCTIONS}
QUERIES["sections"] = section_rows
QUERIES |= {
    "norm_control": _over(tx.remove_control, fx.noisy_text),
    "norm_unicode": _over(tx.normalize_unicode, fx.noisy_text),
    "norm_bullets": _over(tx.normalize_bullets, fx.noisy_text),
    "norm_hyphen": _over(tx.join_hyphens, fx.noisy_text),
    "norm_space": _over(tx.normalize_space, fx.noisy_text),
    "normalize_text": _over(tx.normalize_text, fx.noisy_text),
}


def flagship(spark, sf_dir):
    """Spans and regions to blocks, blocks to sections, for all documents at once."""
    made = assembly.assemble(fx.spans(spark, sf_dir), _layout(spark, sf_dir))
    return sections.sections(attach.text_blocks(made))
