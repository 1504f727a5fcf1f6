"""Sections: runs of text blocks under one outline path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions.text import has_text, is_blank, normalize_title, strip
from pagemill.operators.attach import ORDER
from pagemill.operators.runs import number_stretches
from pagemill.session import materialize

# Marks around a heading inside the text of a section.
HEADING_PREFIX, HEADING_SUFFIX = "<<<HEADING:", ">>>"

def mark_headings(text_blocks: DataFrame) -> DataFrame:
    """Non-blank blocks with ``is_heading`` and the text below its marked heading.

    A block has a heading where its title isn't the last entry of its path by the key of titles.
    """
    leaf = F.try_element_at("toc", F.lit(-1))
    differs = normalize_title(F.col("title")) != normalize_title(leaf)
    rows = text_blocks.withColumn("text", strip(F.col("text"))).where(~is_blank(F.col("text")))
    rows = rows.withColumn("is_heading", has_text(F.col("title")) & has_text(leaf) & F.coalesce(differs, F.lit(False)))
    decorated = F.concat(F.lit(HEADING_PREFIX + " "), "title", F.lit(f" {HEADING_SUFFIX}\n\n"), "text")
    return rows.withColumn("text", F.when(F.col("is_heading"), decorated).otherwise(F.col("text")))


def sections(text_blocks: DataFrame) -> DataFrame:
    """One row per section. A path that comes again opens a new section.

    The blocks are written once, marked, since they are numbered by their paths before their texts move.
    """
    marked = materialize(mark_headings(text_blocks), "marked-blocks")
    rows = number_stretches(marked, "toc", "_s", order=ORDER)
    part = F.struct(*ORDER, "text", F.when(F.col("is_heading"), F.col("title")).alias("head"))
    found = rows.groupBy("doc_id", "_s").agg(F.min_by("toc", F.struct(*ORDER)).alias("toc"), F.array_sort(F.collect_list(part)).alias("_p"))
    found = found.withColumn("_h", F.filter(F.transform("_p", lambda x: x["head"]), lambda x: x.isNotNull()))
    return found.select(
        "doc_id",
        F.format_string("sec_%06d", "_s").alias("section_id"),
        "toc",
        # a heading that comes twice in a row counts once
        F.filter("_h", lambda x, i: (i == 0) | (x != F.try_element_at(F.col("_h"), i))).alias("headings"),
        F.array_join(F.transform("_p", lambda x: x["text"]), "\n\n").alias("text"),
        F.array_distinct(F.transform("_p", lambda x: x["page"])).alias("pages"),
        F.transform("_p", lambda x: x["block_id"]).alias("block_ids"),
    )
