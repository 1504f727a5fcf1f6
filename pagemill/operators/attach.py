"""Attaching blocks to the outline, and merging untitled text into the titled text before it.

Titles are matched on slim rows of keys and titles. What they find are events, which are carried over
the blocks of a document together with the number of titled blocks (:func:`pagemill.operators.runs.scan`);
so text moves by run of pages, and once more to its group.

Blocks without page or order are kept and stand before all others of their document. A block that
comes twice is two blocks here: sources keep the latest row of each key (``records.latest``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions.text import has_text, normalize_text, normalize_title
from pagemill.operators.runs import scan

#: Order of the blocks of a document. The id only parts blocks of the same place, or of none.
ORDER = ("page", "order_id", "block_id")


def _no_path():
    return F.array().cast("array<string>")


def skip_pages(blocks: DataFrame, pages: list[int] | tuple[int, ...]) -> DataFrame:
    """Without the blocks of some pages, which then don't move the outline either."""
    return blocks.where(~F.col("page").isin(*pages) | F.col("page").isNull()) if pages else blocks


def match_outline(blocks: DataFrame, outline: DataFrame) -> DataFrame:
    """Blocks with ``matched_seq`` and ``matched_path`` of the first entry of their title.

    An entry that starts after the block's page doesn't count. The entries of one title are put together
    first, so that each block meets one row; blocks without a title have keys of their own, so that
    they don't meet in one task.
    """
    entry = outline.select("doc_id", normalize_title(F.col("title")).alias("_key"), F.struct("toc_seq", "page_start", "path").alias("_e")).where("_key is not null")
    by_key = entry.groupBy("doc_id", "_key").agg(F.array_sort(F.collect_list("_e")).alias("_entries"))
    # no key of a title holds a line feed
    own = F.concat(F.lit("\n"), F.coalesce(F.col("block_id"), F.lit("")))
    keyed = blocks.withColumn("_key", F.when(has_text(F.col("title")), normalize_title(F.col("title"))).otherwise(own))
    fits = lambda e: e["page_start"].isNull() | F.col("page").isNull() | (F.col("page") >= e["page_start"])
    found = keyed.join(by_key, ["doc_id", "_key"], "left").withColumn("_m", F.try_element_at(F.filter("_entries", fits), F.lit(1)))
    return found.select(*blocks.columns, F.col("_m.toc_seq").alias("matched_seq"), F.col("_m.path").alias("matched_path"))


def carry_paths(matched: DataFrame) -> DataFrame:
    """With ``toc``: the path matched last, tables included; empty before the first match."""
    rows = scan(matched, carries={"toc": F.col("matched_path")}, order=ORDER)
    return rows.withColumn("toc", F.coalesce("toc", _no_path()))


def _attached(blocks: DataFrame, kept: DataFrame, outline: DataFrame | None, sums: dict | None = None) -> DataFrame:
    """Rows of ``kept``, some of ``blocks``, with ``toc`` and running sums. Titles of all blocks count."""
    if outline is None:
        rows = scan(kept, sums=sums, order=ORDER) if sums else kept
        return rows.withColumn("toc", _no_path())
    titled = blocks.where(has_text(F.col("title"))).select("doc_id", *ORDER, "title")
    events = match_outline(titled, outline).where("matched_seq is not null").select("doc_id", *ORDER, F.col("matched_path").alias("toc"))
    rows = scan(kept, carries={"toc": F.lit(None).cast("array<string>")}, sums=sums, events=events, order=ORDER)
    return rows.withColumn("toc", F.coalesce("toc", _no_path()))


def text_blocks(blocks: DataFrame, outline: DataFrame | None = None, pages_to_skip: list[int] | tuple[int, ...] = ()) -> DataFrame:
    """Text blocks, cleaned. An untitled one joins the titled one before it, across tables and pages, which
    keeps its own id, page and path; untitled ones before any titled one stand alone.

    The input is read for its titles and, without text, for its runs, besides the pass over the texts:
    give a table that was written. All text below one title is one row by definition, however much it is.
    """
    kept = skip_pages(blocks, pages_to_skip)
    # cleaned where the blocks lie, before any of them moves
    texts = kept.where("type = 'text'").select("doc_id", *ORDER, "title", normalize_text(F.col("text")).alias("text"))
    rows = _attached(kept, texts, outline, {"_g": F.when(has_text(F.col("title")), 1).otherwise(0)})
    at = F.struct(*ORDER)
    merged = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*ORDER, "text"))), lambda x: x["text"]), "\n\n")
    groups = rows.groupBy("doc_id", "_g", F.when(F.col("_g") == 0, at).alias("_own"))
    names = ("block_id", "page", "order_id", "title", "toc")
    return groups.agg(F.min_by(F.struct(*names), at).alias("_first"), merged.alias("text")).select("doc_id", *(f"_first.{c}" for c in names), "text")


def table_blocks(blocks: DataFrame, outline: DataFrame | None = None, pages_to_skip: list[int] | tuple[int, ...] = ()) -> DataFrame:
    """Table blocks with their paths."""
    kept = skip_pages(blocks, pages_to_skip)
    tables = kept.where("type = 'table'").select("doc_id", *ORDER, "title", "image_crop")
    return _attached(kept, tables, outline).select("doc_id", "block_id", "page", "order_id", "title", "toc", "image_crop")
