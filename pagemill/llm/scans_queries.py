"""Queries of problem 4."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.llm import quality
from pagemill.llm.quality_queries import items, labels, voted
from pagemill.llm.scans import build_lexicon, repair_texts
from pagemill.session import materialize, spread, table, task_count


def _blocks(spark, sf_dir):
    return table(spark, sf_dir, "blocks").where(r"type = 'text' and text rlike '\\S'").select("book_id", "block_id", "page", "text")


def _parts(spark, sf_dir):
    """Which block stands in which section, with the first entry of the section's path."""
    one = table(spark, sf_dir, "sections").select("book_id", "section_id", F.try_element_at("toc", F.lit(1)).alias("entry"), F.explode("block_ids").alias("block_id"))
    return one.distinct()


def _titles(spark, sf_dir):
    return table(spark, sf_dir, "books").where("title is not null").groupBy("book_id").agg(F.collect_set("title").alias("titles"))


def _tools(spark, sf_dir):
    rules = quality.learn(items(spark, sf_dir), labels(spark, sf_dir), ["book_id", "item_id"])
    return build_lexicon(spread(table(spark, sf_dir, "blocks").where("type = 'text'").select("text"))), rules


def _with_heads(spark, sf_dir, rows, key, entries, rules):
    """``rows`` with ``heads``, titles of the book and first entries of the path, and the voted ``kind``.

    Texts of one key that are in no section and differ in kind get none; they count by themselves.

    The heads are put together by keys alone, so that a book that holds a large share of all blocks
    moves no text into one task; texts move by their own key.
    """
    keys = rows.select("book_id", key).distinct()
    heads = keys.join(entries, ["book_id", key], "left").join(_titles(spark, sf_dir), "book_id", "left")
    none = F.array().cast("array<string>")
    heads = heads.select("book_id", key, F.array_union(F.coalesce("titles", none), F.coalesce("entries", none)).alias("heads"))
    kinds = voted(spark, sf_dir, rules).groupBy("book_id", F.col("item").alias(key)).agg(F.min("kind").alias("kind"), F.max("kind").alias("other"))
    heads = heads.join(kinds.select("book_id", key, F.expr("if(kind = other, kind, null)").alias("kind")), ["book_id", key], "left")
    return rows.repartition(task_count(spark), "book_id", key).join(heads, ["book_id", key], "left")


def _repaired_blocks(spark, sf_dir):
    entries = _parts(spark, sf_dir).groupBy("book_id", "block_id").agg(F.collect_set("entry").alias("entries"))
    lexicon, rules = _tools(spark, sf_dir)
    rows = _with_heads(spark, sf_dir, _blocks(spark, sf_dir), "block_id", entries, rules).withColumn("pages", F.array("page"))
    return repair_texts(rows, lexicon, rules, kinds="kind")


def p4_found(spark, sf_dir):
    """Noise of blocks; a section has every noise of its blocks."""
    # written once: the blocks' noises are read for themselves and for the sections
    blocks = materialize(_repaired_blocks(spark, sf_dir).where("size(noises) > 0").select("book_id", "block_id", F.explode("noises").alias("noise")).distinct(), "noises")
    sections = blocks.join(_parts(spark, sf_dir).select("book_id", "section_id", "block_id"), ["book_id", "block_id"])
    return blocks.select("book_id", F.col("block_id").alias("item_id"), "noise").unionByName(sections.select("book_id", F.col("section_id").alias("item_id"), "noise")).distinct()


def p4_blocks(spark, sf_dir):
    """Every text block as continuous paragraphs."""
    return _repaired_blocks(spark, sf_dir).select("book_id", "block_id", F.col("repaired").alias("text"))


def _repaired_sections(spark, sf_dir):
    sections = table(spark, sf_dir, "sections")
    entries = sections.groupBy("book_id", "section_id").agg(F.collect_set(F.try_element_at("toc", F.lit(1))).alias("entries"))
    lexicon, rules = _tools(spark, sf_dir)
    rows = _with_heads(spark, sf_dir, sections.select("book_id", "section_id", "text", "pages"), "section_id", entries, rules)
    return repair_texts(rows, lexicon, rules, kinds="kind")


def p4_sections(spark, sf_dir):
    """Every section as continuous paragraphs."""
    return _repaired_sections(spark, sf_dir).select("book_id", "section_id", F.col("repaired").alias("text"))


def p4_compared(spark, sf_dir):
    """For each noise the number of sections that have it by their blocks, by their own texts, and by both."""
    own = _repaired_sections(spark, sf_dir).select("book_id", F.col("section_id").alias("item_id"), F.explode("noises").alias("noise")).distinct().withColumn("own", F.lit(1))
    sections = table(spark, sf_dir, "sections").select("book_id", F.col("section_id").alias("item_id")).distinct()
    by_blocks = p4_found(spark, sf_dir).join(sections, ["book_id", "item_id"], "left_semi").withColumn("blocks", F.lit(1))
    both = by_blocks.join(own, ["book_id", "item_id", "noise"], "full")
    return both.groupBy("noise").agg(F.count("blocks").alias("by_blocks"), F.count("own").alias("by_text"), F.count(F.col("blocks") + F.col("own")).alias("by_both"))


QUERIES = {f.__name__: f for f in (p4_found, p4_blocks, p4_sections, p4_compared)}
ORACLES: dict[str, str] = {}
