"""Queries of problem 1."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pagemill.llm.split import split_oversized
from pagemill.session import table


def p1_found(spark, sf_dir):
    pieces = split_oversized(table(spark, sf_dir, "sections").select("book_id", "section_id", "headings", "text"))
    return pieces.where("n_pieces > 1").select("book_id", "section_id").distinct()


def p1_pieces(spark, sf_dir):
    sections = table(spark, sf_dir, "sections").select("book_id", "section_id", "headings", "text").dropDuplicates(["book_id", "section_id"])
    return split_oversized(sections).select("book_id", "section_id", "piece_no", "n_pieces", "piece_start", "piece_end", "boundary", "piece_text")


def p1_coverage(spark, sf_dir):
    """Characters of each section that its pieces hold once, to be equal to its length."""
    pieces = p1_pieces(spark, sf_dir).where("piece_text is not null")
    return pieces.groupBy("book_id", "section_id").agg((F.sum(F.char_length("piece_text")) - 200 * (F.max("n_pieces") - 1)).cast("bigint").alias("n_chars"))


def p1_checks(spark, sf_dir):
    """Whether the pieces of each section fit, overlap by 200 and are what stands at their places, up to its end."""
    sections = table(spark, sf_dir, "sections").where("text is not null").select("book_id", "section_id", "headings", "text").dropDuplicates(["book_id", "section_id"])
    pieces = split_oversized(sections)
    along = Window.partitionBy("book_id", "section_id").orderBy("piece_no")
    before = F.lag("piece_end").over(along)
    pieces = pieces.withColumn("fits", F.char_length("piece_text") <= 2000).withColumn("overlaps", F.when(before.isNull(), F.col("piece_start") == 0).otherwise(F.col("piece_start") == before - 200))
    pieces = pieces.withColumn("equal", F.expr("substring(text, piece_start + 1, piece_end - piece_start) = piece_text"))
    return pieces.groupBy("book_id", "section_id").agg(F.bool_and("fits").alias("fits"), F.bool_and("overlaps").alias("overlaps"), F.bool_and("equal").alias("equal"), (F.max("piece_end") == F.max(F.char_length("text"))).alias("whole"))


QUERIES = {f.__name__: f for f in (p1_found, p1_pieces, p1_coverage, p1_checks)}
ORACLES = {
    "p1_checks": "SELECT DISTINCT book_id, section_id, true AS fits, true AS overlaps, true AS equal, true AS whole FROM sections WHERE text IS NOT NULL",
    "p1_found": "SELECT DISTINCT book_id, section_id FROM sections WHERE length(text) > 2000",
    "p1_coverage": "SELECT DISTINCT book_id, section_id, length(text)::BIGINT AS n_chars FROM sections WHERE text IS NOT NULL",
}
