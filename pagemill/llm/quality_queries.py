"""Queries of problem 5."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.llm import quality
from pagemill.session import materialize, spread, table


def items(spark, sf_dir):
    """Non-blank texts of text blocks and sections as (book_id, item_id, text)."""
    blocks = table(spark, sf_dir, "blocks").where("type = 'text'").select("book_id", F.col("block_id").alias("item_id"), "text")
    sections = table(spark, sf_dir, "sections").select("book_id", F.col("section_id").alias("item_id"), "text")
    return blocks.unionByName(sections).where(r"text rlike '\\S'")


def labels(spark, sf_dir):
    """The labelled items, and with each the other items of its section, since all texts of one section are of one kind."""
    given = table(spark, sf_dir, "kind_labels").select("book_id", "item_id", "kind")
    part_of = table(spark, sf_dir, "sections").select("book_id", "section_id", F.explode("block_ids").alias("block_id")).where("section_id is not null and block_id is not null")
    up = given.join(part_of.withColumnRenamed("block_id", "item_id"), ["book_id", "item_id"]).select("book_id", F.col("section_id").alias("item_id"), "kind")
    sections = given.unionByName(up).distinct()
    down = sections.join(part_of.withColumnRenamed("section_id", "item_id"), ["book_id", "item_id"]).select("book_id", F.col("block_id").alias("item_id"), "kind")
    return sections.unionByName(down).distinct()


def _kinds(spark, sf_dir, rules=None):
    every = items(spark, sf_dir)
    rules = rules if rules is not None else quality.learn(every, labels(spark, sf_dir), ["book_id", "item_id"])
    return quality.statistics(spread(every)).withColumn("kind", quality.kind_of(rules))


def voted(spark, sf_dir, rules=None):
    """(book_id, item, kind): texts of one section are of one kind, so the kinds of its texts vote."""
    own = materialize(_kinds(spark, sf_dir, rules).select("book_id", F.col("item_id").alias("item"), "kind"), "kinds")
    parts = table(spark, sf_dir, "sections").select("book_id", "section_id", F.explode("block_ids").alias("block_id"))
    return quality.agree(own, parts, "book_id", "section_id", "block_id")


def p5_found(spark, sf_dir):
    """Items that aren't prose by the vote of their section."""
    return voted(spark, sf_dir).where("kind <> 'prose'").select("book_id", F.col("item").alias("item_id"), "kind").distinct()


def p5_statistics(spark, sf_dir):
    columns = ["book_id", "item_id", *quality.STATISTICS[:5], "kind"]
    return _kinds(spark, sf_dir).select(*columns).distinct()


def p5_measures(spark, sf_dir):
    """The five statistics of every text, without its kind."""
    rows = quality.statistics(spread(items(spark, sf_dir)))
    return rows.select("book_id", "item_id", *quality.STATISTICS[:5]).distinct()


QUERIES = {f.__name__: f for f in (p5_found, p5_statistics, p5_measures)}

# white space, horizontal white space, letters without digits, what words are made of
_W = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_H = _W.replace(r"\x09-\x0d", r"\x09\x0b-\x0d")
_L, _A = r"[\pL\p{Nl}\p{No}]", r"[\pL\pN\pM]"
_SPACED_HEAD = rf"(?m)^[{_H}]*(?:\p{{Nd}}{{1,4}}[{_H}]+)?(?:{_L}[{_H}]+){{5,}}{_L}(?:[{_H}]*\|?[{_H}]*\p{{Nd}}{{1,4}})?[{_H}]*$\n?"
# Frequent function words.
_COMMON = "a after an and any are as at be before but by can each every for from has have if in into is it its may more must never not on only or than that the their then they this to too unless until when which who will with without you your"
_COMMON_LIST = "[" + ", ".join(f"'{w}'" for w in _COMMON.split()) + "]"

ORACLES = {
    "p5_measures": rf"""WITH t AS (SELECT book_id, block_id AS item_id, text FROM blocks WHERE type = 'text' UNION ALL SELECT book_id, section_id, text FROM sections),
b AS (SELECT book_id, item_id, regexp_replace(regexp_replace(text, '<<<HEADING:[^\n]*?>>>[{_W}]*', '', 'g'), '{_SPACED_HEAD}', '', 'g') AS t FROM t WHERE regexp_matches(text, '\S')),
n AS (SELECT book_id, item_id, len(list_filter(regexp_split_to_array(t, '[{_W}]+'), lambda w: regexp_matches(w, '[\pL\pN]')))::BIGINT AS words, length(regexp_replace(t, '[^\pL\pN\pM]', '', 'g')) AS alnum, length(regexp_replace(t, '[{_W}]', '', 'g')) AS ink,
  list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^{_W}]')) AS lines,
  len(list_filter(regexp_extract_all(t, '{_A}+'), lambda w: list_contains({_COMMON_LIST}, lower(w)))) AS common FROM b)
SELECT DISTINCT book_id, item_id, words AS word_count, CASE WHEN words > 0 THEN alnum::DOUBLE / words END AS mean_word_length, CASE WHEN ink > 0 THEN (ink - alnum)::DOUBLE / ink END AS symbol_ratio,
  CASE WHEN len(lines) > 0 THEN len(list_filter(lines, lambda l: regexp_matches(l, '[.!?…][{_W}"''”’»)]*\z')))::DOUBLE / len(lines) END AS punctuated_lines, CASE WHEN words > 0 THEN common::DOUBLE / words WHEN ink > 0 THEN 0 END AS common_words FROM n""",
}
