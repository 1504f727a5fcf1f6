"""Queries of problem 8."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.llm.personal import find_personal
from pagemill.session import spread, table


def _found(spark, sf_dir):
    return find_personal(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), table(spark, sf_dir, "known_names"))


def p8_found(spark, sf_dir):
    one = _found(spark, sf_dir).select("doc_id", F.explode("mentions").alias("m"))
    return one.select("doc_id", F.col("m.line_no").cast("bigint").alias("line_no"), F.col("m.kind").alias("kind")).distinct()


def p8_redacted(spark, sf_dir):
    return _found(spark, sf_dir).select("doc_id", F.col("redacted").alias("text"))


def p8_checks(spark, sf_dir):
    """Whether all outside the mentions of a text is unchanged, and each mention is one placeholder of its kind."""
    rows = _found(spark, sf_dir)
    made = F.expr("aggregate(mentions, struct('' as t, 0 as e), (a, m) -> struct(concat(a.t, substring(text, a.e + 1, m.start - a.e), '[', upper(m.kind), ']') as t, m.end as e), a -> concat(a.t, substring(text, a.e + 1)))")
    return rows.select("doc_id", made.eqNullSafe(F.col("redacted")).alias("kept")).distinct()


QUERIES = {f.__name__: f for f in (p8_found, p8_redacted, p8_checks)}
ORACLES = {"p8_checks": "SELECT DISTINCT doc_id, true AS kept FROM documents"}
