"""Queries of problem 7."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.llm.leaks import runs
from pagemill.llm.looks_queries import form_sql
from pagemill.session import spread, table


def _runs(spark, sf_dir):
    return runs(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), table(spark, sf_dir, "eval_items"))


def p7_found(spark, sf_dir):
    return _runs(spark, sf_dir).where("literal_words >= 12").select("doc_id", "item_id").distinct()


def p7_reparameterised(spark, sf_dir):
    """All runs, of 12 words or more, whose slots were filled anew and consistently."""
    return _runs(spark, sf_dir).where("changed > 0 and consistent").select("doc_id", "item_id", "n_words", "slots", "changed").distinct()


def p7_leaked(spark, sf_dir):
    """Each leaked item with the number of documents that hold it."""
    found = _runs(spark, sf_dir).where("literal_words >= 12")
    return found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("documents"))


def p7_longest(spark, sf_dir):
    """The longest quotation of each item in each document that holds it."""
    found = _runs(spark, sf_dir).where("literal_words >= 12")
    return found.groupBy("doc_id", "item_id").agg(F.max("literal_words").alias("longest"))


QUERIES = {f.__name__: f for f in (p7_found, p7_reparameterised, p7_leaked, p7_longest)}


def _words(c: str) -> str:
    """Words of a text in DuckDB: broken ones joined, one form, lower case, no punctuation."""
    letter, end = r"[\pL]", r"[^\S\n]*\n\s*"
    join = lambda x: f"regexp_replace({x}, '({letter})[-‐‑­¬]{end}({letter})', '\\1\\2', 'g')"
    plain = join(join(form_sql(join(join(c)))))
    return f"list_filter(regexp_split_to_array(regexp_replace(lower({plain}), '[^\\pL\\pN\\s]', '', 'g'), '\\s+'), lambda w: w <> '')"


ORACLES = {
    "p7_longest": f"""WITH d AS (SELECT DISTINCT doc_id, {_words('text')} AS w FROM documents WHERE text IS NOT NULL), i AS (SELECT DISTINCT item_id, {_words('text')} AS w FROM eval_items WHERE text IS NOT NULL),
dw AS (SELECT doc_id, k, array_to_string(w[k:k + 11], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS k FROM d)),
iw AS (SELECT item_id, k, array_to_string(w[k:k + 11], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS k FROM i)),
hits AS (SELECT doc_id, item_id, dw.k AS k, dw.k - iw.k AS shift FROM dw JOIN iw USING (s)),
runs AS (SELECT doc_id, item_id, shift, k - row_number() OVER (PARTITION BY doc_id, item_id, shift ORDER BY k) AS island FROM hits)
SELECT doc_id, item_id, (max(n) + 11)::INT AS longest FROM (SELECT doc_id, item_id, count(*) AS n FROM runs GROUP BY doc_id, item_id, shift, island) GROUP BY ALL""",
    "p7_found": f"""WITH d AS (SELECT DISTINCT doc_id, {_words('text')} AS w FROM documents WHERE text IS NOT NULL), i AS (SELECT DISTINCT item_id, {_words('text')} AS w FROM eval_items WHERE text IS NOT NULL),
dw AS (SELECT doc_id, array_to_string(w[k:k + 11], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS k FROM d)),
iw AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 11], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS k FROM i))
SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (s)""",
}
ORACLES["p7_leaked"] = f"SELECT item_id, count(DISTINCT doc_id) AS documents FROM ({ORACLES['p7_found']}) GROUP BY item_id"
