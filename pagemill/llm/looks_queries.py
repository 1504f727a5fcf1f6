"""Queries of problem 2."""

from __future__ import annotations

import unicodedata

from pyspark.sql import functions as F

from pagemill.llm.looks import LOOKALIKES, UNDRAWN, look_classes, look_pairs, same_look
from pagemill.session import table


def p2_found(spark, sf_dir):
    return look_pairs(table(spark, sf_dir, "blocks"))


def p2_classes(spark, sf_dir):
    """Members of every class of equal look that has more than one writing, with their number of links."""
    return look_classes(table(spark, sf_dir, "blocks"))


def p2_links(spark, sf_dir):
    """The number of links of every member of a class, by its book, block and field."""
    return look_classes(table(spark, sf_dir, "blocks")).select("book_id", "block_id", "field", "n_members", "n_links")


def p2_blocks(spark, sf_dir):
    """Every block with text and title in their one form."""
    blocks = table(spark, sf_dir, "blocks").select("book_id", "block_id", "text", "title").dropDuplicates(["book_id", "block_id"])
    return blocks.select("book_id", "block_id", same_look(F.col("text")).alias("text"), same_look(F.col("title")).alias("title"))


QUERIES = {f.__name__: f for f in (p2_found, p2_classes, p2_links, p2_blocks)}


def _apart(ch: str) -> str:
    """What a character is made of, by the rule of TESTDATA: width, make-up, script, and nothing for what isn't drawn."""
    kind, way = unicodedata.category(ch), unicodedata.decomposition(ch)
    if kind == "Zs":
        return " "
    if ch in "\r\u0085\u2028\u2029":
        return "\n"
    if kind in ("Cf", "Cc") or ch in UNDRAWN or "\U000e0100" <= ch <= "\U000e01ef":
        return ""
    pairs = ("\ufb00", "\ufb06"), ("\u0132", "\u0133"), ("\u01c7", "\u01cc"), ("\u01f1", "\u01f3")
    if way.startswith(("<wide>", "<narrow>")) or any(a <= ch <= b for a, b in pairs):
        ch = unicodedata.normalize("NFKC", ch)
    return "".join(LOOKALIKES.get(c, c) for c in unicodedata.normalize("NFD", ch))


def form_sql(c: str) -> str:
    """The form of equal looks in DuckDB: every character replaced by what it is made of, then composed."""
    ranges = (0x01, 0x20), (0x7F, 0x3400), (0xA4D0, 0xAC00), (0xF900, 0x10000), (0xE0000, 0xE0200)
    chars = [chr(i) for a, b in ranges for i in range(a, b) if chr(i) not in "\t\n" and not 0xD800 <= i < 0xF900]
    changed = {ch: new for ch in chars if unicodedata.normalize("NFC", new := _apart(ch)) != ch}
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    table = f"map([{', '.join(map(quoted, changed))}], [{', '.join(map(quoted, changed.values()))}])"
    pieces = f"regexp_extract_all(replace({c}, chr(13) || chr(10), chr(10)), '(?s)[^\\t\\n\\x20-\\x7e]|[\\t\\n\\x20-\\x7e]+')"
    return f"CASE WHEN regexp_matches({c}, '[^\\t\\n\\x20-\\x7e]') THEN nfc_normalize(array_to_string(list_transform({pieces}, lambda x: coalesce({table}[x], x)), '')) ELSE {c} END"


_FORMS = f"""WITH v AS (SELECT DISTINCT book_id, block_id, 'text' AS field, text AS raw FROM blocks UNION SELECT DISTINCT book_id, block_id, 'title', title FROM blocks),
f AS (SELECT *, {form_sql('raw')} AS form FROM v WHERE raw IS NOT NULL), x AS (SELECT * FROM f WHERE regexp_matches(form, '\\S'))"""
ORACLES = {
    "p2_links": f"""{_FORMS}, c AS (SELECT book_id, field, form, count(*) AS n_members FROM x GROUP BY ALL HAVING count(DISTINCT raw) > 1), r AS (SELECT book_id, field, form, raw, count(*) AS n FROM x GROUP BY ALL)
SELECT x.book_id, x.block_id, x.field, c.n_members, c.n_members - r.n AS n_links FROM x JOIN c USING (book_id, field, form) JOIN r USING (book_id, field, form, raw)""",
    "p2_found": f"""{_FORMS}
SELECT DISTINCT a.book_id, a.block_id AS block_id_a, b.block_id AS block_id_b, a.field FROM x a JOIN x b ON a.book_id = b.book_id AND a.field = b.field AND a.form = b.form AND a.block_id < b.block_id AND a.raw <> b.raw""",
}
