"""Text functions as column expressions.

White space and word characters follow Unicode as Python's do, spelled out as classes so that Java's
and DuckDB's patterns agree. Null stays null and an empty string stays empty in every function.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WS = r"[\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WC = r"[\p{L}\p{N}_]"
# Quotes and dashes, and what they become; bullets become a hyphen.
QUOTES_FROM, QUOTES_TO = "“”‘’–—", "\"\"''--"
BULLETS = "•◦∙·‣▪▫–—"


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(c, rf"\A{WS}+|{WS}+\z", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"{WS}+\z", "")


def is_blank(c: Column) -> Column:
    return F.length(strip(c)) == 0


def remove_control(c: Column) -> Column:
    return F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")


@F.pandas_udf(T.StringType())
def _nfkc(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in parts:
        yield pd.Series([t if t is None or t.isascii() else unicodedata.normalize("NFKC", t) for t in texts], dtype=object)


def nfkc(c: Column) -> Column:
    """Compatibility composition. Only text beyond ASCII goes to Python."""
    return F.coalesce(_nfkc(F.when(c.rlike(r"[^\x00-\x7f]"), c)), c)


def normalize_unicode(c: Column) -> Column:
    return F.translate(nfkc(c), QUOTES_FROM, QUOTES_TO)


def normalize_bullets(c: Column) -> Column:
    return F.translate(c, BULLETS, "-" * len(BULLETS))


def join_hyphens(c: Column) -> Column:
    """Words cut by a hyphen and white space joined where a lower-case ASCII letter follows.

    One pass over look-around is the fixed point of joining pair by pair.
    """
    # the hyphen first, so that what stands before it is looked at only there
    return F.regexp_replace(c, rf"-(?<={WC}-){WS}+(?=[a-z])", "")


def normalize_space(c: Column) -> Column:
    """Runs of blanks to one, more than two line feeds to two, no white space at the ends."""
    return strip(F.regexp_replace(F.regexp_replace(c, r"[ \t]{2,}", " "), r"\n{3,}", "\n\n"))


def normalize_text(c: Column) -> Column:
    """All of the above in their order."""
    return normalize_space(join_hyphens(normalize_bullets(normalize_unicode(remove_control(c)))))


def normalize_title(c: Column) -> Column:
    """Key under which titles are equal: lower case, ``chapter`` as ``ch``, no punctuation, single blanks."""
    short = F.regexp_replace(F.lower(c), rf"(?<!{WC})chapter(?!{WC})", "ch")
    words = F.regexp_replace(short, r"[^\p{L}\p{N}_\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]", "")
    return strip(F.regexp_replace(words, rf"{WS}+", " "))


def has_text(c: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(c != "", F.lit(False))


def base64_of(content: Column) -> Column:
    """Base64 in one line."""
    return F.regexp_replace(F.base64(content), "[\r\n]", "")
