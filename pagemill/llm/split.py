"""Splitting oversized items at natural boundaries (problem 1).

A text longer than ``limit`` code points is cut into consecutive pieces of at most ``limit`` code
points. Each piece after the first begins exactly ``overlap`` code points before the end of the piece
before it, so the first piece followed by the others without their first ``overlap`` code points is
the text again.

The separators form a hierarchy: heading, blank line, line, sentence, word, character. Pieces are
packed greedily: as long as the rest fits, it is the last piece; otherwise the piece runs to the last
boundary of the strongest kind that lies in its window, and weaker kinds are tried only where the
window holds no stronger one.

Defined results: null texts give one piece with null text and null bounds, empty texts one piece of
length 0; texts that fit give one piece equal to the text; equal rows give equal pieces, once for
each row; other columns are carried unchanged, one with the name of an added column as ``<name>_input``.
Length and positions count code points.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.naming import make_room

#: Names of the boundary kinds, strongest first; ``end`` closes the text.
KINDS = ("heading", "paragraph", "line", "sentence", "word", "character")
HEADING = "<<<HEADING:"

_BLANK = regex.compile(r"\n[^\S\n]*\n\s*")
_LINE = regex.compile(r"\n")
_SENTENCE = regex.compile(r"[.!?…][\"'”’»)\]]*\s+(?=[\"'“‘«(\[]*[\p{Lu}\p{Nd}\p{Lo}])|[。！？]")
_WORD = regex.compile(r"\s+")
_EXTEND = regex.compile("[\\p{M}\u200d\ufe0e\ufe0f]")

ADDED = ("piece_no", "n_pieces", "piece_start", "piece_end", "boundary", "piece_text")
PIECES = "array<struct<piece_no:int,piece_start:int,piece_end:int,boundary:string,piece_text:string>>"


def boundaries(text: str, headings: list[str] | None = None) -> list[list[int]]:
    """Positions where a piece may end, ascending, for each kind but ``character``.

    Headings are marked in the text as ``<<<HEADING: title >>>``; the titles in ``headings`` say which
    marks are meant, and without that list every mark counts.
    """
    marks = []
    at = text.find(HEADING)
    if at >= 0:
        known = None if headings is None else {h for h in headings if h}
        while at >= 0:
            if known is None or not known or any(text.startswith(h, at + len(HEADING) + 1) for h in known):
                marks.append(at)
            at = text.find(HEADING, at + 1)
    return [marks, [m.end() for m in _BLANK.finditer(text)], [m.end() for m in _LINE.finditer(text)], [m.end() for m in _SENTENCE.finditer(text)], [m.end() for m in _WORD.finditer(text)]]


def cut(text: str, limit: int, overlap: int, headings: list[str] | None = None) -> list[tuple[int, int, str]]:
    """(start, end, kind of boundary at the end) of every piece."""
    n = len(text)
    if n <= limit:
        return [(0, n, "end")]
    kinds = boundaries(text, headings)
    out, start = [], 0
    while n - start > limit:
        low, high = start + (overlap if out else 0), start + limit
        for kind, places in zip(KINDS, kinds, strict=False):
            i = bisect_right(places, high)
            # an end must leave room for progress: the next piece begins ``overlap`` before it
            if i and places[i - 1] > max(low, start + overlap):
                end, name = places[i - 1], kind
                break
        else:
            end, name = high, "character"
            while end - 1 > max(low, start + overlap) and _EXTEND.match(text, end):
                end -= 1
        out.append((start, end, name))
        start = end - overlap
    out.append((start, n, "end"))
    return out


def split_oversized(df: DataFrame, text: str = "text", headings: str | None = "headings", limit: int = 2000, overlap: int = 200) -> DataFrame:
    """One row per piece: the columns of ``df`` and those in ``ADDED``.

    Only oversized texts go to Python; the others become their only piece inside the JVM.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and less than limit")
    df, renamed = make_room(df, (*ADDED, "_pieces", "_p"))
    text, headings = renamed[text], renamed[headings] if headings else None

    @F.pandas_udf(PIECES)
    def pieces(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, heads in parts:
            yield pd.Series([None if t is None else [(i, a, b, k, t[a:b]) for i, (a, b, k) in enumerate(cut(t, limit, overlap, None if h is None else list(h)))] for t, h in zip(texts, heads, strict=True)])

    # not deterministic: never evaluated a second time below a filter on the number of pieces
    pieces = pieces.asNondeterministic()
    over = F.char_length(F.col(text)) > limit
    heads = F.col(headings).cast("array<string>") if headings else F.lit(None).cast("array<string>")
    whole = F.array(F.struct(F.lit(0).alias("piece_no"), F.when(F.col(text).isNotNull(), F.lit(0)).alias("piece_start"), F.char_length(text).alias("piece_end"), F.lit("end").alias("boundary"), F.col(text).alias("piece_text")))
    cutted = df.withColumn("_pieces", F.coalesce(pieces(F.when(over, F.col(text)), F.when(over, heads)), whole))
    flat = cutted.withColumn("n_pieces", F.size("_pieces")).select(*df.columns, "n_pieces", F.explode_outer("_pieces").alias("_p"))
    return flat.select(*df.columns, F.col("_p.piece_no").alias("piece_no"), "n_pieces", F.col("_p.piece_start").alias("piece_start"), F.col("_p.piece_end").alias("piece_end"), F.col("_p.boundary").alias("boundary"), F.col("_p.piece_text").alias("piece_text"))
