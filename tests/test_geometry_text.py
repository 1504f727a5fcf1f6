"""Golden cases of the scalar functions, and text functions beside a plain Python model."""

import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.functions import geometry as g
from pagemill.functions import text as tx


def _one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("before", "after"),
    [("cit- ies", "cities"), ("Mid- Day", "Mid- Day"), ("ab- c- d", "abcd"), ("x - y", "x - y"), (None, None), ("", "")],
)
def test_hyphens(spark, before, after):
    assert _one(spark, before, tx.join_hyphens) == after


@pytest.mark.parametrize(
    ("before", "after"),
    [("“A”\u0007 – b…", '"A" - b...'), ("• item\n\n\n\nnext", "- item\n\nnext"), ("a\tb", "a\tb"), ("a\t\tb", "a b"), (None, None), ("", "")],
)
def test_normalize_text(spark, before, after):
    assert _one(spark, before, tx.normalize_text) == after


@pytest.mark.parametrize(("before", "after"), [("CHAPTER 1: The  Foo!", "ch 1 the foo"), ("Ch. 2 — Bar", "ch 2 bar"), ("ch.foo", "chfoo"), ("Sub_chapter", "sub_chapter"), ("***", ""), (None, None)])
def test_title_key(spark, before, after):
    assert _one(spark, before, tx.normalize_title) == after


def _model(text):
    if not text:
        return text
    text = "".join(c for c in text if c in "\t\n\r" or not (ord(c) < 32 or ord(c) == 127))
    text = unicodedata.normalize("NFKC", text)
    for a, b in zip("“”‘’–—", "\"\"''--", strict=True):
        text = text.replace(a, b)
    text = re.sub("[•◦∙·‣▪▫]", "-", text)
    while (new := re.sub(r"(\w)-\s+([a-z])", r"\1\2", text)) != text:
        text = new
    text = re.sub(r"[ \t]{2,}", " ", text)
    return re.sub(r"\n{3,}", "\n\n", text).strip()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="aZé1 -\t\n•“”ﬁ…–\u0007  ", max_size=40), min_size=1, max_size=60))
def test_normalize_text_beside_model(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", tx.normalize_text(F.col("t")).alias("y")).collect()
    assert {r.i: r.y for r in rows} == {i: _model(t) for i, t in enumerate(texts)}


def _covers(spark, a, b):
    row = spark.createDataFrame([(*a, *b)], "sx0 int, sy0 int, sx1 int, sy1 int, rx0 int, ry0 int, rx1 int, ry1 int")
    return row.select(g.covers(g.box("s"), g.box("r")).alias("y")).first().y


def test_overlap(spark):
    assert _covers(spark, (0, 0, 10, 10), (0, 0, 3, 10))
    assert not _covers(spark, (0, 0, 10, 10), (8, 0, 20, 10))
    assert not _covers(spark, (0, 0, 10, 10), (10, 0, 20, 10))
    assert not _covers(spark, (0, 0, 100, 10), (0, 0, 10, 10))
    assert _covers(spark, (0, 0, 10, 10), (0, 0, 100, 10))


def test_crop(spark):
    row = spark.createDataFrame([(5, 5, 100, 100)], "x0 int, y0 int, x1 int, y1 int")
    cut = g.padded(g.box(), F.lit(104), F.lit(200))
    assert tuple(row.select(*cut).first()) == (0, 0, 104, 108)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(-50, 3000), st.integers(0, 900), st.integers(1, 4000)), min_size=1, max_size=80), st.integers(1, 7))
def test_column_index_is_float_floor(spark, boxes, n):
    rows = [(i, x, x + w, width) for i, (x, w, width) in enumerate(boxes)]
    got = spark.createDataFrame(rows, "i int, x0 int, x1 int, w int").select("i", g.column_index(F.col("x0"), F.col("x1"), F.col("w"), n).alias("c")).collect()
    assert {r.i: r.c for r in got} == {i: min(int(((a + b) / 2) // (w / n)), n - 1) for i, a, b, w in rows}
