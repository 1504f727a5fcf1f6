import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.llm import split

SCHEMA = "id int, headings array<string>, text string"


def check(text, limit, overlap, pieces):
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    for a, b, _ in pieces:
        assert b - a <= limit
    for (_, b, _), (c, d, _) in zip(pieces, pieces[1:], strict=False):
        assert c == b - overlap and d > b
    assert text[: pieces[0][1]] + "".join(text[a + overlap : b] for a, b, _ in pieces[1:]) == text


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .\n!Ǘ", max_size=600), st.integers(12, 80), st.integers(0, 10))
def test_pieces_give_back_the_text(text, limit, overlap):
    check(text, limit, overlap, split.cut(text, limit, overlap))


def test_strongest_boundary_in_the_window_wins():
    heading = "<<<HEADING: Two >>>\n\n"
    text = "a b. " * 10 + "\n\n" + heading + "c d. " * 30
    pieces = split.cut(text, 100, 10, ["Two"])
    assert pieces[0][2] == "heading" and text[pieces[0][1] :].startswith("<<<HEADING: Two")
    assert split.cut(text, 100, 10, ["Other"])[0][2] == "paragraph"
    assert [k for _, _, k in split.cut("x. Y" * 5 + "\n" + "z" * 90, 60, 5)] == ["line", "character", "end"]
    assert split.cut("One two. Three four. Five", 22, 3)[0][2] == "sentence"
    assert split.cut("one two three four five", 12, 3)[0][2] == "word"


def test_accents_stay_with_their_letter():
    text = "é" * 100
    assert all(text[b : b + 1] != "́" for _, b, k in split.cut(text, 15, 3) if k == "character")


def test_frame(spark):
    long = "word " * 5000
    rows = [(1, None, None), (2, [], ""), (3, ["h"], "short"), (4, [None, "h"], long), (4, [None, "h"], long), (5, None, "x" * 2001)]
    got = split.split_oversized(spark.createDataFrame(rows, SCHEMA)).collect()
    of = lambda i: sorted((r.piece_no, r.piece_start, r.piece_end, r.piece_text) for r in got if r.id == i)
    assert of(1) == [(0, None, None, None)] and of(2) == [(0, 0, 0, "")] and of(3) == [(0, 0, 5, "short")]
    assert [r[1:3] for r in of(5)] == [(0, 2000), (1800, 2001)]
    four = of(4)
    assert len(four) == 2 * max(r.n_pieces for r in got if r.id == 4) and max(len(r[3]) for r in four) <= 2000


def test_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(7, "mine", "x" * 30, "k")], "piece_no int, piece_text string, text string, _pieces string")
    got = split.split_oversized(df, headings=None, limit=20, overlap=5).orderBy("piece_no").collect()
    assert [(r.piece_no_input, r.piece_text_input, r.piece_no, len(r.piece_text)) for r in got] == [(7, "mine", 0, 20), (7, "mine", 1, 15)]
    own = split.split_oversized(df.drop("text"), text="piece_text", headings=None)
    assert own.first().piece_text == "mine"
    assert split.split_oversized(df.limit(0), headings=None).count() == 0
    with pytest.raises(ValueError):
        split.split_oversized(df, limit=5, overlap=5)
