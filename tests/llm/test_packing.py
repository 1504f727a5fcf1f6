import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.llm import packing

pytestmark = pytest.mark.skipif(not os.path.exists(packing.TOKENIZER), reason="no tokenizer file here")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=0, max_size=60), st.integers(1, 9))
def test_differencing_keeps_every_item(sizes, windows):
    at = packing.differencing(sizes, windows)
    assert len(at) == len(sizes) and all(0 <= w < windows for w in at)
    totals = [sum(s for s, w in zip(sizes, at, strict=True) if w == k) for k in range(windows)]
    assert max(totals) <= sum(sizes) / windows + max(sizes, default=0)  # no window is more than one item over the mean


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 100), max_size=80))
def test_fill_holds_the_capacity(sizes):
    at, n = packing.fill(sizes, 100)
    assert all(sum(s for s, w in zip(sizes, at, strict=True) if w == k) <= 100 for k in range(n))


def test_differencing_is_near_equal():
    sizes = [(i * 7919) % 97 + 3 for i in range(2000)]
    at = packing.differencing(sizes, 50)
    totals = [sum(s for s, w in zip(sizes, at, strict=True) if w == k) for k in range(50)]
    assert max(totals) - min(totals) <= 2


DOCS = "doc_id bigint, text string, container string, n_tokens int"


def test_frame(spark):
    word = "stone "
    texts = [None, "", "a", word * 3000, word * 2048, word * 2049] + [word * (i % 400 + 1) for i in range(300)]
    rows = [(i, t, "mine", 7) for i, t in enumerate(texts)] + [(5, texts[5], "mine", 7), (None, "x", None, None)]
    got = packing.pack(spark.createDataFrame(rows, DOCS)).collect()
    assert [(r.n_tokens, r.container) for r in got if r.doc_id == 0] == [(None, None)]
    assert [(r.n_tokens, r.container is None) for r in got if r.doc_id == 1] == [(0, False)]
    used: dict = {}
    for r in got:
        if r.container is not None:
            used[r.container] = used.get(r.container, 0) + r.n_tokens
    assert max(used.values()) <= 2048 and sum(v for v in used.values()) / (2048 * len(used)) > 0.97
    one = packing.load_tokenizer(packing.TOKENIZER)
    for i, t in enumerate(texts):
        if t is None:
            continue
        pieces = sorted((r.piece_no, r.start_token, r.n_tokens) for r in got if r.doc_id == i)
        n = one([t])[0]
        times = 2 if i == 5 else 1
        assert sum(p[2] for p in pieces) == times * n
        assert len(pieces) == times * max(1, -(-n // 2048)), "only texts over the capacity are cut"
    assert len([r for r in got if r.doc_id is None]) == 1


def test_empty_and_same_again(spark):
    assert packing.pack(spark.createDataFrame([], DOCS)).count() == 0
    df = spark.createDataFrame([(i, "stone " * (i % 50), None, None) for i in range(200)], DOCS)
    one, two = (sorted(map(tuple, packing.pack(df).collect())) for _ in range(2))
    assert one == two
    with pytest.raises(Exception, match="isn't there"):
        packing.pack(df, tokenizer="/nowhere.json").count()


def test_both_kinds_of_files_count_alike():
    other = os.path.join(os.path.dirname(packing.TOKENIZER), "byte_bpe_50k.json")
    texts = ["", "It's 12 o'clock,  isn't it?\n\n\tYes.", "Ärger  über <|endoftext|> 門🎲", "x" * 5000, " \n "]
    assert packing.load_tokenizer(packing.TOKENIZER)(texts) == packing.load_tokenizer(other)(texts)
