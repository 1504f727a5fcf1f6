import unicodedata
from itertools import combinations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.llm.looks import LOOKALIKES, Transducer, canonical, look_classes, look_pairs, same_look, transducer

ODD = "aé́̈ﬁﬀＡ１　  ​‍­﻿⁠\u0007\x0b\r\n\tаеорсΑΒοɡһԁｶﾞ가각“”‘’–—-æŒßĳ🎲мה門"


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=ODD, max_size=30))
def test_stable_and_composed(text):
    once = canonical(text)
    assert canonical(once) == once and unicodedata.is_normalized("NFC", once)
    assert canonical(unicodedata.normalize("NFD", text)) == canonical(unicodedata.normalize("NFC", text))


def test_same_look_same_form():
    for a, b in [("Ｐｅｒｉｌｓ", "Perils"), ("ﬁrst", "first"), ("é", "é"), ("e​́", "é"), ("а́", "á"), ("a b", "a b"), ("a　b", "a b"), ("so­ft", "soft"), ("x\u0007y", "xy"), ("Ѕοngѕ", "Songs"), ("a\r\nb", "a\nb"), ("１２", "12"), ("Ĳ", "IJ")]:
        assert canonical(a) == canonical(b) == b


def test_different_look_different_form():
    values = ["a", "A", "á", "à", "a ", "a  ", "a\n", "a-", "a–", "a—", "a‐", "'a'", "‘a’", '"a"', "“a”", "a.", "æ", "ae", "œ", "ß", "ss", "i", "ı", "l", "1", "0", "o", "O", "…", "...", "²", "2", "½", "™", "a\tb", "a b"]
    assert all(canonical(a) != canonical(b) for a, b in combinations(values, 2))


def test_mapping_is_checked():
    assert transducer().table and all(v.isascii() for v in LOOKALIKES.values())
    broken = Transducer()
    broken.table["q"] = "p"
    try:
        broken.check()
        raise AssertionError
    except ValueError:
        pass


def test_column(spark):
    rows = spark.createDataFrame([(0, None), (1, ""), (2, "plain"), (3, "Ａ" * 200_000), (4, "​")], "i int, t string")
    got = {r.i: r.y for r in rows.select("i", same_look(F.col("t")).alias("y")).collect()}
    assert got == {0: None, 1: "", 2: "plain", 3: "A" * 200_000, 4: ""}


BLOCKS = "book_id bigint, block_id string, type string, text string, title string, field string"


def _brute(rows, fields=("text", "title")):
    out = set()
    for a, b in combinations(sorted(set(rows), key=str), 2):
        for f, k in zip(fields, (3, 4), strict=True):
            x, y = a[k], b[k]
            if None in (a[0], a[1], b[0], b[1]) or a[0] != b[0] or a[1] == b[1] or not (x or "").strip() or not (y or "").strip():
                continue
            if x != y and canonical(x) == canonical(y) and canonical(x).strip():
                out.add((a[0], min(a[1], b[1]), max(a[1], b[1]), f))
    return out


def test_pairs_beside_brute_force(spark):
    spell = ["Songs", "Ѕongs", "Ｓongs", "So​ngs", "songs", "​", " ", "", None]
    rows = [(i % 3, f"b{i // 2}" if i % 7 else f"b{i}", "text", spell[i % 9], spell[(i * 5) % 9], "extra") for i in range(60)]
    rows = [r for r in {(r[0], r[1]): r for r in rows}.values()]
    rows += rows[:5] + [(None, "b1", "text", "Songs", None, "x"), (1, None, "text", "Ѕongs", None, "x")]
    got = look_pairs(spark.createDataFrame(rows, BLOCKS)).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == _brute(rows) != set()


def test_a_hot_title_gives_only_pairs_of_different_spelling(spark):
    rows = [(1, f"b{i:05d}", "text", None, "Songs", "") for i in range(3000)] + [(1, "zz", "text", None, "Ѕongs", "")]
    assert look_pairs(spark.createDataFrame(rows, BLOCKS)).count() == 3000
    assert look_pairs(spark.createDataFrame([], BLOCKS)).count() == 0


def test_classes_hold_all_links(spark):
    rows = [(1, f"b{i}", "text", t, h) for i, (t, h) in enumerate([("Ａ", "x"), ("A", "х"), ("A", "x"), ("А", None), ("B", " "), ("A", "y")])] + [(2, "b0", "text", "A", "x"), (1, "b1", "text", "A", "х")]
    df = spark.createDataFrame([(*r, "f") for r in rows], BLOCKS)
    got = {(r.book_id, r.block_id, r.field): (r.n_members, r.n_links) for r in look_classes(df).collect()}
    links: dict = {}
    for g, a, b, f in _brute(rows):
        for k in (a, b):
            links[g, k, f] = links.get((g, k, f), 0) + 1
    assert {k: n for k, (_, n) in got.items()} == links and got[1, "b0", "text"] == (5, 4)


def test_words_of_one_script_stay_in_it():
    for word in ("привет", "ёлка", "Ελλάδα", "Й"):
        assert canonical(word) == word
    assert canonical("пpивeт") == canonical("привет") and canonical("ëлка") == "ёлка" and canonical("Eλλάδα") == "Ελλάδα"
    # words with letters of both, or with none that tells, are Latin
    assert canonical("ꓮBC") == "ABC" and canonical("сосо") == "coco" and canonical("Sфera") == canonical("Ѕферa"[0:2] + "era") == "Sфera" and canonical("руна and руna") == "руна and pyna"


def test_every_entry_of_the_table_stands():
    one = transducer()
    for source, form in one.table.items():
        assert one(source) == one(form) and unicodedata.is_normalized("NFC", form)
    for ch in one.undrawn:
        assert one(ch) == "" and one(f"e{ch}\u0301") == "é"
    assert all(one(source) == form for source, form in LOOKALIKES.items() if not one.foreign.search(source))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aeаеAĂăо\u0301\u0306\u0323\u0327\u200bｅＡế", max_size=8))
def test_trie_beside_composition(text):
    apart = "".join(LOOKALIKES.get(c, c) for c in unicodedata.normalize("NFD", "".join(unicodedata.normalize("NFKC", c) if "！" <= c <= "～" else c for c in text.replace("\u200b", ""))))
    assert canonical(text) == unicodedata.normalize("NFC", apart)


def test_letters_of_one_script_may_not_share(monkeypatch):
    for source, form in (("Д", "A"), ("Q", "O")):
        monkeypatch.setitem(LOOKALIKES, source, form)
        try:
            Transducer()
            raise AssertionError
        except ValueError:
            monkeypatch.delitem(LOOKALIKES, source)
