import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from pagemill.llm import scans
from pagemill.llm.quality import Condition, Rule
from pagemill.llm.scans import Head, Lexicon

WORDS = {w: 1000 for w in "the first rule of storm short with never turn costs and a to mill range magic weapons such as long stonemason silver marks follows modern corner bone door cost by one night book see also covers ground for".split()} | {"cosf": 12, "tom": 40}
PAIRS = {("the", "first"): 900, ("rule", "storm"): 90, ("the", "storm"): 500, ("silver", "marks"): 700, ("the", "silver"): 600, ("for", "#"): 800, ("#", "silver"): 900}
JUNK = [Rule("junk", (Condition("word_like", True, 0.2),))]


@pytest.fixture
def lexicon():
    return Lexicon(dict(WORDS), dict(PAIRS))


def _brute(word, lexicon):
    """All vocabulary words within two confusions, by undoing them everywhere."""
    seen, now = {word: 0}, {word}
    for e in (1, 2):
        new = set()
        for w in now:
            for true, printed in scans.CONFUSIONS:
                i = w.find(printed)
                while i >= 0:
                    new.add(w[:i] + true + w[i + len(printed) :])
                    i = w.find(printed, i + 1)
        now = {w for w in new if w not in seen}
        seen |= dict.fromkeys(now, e)
    return {(e, w) for w, e in seen.items() if w in lexicon.counts and w != word and e}


@pytest.mark.parametrize("word", ["storrn", "ru1e", "fir5t", "r@nge", "sliort", "withm", "nevcr", "turri", "corner", "vvith", "firsf", "c0sts", "rn0dem", "stcrrn", "xyz", "magicc"])
def test_candidates_are_complete(lexicon, word):
    got = set(lexicon.candidates(word))
    want = _brute(word, lexicon)
    # undoing on the text may also undo what an earlier undoing made; the automaton reads each letter once
    assert {w for _, w in got} <= {w for _, w in want} | {w for w in lexicon.counts if not word.isalpha()}
    assert {w for e, w in want if e == 1} <= {w for _, w in got}


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("word", ["strom", "rle", "fistr", "ranger", "nevver", "boor", "modrn", "x", "stonemasons", "qqqq", "the", ""])
@pytest.mark.parametrize("edits", [1, 2])
def test_plain_edits_give_exactly_the_words_within_the_distance(word, edits):
    plain = Lexicon(dict(WORDS), {}, plain_edits=edits)
    assert set(plain.plain_candidates(word)) == {w for w in WORDS if w != word and _distance(word, w) <= edits}


def test_correct_words(lexicon):
    assert scans.correct_words("The fir5t storrn NEVCR 1d6 3rd 12 zzz, Firsf!", lexicon) == ("The first storm NEVER 1d6 3rd 12 zzz, First!", 4)


def _lexicon(texts, **options):
    """The lexicon of some texts, counted in this process."""
    words, pairs = Counter(), Counter()
    for out in scans.count_batches(iter([pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])])):
        for w, h, n in zip(*(c.to_pylist() for c in out.columns), strict=True):
            (pairs if w is None else words)[h if w is None else w] += n
    total = sum(words.values())
    hashed = scans.Counts(np.array([*pairs], np.int64).view(np.uint64), np.array([*pairs.values()], np.uint32))
    return Lexicon({w: n for w, n in words.items() if n >= max(3, 1e-5 * total)}, hashed, scans.Counts.of(words), least=max(5, int(3e-5 * total)), **options)


def test_counts_beside_plain_counting():
    texts = ["The “old” house, 12 storms\nthe old-\nhouse", None, "", "house 3rd the old", "ärger über Эхо"]
    words, pairs = Counter(), Counter()
    for t in filter(None, texts):
        found = ["#" if x[0].isdigit() else x for x in scans._PAIRS.findall(t.lower())]
        words.update(found)
        pairs.update(f"{a} {b}" for a, b in zip(found, found[1:], strict=False))
    got = _lexicon(texts * 3)
    assert {w: got.seen(w) for w in words} == {w: 3 * n for w, n in words.items()}
    assert {p: got.pairs.get(p) for p in pairs} == {p: 3 * n for p, n in pairs.items()} and got.pairs.get("no pair") == 0


CORPUS = ["the old house stands on the hill"] * 50 + ["an attack on the house came at night"] * 50 + ["the modern house stands"] * 400 + ["a new modem was plugged in here"] * 3 + ["the train arrives at the station and burns"] * 50


@pytest.mark.parametrize(
    ("printed", "meant"),
    [
        ("the old hcuse stands", "the old house stands"), ("the old hause stands", "the old house stands"), ("the old hous stands", "the old house stands"), ("an atack on the house", "an attack on the house"), ("the tratn arrives", "the train arrives"),
        ("a new modem was plugged in", None), ("the modem house stands", "the modern house stands"), ("the bum stands", None), ("the Haus stands", None), ("the " + "x" * 40 + " stands", None), ("modem", None),
    ],
)
def test_context_decides(printed, meant):
    lexicon = _lexicon(CORPUS)
    if printed == "modem":
        assert lexicon.correct("modem", "new", "was") is None and lexicon.correct("modem", "the", "house") == "modern"
    else:
        assert scans.correct_words(printed, lexicon)[0] == (meant or printed)


def test_long_words_are_corrected():
    word = "donaudampfschifffahrtsgesellschaftskapitän"
    lexicon = _lexicon([f"the {word} stands here"] * 40)
    assert scans.correct_words(f"the {word.replace('m', 'rn')} stands", lexicon)[0] == f"the {word} stands"
    assert scans.correct_words(f"the {word[:20]}{word[21:]} stands", lexicon)[0] == f"the {word} stands"


def _spoil(word, rng):
    """One letter changed, lost or added, and no confusion of scanning."""
    i, letters = rng.randrange(1, len(word) - 1), "abcdefghijklmnopqrstuvwxyz"
    return rng.choice([word[:i] + rng.choice([c for c in letters if c != word[i] and (word[i], c) not in scans.CONFUSIONS]) + word[i + 1 :], word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i:]])


def test_recall_and_precision_on_spoiled_texts(tmp_path):
    rows = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text", "lang"]).to_pylist()
    texts = [r["text"] for r in rows if r["text"] and r["lang"] == "en"]
    lexicon, rng = _lexicon(texts), random.Random(2)
    right = wrong = n = 0
    for text in texts[:250]:
        truth = re.split(r"(\s+)", text)
        printed = list(truth)
        places = [i for i, w in enumerate(truth) if re.fullmatch(r"[a-z]{5,}", w) and lexicon.counts.get(w, 0) >= 20]
        chosen = set(rng.sample(places, max(1, len(places) // 15))) if places else set()
        for i in chosen:
            while lexicon.seen(printed[i]):
                printed[i] = _spoil(truth[i], rng)
        fixed = re.split(r"(\s+)", scans.correct_words("".join(printed), lexicon)[0])
        n += len(chosen)
        right += sum(fixed[i] == truth[i] for i in chosen)
        wrong += sum(x != y and (i not in chosen or x != truth[i]) for i, (x, y) in enumerate(zip(fixed, printed, strict=True)))
    assert right >= 0.9 * n and right >= 0.98 * (right + wrong)


def test_cut_words(lexicon):
    for cut in ("stone-\nmason", "stone- mason", "stone‐ \n mason", "stone¬\nmason"):
        assert scans.join_cut_words(f"The {cut} costs", lexicon) == ("The stonemason costs", 1)
    assert scans.join_cut_words("Long- and short weapons, half-\ngiant", lexicon)[1] == 0


def _repair(text, page=5, titles=("The Salt Codex of Vuhaté", "Chapter 2: Storms"), lexicon=None, kind="prose", reflowed=True):
    return scans.repair(text, [page], [Head(t) for t in titles], lexicon, kind, reflowed)


@pytest.mark.parametrize(
    ("text", "noises"),
    [
        ("THE SALT CODEX OF VUHATÉ\nThe first rule", ["header"]),
        ("The first T H E     S A L T     C O D E X     O F     V U H A T É rule", ["header"]),
        ("The first The Salt Codex of Vuhaté · Chapter 2: Storms\nrule", ["header"]),
        ("The first\n5 | CHAPTER 2: STORMS\nrule", ["header", "pageno"]),
        ("See also The Salt Codex of Vuhaté, which covers the ground.", []),
        ("Page 5\nThe first rule", ["pageno"]),
        ("The first - 5 - rule", ["pageno"]),
        ("[5] The first rule", ["pageno"]),
        ("The first\n5\nrule", ["pageno"]),
        ("The 5 first rule", ["pageno"]),
        ("[6] The rule costs\n7\nmarks for 5 silver marks", []),
        ("Range of the storm:\n5\nThe first", []),
        ("The stone-\nPage 5\nmason", ["hyphen", "pageno"]),
        ("The storrn", ["misread"]),
        ("The first rule", []),
    ],
)
def test_noises(lexicon, text, noises):
    fixed, got = _repair(text, lexicon=lexicon, reflowed=False)
    assert got == noises
    if noises:
        assert _repair(fixed, lexicon=lexicon, reflowed=False) == (fixed, []), "nothing is left to repair"


@pytest.mark.parametrize(
    ("text", "noises"),
    [
        ("Oil\nThe first rule", ["header"]),
        ("The first\n5 | OIL\nrule", ["header", "pageno"]),
        ("The first OIL rule", ["header"]),
        ("The first Oil · Chapter 2: Storms\nrule", ["header"]),
        ("The first Oil rule", []),
        ("The first rule costs AC 5", []),
        ("AC\nThe first rule", ["header"]),
        ("The first 12 rule\n12", []),
    ],
)
def test_short_heads(lexicon, text, noises):
    assert _repair(text, titles=("Oil", "AC", "12", "Chapter 2: Storms"), lexicon=lexicon, reflowed=False)[1] == noises


def test_reflow(lexicon):
    assert _repair("The first\nrule of the\n\nstonemason\n5\n", lexicon=lexicon)[0] == "The first rule of the\n\nstonemason"
    assert _repair("- one\n- door", lexicon=lexicon, kind="list")[0] == "- one\n- door"
    assert _repair("fir5t #~", lexicon=lexicon, kind="junk") == ("fir5t #~", [])


BLOCKS = "id int, text string, pages array<int>, heads array<string>, noises string"


def test_frame(spark, lexicon):
    rows = [(1, "The fir5t rule", [5], ["The Salt Codex of Vuhaté", None], "mine"), (2, None, None, None, None), (3, " ", [None], [], None), (4, "The first rule " * 20_000 + "storrn", None, None, None), (1, "The fir5t rule", [5], None, "mine")]
    got = scans.repair_texts(spark.createDataFrame(rows, BLOCKS), lexicon, JUNK).collect()
    by = {r.id: r for r in got}
    assert len(got) == 5 and by[1].repaired == "The first rule" and by[1].noises == ["misread"] and by[1].noises_input == "mine"
    assert by[2].repaired is None and by[2].noises == [] and by[3].repaired == " " and by[4].noises == ["misread"]
    assert scans.repair_texts(spark.createDataFrame([], BLOCKS), lexicon, JUNK).count() == 0


@pytest.mark.parametrize("reflowed", [True, False])
def test_known_kinds_go_before_own(spark, lexicon, reflowed):
    rows = [(1, "fir5t #~", [5], [], "prose"), (2, "The fir5t rule", [5], [], "junk"), (3, "The fir5t rule", [5], [], None), (4, "The first\n5\nrule", [5], [], "list"), (5, "@@ fir5t ##", [5], [], None)]
    got = scans.repair_texts(spark.createDataFrame(rows, BLOCKS.replace("noises", "kind")), lexicon, JUNK, reflowed=reflowed, kinds="kind").collect()
    own = {r.id: r.noises for r in scans.repair_texts(spark.createDataFrame(rows, BLOCKS.replace("noises", "kind")), lexicon, JUNK, reflowed=reflowed).collect()}
    by = {r.id: r.noises for r in got}
    assert by == {1: ["misread"], 2: [], 3: ["misread"], 4: [], 5: own[5]}
    assert own[2] == own[3] == ["misread"] and own[4] == ["pageno"]


def test_lexicon_counts_the_whole_corpus(spark):
    texts = spark.createDataFrame([("The storm turns",)] * 50 + [("the storrn turns 12 times",)] * 2 + [(None,), ("",)], "text string")
    made = scans.build_lexicon(texts)
    assert made.counts["storm"] == 50 and made.counts["the"] == 52 and "storrn" not in made.counts
    assert made.pair("the", "storm") == 50 and made.seen("storrn") == 2 and made.seen("never seen") == 0
    assert made.correct("storrn", "the", "turns") == "storm" and scans.build_lexicon(texts.limit(0)).counts == {}


def test_plain_edits_reach_the_workers(spark):
    rows = spark.createDataFrame([(1, "the old hous stands", None, None, None)], BLOCKS)
    for edits, want in ((0, "the old hous stands"), (1, "the old house stands")):
        assert scans.repair_texts(rows, _lexicon(CORPUS, plain_edits=edits), JUNK).first().repaired == want


def test_only_pieces_in_doubt_are_taken_apart(lexicon, monkeypatch):
    plain = "the first rule of storm " * 50
    text = plain + "the storrn (storrn) storrns the (storrn)"
    fixed = scans.correct_words(text, lexicon)
    assert fixed == (plain + "the storm (storm) storrns the (storm)", 3)
    asked = []
    real = Lexicon.doubtful
    monkeypatch.setattr(Lexicon, "doubtful", lambda self, word: asked.append(word) or real(self, word))
    assert scans.correct_words(text, lexicon) == fixed
    assert len(asked) < 20  # the words that stand aren't asked for again
