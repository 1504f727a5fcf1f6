import numpy as np
import pandas as pd

from pagemill.llm import quality


def _row(text):
    return dict(zip(quality.STATISTICS, quality.measure([text])[0], strict=True))


def test_statistics_of_small_texts():
    x = _row("The old song, they say.\nIt is long")
    assert x["word_count"] == 8 and x["punctuated_lines"] == 0.5 and x["words_per_line"] == 4
    assert abs(x["mean_word_length"] - 25 / 8) < 1e-9 and abs(x["symbol_ratio"] - 2 / 27) < 1e-9
    assert x["common_words"] == 4 / 8
    assert _row("- a\n- b\n")["marked_lines"] == 1 and _row("- 17 - The\n")["marked_lines"] == 0
    assert _row("Roll Cost Weight\n1 2 3")["leading_capitals"] == 3
    assert all(np.isnan(v) for k, v in _row(" \n").items() if k != "word_count")
    assert _row("<<<HEADING: X Y >>>\n\none")["word_count"] == 1


def test_measured_together_or_alone():
    texts = ["", "a b.", "Ünïcode “quoted.”", "x\n\ny\t z", "🎲 夜の門 1d6", "word " * 3000] * 3
    together = quality.measure(texts)
    alone = np.vstack([quality.measure([t]) for t in texts])
    assert np.allclose(together, alone, equal_nan=True)


def _labelled(n=240):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        kind = ("prose", "list", "table", "junk")[i % 4]
        x = dict.fromkeys(quality.STATISTICS, 0.0)
        x |= {"common_words": rng.uniform(0.3, 0.5) if kind == "prose" else rng.uniform(0, 0.2), "word_like": rng.uniform(0, 0.2) if kind == "junk" else rng.uniform(0.6, 1), "leading_capitals": rng.integers(3, 6) if kind == "table" else rng.integers(0, 2), "marked_lines": 1.0 if kind == "list" else 0.0}
        rows.append(x | {"kind": kind})
    return pd.DataFrame(rows)


def test_rules_hold_on_rows_not_seen():
    rows = _labelled()
    rules = quality.induce(rows.iloc[:160])
    rest = rows.iloc[160:].reset_index(drop=True)
    x = {s: rest[s].to_numpy(float) for s in quality.STATISTICS}
    said = np.full(len(rest), "prose", object)
    for r in reversed(rules):
        said[r.covers(x)] = r.kind
    assert (said == rest["kind"]).mean() > 0.97
    assert quality.induce(rows.iloc[:160]) == rules
    assert quality.induce(rows.iloc[:0]) == [] and quality.case_sql([]).endswith("ELSE 'prose' END")


ITEMS = "book_id bigint, item_id string, text string, word_count string, kind_x string"


def test_frame(spark):
    prose = "The old song says that they never go to the mill, and it is told in every house."
    rows = []
    for i in range(160):
        text = (f"{prose} {i}.", "\n".join(f"- item {i} {k}" for k in range(4)), "Roll Cost Item\n1d6 2 sp\n3d8 4 sp", "#~ %& |] " * 4)[i % 4]
        rows.append((i % 5, f"i{i}", text, "mine", None))
    items = spark.createDataFrame(rows + rows[:3] + [(1, "null", None, None, None), (1, "blank", " \n", None, None), (1, "long", f"{prose} " * 20_000, None, None)], ITEMS)
    labels = spark.createDataFrame([(r[0], r[1], ("prose", "list", "table", "junk")[int(r[1][1:]) % 4]) for r in rows[:120]] + [(0, "i0", "junk"), (None, "x", "list"), (1, None, "list"), (1, "x", None)], "book_id bigint, item_id string, kind string")
    rules = quality.learn(items, labels, ["book_id", "item_id"])
    got = quality.statistics(items).withColumn("kind", quality.kind_of(rules)).collect()
    kinds = {r.item_id: r.kind for r in got}
    assert all(kinds[f"i{i}"] == ("prose", "list", "table", "junk")[i % 4] for i in range(160))
    assert kinds["null"] is None and kinds["blank"] is None and kinds["long"] == "prose"
    by = {r.item_id: r for r in got}
    assert by["null"].word_count == 0 and by["null"].symbol_ratio is None and by["i0"].word_count_input == "mine" and len(got) == len(rows) + 6
    assert quality.learn(items.limit(0), labels, ["book_id", "item_id"]) == [] and quality.learn(items, labels.limit(0), ["book_id", "item_id"]) == []
    assert quality.statistics(items.limit(0)).count() == 0


def test_texts_of_a_whole_agree(spark):
    kinds = spark.createDataFrame([(1, "s", "prose"), (1, "a", "list"), (1, "b", "list"), (1, "c", "prose"), (1, "c", "prose"), (1, "alone", "junk"), (1, "t", "table"), (1, "d", "junk"), (2, "a", "prose"), (1, "n", None), (None, "a", "list")], "book bigint, item string, kind string")
    parts = spark.createDataFrame([(1, "s", "a"), (1, "s", "b"), (1, "s", "c"), (1, "s", "c"), (1, "t", "d"), (1, "t", None), (1, "u", "missing"), (None, "s", "a")], "book bigint, sec string, blk string")
    got = {(r.book, r.item): r.kind for r in quality.agree(kinds, parts, "book", "sec", "blk").collect()}
    # two lists against one prose and the section's own prose: a tie, which the section's own text settles
    assert got == {(1, "s"): "prose", (1, "a"): "prose", (1, "b"): "prose", (1, "c"): "prose", (1, "alone"): "junk", (1, "t"): "table", (1, "d"): "table", (2, "a"): "prose", (None, "a"): "list"}
    assert quality.agree(kinds.limit(0), parts, "book", "sec", "blk").count() == 0
