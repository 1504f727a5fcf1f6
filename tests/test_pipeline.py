"""Golden cases of ordering, assembly, outline, attaching and sections; windows beside a walk in Python."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill import schema
from pagemill.operators import assembly, attach, ordering, outline, sections, tables


def _spans(spark, rows):
    """(text, size, x0, y0, x1, y1) in list order, one page."""
    return spark.createDataFrame([(1, 2, i, *r) for i, r in enumerate(rows)], schema.SPAN)


def _layout(spark, rows):
    return spark.createDataFrame([(1, 2, i, label, 0.9, *b) for i, (label, *b) in enumerate(rows)], schema.LAYOUT)


def test_reading_order(spark):
    boxes = [(600, 10, 900, 20), (0, 50, 300, 60), (0, 10, 300, 20), (0, 10, 300, 20)]
    got = ordering.reading_order(_spans(spark, [("t", 9.0, *b) for b in boxes])).orderBy("seq").collect()
    assert [r.region_idx for r in got] == [2, 3, 1, 0]
    with pytest.raises(ValueError):
        ordering.reading_order(_spans(spark, []), 0)


def _line(y, text, size=9.0):
    return (text, size, 0, y, 100, y + 10)


def test_assembly(spark):
    spans = [_line(0, "T1"), _line(20, "a"), _line(40, "b"), _line(60, "t"), _line(80, "t"), _line(100, "c"), _line(120, "foot"), _line(140, "H", 12.0), _line(160, "d")]
    layout = [("paragraph_title", 0, 0, 100, 10), ("table", 0, 60, 100, 90), ("footer", 0, 120, 100, 130)]
    got = assembly.assemble(_spans(spark, spans), _layout(spark, layout), columns=1).orderBy("order_id").collect()
    assert [(r.block_id, r.title, r.text) for r in got] == [("blk_3_00000", "T1", "a b"), ("tbl_3_00001", "T1", None), ("blk_3_00002", "T1", "c"), ("blk_3_00003", "H", "d")]


def test_repeated_table_does_not_part_text(spark):
    spans = [_line(0, "a"), _line(20, "t"), _line(40, "b"), _line(60, "t"), _line(80, "c")]
    layout = [("table", 0, 20, 100, 30), ("table", 0, 200, 100, 300)]
    two = _layout(spark, layout)
    again = spans[:3] + [("t", 9.0, 0, 62, 100, 66)] + spans[4:]
    tall = _layout(spark, [("table", 0, 20, 40, 70)])
    got = assembly.assemble(_spans(spark, [_line(0, "a"), ("t", 9.0, 0, 20, 50, 30), ("b", 9.0, 60, 40, 100, 50), ("t", 9.0, 0, 60, 50, 70), _line(80, "c")]), tall, columns=1).orderBy("order_id").collect()
    assert [(r.type, r.text) for r in got] == [("text", "a"), ("table", None), ("text", "b c")]
    assert two.count() == 2 and len(again) == 5


def _assemble_model(spans, layout, prose=9.0):
    """A walk over one page, span by span."""

    def covers(a, b):
        w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
        return w > 0 and h > 0 and w * h / max((a[2] - a[0]) * (a[3] - a[1]), 1) >= 0.3

    out, title, run, seen = [], None, [], set()

    def close():
        if run:
            out.append(("text", title, " ".join(run)))
            run.clear()

    for i, (text, size, *box) in enumerate(spans):
        label = next((x for x, *b in layout if covers(box, b)), None)
        table = next((k for k, (x, *b) in enumerate(layout) if x == "table" and covers(box, b)), None)
        sizes = [s[1] for s in spans]
        lonely = size is not None and size > prose and (i == 0 or sizes[i - 1] != size) and (i + 1 == len(spans) or sizes[i + 1] != size)
        if label in schema.NOISE_LABELS:
            continue
        if label in schema.TITLE_LABELS or (table is None and lonely):
            close()
            title = text
        elif table is not None:
            if table not in seen:
                close()
                seen.add(table)
                out.append(("table", title, None))
        else:
            run.append(text)
    close()
    return out


@settings(max_examples=25, deadline=None)
@given(st.data())
def test_assembly_beside_walk(spark, data):
    n = data.draw(st.integers(1, 14))
    spans = [(f"s{i}", data.draw(st.sampled_from([None, 9.0, 12.0, 14.0])), 0, 20 * i, 100, 20 * i + 10) for i in range(n)]
    labels = ("table", "paragraph_title", "footer", "text", "figure_title", "image")
    layout = []
    for _ in range(data.draw(st.integers(0, 5))):
        y = data.draw(st.integers(0, 20 * n))
        layout.append((data.draw(st.sampled_from(labels)), 0, y, data.draw(st.sampled_from([20, 40, 100])), y + data.draw(st.integers(5, 80))))
    got = assembly.assemble(_spans(spark, spans), _layout(spark, layout), columns=1).orderBy("order_id").collect()
    assert [(r.type, r.title, r.text) for r in got] == _assemble_model(spans, layout)


LINES = [("PART ONE....", 18.0), ("Races........ 11", 14.0), ("Dwarf", 11.0), ("18", 11.0), ("19", 11.0), ("Classes..21", 14.0)]


def test_outline(spark):
    lines = spark.createDataFrame([(1, i, t, s) for i, (t, s) in enumerate(LINES)], "doc_id bigint, toc_seq int, text string, size double")
    got = outline.outline(lines).orderBy("toc_seq").collect()
    assert [(r.level, r.page_start, r.path) for r in got] == [(0, 11, ["PART ONE"]), (1, 11, ["PART ONE", "Races"]), (2, 18, ["PART ONE", "Races", "Dwarf"]), (1, 21, ["PART ONE", "Classes"])]


def test_outline_json(spark):
    lines = spark.createDataFrame([(1, i, t, s) for i, (t, s) in enumerate(LINES)], "doc_id bigint, toc_seq int, text string, size double")
    text = outline.nested_json(outline.outline(lines)).first().toc_json
    assert '"title": "PART ONE", "page_start": 11' in text and text.count('"children"') == 4


def _attached(spark):
    lines = spark.createDataFrame([(1, i, t, s) for i, (t, s) in enumerate(LINES)], "doc_id bigint, toc_seq int, text string, size double")
    rows = [(1, "b0", 0, 3, "text", "x", None, None), (1, "b1", 1, 3, "text", "r", "RACES", None), (1, "b2", 0, 11, "text", "r2", "Races!", None), (1, "t0", 1, 11, "table", None, None, "c.png"), (1, "b3", 0, 12, "text", "y", None, None)]
    return spark.createDataFrame(rows, schema.BLOCK), outline.outline(lines)


def test_attach_and_sections(spark):
    blocks, tree = _attached(spark)
    texts = attach.text_blocks(blocks, tree)
    got = {r.block_id: (r.toc, r.text, r.page) for r in texts.collect()}
    assert got == {"b0": ([], "x", 3), "b1": ([], "r", 3), "b2": (["PART ONE", "Races"], "r2\n\ny", 11)}
    assert [r.toc for r in attach.table_blocks(blocks, tree).collect()] == [["PART ONE", "Races"]]
    cut = sections.sections(texts).orderBy("section_id").collect()
    assert [(r.section_id, r.toc, r.text, r.headings, r.pages, r.block_ids) for r in cut] == [("sec_000000", [], "x\n\nr", [], [3], ["b0", "b1"]), ("sec_000001", ["PART ONE", "Races"], "r2\n\ny", [], [11], ["b2"])]


def test_skipped_page_does_not_move_the_outline(spark):
    blocks, tree = _attached(spark)
    got = {r.block_id: r.toc for r in attach.text_blocks(blocks, tree, [11]).collect()}
    assert got["b1"] == [] and "b2" not in got


def test_headings(spark):
    rows = [(1, f"b{i}", 1, i, t, ["Races"], x) for i, (t, x) in enumerate([("Elf", "a"), ("Elf", "b"), (None, "c"), ("Elf", "d"), ("Orc", "e"), (None, "  ")])]
    got = sections.sections(spark.createDataFrame(rows, schema.TEXT_BLOCK)).collect()
    assert len(got) == 1 and got[0].headings == ["Elf", "Orc"]
    assert got[0].text.startswith("<<<HEADING: Elf >>>\n\na\n\n<<<HEADING: Elf >>>\n\nb\n\nc\n\n")


def test_assignment(spark):
    matrix = [[0.1, 0.9, 0.2], [0.3, 0.8, 0.4], [0.9, 0.1, 0.05]]
    assert ordering.settle(matrix) == [1, 2, 0]
    rows = [(1, 0, r, c, s) for r, row in enumerate(matrix) for c, s in enumerate(row)]
    got = ordering.assign_order(spark.createDataFrame(rows, "doc_id bigint, page_index int, row int, col int, score double")).orderBy("region_idx").collect()
    assert [r.position for r in got] == [1, 2, 0]
    with pytest.raises(ValueError):
        ordering.settle([[1.0], [2.0]])


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 7).flatmap(lambda n: st.lists(st.lists(st.integers(0, 1000), min_size=n, max_size=n, unique=True), min_size=n, max_size=n)))
def test_assignment_is_stable(matrix):
    got = ordering.settle(matrix)
    assert sorted(got) == list(range(len(matrix)))
    for r, row in enumerate(matrix):
        for c, s in enumerate(row):
            holder = got.index(c)
            assert s <= row[got[r]] or (matrix[holder][c], -holder) >= (s, -r)


def test_answers(spark):
    rows = spark.createDataFrame([("a", "{}"), ("b", "[1]"), ("c", "```x"), ("d", '{"columns": null, "rows": [{"A": 1}]}'), ("e", None)], "id string, answer string")
    got = {r.id: (r.columns, r.rows, r.description, r.status) for r in tables.parse_answers(rows).collect()}
    assert got["a"] == ([], [], None, "ok") and got["b"][3] == "not_object" and got["c"][3] == "invalid" and got["e"][3] == "invalid"
    assert got["d"] == (None, [{"A": "1"}], None, "ok")


class _Client:
    def __init__(self, answers):
        self.answers, self.tokens = list(answers), []

    def ask(self, system, prompt, image, max_tokens):
        self.tokens.append(max_tokens)
        a = self.answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a


def test_retries():
    waits = []
    one = _Client([tables.RateLimited(), "no", '{"a": 1}'])
    assert tables.ask_with_retries(one, "p", None, wait=waits.append) == ('{"a": 1}', "ok")
    assert one.tokens == [1024, 2048, 4096] and waits == [3, 6, 4]
    assert tables.ask_with_retries(_Client(["x"] * 3), "p", None, wait=waits.append) == ("x", "failed")
    with pytest.raises(KeyError):
        tables.ask_with_retries(_Client([KeyError()]), "p", None, wait=waits.append)


def test_blocks_without_page_or_order_stay(spark):
    rows = [(1, "a", 0, None, "text", "t1", None, None), (1, "b", 1, None, "text", "t2", "T", None), (1, "c", 0, 1, "table", None, "Races", "crop"), (1, "d", 1, 1, "text", "t3", None, None), (None, "e", None, None, "text", "t4", None, None), (1, "f", None, 1, "text", "t0", "  ", None)]
    blocks = spark.createDataFrame(rows, schema.BLOCK)
    entries = spark.createDataFrame([(1, 0, "races", 1, 0), (1, 1, "T", 900, 0)], schema.OUTLINE_ENTRY)
    tree = outline.tree(entries)
    matched = {r.block_id: r.matched_seq for r in attach.match_outline(blocks, tree).collect()}
    assert matched == {"a": None, "b": 1, "c": 0, "d": None, "e": None, "f": None}, "without a page no entry starts too late"
    got = {r.block_id: (r.toc, r.text) for r in attach.text_blocks(blocks, tree).collect()}
    assert got == {"a": ([], "t1"), "b": (["T"], "t2"), "f": (["T"], "t0\n\nt3"), "e": ([], "t4")}
    assert [(r.block_id, r.toc) for r in attach.table_blocks(blocks, tree).collect()] == [("c", ["races"])]
    found = {(r.doc_id, r.section_id): (r.text, r.pages, r.block_ids) for r in sections.sections(attach.text_blocks(blocks, tree)).collect()}
    assert found[1, "sec_000000"] == ("t1", [None], ["a"]) and found[None, "sec_000000"] == ("t4", [None], ["e"])
    assert found[1, "sec_000001"] == ("t2\n\n<<<HEADING:    >>>\n\nt0\n\nt3", [None, 1], ["b", "f"])


def test_latest_row_of_each_key(spark):
    from pagemill.sources.records import latest

    df = spark.createDataFrame([(1, "a", "old", 1), (1, "a", "new", 2), (2, "a", "only", None), (1, "a", "none", None)], "d int, k string, v string, at int")
    assert sorted((r.d, r.k, r.v) for r in latest(df, ["d", "k"], "at").collect()) == [(1, "a", "new"), (2, "a", "only")]
