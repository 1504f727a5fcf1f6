"""What the plans are: how often inputs are read and rows move."""

import re

from pagemill import schema
from pagemill.operators import attach, outline, sections, spatial
from pagemill.sources import pages


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _count(df, what):
    return len(re.findall(rf"\b{what}\b", _plan(df)))


def _tables(spark, tmp_path):
    blocks = spark.createDataFrame([(1, f"b{i}", i % 2, i // 2, "text", "word " * 50, "T" if i % 3 == 0 else None, None) for i in range(20)], schema.BLOCK)
    blocks.write.parquet(str(tmp_path / "blocks"))
    entries = spark.createDataFrame([(1, 0, "t", None, 0)], schema.OUTLINE_ENTRY)
    outline.tree(entries).write.parquet(str(tmp_path / "outline"))
    return spark.read.parquet(str(tmp_path / "blocks")), spark.read.parquet(str(tmp_path / "outline"))


def test_text_is_read_once_and_moves_twice(spark, tmp_path):
    blocks, tree = _tables(spark, tmp_path)
    made = attach.text_blocks(blocks, tree)
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", _plan(made))
    assert sum("text#" in s for s in scans) == 1, "the other reads are of keys and titles"
    moved = sum("text#" in s for s in re.findall(r"(?:Exchange|REPARTITION)[^\n]*\n[^\n]*", _plan(made)))
    assert _count(made, "SortMergeJoin") <= 2 and moved <= 2
    found = sections.sections(made)
    # the blocks were written once; rows meet by run, summaries by document, texts by run and by section
    assert _count(found, "Exchange") <= 6 and _count(found, "ArrowEvalPython") == 0 and _count(found, "SortMergeJoin") == 0


def test_cleaning_runs_once(spark, tmp_path):
    blocks, tree = _tables(spark, tmp_path)
    assert _count(attach.text_blocks(blocks, tree), "ArrowEvalPython") == 1
    assert _count(attach.table_blocks(blocks, tree), "ArrowEvalPython") == 0


def test_first_matches_aggregates_regions_only(spark, tmp_path):
    spark.createDataFrame([(1, 0, 0, "a", 9.0, 0, 0, 10, 10)], schema.SPAN).write.parquet(str(tmp_path / "spans"))
    spark.createDataFrame([(1, 0, 0, "table", 0.9, 0, 0, 5, 10)], schema.LAYOUT).write.parquet(str(tmp_path / "layout"))
    made = spatial.first_matches(spark.read.parquet(str(tmp_path / "spans")), spark.read.parquet(str(tmp_path / "layout")))
    keys = re.findall(r"Aggregate\(keys=\[([^\]]*)\]", _plan(made))
    assert keys and not any("text#" in k or "size#" in k for k in keys)
    assert made.select("label", "table_idx").first() == ("table", 0)


def test_a_file_is_opened_once_for_a_range_of_pages(spark, tmp_path):
    noted = str(tmp_path / "opened")

    def renderer():
        with open(noted, "a") as f:
            f.write("x")

        class One:
            def page_count(self, content):
                return len(content)

            def render(self, content, page_index, dpi):
                return 1, 1, content[page_index : page_index + 1]

        return One()

    files = spark.createDataFrame([(1, bytearray(b"abcdefg")), (2, bytearray(b"xy"))], "doc_id bigint, content binary")
    done = spark.createDataFrame([(2, 0), (2, 1)], "doc_id bigint, page_index int")
    made = pages.render_pages(files, renderer, done, range_pages=3)
    got = {(r.doc_id, r.page_index): r.image and bytes(r.image) for r in made.collect()}
    assert got == {**{(1, i): b"abcdefg"[i : i + 1] for i in range(7)}, (2, 0): None, (2, 1): None}


def test_empty_tables(spark):
    none = lambda ddl: spark.createDataFrame([], ddl)
    tree = outline.tree(none(schema.OUTLINE_ENTRY))
    assert tree.count() == 0 and attach.text_blocks(none(schema.BLOCK), tree).count() == 0
    assert sections.sections(attach.text_blocks(none(schema.BLOCK))).count() == 0
    assert spatial.first_matches(none(schema.SPAN), none(schema.LAYOUT)).count() == 0
