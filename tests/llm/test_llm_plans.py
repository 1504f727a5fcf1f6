"""What the plans of the training text operators are."""

import re

from pagemill.llm.looks import look_pairs
from pagemill.llm.packing import pack
from pagemill.llm.split import split_oversized


def _count(df, what):
    return len(re.findall(rf"\b{what}\b", df._jdf.queryExecution().executedPlan().toString()))


def test_the_splitter_runs_once_below_a_filter(spark):
    df = spark.createDataFrame([(1, "word " * 900, None)], "id int, text string, headings array<string>")
    assert _count(split_oversized(df).where("n_pieces > 1").select("id").distinct(), "ArrowEvalPython") == 1


def test_pairs_are_joined_without_python_or_text(spark):
    df = spark.createDataFrame([(1, "a", "x", None), (1, "b", "ｘ", None)], "book_id int, block_id string, text string, title string")
    pairs = look_pairs(df)
    assert _count(pairs, "ArrowEvalPython") == 0 and [tuple(r) for r in pairs.collect()] == [(1, "a", "b", "text")]


def test_shards_stay_apart(spark):
    df = spark.createDataFrame([(i, "stone " * 40) for i in range(3000)], "doc_id int, text string")
    packed = pack(df, shard_windows=4)
    assert "REPARTITION_BY_NUM" in packed._jdf.queryExecution().executedPlan().toString()
    assert packed.where("container is null").count() == 0
