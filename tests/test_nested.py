import json

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.operators import nested

TABLES = "book_id bigint, table_id string, columns array<string>, rows array<map<string,string>>, position int, key string"


def test_outline_shapes():
    nodes = [{"title": "a", "children": [{"title": "b", "children": {"title": "c"}}, {"title": "d", "children": None}]}, "e"]
    for record in (nodes, {"toc": nodes}, json.dumps(nodes)):
        rep, definition, found = nested.shred_outline(json.dumps(record))
        assert [n["title"] for n in found] == ["a", "b", "c", "d", "e"]
        assert definition == [1, 2, 3, 2, 1] and rep == [0, 0, 0, 2, 1]
        assert nested.outline_parents(definition) == [-1, 0, 1, 0, -1]
    for empty in (None, "", "nonsense", "[]", "{}", "3", "null", "[null, 7]"):
        assert nested.shred_outline(empty) == ([], [], [])
    assert [n["title"] for n in nested.shred_outline('{"title": "only"}')[2]] == ["only"]
    assert nested.shred_outline('[{"title": "x", "meta": {"children": [{"title": "no"}]}}]')[1] == [1]


def test_deep_outline():
    node = {"title": "leaf"}
    for i in range(400):
        node = {"title": str(i), "children": [node]}
    definition = nested.shred_outline(json.dumps([node]))[1]
    assert definition == list(range(1, 402)) and nested.outline_parents(definition) == list(range(-1, 400))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.one_of(st.none(), st.dictionaries(st.sampled_from("abc"), st.one_of(st.none(), st.text(max_size=2)), max_size=3)), max_size=4)), max_size=6))
def test_levels_give_back_the_rows(records):
    array = pa.array([None if r is None else [None if m is None else list(m.items()) for m in r] for r in records], pa.list_(pa.map_(pa.string(), pa.string())))
    leaves = {x.path: x for x in nested.shred_arrow(array, "v")}
    keys, values = leaves["v.element.key"], leaves["v.element.value"]
    slot, record, _, own = nested.rebuild(keys, 1)
    assert list(zip(record.tolist(), own.tolist(), strict=True)) == [(i, j) for i, r in enumerate(records) for j in range(len(r or []))]
    slot, record, parent, own = nested.rebuild(keys, 2)
    got = [(r, p, o, keys.values[k].as_py(), values.values[v].as_py()) for r, p, o, k, v in zip(record.tolist(), parent.tolist(), own.tolist(), keys.index[slot].tolist(), values.index[slot].tolist(), strict=True)]
    assert got == [(i, j, k, key, value) for i, r in enumerate(records) for j, m in enumerate(r or []) for k, (key, value) in enumerate((m or {}).items())]


def test_struct_in_list():
    array = pa.array([[{"a": 1, "b": ["x", "y"]}, None], [], None, [{"a": None, "b": None}]], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.list_(pa.string()))])))
    leaves = {x.path: x for x in nested.shred_arrow(array, "v")}
    slot, record, _, own = nested.rebuild(leaves["v.element.a"], 1)
    assert list(zip(record.tolist(), own.tolist(), strict=True)) == [(0, 0), (0, 1), (3, 0)]
    slot, record, parent, own = nested.rebuild(leaves["v.element.b.element"], 2)
    assert list(zip(record.tolist(), parent.tolist(), own.tolist(), strict=True)) == [(0, 0, 0), (0, 0, 1)]


def test_links(spark):
    tocs = spark.createDataFrame([("t", 1, '[{"title": "a", "children": [{"title": "b"}]}]'), ("t", 1, '[{"title": "a", "children": [{"title": "b"}]}]'), ("u", None, None)], "toc_id string, book_id bigint, toc_json string")
    rows = [(1, "x", ["A", None], [{"A": "1", "Z": None}, {}, None], 5, "k"), (1, "x", ["A", None], [{"A": "1", "Z": None}, {}, None], 5, "k"), (2, "y", None, None, None, None), (3, "z", [], [], 1, "")]
    got = {tuple(r) for r in nested.links(tocs, spark.createDataFrame(rows, TABLES)).collect()}
    assert got == {(1, "t", "node", "0", "1"), (1, "x", "column", "x", "0"), (1, "x", "column", "x", "1"), (1, "x", "row", "x", "0"), (1, "x", "row", "x", "1"), (1, "x", "row", "x", "2"), (1, "x", "cell", "0", "A"), (1, "x", "cell", "0", "Z")}
    assert nested.links(tocs.limit(0), spark.createDataFrame([], TABLES)).count() == 0
