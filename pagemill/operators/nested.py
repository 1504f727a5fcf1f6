"""Columnar shredding of nested records into related flat tables.

A nested column is cut into leaf columns. Every slot of a leaf carries a repetition level (the depth
of the list that continues at this slot, 0 at the start of a record) and a definition level (how much
of the path is there). The flat table of any repeated ancestor is then rebuilt from these two level
sequences alone: its rows, their positions and the position of the parent.

Two shredders feed the same rebuild step:

* :func:`shred_arrow` for columns with a schema (lists, maps and structs to any depth), vectorised
  over the offsets of an Arrow batch;
* :func:`shred_outline` for recursive JSON outlines, whose list nests in itself; the leaf path is
  ``children*.title`` and the definition level of a slot is the depth of its node.

Defined results: null, empty and malformed records give no rows; null and empty lists and maps give
no rows; null elements of a list are rows (they have a position); equal records give equal rows, and
the queries return distinct rows. Extra columns are ignored; the key columns are named by the caller.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys under which an outline record may keep its top list.
TOP_KEYS = ("toc", "outline", "entries", "nodes", "items", "children")


@dataclass
class Leaf:
    """One leaf column: levels of every slot, and where its value lies in ``values`` (-1: absent)."""

    path: str
    rep: np.ndarray
    definition: np.ndarray
    index: np.ndarray
    values: pa.Array | None
    #: definition level from which on an element of the k-th list (from 1) of the path exists
    exists_at: list[int]


def shred_arrow(array: pa.Array, path: str) -> list[Leaf]:
    """Leaves of one Arrow column with the levels of every slot."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    n = len(array)
    zeros = np.zeros(n, np.int32)
    return list(_shred(array, path, zeros, zeros.copy(), np.arange(n), 0, []))


def _valid(array: pa.Array, index: np.ndarray) -> np.ndarray:
    there = index >= 0
    ok = np.asarray(array.is_valid()) if len(array) else np.zeros(0, bool)
    out = np.zeros(len(index), bool)
    out[there] = ok[index[there]]
    return out


def _shred(array: pa.Array, path: str, rep: np.ndarray, definition: np.ndarray, index: np.ndarray, level: int, exists: list[int]) -> Iterator[Leaf]:
    kind = array.type
    valid = _valid(array, index)
    if pa.types.is_list(kind) or pa.types.is_large_list(kind) or pa.types.is_map(kind):
        offsets = np.asarray(array.offsets)
        count = np.zeros(len(index), np.int64)
        count[valid] = offsets[index[valid] + 1] - offsets[index[valid]]
        slots = np.maximum(count, 1)
        owner = np.repeat(np.arange(len(index)), slots)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(slots) - slots, slots)
        full = count[owner] > 0
        new_rep = np.where(within > 0, level + 1, rep[owner]).astype(np.int32)
        # null list: as before; empty list: one more; element: two more
        new_def = definition[owner] + np.where(full, 2, valid[owner].astype(np.int32))
        new_index = np.where(full, np.where(index[owner] >= 0, offsets[np.maximum(index[owner], 0)], 0) + within, -1)
        deeper = [*exists, (exists[-1] if exists else 0) + 2]
        if pa.types.is_map(kind):
            yield from _shred(array.keys, f"{path}.key", new_rep, new_def, new_index, level + 1, deeper)
            yield from _shred(array.items, f"{path}.value", new_rep, new_def, new_index, level + 1, deeper)
        else:
            yield from _shred(array.values, f"{path}.element", new_rep, new_def, new_index, level + 1, deeper)
    elif pa.types.is_struct(kind):
        inner = np.where(valid, index, -1)
        for i, field in enumerate(kind):
            yield from _shred(array.field(i), f"{path}.{field.name}", rep, definition, inner, level, exists)
    else:
        yield Leaf(path, rep, definition + valid, index, array, exists)


def rebuild(leaf: Leaf, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the ``depth``-th repeated ancestor (from 1) of a leaf.

    Returns slot, record, parent position and own position of every row, all from the levels: a slot
    opens a row iff no deeper list continues there and the element is defined.
    """
    record = np.cumsum(leaf.rep == 0) - 1
    opens = (leaf.rep <= depth) & (leaf.definition >= leaf.exists_at[depth - 1])
    slot = np.flatnonzero(opens)
    own = _positions(leaf, depth)
    parent = _positions(leaf, depth - 1) if depth > 1 else record
    return slot, record[slot], parent[slot], own[slot]


def _positions(leaf: Leaf, depth: int) -> np.ndarray:
    """Position, within its list, of the ``depth``-th list's element at every slot."""
    step = leaf.rep == depth
    restart = leaf.rep < depth
    total = np.cumsum(step)
    base = np.maximum.accumulate(np.where(restart, total, 0)) if len(total) else total
    return total - base


def outline_top(value: Any) -> list:
    """Top nodes of an outline record in any of its shapes."""
    for _ in range(2):
        if isinstance(value, str):
            try:
                value = json.loads(value)
            except (ValueError, RecursionError):
                return []
    if isinstance(value, list):
        return value
    if isinstance(value, dict):
        if "title" in value:
            return [value]
        for key in TOP_KEYS:
            if isinstance(value.get(key), (list, dict)):
                inner = value[key]
                return inner if isinstance(inner, list) else outline_top(inner)
        for inner in value.values():
            if isinstance(inner, list):
                return inner
    return []


def _children(node: Any) -> list:
    inner = node.get("children") if isinstance(node, dict) else None
    if isinstance(inner, list):
        return inner
    return [inner] if isinstance(inner, dict) else []


def shred_outline(record: str | None) -> tuple[list[int], list[int], list[dict]]:
    """Repetition levels, definition levels and nodes of one outline, in reading order.

    Depth counts from 1. A node that continues its list repeats at its own depth; a first child
    repeats where its parent did, as in the unrolled leaf path. An explicit stack keeps deep outlines
    off the call stack. Null nodes are left out; a bare string is a node with that title.
    """
    rep: list[int] = []
    definition: list[int] = []
    nodes: list[dict] = []
    stack = [(iter(outline_top(record)), 1, 0)]
    while stack:
        siblings, depth, first_rep = stack[-1]
        node = next(siblings, _END)
        if node is _END:
            stack.pop()
            continue
        if not isinstance(node, (dict, str)):
            continue
        stack[-1] = (siblings, depth, depth)
        rep.append(first_rep)
        definition.append(depth)
        nodes.append(node if isinstance(node, dict) else {"title": node})
        inner = _children(node)
        if inner:
            stack.append((iter(inner), depth + 1, first_rep))
    return rep, definition, nodes


_END = object()


def outline_parents(definition: list[int]) -> list[int]:
    """Parent position of every node from the definition levels alone (-1: top node)."""
    last: list[int] = []
    out = []
    for position, depth in enumerate(definition):
        del last[depth - 1 :]
        out.append(last[-1] if last else -1)
        last.append(position)
    return out


_NODE_SCHEMA = "book_id bigint, record_id string, position int, parent_position int, depth int, repetition int, title string, level string, page_start string"


def outline_nodes(tocs: DataFrame, key: str = "toc_id", book: str = "book_id", value: str = "toc_json") -> DataFrame:
    """Flat table of outline nodes, each with its position and its parent's position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("book_id", pa.int64()), ("record_id", pa.string()), ("position", pa.int32()), ("parent_position", pa.int32()), ("depth", pa.int32()), ("repetition", pa.int32()), ("title", pa.string()), ("level", pa.string()), ("page_start", pa.string())])
        for batch in batches:
            out: list[tuple] = []
            for book_id, record_id, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                rep, definition, nodes = shred_outline(text)
                for i, (r, d, parent, node) in enumerate(zip(rep, definition, outline_parents(definition), nodes, strict=True)):
                    out.append((book_id, record_id, i, None if parent < 0 else parent, d, r, _text(node.get("title")), _text(node.get("level")), _text(node.get("page_start"))))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 9, schema, strict=True)], schema=schema)

    return tocs.select(F.col(book).cast("bigint").alias("book_id"), F.col(key).cast("string").alias("record_id"), F.col(value).cast("string").alias("v")).mapInArrow(run, _NODE_SCHEMA)


def _text(value: Any) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False)


def _arrow_rows(path_of: str, depth: int, with_value: bool):
    """mapInArrow body: rows of the ``depth``-th list of leaf ``path_of`` of the last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            leaves = {x.path: x for x in shred_arrow(column, "v")}
            leaf = leaves[path_of]
            slot, record, parent, own = rebuild(leaf, depth)
            names, arrays = ["book_id", "record_id", "parent_position", "position"], [batch.column(0).take(pa.array(record)), batch.column(1).take(pa.array(record)), pa.array(parent.astype(np.int32)), pa.array(own.astype(np.int32))]
            if with_value:
                for name, x in (("key", leaf), ("value", leaves.get(path_of.rsplit(".", 1)[0] + ".value", leaf))):
                    at = x.index[slot]
                    arrays.append(x.values.take(pa.array(at, mask=at < 0)).cast(pa.string()))
                    names.append(name)
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def _nested(df: DataFrame, book: str, key: str, column: str | Column) -> DataFrame:
    return df.select(F.col(book).cast("bigint").alias("book_id"), F.col(key).cast("string").alias("record_id"), (F.col(column) if isinstance(column, str) else column).alias("v"))


def list_elements(df: DataFrame, column: str = "columns", key: str = "table_id", book: str = "book_id") -> DataFrame:
    """Elements of a list of strings: (book_id, record_id, position, value)."""
    out = _nested(df, book, key, column).mapInArrow(_arrow_rows("v.element", 1, True), "book_id bigint, record_id string, parent_position int, position int, key string, value string")
    return out.select("book_id", "record_id", "position", "value")


def map_rows(df: DataFrame, column: str = "rows", key: str = "table_id", book: str = "book_id") -> DataFrame:
    """Rows of a list of maps, also empty and null ones: (book_id, record_id, position)."""
    out = _nested(df, book, key, column).mapInArrow(_arrow_rows("v.element.key", 1, False), "book_id bigint, record_id string, parent_position int, position int")
    return out.select("book_id", "record_id", "position")


def map_cells(df: DataFrame, column: str = "rows", key: str = "table_id", book: str = "book_id") -> DataFrame:
    """Cells of a list of maps: (book_id, record_id, row_position, position, key, value)."""
    out = _nested(df, book, key, column).mapInArrow(_arrow_rows("v.element.key", 2, True), "book_id bigint, record_id string, parent_position int, position int, key string, value string")
    return out.withColumnRenamed("parent_position", "row_position")


def _table_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of columns, rows and cells from one pass over (book_id, record_id, columns, rows)."""
    for batch in batches:
        books, ids = batch.column(0), batch.column(1)
        parts: list[list[pa.Array]] = []

        def add(link: str, record: np.ndarray, parent: pa.Array | None, child: pa.Array, books=books, ids=ids, parts=parts) -> None:
            at = pa.array(record)
            named = ids.take(at)
            parts.append([books.take(at), named, pa.array([link] * len(record), pa.string()), named if parent is None else parent, child])

        number = lambda x: pa.array(x).cast(pa.string())
        column = shred_arrow(batch.column(2), "columns")[0]
        _, record, _, own = rebuild(column, 1)
        add("column", record, None, number(own))
        key = next(x for x in shred_arrow(batch.column(3), "rows") if x.path == "rows.element.key")
        _, record, _, own = rebuild(key, 1)
        add("row", record, None, number(own))
        slot, record, parent, _ = rebuild(key, 2)
        add("cell", record, number(parent), key.values.take(pa.array(key.index[slot])).cast(pa.string()))
        for p in parts:
            yield pa.RecordBatch.from_arrays(p, names=["book_id", "record_id", "link", "parent_key", "child_key"])


def links(tocs: DataFrame, tables: DataFrame) -> DataFrame:
    """All parent-child links: (book_id, record_id, link, parent_key, child_key), distinct."""
    s = lambda c: F.col(c).cast(T.StringType())
    node = outline_nodes(tocs).where("parent_position is not null").select("book_id", "record_id", F.lit("node").alias("link"), s("parent_position").alias("parent_key"), s("position").alias("child_key"))
    source = tables.select(F.col("book_id").cast("bigint").alias("book_id"), F.col("table_id").cast("string").alias("record_id"), "columns", "rows")
    table = source.mapInArrow(_table_links, "book_id bigint, record_id string, link string, parent_key string, child_key string")
    return node.unionByName(table).distinct()
