"""Columns an operator adds beside those of its input."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def make_room(df: DataFrame, added: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with every column that has the name of an added one kept as ``<name>_input``.

    Further underscores follow until the name is free. Names are compared as Spark does, without case.
    Returns the frame and the new names of all columns by their old ones.
    """
    taken = {c.lower() for c in df.columns} | {a.lower() for a in added}
    new: dict[str, str] = {}
    for c in df.columns:
        if c.lower() in {a.lower() for a in added}:
            name = f"{c}_input"
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
            new[c] = name
    return (df.withColumnsRenamed(new) if new else df), {c: new.get(c, c) for c in df.columns}
