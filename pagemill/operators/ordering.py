"""Reading order of the spans of a page."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions.geometry import column_index, per_mille
from pagemill.operators.spatial import PAGE_KEYS

# Token ids of the order model's input.
FIRST_TOKEN, UNKNOWN_TOKEN, LAST_TOKEN = 0, 3, 2


def page_extent(spans: DataFrame) -> DataFrame:
    """Largest x1 and y1 of every page."""
    return spans.groupBy(*PAGE_KEYS).agg(F.max("x1").alias("max_x"), F.max("y1").alias("max_y"))


def normalized_boxes(spans: DataFrame) -> DataFrame:
    """Boxes in thousandths of the page extent."""
    w = Window.partitionBy(*PAGE_KEYS)
    extent = spans.withColumn("_w", F.max("x1").over(w)).withColumn("_h", F.max("y1").over(w))
    return extent.select(*PAGE_KEYS, "region_idx", *(per_mille(F.col(c), F.col("_w" if c[0] == "x" else "_h")).alias(f"n{c}") for c in ("x0", "y0", "x1", "y1")))


def assign_columns(spans: DataFrame, columns: int = 2) -> DataFrame:
    """Spans with ``col_idx``."""
    if columns < 1:
        raise ValueError("a page has at least one column")
    width = F.max("x1").over(Window.partitionBy(*PAGE_KEYS))
    return spans.withColumn("_w", width).withColumn("col_idx", column_index(F.col("x0"), F.col("x1"), F.col("_w"), columns)).drop("_w")


def reading_order(spans: DataFrame, columns: int = 2) -> DataFrame:
    """Spans with ``seq``: column by column, each from top to bottom, then from left to right.

    Ties keep the order of the regions. Spans whose middle lies left of the page are in no column and
    are left out.
    """
    w = Window.partitionBy(*PAGE_KEYS).orderBy("col_idx", "y0", "x0", "region_idx")
    return assign_columns(spans, columns).where("col_idx >= 0").withColumn("seq", F.row_number().over(w) - 1).drop("col_idx")


def model_inputs(spans: DataFrame) -> DataFrame:
    """One row per page: token ids, attention mask and boxes with an empty box at both ends."""
    boxes = normalized_boxes(spans)
    one = F.array("nx0", "ny0", "nx1", "ny1")
    pages = boxes.groupBy(*PAGE_KEYS).agg(F.array_sort(F.collect_list(F.struct("region_idx", one.alias("box")))).alias("b"))
    n, none = F.size("b"), F.array(F.array(*[F.lit(0)] * 4))
    return pages.select(
        *PAGE_KEYS,
        F.concat(F.array(F.lit(FIRST_TOKEN)), F.array_repeat(F.lit(UNKNOWN_TOKEN), n), F.array(F.lit(LAST_TOKEN))).alias("input_ids"),
        F.array_repeat(F.lit(1), n + 2).alias("attention_mask"),
        F.concat(none, F.transform("b", lambda x: x["box"]), none).alias("bbox"),
    )


def first_choices(scores: DataFrame) -> DataFrame:
    """Position each row likes best; of equal scores the last position."""
    return scores.groupBy(*PAGE_KEYS, "row").agg(F.max_by("col", F.struct("score", "col")).alias("choice"), F.max("score").alias("score"))


def collisions(scores: DataFrame) -> DataFrame:
    """Positions that more than one row likes best, with those rows."""
    found = first_choices(scores).groupBy(*PAGE_KEYS, F.col("choice").alias("position")).agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return found.where(F.size("rows") > 1)


def settle(matrix: list[list[float]]) -> list[int]:
    """A position for each row: every position goes to the row that scores highest on it (the lower row
    of equal ones), and a row that loses its position tries its next best.

    Raises ``ValueError`` when a row has no position left.
    """
    left = [sorted(range(len(row)), key=lambda c, row=row: (row[c], c)) for row in matrix]
    holder: dict[int, int] = {}
    waiting = list(range(len(matrix)))
    heapq.heapify(waiting)
    while waiting:
        row = heapq.heappop(waiting)
        while True:
            if not left[row]:
                raise ValueError(f"row {row} has no position left")
            position = left[row].pop()
            other = holder.get(position)
            if other is None:
                holder[position] = row
                break
            if (matrix[row][position], -row) > (matrix[other][position], -other):
                holder[position] = row
                heapq.heappush(waiting, other)
                break
    out = [0] * len(matrix)
    for position, row in holder.items():
        out[row] = position
    return out


def assign_order(scores: DataFrame) -> DataFrame:
    """Position of each region of a page from its score matrix (page, row, col, score)."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        n = int(rows["row"].max()) + 1
        m = int(rows["col"].max()) + 1
        matrix = [[float("-inf")] * m for _ in range(n)]
        for r, c, s in zip(rows["row"], rows["col"], rows["score"], strict=True):
            matrix[r][c] = s
        return pd.DataFrame({"doc_id": rows["doc_id"].iloc[0], "page_index": rows["page_index"].iloc[0], "region_idx": range(n), "position": settle(matrix)})

    return scores.groupBy(*PAGE_KEYS).applyInPandas(one, "doc_id bigint, page_index int, region_idx int, position int")


def order_by_model(spans: DataFrame, scorer) -> DataFrame:
    """Reading order from a model: ``scorer(boxes) -> matrix`` for the boxes of one page in thousandths.

    The scorer is built once per Python worker by calling it without arguments if it is a class.
    """
    pages = model_inputs(spans)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = scorer() if isinstance(scorer, type) else scorer
        for pdf in parts:
            rows = []
            for doc, page, boxes in zip(pdf["doc_id"], pdf["page_index"], pdf["bbox"], strict=True):
                inner = [list(b) for b in boxes][1:-1]
                matrix = model(inner)
                rows += [(doc, page, i, p) for i, p in enumerate(settle([list(r)[: len(inner)] for r in matrix]))]
            yield pd.DataFrame(rows, columns=["doc_id", "page_index", "region_idx", "position"])

    return pages.mapInPandas(run, "doc_id bigint, page_index int, region_idx int, position int")
