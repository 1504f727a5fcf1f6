"""Tables read from block images by a vision model.

The model is a client injected by the caller. Calls run in ``mapInPandas``, one client per worker; the
number of partitions bounds the calls under way. A block whose answers stay invalid gets a status
instead of ending the run; ``strict`` raises instead.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Answer sizes of the attempts, and waits in seconds.
TOKEN_SCHEDULE = (1024, 2048, 4096)
SUCCESS_WAIT, RETRY_WAIT = 4, 3

ANSWER = "columns array<string>, rows array<map<string,string>>, description string"

SYSTEM_PROMPT = """The user sends a picture of one table cut out of a scanned page. Read it into a record.
The record is a JSON object with three fields, and your whole answer is that object:
"description": a string, "columns": an array of strings, "rows": an array of objects with string values.
Every object in "rows" has exactly the names in "columns" as its keys. A cell without ink is "".
Don't guess at what can't be read: leave such a cell "" as well. Names of columns that aren't printed may be made up."""

PROMPT = """Path: %s
Title: %s

The path and the title say where in its document the table stands; use them to name columns without a name.
In "description", tell in one or two sentences what the table is for, what one row is, and what each column holds."""


class RateLimited(Exception):
    """The client was asked to wait."""


class Client(Protocol):
    def ask(self, system: str, prompt: str, image: str | None, max_tokens: int) -> str: ...


def context(toc: Column, title: Column) -> tuple[Column, Column]:
    """The path as text, and the title, ``None`` where there is none."""
    return F.array_join(F.coalesce(toc, F.array().cast("array<string>")), " > "), F.coalesce(F.when(title != "", title), F.lit("None"))


def prompt(toc: Column, title: Column) -> Column:
    path, name = context(toc, title)
    return F.format_string(PROMPT, path, name)


def parse_answers(answers: DataFrame, column: str = "answer") -> DataFrame:
    """With description, columns, rows and status (``ok``, ``invalid`` for no JSON, ``not_object``).

    A missing list is an empty one; a null one stays null. Rows that are no objects aren't rows.
    """
    text = F.col(column)
    valid = F.try_parse_json(text).isNotNull()
    is_object = valid & F.trim(text).startswith("{")
    parsed = F.from_json(F.when(is_object, text), ANSWER)
    keys = F.json_object_keys(F.when(is_object, text))
    status = F.when(~F.coalesce(valid, F.lit(False)), "invalid").when(~is_object, "not_object").otherwise("ok")
    rows = answers.withColumn("_p", parsed).withColumn("_k", keys).withColumn("status", status)
    missing = lambda name: (F.col("status") == "ok") & ~F.array_contains("_k", name)
    return rows.select(
        *answers.columns,
        F.col("_p.description").alias("description"),
        F.when(missing("columns"), F.array().cast("array<string>")).otherwise(F.col("_p.columns")).alias("columns"),
        F.when(missing("rows"), F.array().cast("array<map<string,string>>")).otherwise(F.col("_p.rows")).alias("rows"),
        "status",
    )


def ask_with_retries(client: Client, text: str, image: str | None, schedule: tuple[int, ...] = TOKEN_SCHEDULE, wait: Callable[[float], Any] = time.sleep) -> tuple[str | None, str]:
    """The first answer that is JSON, and ``ok``; else the last answer, and ``failed``.

    Waits longer with each attempt after a limit or a broken answer, and once after success. Errors
    other than the limit go to the caller.
    """
    last = None
    for attempt, tokens in enumerate(schedule, 1):
        try:
            last = client.ask(SYSTEM_PROMPT, text, image, tokens)
            json.loads(last)
        except RateLimited:
            wait(RETRY_WAIT * attempt)
            continue
        except (ValueError, TypeError):
            wait(RETRY_WAIT * attempt)
            continue
        wait(SUCCESS_WAIT)
        return last, "ok"
    return last, "failed"


def extract_tables(blocks: DataFrame, client: Callable[[], Client], calls: int | None = None, image: str | None = None, strict: bool = False, wait: Callable[[float], Any] = time.sleep) -> DataFrame:
    """Extracted tables of table blocks (doc_id, block_id, page, toc, title, image_crop).

    ``client`` makes a client in the worker; ``image`` names a column with the picture as base64 text;
    ``calls`` bounds the calls at a time.
    """
    keys = ["doc_id", "block_id"]
    asked = blocks.select(*keys, prompt(F.col("toc"), F.col("title")).alias("prompt"), (F.col(image) if image else F.lit(None).cast("string")).alias("image"))
    if calls:
        asked = asked.repartition(calls)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = client()
        for pdf in parts:
            found = [ask_with_retries(one, p, i, wait=wait) for p, i in zip(pdf["prompt"], pdf["image"], strict=True)]
            if strict and any(s == "failed" for _, s in found):
                raise RuntimeError(f"no valid answer for {pdf['block_id'][[s == 'failed' for _, s in found]].tolist()}")
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "block_id": pdf["block_id"], "answer": [a for a, _ in found]})

    answers = parse_answers(asked.mapInPandas(run, "doc_id bigint, block_id string, answer string"))
    out = blocks.join(answers, keys)
    return out.select("doc_id", F.col("block_id").alias("table_id"), "toc", "title", "page", "description", "columns", "rows", "image_crop", "status")


def table_cells(tables: DataFrame) -> DataFrame:
    """(doc_id, table_id, row, column, value): every cell of every extracted table."""
    rows = tables.select("doc_id", "table_id", F.posexplode("rows").alias("row", "r"))
    return rows.select("doc_id", "table_id", "row", F.explode("r").alias("column", "value"))
