"""Filling fixed-capacity containers (problem 6).

Every text is sized in tokens of a public tokenizer and assigned to containers of ``capacity`` tokens.
A text larger than one container, and only such a text, is cut into pieces, all but the last full.

Items are spread by a hash over shards of about ``shard_windows`` containers each; only keys and sizes
are shuffled. Within a shard the items are partitioned by Karmarkar-Karp multiway differencing: each
item starts as a partial partition with one filled window, and the two partial partitions with the
largest spread are merged with opposing imbalances until one is left, which gives windows of nearly
equal size. The number of windows starts at the least that could do and rises whenever the fullest
window exceeds the capacity. Shards are independent tasks of bounded size: a shard holds about
``shard_windows * capacity`` tokens whatever the distribution of texts over sources or languages.

Defined results: a null text has one row with null size and null container; an empty text has size 0
and stands in some container; rows with equal keys are separate items; other columns aren't read.
"""

from __future__ import annotations

import base64
import heapq
import math
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.session import materialize, task_count

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how texts are cut before byte pairs are merged, for vocabularies given as ranks.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LOADED: dict[str, Callable[[list[str]], list[int]]] = {}


def load_tokenizer(path: str) -> Callable[[list[str]], list[int]]:
    """Sizes of texts by a tokenizer from its file, made once per process.

    ``.tiktoken`` files hold ranks of byte pairs, others are files of the ``tokenizers`` library.
    Special tokens in a text count as ordinary text.
    """
    if path not in _LOADED:
        if not Path(path).exists():
            raise FileNotFoundError(f"tokenizer file {path} isn't there on this machine")
        if path.endswith(".tiktoken"):
            import tiktoken

            pairs = (line.split() for line in Path(path).read_bytes().splitlines() if line)
            ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
            encoding = tiktoken.Encoding(Path(path).stem, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            _LOADED[path] = lambda texts: [len(encoding.encode_ordinary(t)) for t in texts]
        else:
            from tokenizers import Tokenizer

            one = Tokenizer.from_file(path)
            one.encode_special_tokens = True
            one.no_truncation()
            _LOADED[path] = lambda texts: [len(e) for e in one.encode_batch_fast(texts, add_special_tokens=False)]
    return _LOADED[path]


def token_count(text: Column, tokenizer: str = TOKENIZER) -> Column:
    """Number of tokens of a text."""

    @F.pandas_udf(T.LongType())
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        one = load_tokenizer(tokenizer)
        for texts in parts:
            sizes: list[int | None] = [None] * len(texts)
            # small batches, so that the encodings of long texts don't pile up
            for i in range(0, len(texts), 64):
                some = [(j, t) for j, t in enumerate(texts.iloc[i : i + 64], i) if t is not None]
                for (j, _), n in zip(some, one([t for _, t in some]), strict=True):
                    sizes[j] = n
            yield pd.Series(sizes, dtype="Int64")

    return count(text)


def differencing(sizes: list[int], windows: int) -> list[int]:
    """Window of every item by multiway differencing into ``windows`` windows.

    A partial partition is a list of its filled windows, largest first, as (sum, items); windows not
    named are empty. Merging pairs the largest of one with the smallest of the other. Item lists are
    joined as a tree of pairs, so a merge costs no more than the windows it touches.
    """
    if not sizes:
        return []
    if windows == 1:
        return [0] * len(sizes)
    heap = [(-size, i, [(size, i)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        room = windows - len(a)
        # b's smallest windows meet a's largest; the windows a leaves empty take b's largest
        kept, meet = b[:room], b[room:]
        alone = len(a) - len(meet)
        merged = [(x + y, (i, j)) for (x, i), (y, j) in zip(a[alone:], reversed(meet), strict=True)]
        merged += a[:alone]
        merged += kept
        merged.sort(key=lambda w: -w[0])
        spread = merged[0][0] - (merged[-1][0] if len(merged) == windows else 0)
        if len(merged) == windows and merged[-1][0] == merged[0][0]:
            spread = 0
        heapq.heappush(heap, (-spread, serial, merged))
        serial += 1
    out = [0] * len(sizes)
    for window, (_, tree) in enumerate(heap[0][2]):
        stack = [tree]
        while stack:
            x = stack.pop()
            if isinstance(x, tuple):
                stack.extend(x)
            else:
                out[x] = window
    return out


def fill(sizes: list[int], capacity: int) -> tuple[list[int], int]:
    """Windows of the items and their number: the least from the sum on that holds them all."""
    windows = max(1, math.ceil(sum(sizes) / capacity))
    while True:
        at = differencing(sizes, windows)
        totals = np.bincount(at, weights=sizes, minlength=windows) if sizes else np.zeros(1)
        if totals.max() <= capacity:
            return at, windows
        windows += 1


def pack(df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = 2048, tokenizer: str = TOKENIZER, shard_windows: int = 256) -> DataFrame:
    """(key, piece_no, start_token, n_tokens, shard, window): where every piece of every text goes."""
    sized = materialize(df.select(F.col(key).cast("string").alias("k"), token_count(F.col(text).cast("string"), tokenizer).alias("n")).withColumn("row", F.monotonically_increasing_id()), "packing-sizes")
    total, items = sized.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("n")).first()
    # by tokens, and by number where most texts are empty or tiny
    shards = max(1, round(total / (capacity * shard_windows)), items // 200_000)
    last = F.greatest(F.ceil(F.col("n") / capacity), F.lit(1)) - 1
    pieces = sized.where("n is not null").withColumn("piece_no", F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))))
    pieces = pieces.withColumn("start_token", F.col("piece_no") * capacity).withColumn("n_tokens", F.least(F.col("n") - F.col("start_token"), F.lit(capacity)))
    # full pieces need no partner: each fills a container of its own
    full = F.col("n_tokens") == capacity
    shard = F.pmod(F.xxhash64("k", "row"), F.lit(shards)).cast("int")
    pieces = pieces.select("k", "row", F.col("piece_no").cast("int").alias("piece_no"), F.col("start_token").cast("bigint").alias("start_token"), F.col("n_tokens").cast("int").alias("n_tokens"), shard.alias("shard"))
    alone = pieces.where(full).select("k", "piece_no", "start_token", "n_tokens", F.lit(-1).alias("shard"), F.concat_ws(":", "k", "row", "piece_no").alias("container"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_tokens", "k", "row", "piece_no"], ascending=[False, True, True, True], kind="stable")
        at, _ = fill(rows["n_tokens"].tolist(), capacity)
        return rows.assign(container=[f"s{s}:{w}" for s, w in zip(rows["shard"], at, strict=True)])[["k", "piece_no", "start_token", "n_tokens", "shard", "container"]]

    # by a number, which Spark doesn't merge however few bytes there are: the work of a shard is in its merging
    parts = min(shards, 4 * task_count(df.sparkSession))
    shared = pieces.where(~full).repartition(parts, "shard").groupBy("shard").applyInPandas(run, "k string, piece_no int, start_token bigint, n_tokens int, shard int, container string")
    without = sized.where("n is null").select("k", F.lit(None).cast("int").alias("piece_no"), F.lit(None).cast("bigint").alias("start_token"), F.lit(None).cast("int").alias("n_tokens"), F.lit(None).cast("int").alias("shard"), F.lit(None).cast("string").alias("container"))
    out = shared.unionByName(alone).unionByName(without)
    return out.withColumn(key, F.col("k").cast(df.schema[key].dataType)).select(key, "piece_no", "start_token", "n_tokens", "shard", "container")
