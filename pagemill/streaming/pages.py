"""Blocks from a stream of pages.

Page-local stages run on each micro-batch; the batch is written under its own number, so a batch that
runs again after a failure replaces what it wrote. Stages over whole documents need all their pages in
order and run in batch over the documents that changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagemill import schema
from pagemill.operators.assembly import assemble
from pagemill.operators.attach import text_blocks
from pagemill.operators.sections import sections

_SPANS = "array<struct<region_idx:int,text:string,size:double,x0:int,y0:int,x1:int,y1:int>>"
_REGIONS = "array<struct<layout_idx:int,label:string,confidence:double,x0:int,y0:int,x1:int,y1:int>>"
PAGE_RECORD = f"doc_id bigint, page_index int, spans {_SPANS}, regions {_REGIONS}"


def page_records(spans: DataFrame, layout: DataFrame) -> DataFrame:
    """One record per page with its spans and regions, as the stream carries them."""
    keys = ["doc_id", "page_index"]
    s = spans.groupBy(*keys).agg(F.collect_list(F.struct("region_idx", "text", "size", "x0", "y0", "x1", "y1")).alias("spans"))
    r = layout.groupBy(*keys).agg(F.collect_list(F.struct("layout_idx", "label", "confidence", "x0", "y0", "x1", "y1")).alias("regions"))
    return s.join(r, keys, "left")


def blocks_of(records: DataFrame, **options) -> DataFrame:
    """Blocks of page records. A page that comes again in a batch counts once."""
    once = records.dropDuplicates(["doc_id", "page_index"])
    spans = once.select("doc_id", "page_index", F.inline("spans"))
    layout = once.select("doc_id", "page_index", F.inline("regions"))
    return assemble(spans, layout, **options)


def stream_blocks(spark: SparkSession, source: str, target: str, checkpoint: str, **options) -> StreamingQuery:
    """Reads page records (JSON) from ``source`` until none is left, and writes blocks to ``target``."""

    def write(batch: DataFrame, number: int) -> None:
        blocks_of(batch, **options).withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)

    pages = spark.readStream.schema(PAGE_RECORD).json(source)
    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_blocks(spark: SparkSession, target: str) -> DataFrame:
    """Blocks as the latest batch of each page has them."""
    rows = spark.read.parquet(target)
    latest = rows.groupBy("doc_id", "page").agg(F.max("batch").alias("batch"))
    return rows.join(latest, ["doc_id", "page", "batch"], "left_semi").drop("batch")


def refresh_sections(blocks: DataFrame, changed: DataFrame, outline: DataFrame | None = None) -> DataFrame:
    """Sections of the documents in ``changed`` (doc_id), from all their blocks."""
    return sections(text_blocks(blocks.join(changed.select("doc_id").distinct(), "doc_id", "left_semi"), outline))
