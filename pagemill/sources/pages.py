"""Sources of pages, positioned text and regions.

Rendering, recognition and detection are injected: a provider is made once per Python worker by calling
the given factory. No library for them is needed here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill import schema
from pagemill.functions.geometry import to_pixels
from pagemill.functions.text import is_blank, strip
from pagemill.schema import NOISE_LABELS


#: Bytes of page images a worker holds before it hands them on.
BATCH_BYTES = 32 << 20


class Renderer(Protocol):
    def page_count(self, content: bytes) -> int: ...

    def render(self, content: bytes, page_index: int, dpi: int) -> tuple[int, int, bytes]: ...


def page_manifest(documents: DataFrame, image_dir: str = "pages", dpi: int = 300) -> DataFrame:
    """One row per page of (doc_id, page_count): index from 0, and the image path with the number from 1."""
    pages = documents.where("page_count > 0").select("doc_id", F.explode(F.sequence(F.lit(0), F.col("page_count").cast("int") - 1)).alias("page_index"))
    return pages.select("doc_id", "page_index", F.lit(dpi).alias("dpi"), F.concat(F.lit(image_dir + "/"), F.format_string("page_%04d.png", F.col("page_index") + 1)).alias("image_path"))


def render_pages(files: DataFrame, renderer: Callable[[], Renderer], done: DataFrame | None = None, image_dir: str = "pages", dpi: int = 300, range_pages: int = 64) -> DataFrame:
    """Pages with size and image bytes from (doc_id, content). Pages in ``done`` (doc_id, page_index) come without.

    A file goes to the workers once for each ``range_pages`` pages that have any page to render, and a
    worker opens it for that range and hands on its pages before they exceed ``BATCH_BYTES`` by more than one.
    """

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = None
        for pdf in parts:
            one = one or renderer()
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "page_count": [one.page_count(c) for c in pdf["content"]]})

    manifest = page_manifest(files.select("doc_id", "content").mapInPandas(count, "doc_id bigint, page_count int"), image_dir, dpi)
    cached = manifest.limit(0)
    due = manifest
    if done is not None:
        due = manifest.join(done.select("doc_id", "page_index"), ["doc_id", "page_index"], "left_anti")
        cached = manifest.join(done.select("doc_id", "page_index").distinct(), ["doc_id", "page_index"], "left_semi")

    def render(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one, rows, size = None, [], 0
        names = ["doc_id", "page_index", "dpi", "image_path", "width", "height", "image"]
        for pdf in parts:
            for doc, content, pages in zip(pdf["doc_id"], pdf["content"], pdf["_pages"], strict=True):
                one = one or renderer()
                for page, path in sorted((p["page_index"], p["image_path"]) for p in pages):
                    width, height, image = one.render(content, page, dpi)
                    rows.append((doc, page, dpi, path, width, height, image))
                    size += len(image)
                    if size >= BATCH_BYTES or len(rows) >= 1000:
                        yield pd.DataFrame(rows, columns=names)
                        rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names)

    ranges = due.groupBy("doc_id", F.floor(F.col("page_index") / range_pages).alias("_range")).agg(F.collect_list(F.struct("page_index", "image_path")).alias("_pages"))
    fresh = files.select("doc_id", "content").join(ranges, "doc_id").mapInPandas(render, "doc_id bigint, page_index int, dpi int, image_path string, width int, height int, image binary")
    none = lambda t: F.lit(None).cast(t)
    return fresh.unionByName(cached.withColumns({"width": none("int"), "height": none("int"), "image": none("binary")})).select("doc_id", "page_index", "width", "height", "dpi", "image_path", "image")


def unnest_spans(raw: DataFrame, dpi: int = 300) -> DataFrame:
    """Spans from nested recognition results (schema.RAW_PAGE), in pixels; font sizes stay in points.

    Blocks that hold no text (type other than 0) and blank spans are left out; ``region_idx`` counts the
    spans that are left, in the order of the result.
    """
    lines = raw.select("doc_id", "page_index", F.posexplode("blocks").alias("b", "block")).where("block.type = 0").select("doc_id", "page_index", "b", F.posexplode("block.lines").alias("l", "line"))
    spans = lines.select("doc_id", "page_index", "b", "l", F.posexplode("line.spans").alias("s", "span")).withColumn("text", strip(F.col("span.text"))).where(~is_blank(F.col("text")))
    order = F.row_number().over(Window.partitionBy("doc_id", "page_index").orderBy("b", "l", "s")) - 1
    at = lambda i: to_pixels(F.col("span.bbox")[i], dpi)
    return spans.select("doc_id", "page_index", order.alias("region_idx"), "text", F.col("span.size").alias("size"), at(0).alias("x0"), at(1).alias("y0"), at(2).alias("x1"), at(3).alias("y1"))


def _seen(pages: DataFrame, looker: Callable[[], Callable[[bytes | None, str], list]], column: str, kind: str) -> DataFrame:
    """What an injected ``f(image, path) -> list`` says of each page; made once per worker that has any page."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = None
        for pdf in parts:
            images = pdf["image"] if "image" in pdf else [None] * len(pdf)
            said = []
            for image, path in zip(images, pdf["image_path"], strict=True):
                one = one or looker()
                said.append(one(image, path) or [])
            yield pdf[["doc_id", "page_index"]].assign(**{column: said})

    return pages.mapInPandas(run, kind)


def recognise_raw(pages: DataFrame, recogniser: Callable[[], Callable[[bytes | None, str], list]]) -> DataFrame:
    """Nested recognition results (schema.RAW_PAGE) of pages, a row also for pages without text."""
    return _seen(pages, recogniser, "blocks", schema.RAW_PAGE)


def recognise(pages: DataFrame, recogniser: Callable[[], Callable[[bytes | None, str], list]], dpi: int = 300) -> DataFrame:
    """Spans of pages from an injected recogniser ``f(image, path) -> blocks``."""
    return unnest_spans(recognise_raw(pages, recogniser), dpi)


def keep_regions(regions: DataFrame, min_confidence: float = 0.5) -> DataFrame:
    """Regions of enough confidence, and all regions of noise, which is dropped by label later."""
    return regions.where((F.col("confidence") >= min_confidence) | F.col("label").isin(*NOISE_LABELS))


def detect_raw(pages: DataFrame, detector: Callable[[], Callable[[bytes | None, str], list]]) -> DataFrame:
    """All boxes of pages (schema.RAW_LAYOUT) as detected, a row also for pages without any."""
    return _seen(pages, detector, "boxes", schema.RAW_LAYOUT)


def regions_of(raw: DataFrame, min_confidence: float = 0.5) -> DataFrame:
    """Layout regions of enough confidence from detected boxes.

    ``layout_idx`` counts the regions that were kept, in the order of the result.
    """
    found = raw.select("doc_id", "page_index", F.posexplode("boxes").alias("i", "box"))
    at = lambda i: F.col("box.coordinate")[i].cast("int")
    rows = keep_regions(found.select("doc_id", "page_index", "i", F.col("box.label").alias("label"), F.col("box.score").alias("confidence"), at(0).alias("x0"), at(1).alias("y0"), at(2).alias("x1"), at(3).alias("y1")), min_confidence)
    order = F.row_number().over(Window.partitionBy("doc_id", "page_index").orderBy("i")) - 1
    return rows.select("doc_id", "page_index", order.alias("layout_idx"), "label", "confidence", "x0", "y0", "x1", "y1")


def detect(pages: DataFrame, detector: Callable[[], Callable[[bytes | None, str], list]], min_confidence: float = 0.5) -> DataFrame:
    """Layout regions of pages from an injected detector ``f(image, path) -> [{score, label, coordinate}]``."""
    return regions_of(detect_raw(pages, detector), min_confidence)


def read_images(spark: SparkSession, path: str, pattern: str = "*.png") -> DataFrame:
    """(path, image): files as bytes. Raises when the folder has none."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return found.select("path", F.col("content").alias("image"))


def require_images(pages: DataFrame, images: DataFrame) -> DataFrame:
    """Pages with their image; a page whose image is missing or empty ends the query with its path."""
    joined = pages.join(images.withColumnRenamed("path", "image_path"), "image_path", "left")
    missing = F.col("image").isNull() | (F.length("image") == 0)
    checked = F.when(missing, F.raise_error(F.concat(F.lit("no image at "), "image_path"))).otherwise(F.col("image"))
    return joined.withColumn("image", checked)


def load_images(pages: DataFrame, root: str, spend: bool = False) -> DataFrame:
    """Pages with their image, each read from its ``image_path`` under ``root``, of the file systems of ``records.put_images``.

    A page whose image is missing or empty ends the query with its path. The files are opened by the workers
    by their names: no folder is listed, and neither images nor pages are shuffled. A worker hands on images
    before they exceed ``BATCH_BYTES`` by more than one.

    With ``spend``, for rows as ``put_images(apart=True)`` hands them on, the first folder of ``image_path`` is
    deleted when the rows go on to another: the disk holds a few batches of files, however many pages there are.
    """

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(root)
        base, last = base.rstrip("/"), None
        for batch in batches:
            images, size, done = [], 0, 0
            for path in batch.column("image_path").to_pylist():
                try:
                    with files.open_input_file(f"{base}/{path}") as one:
                        image = one.readall()
                except FileNotFoundError:
                    image = b""
                if not image:
                    raise FileNotFoundError(f"no image at {path}")
                if spend and (first := path.partition("/")[0]) != last:
                    if last:
                        files.delete_dir(f"{base}/{last}")
                    last = first
                images.append(image)
                size += len(image)
                if size >= BATCH_BYTES or done + len(images) == batch.num_rows:
                    part = batch.slice(done, len(images))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(images, pa.binary())], names=[*batch.schema.names, "image"])
                    images, size, done = [], 0, done + len(images)
        if last:
            files.delete_dir(f"{base}/{last}")

    return pages.mapInArrow(load, T.StructType([*pages.schema.fields, T.StructField("image", T.BinaryType())]))
