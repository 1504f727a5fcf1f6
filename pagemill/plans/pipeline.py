"""Whole runs: ingestion of documents, the contents page by itself, and inspection of a page."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.functions.text import base64_of
from pagemill.operators import assembly, attach, ordering, outline, overlay, sections, spatial, tables
from pagemill.sources import pages, records


@dataclass(frozen=True)
class Settings:
    """What a run depends on. Pages count from 1 here, as people count them."""

    dpi: int = 300
    columns: int = 2
    min_confidence: float = 0.8
    min_overlap: float = 0.3
    prose_font: float | None = 9.0
    contents_page: int | None = 2
    skipped_pages: tuple[int, ...] = ()
    image_dir: str = "pages"
    crop_dir: str = "crops"

    def fingerprint(self) -> str:
        """Short name of these settings, to tell results of other settings apart."""
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()[:16]


@dataclass
class Providers:
    """Factories of what isn't part of this library; each is called once per Python worker."""

    renderer: Callable | None = None
    recogniser: Callable | None = None
    detector: Callable | None = None
    table_client: Callable | None = None
    cropper: Callable | None = None
    wait: Callable = field(default=tables.time.sleep)


def contents_lines(spans: DataFrame, layout: DataFrame, settings: Settings) -> DataFrame:
    """Lines of the contents page in reading order: those that a content region covers."""
    page = F.col("page_index") == settings.contents_page - 1
    ordered = ordering.reading_order(spans.where(page), settings.columns)
    kept = spatial.content_spans(ordered, layout.where(page), settings.min_overlap)
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("seq")) - 1
    return kept.select("doc_id", place.alias("toc_seq"), "text", "size")


def contents(spans: DataFrame, layout: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The outline of every document from its contents page."""
    return outline.outline(contents_lines(spans, layout, settings or Settings()))


def structure(spans: DataFrame, layout: DataFrame, settings: Settings | None = None, blocks: DataFrame | None = None) -> dict[str, DataFrame]:
    """blocks, outline, text_blocks, table_blocks and sections of all documents.

    ``blocks`` may be given as read back from an earlier run.
    """
    s = settings or Settings()
    tree = contents(spans, layout, s) if s.contents_page else None
    made = blocks if blocks is not None else assembly.assemble(spans, layout, s.columns, s.prose_font, s.min_overlap, s.crop_dir)
    texts = attach.text_blocks(made, tree, s.skipped_pages)
    out = {"blocks": made, "text_blocks": texts, "table_blocks": attach.table_blocks(made, tree, s.skipped_pages), "sections": sections.sections(texts)}
    return out | ({"outline": tree} if tree is not None else {})


def page_inputs(files: DataFrame, providers: Providers, settings: Settings, done: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Spans and regions of (doc_id, content); pages in ``done`` (doc_id, page_index) aren't rendered again."""
    rendered = pages.render_pages(files, providers.renderer, done, settings.image_dir, settings.dpi)
    return pages.recognise(rendered, providers.recogniser, settings.dpi), pages.detect(rendered, providers.detector, settings.min_confidence)


class _Store:
    """The tables of one run under its folder. What costs calls of providers is only ever added to."""

    def __init__(self, spark: SparkSession, at: str) -> None:
        self.spark, self.at = spark, at

    def has(self, name: str) -> bool:
        return records.exists(self.spark, f"{self.at}/{name}")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.at}/{name}")

    def add(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("append").parquet(f"{self.at}/{name}")
        return self.read(name)

    def rest(self, name: str, work: DataFrame, keys: list[str]) -> DataFrame:
        return records.pending(work, self.read(name), keys) if self.has(name) else work


PAGE = ["doc_id", "page_index"]


def ingest(files: DataFrame, providers: Providers, target: str, settings: Settings | None = None) -> dict[str, DataFrame]:
    """Runs every stage over (doc_id, content) and writes each under ``target``, in a folder of the settings.

    Rendered pages, recognised text, detected boxes, crops and tables are kept by their keys: a run that
    comes again calls the providers only for pages and tables that aren't there, and asks again for tables
    whose answers stayed invalid. Page images and crops are also written as files, ``image_path`` and
    ``image_crop`` below ``doc_<id>``. Needs a ``cropper`` for crops; without one the model gets no picture.
    Returns the written tables.
    """
    s = settings or Settings()
    spark = files.sparkSession
    at = f"{target}/{s.fingerprint()}"
    store = _Store(spark, at)

    known = store.read("pages").select(*PAGE) if store.has("pages") else None
    made = pages.render_pages(files, providers.renderer, known, s.image_dir, s.dpi).where("image is not null")
    rendered = store.add("pages", made)
    _write_files(store, "page_files", rendered, PAGE, "image_path")
    recognised = store.add("recognised", pages.recognise_raw(store.rest("recognised", rendered, PAGE), providers.recogniser))
    detected = store.add("detected", pages.detect_raw(store.rest("detected", rendered, PAGE), providers.detector))

    for name, df in (("spans", pages.unnest_spans(recognised, s.dpi)), ("layout", pages.regions_of(detected, s.min_confidence))):
        df.write.mode("overwrite").parquet(f"{at}/{name}")
    spans, layout = store.read("spans"), store.read("layout")
    shape = (s.columns, s.prose_font, s.min_overlap, s.crop_dir)
    records.write_blocks(assembly.assemble(spans, layout, *shape), f"{at}/blocks", "overwrite")
    blocks = records.read_blocks(spark, f"{at}/blocks")
    blocks.write.mode("overwrite").parquet(f"{at}/current_blocks")
    out = structure(spans, layout, s, store.read("current_blocks"))
    for name in ("text_blocks", "table_blocks", "sections", *(["outline"] if "outline" in out else [])):
        out[name].write.mode("overwrite").parquet(f"{at}/records/{name}")
        out[name] = store.read(f"records/{name}")
        records.write_json(out[name], f"{at}/{name}")
    if "outline" in out:
        records.write_json(outline.nested_json(out["outline"]), f"{at}/toc")

    pictures = None
    if providers.cropper is not None:
        regions = assembly.table_regions(spans, layout, *shape).join(rendered.select(*PAGE, "width", "height"), PAGE)
        due = store.rest("crops", assembly.crop_boxes(regions), ["doc_id", "block_id"])
        pictures = store.add("crops", records.crop_images(due, rendered, providers.cropper))
        _write_files(store, "crop_files", pictures, ["doc_id", "block_id"], "image_crop")
    if providers.table_client is not None:
        out["tables"] = _more_tables(store, out["table_blocks"], pictures, providers)
        records.write_json(out["tables"], f"{at}/tables")
    return out | {"pages": rendered.drop("image")}


def _write_files(store: _Store, name: str, images: DataFrame, keys: list[str], path: str) -> None:
    """Image files that weren't written before, each document in its folder, and a note of them."""
    due = store.rest(name, images, keys)
    named = due.select(F.concat(F.format_string("doc_%d/", "doc_id"), path).alias("image_path"), "image")
    records.write_images(named, store.at)
    store.add(name, due.select(*keys))


def _more_tables(store: _Store, blocks: DataFrame, pictures: DataFrame | None, providers: Providers) -> DataFrame:
    """All tables: those read before, and those asked for now. Each has one row, that of its last attempt."""
    key = ["doc_id", "table_id"]
    due, attempt = blocks, 0
    if store.has("answers"):
        before = store.read("answers")
        due = records.pending(blocks, before.where("status = 'ok'").withColumnRenamed("table_id", "block_id"), ["doc_id", "block_id"])
        attempt = before.agg(F.coalesce(F.max("attempt"), F.lit(0))).first()[0] + 1
    image = None
    if pictures is not None:
        due, image = due.join(pictures.select("doc_id", "block_id", base64_of(F.col("image")).alias("picture")), ["doc_id", "block_id"], "left"), "picture"
    read = tables.extract_tables(due, providers.table_client, image=image, wait=providers.wait)
    answers = store.add("answers", read.withColumn("attempt", F.lit(attempt)))
    # a row of an earlier attempt counts no more, whether it failed or not
    return records.latest(answers, key, "attempt").drop("attempt")


def inspect(spans: DataFrame, detected: DataFrame, doc_id: int, page: int, columns: int = 2, min_confidence: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """What to draw over one page (from 1): its spans with their place in reading order, and its regions.

    ``detected`` holds all boxes as detected, so that a page may be looked at with another confidence than
    it was ingested with.
    """
    one = (F.col("doc_id") == doc_id) & (F.col("page_index") == page - 1)
    s, r = spans.where(one), pages.regions_of(detected.where(one), min_confidence)
    return overlay.order_overlay(s, ordering.reading_order(s, columns)), overlay.layout_overlay(r)
