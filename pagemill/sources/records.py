"""Reading and writing the records of the stages, and resuming where a run stopped."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill import schema


def write_blocks(blocks: DataFrame, path: str, mode: str = "append") -> None:
    """Blocks as JSON, in as many files as the plan has partitions, whatever the number of pages.

    Each writing has its time. A page written again replaces what it had, pages not written now stay.
    """
    now = time.time_ns() // 1000
    blocks.withColumn("written", F.lit(now)).write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """All blocks under a path, each page as it was written last. Order lies in page and order_id, never in file names."""
    rows = spark.read.schema(f"{schema.BLOCK}, written bigint").json(path)
    last = rows.groupBy(F.col("doc_id").alias("_d"), F.col("page").alias("_p")).agg(F.max("written").alias("_w"))
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("page").eqNullSafe(F.col("_p")) & F.col("written").eqNullSafe(F.col("_w"))
    return rows.join(last, same, "left_semi").drop("written")


def latest(df: DataFrame, keys: list[str], by: str) -> DataFrame:
    """One row for each key: that of the greatest ``by``, a null the least; of equal ones some row."""
    rest = [c for c in df.columns if c not in keys]
    found = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(by)).alias("_r"))
    return found.select(*(c if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns))


def read_block_arrays(spark: SparkSession, path: str, doc_id: int = 0) -> DataFrame:
    """Blocks from files that each hold one JSON array, as other tools write them."""
    fields = ", ".join(f for f in schema.BLOCK.split(", ") if not f.startswith("doc_id"))
    return spark.read.schema(fields).option("multiLine", "true").json(path).withColumn("doc_id", F.lit(doc_id).cast("bigint"))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def pending(work: DataFrame, done: DataFrame, keys: list[str], fingerprint: str | None = None) -> DataFrame:
    """Rows whose keys weren't done, or were done under another configuration fingerprint."""
    finished = done if fingerprint is None else done.where(F.col("fingerprint") == fingerprint)
    return work.join(finished.select(*keys), keys, "left_anti")


def resume(work: DataFrame, done: DataFrame, keys: list[str], run) -> DataFrame:
    """Results already there and those of ``run`` over the rest."""
    return done.unionByName(run(pending(work, done, keys)))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, on any file system Spark knows."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def put_images(images: DataFrame, root: str, apart: bool = False) -> DataFrame:
    """``images`` without ``image``, each row handed on when its file is there; rows without image are left out.

    ``image_path`` is the file's place under ``root``, a folder that all workers reach: a path or a URI of any
    file system Arrow knows (``file``, ``hdfs``, ``s3``, ``gs`` ...). Each file appears whole: it is written
    beside its place and moved there. Nothing is written before the rows are asked for.

    ``apart`` gives every batch of rows a folder of its own, which no other task or attempt has and which
    ``image_path`` then begins with, for files that are read once by ``pages.load_images``. Such files are
    known to nobody before their rows are handed on, so they are written at their place.
    """
    rest = [f for f in images.schema.fields if f.name != "image"]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(root)
        own = uuid.uuid4().hex  # no other task has it, nor another attempt at this one
        there: set[str] = set()
        for k, batch in enumerate(batches):
            paths = batch.column("image_path").to_pylist()
            if apart:
                paths = [f"{own}-{k}/{p}" for p in paths]
            for path, image in zip(paths, batch.column("image"), strict=True):
                place = f"{base.rstrip('/')}/{path}"
                folder, _, name = place.rpartition("/")
                if folder not in there:
                    files.create_dir(folder, recursive=True)
                    there.add(folder)
                at = place if apart else f"{folder}/.{name}.{own}"
                with files.open_output_stream(at) as out:
                    out.write(image.as_buffer())
                if not apart:
                    files.move(at, place)
            if apart:
                there.clear()
            columns = [pa.array(paths, pa.string()) if f.name == "image_path" else batch.column(f.name) for f in rest]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in rest])

    return images.where("image is not null").mapInArrow(put, T.StructType(rest))


def write_images(images: DataFrame, root: str) -> None:
    """Writes (image_path, image) as files under a folder that all workers reach, as :func:`put_images` does."""
    put_images(images.select("image_path", "image"), root).write.format("noop").mode("overwrite").save()


def crop_images(boxes: DataFrame, pages: DataFrame, cropper) -> DataFrame:
    """``boxes`` with ``image``: ``cropper() -> f(image, x0, y0, x1, y1) -> bytes``, made once per worker.

    ``boxes`` has doc_id, page_index and crop_x0 .. crop_y1; ``pages`` doc_id, page_index, image. The
    boxes of a page are put together first, so that its image moves and is sent to Python once.
    """
    own = [c for c in boxes.columns if c not in ("doc_id", "page_index")]
    of_page = boxes.groupBy("doc_id", "page_index").agg(F.collect_list(F.struct(*own)).alias("_boxes"))
    kind = T.StructType([*boxes.schema.fields, T.StructField("image", T.BinaryType())])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = None
        for pdf in parts:
            rows = []
            for doc, page, image, found in zip(pdf["doc_id"], pdf["page_index"], pdf["image"], pdf["_boxes"], strict=True):
                one = one or cropper()
                for b in found:
                    cut = one(image, *(b[f"crop_{c}"] for c in ("x0", "y0", "x1", "y1")))
                    rows.append({"doc_id": doc, "page_index": page, **{c: b[c] for c in own}, "image": cut})
            yield pd.DataFrame(rows, columns=kind.names)

    joined = pages.select("doc_id", "page_index", "image").join(of_page, ["doc_id", "page_index"])
    return joined.mapInPandas(run, kind)
