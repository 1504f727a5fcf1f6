"""Session-level helpers: the shared folder, lineage cuts and table access."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_OWN_DIR: dict[str, str] = {}
_SHIPPED: set[str] = set()
_LEAVES: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset (local tests) a
    temporary folder of this machine is used, which local mode shares by nature.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    key = spark.sparkContext.applicationId
    if key not in _OWN_DIR:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        _OWN_DIR[key] = "file://" + tempfile.mkdtemp(prefix="pagemill-")
    return _OWN_DIR[key]


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers, once, unless their PYTHONPATH has it."""
    root = Path(__file__).resolve().parent.parent
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    _SHIPPED.add(app)
    archive = Path(tempfile.mkdtemp(prefix="pagemill-")) / "pagemill.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted((root / "pagemill").rglob("*.py")):
            z.write(p, p.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with files that outlive any executor, gives the reader exact sizes (so that
    Spark may choose a broadcast by itself) and keeps a plan used several times from running again.
    The files go when the session ends, or before by :func:`release`.
    """
    spark = df.sparkSession
    path = f"{own_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def own_folder(spark: SparkSession) -> str:
    """Folder of this application in the shared one; the JVM deletes it when it closes its file systems."""
    folder = f"{shared_dir(spark)}/pagemill/{spark.sparkContext.applicationId}"
    if folder not in _LEAVES:
        _LEAVES.add(folder)
        files, at = _file_system(spark, folder)
        files.mkdirs(at)
        files.deleteOnExit(at)
    return folder


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def release(spark: SparkSession) -> None:
    """Delete all that was materialized in this session. Frames made from it can't be read any more."""
    for folder in [f for f in _LEAVES if f.endswith(f"/{spark.sparkContext.applicationId}")]:
        files, at = _file_system(spark, folder)
        files.delete(at, True)
        _LEAVES.discard(folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of files up to which an input of few partitions is spread over the cores.
SPREAD_BYTES = 256 << 20


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as there are cores, if its files are small.

    For work that costs far more than moving its input. The results are the same either way; inputs of
    more than ``SPREAD_BYTES``, by the sizes of their files, stay in the partitions of their scan.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df._jdf.queryExecution().toRdd().getNumPartitions() >= cores:
        return df
    size = 0
    for f in df.inputFiles():
        files, at = _file_system(spark, f)
        size += files.getFileStatus(at).getLen()
    return df.repartition(cores) if size <= SPREAD_BYTES else df


def task_count(spark: SparkSession) -> int:
    """Partitions for a costly stage after a shuffle: as configured, and no fewer than the cores."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
