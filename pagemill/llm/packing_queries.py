"""Queries of problem 6."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pagemill.llm.packing import pack
from pagemill.session import spread, table

CAPACITY = 2048


def p6_packing(spark, sf_dir):
    return pack(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), capacity=CAPACITY)


def p6_fill(spark, sf_dir):
    """Containers by how full they are: 100 is full, and no container is over its capacity."""
    one = p6_packing(spark, sf_dir).where("container is not null").groupBy("container").agg(F.sum("n_tokens").alias("used"))
    return one.groupBy(F.floor(F.col("used") * 100 / CAPACITY).alias("percent")).agg(F.count("*").alias("containers"), F.sum("used").alias("tokens"))


def p6_checks(spark, sf_dir):
    """Whether each document is packed, in pieces that follow one another, cut only where it is larger than a container."""
    pieces = p6_packing(spark, sf_dir)
    along = Window.partitionBy("doc_id").orderBy("piece_no")
    follows = F.col("start_token") == F.coalesce(F.lag(F.col("start_token") + F.col("n_tokens")).over(along), F.lit(0))
    rows = pieces.withColumn("follows", F.coalesce(follows, F.lit(True)))
    single = (F.count("*") == 1) | (F.sum("n_tokens") > CAPACITY)
    return rows.groupBy("doc_id").agg(F.bool_and(F.col("container").isNotNull()).alias("packed"), F.bool_and("follows").alias("follows"), single.alias("uncut"))


def p6_overfull(spark, sf_dir):
    """Containers over their capacity: none."""
    used = p6_packing(spark, sf_dir).where("container is not null").groupBy("container").agg(F.sum("n_tokens").alias("used"))
    return used.where(F.col("used") > CAPACITY)


QUERIES = {f.__name__: f for f in (p6_packing, p6_fill, p6_checks, p6_overfull)}
ORACLES = {
    "p6_checks": "SELECT DISTINCT doc_id, text IS NOT NULL AS packed, true AS follows, true AS uncut FROM documents",
    "p6_overfull": "SELECT NULL::VARCHAR AS container, NULL::BIGINT AS used WHERE false",
}
