"""Small helpers the corpus operators share."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions of this package travel with the job, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

# A Python task sees this many rows at a time, so that long texts fit in its memory.
ARROW_ROWS = 500


def prepare(spark: SparkSession) -> None:
    """Session settings of the corpus operators."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; -1 for a row without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % by, F.lit(-1))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path every executor reaches: below spark.checkpoint.dir, or below the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    The rows outlive lost executors and are computed once, whoever reads them.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blocks(lengths: list[int], limit: int) -> list[tuple[int, int]]:
    """Runs [first, last) of rows of about ``limit`` characters together; a longer row stands alone."""
    out, first, total = [], 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > limit:
            out.append((first, i))
            first, total = i, 0
        total += n
    if first < len(lengths):
        out.append((first, len(lengths)))
    return out
