"""Sinks. All of them may be re-run after a failure without writing twice."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import FEED_COLUMNS
from .session import written

# Fixed header of the stock export.
STOCK_HEADER = {
    "code": "Codigo",
    "name": "Descripcion",
    "vendor": "Proveedor",
    "on_hand": "En Mano",
    "forecast": "Previsto",
    "invoiced": "Factura",
    "cost_today": "Costo Hoy",
    "cost_purchase": "Costo Compra",
}


def write_daily(feed: DataFrame, path: str, mode: str = "append", order: list[str] | None = None) -> None:
    """One folder per write date, rows in the given order inside a file.

    Rows are dealt by day, and a day too large for one task is split. A file's
    time is its day, so a stream that takes the oldest files first takes the
    days in order whichever task wrote them; a day that is no date keeps the
    time it was written. Files go to their place when their task ends, not one by
    one at the end of the job: there are as many as days. A repeated task writes
    the same names; start a stream after the write.

    A row is dealt as the line of text it becomes, which is a fraction of its
    columns, and files are compressed: readers see that by their names.
    """
    line = F.to_csv(F.struct(*FEED_COLUMNS), {"quoteAll": "false", "escape": '"'}).alias("value")
    order = order or []
    out = feed.select(line, *order, F.substring("write_date", 1, 10).alias("day")).hint("rebalance", "day")
    out = out.sortWithinPartitions("day", *order).select("value", "day")
    writer = out.write.partitionBy("day").mode(mode).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.option("compression", "gzip").text(path)
    fs, found = _day_files(feed.sparkSession, path)
    for file in found:
        try:
            day = datetime.strptime(file.getPath().getParent().getName(), "day=%Y-%m-%d").replace(tzinfo=UTC)
        except ValueError:
            continue
        if file.getModificationTime() != (at := int(day.timestamp() * 1000)):
            fs.setTimes(file.getPath(), at, -1)


def _day_files(spark: SparkSession, path: str):
    """(file system, files in the day folders below ``path``): one a day, or a few."""
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/day=*/part-*")
    fs = files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, list(fs.globStatus(files) or [])


def drop_empty_days(spark: SparkSession, path: str) -> int:
    """Remove the day folders that a stream has emptied, so that they are no longer listed; returns how many are left."""
    fs, found = _day_files(spark, path)
    used = {f.getPath().getParent().getName() for f in found}
    days = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/day=*")
    for folder in fs.globStatus(days) or []:
        if folder.getPath().getName() not in used:
            fs.delete(folder.getPath(), True)
    return len(used)


def write_supplier_sheets(rows: DataFrame, path: str) -> None:
    """Staged supplier price rows as Parquet, the rows of a vendor side by side in as many files as their size asks for.

    ``vendor_ref`` is a column of the files, so their number follows the rows and
    not the vendors; rows are sorted by it, and a reader of one vendor skips the rest.
    """
    rows.hint("rebalance", "vendor_ref").sortWithinPartitions("vendor_ref", "sheet_no").write.mode("overwrite").parquet(path)


def export_stock_csv(reconciliation: DataFrame, path: str) -> None:
    """Quoted CSV parts below ``path``; every part begins with the header."""
    named = reconciliation.select(*[F.col(c).alias(h) for c, h in STOCK_HEADER.items()])
    named.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def append_kpi_month(snapshot: DataFrame, path: str) -> None:
    """Append a snapshot; the same date written again replaces itself."""
    snapshot.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def import_log(actions: DataFrame, errors: DataFrame, vendors: DataFrame) -> DataFrame:
    """Counters, vendor list and state of each upload.

    ``actions``: upload_id, action; ``errors``: upload_id; ``vendors``:
    upload_id, sheet_no, vendor_ref. Vendors are sheets of one workbook, a few
    dozen at most, and are made distinct before they are listed.
    """
    done = actions.groupBy("upload_id").agg(
        F.count_if(F.col("action") == "created").alias("created_products"),
        F.count_if(F.col("action") == "updated").alias("updated_products"),
    )
    failed = errors.groupBy("upload_id").agg(F.count(F.lit(1)).alias("errors"))
    sheets = vendors.groupBy("upload_id", "vendor_ref").agg(F.min("sheet_no").alias("sheet_no"))
    listed = sheets.groupBy("upload_id").agg(
        F.array_sort(F.collect_list(F.struct("sheet_no", "vendor_ref"))).alias("__v")
    )
    names = F.array_join(F.col("__v.vendor_ref"), ", ")
    out = listed.select("upload_id", names.alias("vendors")).join(done, "upload_id", "left").join(failed, "upload_id", "left")
    zero = F.lit(0).cast("bigint")
    counts = ["created_products", "updated_products", "errors"]
    out = out.select("upload_id", "vendors", *[F.coalesce(c, zero).alias(c) for c in counts])
    return out.withColumn("state", F.when(F.col("errors") > 0, "error").otherwise("done"))


def write_import_log(log: DataFrame, path: str) -> None:
    log.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("upload_id").parquet(path)


def write_import_errors(errors: DataFrame, path: str) -> None:
    errors.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("upload_id").parquet(path)


def record_import(actions: DataFrame, errors: DataFrame, vendors: DataFrame, path: str) -> DataFrame:
    """Write the log and the errors of uploads below ``path``, a folder an upload; an upload recorded again replaces itself. Returns the log."""
    log = written(import_log(actions, errors, vendors))
    write_import_log(log, f"{path}/log")
    write_import_errors(errors, f"{path}/errors")
    return log


RUN_COUNTERS = ["processed", "created", "barcodes_created", "barcodes_changed"]


def run_stats(products: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Counters of one feed run from the action columns of its upserts.

    An updated product counts as processed; a created one is counted apart.
    """
    p = products.agg(
        F.count_if(F.col("action") == "updated").alias("processed"),
        F.count_if(F.col("action") == "created").alias("created"),
        F.lit(None).cast("bigint").alias("barcodes_created"),
        F.lit(None).cast("bigint").alias("barcodes_changed"),
    )
    b = barcodes.agg(
        F.lit(None).cast("bigint").alias("processed"),
        F.lit(None).cast("bigint").alias("created"),
        F.count_if(F.col("action") == "created").alias("barcodes_created"),
        F.count_if(F.col("action") == "changed").alias("barcodes_changed"),
    )
    return p.unionByName(b).agg(*[F.max(c).alias(c) for c in p.columns])
