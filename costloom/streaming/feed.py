"""The product feed as a stream of daily files.

A file is read once, oldest first; the checkpoint replaces a line cursor and a
watermark, and a finished file leaves the folder. Small lookup tables are read
once a run. Each batch runs the same operators as a batch job, on the products it
touches and their state only, and writes its output under its own number, so a
batch repeated after a failure overwrites its own output and never applies twice.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.catalogue import choose_tax, good_rows, link_barcodes, parse_feed, protected_prefix, reject_rows, upsert_items, upsert_products
from ..operators.costing import purchase_nets, with_invoice_cost
from ..operators.currency import current_rates, rate_months
from ..operators.prices import apply_prices, scd2_prices
from ..schemas import FEED
from ..session import written
from ..sinks import RUN_COUNTERS, run_stats
from ..sources.files import CSV
from .state import KeyedTable

PRODUCT_FIELDS = [
    "name", "description_sale", "upv", "weight", "volume", "wholesaler_bulk", "retail_bulk", "warranty", "item_code", "iva",
    "write_date", "type", "invoice_policy", "purchase_method", "sale_tax_id", "purchase_tax_id",
]


# Finished files stay listed for their age at most; feed files carry their day as time.
ANY_AGE = "36500d"


def stream_feed(spark: SparkSession, path: str, files_per_batch: int = 1, archive: str | None = None) -> DataFrame:
    """Daily feed files, oldest first by file time (see ``sinks.write_daily``); done files move to ``archive``.

    ``archive`` must lie outside ``path``. Each row keeps its file and block, the
    first part of its place in the feed.
    """
    # Many small folders: list them in a few tasks, not in one each.
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(4 * spark.sparkContext.defaultParallelism))
    reader = (
        spark.readStream.schema(FEED)
        .options(**CSV)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("latestFirst", "false")
        .option("maxFileAge", ANY_AGE)
        .option("recursiveFileLookup", "true")
    )
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.csv(path).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def placed(batch: DataFrame) -> DataFrame:
    """Rows with ``place``, their order in the feed: file, block, and number in the task that reads the block."""
    place = F.struct("file", "block", F.monotonically_increasing_id().alias("line"))
    return batch.withColumn("place", place).drop("file", "block")


def by_file_number(rows: DataFrame) -> DataFrame:
    """``place`` with the number of its file among those of the batch, in the order of their paths, for the path.

    Places are moved and compared many times, and a path is longer than the rest of a
    row. One row a file, at most ``files_per_batch``, is numbered and broadcast.
    """
    files = rows.select(F.col("place.file").alias("__path")).distinct()
    numbers = written(files.select("__path", F.row_number().over(Window.orderBy("__path")).alias("__number")))
    out = rows.join(F.broadcast(numbers), F.col("place.file") == F.col("__path"))
    return out.withColumn("place", F.struct(F.col("__number").alias("file"), "place.block", "place.line")).select(*rows.columns)


def side_by_side(*steps: Callable[[], object]) -> list:
    """Results of steps that do not need each other: their small jobs overlap instead of waiting in line."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(step) for step in steps]]


KEYS = {"product": ("default_code",), "item": ("code",), "barcode": ("barcode",), "history": ("vendor_id", "product_tmpl_id")}


@dataclass
class FeedJob:
    """State folder and side inputs of a feed stream.

    ``dims(spark)`` returns the inputs of a run: items, barcodes, tax, rates,
    layers and lines (purchase lines). ``initial`` holds product, item, barcode
    (barcode, product_id) and history as they are before the first batch.
    ``fallback_date`` is where the invoice cost of a product without stock looks
    for a line.
    """

    state: str
    primary_vendor_id: int
    dims: Callable[[SparkSession], dict[str, DataFrame]]
    initial: dict[str, DataFrame] = field(default_factory=dict)
    fallback_date: str = "2018-01-01"
    buckets: int = 64
    compact_every: int = 16
    session: SparkSession | None = None  # where batches are worked on; a stream's own session has no adaptive execution
    first_batch: int | None = None  # of this run
    lookups: dict[str, DataFrame] = field(default_factory=dict)

    def table(self, name: str) -> KeyedTable:
        """A state table. Of the history only open rows are state; closed ones stay in the batch that closed them."""
        start = self.initial[name]
        if name == "barcode":
            start = start.withColumn("action", F.lit(None).cast("string"))
        live = "date_end IS NULL" if name == "history" else "true"
        return KeyedTable(f"{self.state}/{name}", start.schema, KEYS[name], live, self.buckets, self.compact_every)

    def open_run(self, spark: SparkSession, batch: int) -> None:
        """Before the first batch of a run: start tables, and reduce the lookups all its batches use."""
        if self.first_batch is not None:
            return
        dims = self.dims(spark)
        bought = dims["lines"].select(F.col("product_id").alias("id")).distinct()
        inside = dims["layers"].filter(F.col("location_usage") == "internal")
        bare = self.initial | {"barcode": self.initial["barcode"].withColumn("action", F.lit(None).cast("string"))}
        look = {
            "items": lambda: written(dims["items"]),
            "barcodes": lambda: written(dims["barcodes"]),
            "stocked": lambda: written(inside.select("product_id", "location_usage").distinct()),
            "rates": lambda: written(current_rates(dims["rates"])),
            "months": lambda: rate_months(dims["rates"]),
            "nets": lambda: written(purchase_nets(bought, dims["lines"], dims["layers"], self.fallback_date)),
        }
        done = side_by_side(*look.values(), *[lambda n=n: self.table(n).start(bare[n]) for n in bare])
        self.lookups = {"tax": dims["tax"], **dict(zip(look, done, strict=False))}
        self.first_batch = batch

    def save(self, df: DataFrame, name: str, batch: int) -> DataFrame:
        """Write a table of a batch and read it back: later steps start from files."""
        folder = f"{self.state}/{name}/batch={batch}"
        df.write.mode("overwrite").parquet(folder)
        return (self.session or df.sparkSession).read.schema(df.schema).parquet(folder)

    def saved(self, spark: SparkSession, name: str, batch: int) -> DataFrame:
        return spark.read.parquet(f"{self.state}/{name}/batch={batch}")


def run_feed_batch(job: FeedJob, batch: DataFrame, batch_id: int) -> None:
    """One batch, with a log row of how it went also if it fails."""
    start = time.time()

    def log(stats: DataFrame, state: str, message: str | None) -> None:
        row = stats.withColumns(
            {
                "batch": F.lit(batch_id),
                "started": F.timestamp_seconds(F.lit(start)),
                "seconds": F.lit(time.time() - start),
                "state": F.lit(state),
                "message": F.lit(message).cast("string"),
            }
        )
        row.write.mode("overwrite").parquet(f"{job.state}/run_log/batch={batch_id}")

    try:
        stats = load_batch(job, batch, batch_id)
        log(stats, "done", None)
    except Exception as ex:
        none = batch.sparkSession.range(1).select(*[F.lit(None).cast("bigint").alias(c) for c in RUN_COUNTERS])
        log(none, "error", str(ex)[:2000])
        raise


def load_batch(job: FeedJob, batch: DataFrame, batch_id: int) -> DataFrame:
    """Items, products, taxes, barcodes, history, prices and costs of one batch; returns its counters."""
    spark = job.session or batch.sparkSession
    job.open_run(spark, batch_id)
    item, product, history, barcode = (job.table(n) for n in ("item", "product", "history", "barcode"))
    look = job.lookups

    def load_items() -> None:
        if batch_id <= job.first_batch:  # the item file is loaded once a run
            item.write(upsert_items(item.read(spark, batch_id), look["items"]).filter("action <> 'unchanged'"), batch_id)
        else:
            item.skip(spark, batch_id)

    parsed, _ = side_by_side(lambda: job.save(parse_feed(placed(batch)), "parsed", batch_id), load_items)
    good = by_file_number(good_rows(parsed))
    current = written(product.read(spark, batch_id, good.select("default_code").distinct()))
    feed = job.save(choose_tax(protected_prefix(good, current), look["tax"]), "feed", batch_id)
    taxed = feed.filter(~F.col("tax_missing"))

    upserted = upsert_products(current, taxed, PRODUCT_FIELDS, ["place"]).filter(F.col("action").isin("created", "updated"))
    fresh = {"invoice_cost": 0.0, "today_cost": 0.0, "standard_price": 0.0, "standard_product_price": 0.0, "list_price": 0.0, "margin": 0.0}
    products = written(
        upserted.withColumns(
            {
                "id": F.coalesce("id", F.xxhash64("default_code")),
                "tmpl_id": F.coalesce("tmpl_id", F.xxhash64("default_code")),
                "currency": F.coalesce("currency", F.lit("ARS")),
                "state": F.coalesce("state", F.lit("sellable")),
                **{c: F.coalesce(c, F.lit(v)) for c, v in fresh.items()},
            }
        )
    )

    # Every row is an event, in the order of the feed. History and prices read them several times.
    found = taxed.join(products.select("default_code", "tmpl_id"), "default_code").select(
        F.lit(job.primary_vendor_id).cast("bigint").alias("vendor_id"),
        "tmpl_id",
        F.col("write_date").cast("date").alias("date"),
        F.col("place").alias("seq"),
        "cost",
        F.lit(None).cast("double").alias("price"),
        F.lit(True).alias("is_primary"),
        F.lit(False).alias("manual"),
        F.col("wholesaler_bulk").alias("min_qty"),
        F.col("default_code").alias("vendor_code"),
    )
    events = written(found)

    def load_history() -> None:
        touched = products.select(F.lit(job.primary_vendor_id).cast("bigint").alias("vendor_id"), F.col("tmpl_id").alias("product_tmpl_id"))
        feed_prices = events.select("vendor_id", F.col("tmpl_id").alias("product_tmpl_id"), F.col("cost").alias("price"), "date", "seq", "is_primary", "min_qty", "vendor_code")
        history.write(scd2_prices(history.read(spark, batch_id, touched), feed_prices), batch_id)

    def load_prices() -> None:
        # The price state of a product is its row: the batch goes on from there.
        priced = apply_prices(products, events.drop("min_qty", "vendor_code"), item.read(spark, batch_id + 1), look["stocked"], look["rates"])
        product.write(with_invoice_cost(priced, look["nets"], look["months"]), batch_id)

    def load_barcodes() -> None:
        offered = look["barcodes"].join(products.select(F.col("default_code").alias("product_code")), "product_code", "left_semi")
        linked = link_barcodes(products, offered, barcode.read(spark, batch_id, offered))
        barcode.write(linked.filter("action <> 'unchanged'"), batch_id)

    side_by_side(load_history, load_prices, load_barcodes)
    return run_stats(products, barcode.delta(spark, batch_id))


def rejects(spark: SparkSession, job: FeedJob, batch: int) -> DataFrame:
    """One row per reason of a feed row that a batch rejected."""
    return reject_rows(job.saved(spark, "parsed", batch))


def without_tax(spark: SparkSession, job: FeedJob, batch: int) -> DataFrame:
    """Feed rows of a batch that were left out because no tax has their rate."""
    return job.saved(spark, "feed", batch).filter("tax_missing")


def price_history(spark: SparkSession, job: FeedJob, last_batch: int) -> DataFrame:
    """Whole history: rows closed by any batch, and those that are open after the last one."""
    history = job.table("history")
    closed = [history.delta(spark, n).filter("date_end IS NOT NULL") for n in range(last_batch + 1)]
    out = history.read(spark, last_batch + 1)
    for rows in closed:
        out = out.unionByName(rows)
    return out


def start_feed(stream: DataFrame, job: FeedJob, checkpoint: str) -> StreamingQuery:
    """Run the stream until all files present are done; the lookups are read anew."""
    job.first_batch, job.session = None, stream.sparkSession
    return (
        stream.writeStream.foreachBatch(lambda df, n: run_feed_batch(job, df, n))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
