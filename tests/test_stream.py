"""The feed stream: one file per batch, oldest first, and safe to repeat."""

import os
import re

import pytest
from pyspark.sql import functions as F

from costloom.plans.catalogue import TAX_SQL
from costloom.schemas import FEED, FEED_COLUMNS
from costloom.sources.files import CSV
from costloom.sinks import drop_empty_days, write_daily
from costloom.streaming.feed import FeedJob, by_file_number, price_history, rejects, run_feed_batch, start_feed, stream_feed
from costloom.streaming.state import KeyedTable

PRODUCT = (
    "id long, tmpl_id long, default_code string, currency string, state string, list_price double, standard_price double, "
    "standard_product_price double, today_cost double, margin double, name string, description_sale string, upv long, weight double, "
    "volume double, warranty double, iva double, wholesaler_bulk long, retail_bulk long, item_code string, category_stale boolean, "
    "invoice_cost double, write_date timestamp, type string, invoice_policy string, purchase_method string, sale_tax_id long, purchase_tax_id long"
)
LINE = '{code},"{code} name",,{cost},100,1.0,.000,25,25,,0,21.00,102,{day} 10:00:00\n'


@pytest.fixture
def job(spark, tmp_path):
    dims = {
        "items": spark.createDataFrame([("102", "WASHER", "102", "S", "F", 0.5)], "code string, name string, origin string, section string, family string, margin double"),
        "tax": spark.sql(TAX_SQL),
        "rates": spark.createDataFrame([], "currency string, date date, rate double"),
        "layers": spark.createDataFrame([], "id long, product_id long, location_usage string, in_date timestamp"),
        "lines": spark.createDataFrame(
            [(1, 0, 50.0, 10.0, 0.0, False, "ARS", None, True)],
            "id long, product_id long, price_unit double, discount double, invoice_discount double, is_primary boolean, currency string, date_invoice date, discount_processed boolean",
        ),
        "barcodes": spark.createDataFrame([("102.AF", "779")], "product_code string, barcode string"),
    }
    initial = {
        "product": spark.createDataFrame([], PRODUCT),
        "item": dims["items"].limit(0),
        "history": spark.createDataFrame([], "vendor_id long, product_tmpl_id long, min_qty long, vendor_code string, price double, date_start date, date_end date"),
        "barcode": spark.createDataFrame([], "barcode string, product_id long"),
    }
    return FeedJob(str(tmp_path / "state"), 1, lambda s: dims, initial)


def write_day(folder, number, day, costs):
    path = folder / f"{day}-data.csv"
    path.write_text("".join(LINE.format(code=c, cost=v, day=day) for c, v in costs.items()))
    os.utime(path, (number * 1000, number * 1000))


def test_price_falls_and_recovers_over_three_days(spark, job, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    write_day(feed, 1, "2018-01-26", {"102.AF": "778.32", "102.B": "209.83"})
    write_day(feed, 2, "2018-08-30", {"102.AF": "700.00", "102.X": "bad"})
    write_day(feed, 3, "2018-09-30", {"102.AF": "778.32"})
    query = start_feed(stream_feed(spark, str(feed)), job, str(tmp_path / "checkpoint"))
    assert query.awaitTermination(240)

    def table(name, batch):
        return spark.read.parquet(f"{job.state}/{name}/batch={batch}")

    def product(after):
        return job.table("product").read(spark, after + 1)

    states = [product(n).filter("default_code = '102.AF'").collect()[0] for n in range(3)]
    assert [(r.state, round(r.today_cost, 4)) for r in states] == [("sellable", 7.7832), ("offer", 7.0), ("sellable", 7.7832)]
    assert states[2].list_price == pytest.approx(7.7832 * 1.5)
    history = [(round(r.price, 6), str(r.date_start), r.date_end and str(r.date_end)) for r in price_history(spark, job, 2).orderBy("date_start", "price").collect()]
    assert history == [(2.0983, "2018-01-26", None), (7.7832, "2018-01-26", "2018-08-29"), (7.0, "2018-08-30", "2018-09-29"), (7.7832, "2018-09-30", None)]
    logs = [table("run_log", n).collect()[0] for n in range(3)]
    assert [(r.created, r.processed, r.barcodes_created) for r in logs] == [(2, 0, 1), (0, 1, 0), (0, 1, 0)]
    assert all(r.state == "done" and r.seconds > 0 and r.message is None for r in logs)
    assert (states[0].type, states[0].invoice_policy, states[0].purchase_method, str(states[2].write_date)) == ("product", "order", "purchase", "2018-09-30 10:00:00")
    assert states[0].sale_tax_id is not None and states[0].purchase_tax_id is not None
    assert {(r.min_qty, r.vendor_code) for r in price_history(spark, job, 2).collect()} == {(25, "102.AF"), (25, "102.B")}
    assert rejects(spark, job, 1).count() == 1
    # A batch writes the rows it touched, and repeated it changes nothing.
    assert [job.table("product").delta(spark, n).count() for n in range(3)] == [2, 1, 1] and product(2).count() == 2
    before = sorted(product(2).collect(), key=str)
    run_feed_batch(job, read(spark, feed / "2018-09-30-data.csv"), 2)
    assert sorted(product(2).collect(), key=str) == before
    assert price_history(spark, job, 2).count() == 4


def read(spark, path):
    return spark.read.schema(FEED).options(**CSV).csv(str(path)).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def test_rows_of_one_second_apply_in_file_order(spark, job, tmp_path):
    path = tmp_path / "2018-01-26-data.csv"
    path.write_text("".join(LINE.format(code="102.AF", cost=c, day="2018-01-26") for c in ("500.00", "900.00", "700.00")))
    run_feed_batch(job, read(spark, path), 0)
    row = job.table("product").delta(spark, 0).collect()[0]
    # 5.0, up to 9.0, then down to 7.0: without stock the fall is taken and puts it on offer.
    assert (row.today_cost, row.state) == (7.0, "offer")
    history = job.table("history").delta(spark, 0).collect()
    assert sorted(r.price for r in history) == [5.0, 7.0, 9.0] and [r.price for r in history if r.date_end is None] == [7.0]


def test_places_keep_their_order_without_paths(spark):
    paths = ["f:/b/day=2018-01-02/p1", "f:/a/day=2018-01-03/p0", "f:/b/day=2018-01-01/p9"]
    rows = spark.createDataFrame([((paths[n % 3], n // 3 % 2, n), n) for n in range(30)], "place struct<file:string,block:long,line:long>, n int")
    short = by_file_number(rows)
    assert short.columns == ["place", "n"] and short.schema["place"].dataType["file"].dataType.simpleString() == "int"
    assert [r.n for r in short.orderBy("place").collect()] == [r.n for r in rows.orderBy("place").collect()]


def test_a_failed_batch_is_logged_and_lost_state_is_no_new_start(spark, job, tmp_path):
    path = tmp_path / "2018-01-26-data.csv"
    path.write_text(LINE.format(code="102.AF", cost="500.00", day="2018-01-26"))
    with pytest.raises(Exception, match="batch=2"):
        run_feed_batch(job, read(spark, path), 3)
    log = spark.read.parquet(f"{job.state}/run_log/batch=3").collect()[0]
    assert log.state == "error" and "batch=2" in log.message and log.created is None


def test_finished_files_leave_the_folder_between_runs(spark, job, tmp_path):
    rows = [("102.AF", 500 + 10 * n, f"2018-0{1 + n // 2}-{10 + n:02d} 10:00:00") for n in range(6)]
    feed = spark.createDataFrame([(c, f"{c} name", "", str(v), "100", "1.0", "", "25", "25", "", "0", "21.00", "102", d) for c, v, d in rows], ", ".join(f"{c} string" for c in FEED_COLUMNS))
    folder, done, left = f"{tmp_path}/feed", f"{tmp_path}/done", []
    for part in (feed.filter("write_date < '2018-02-12'"), feed.filter("write_date >= '2018-02-12'")):
        write_daily(part, folder)
        query = start_feed(stream_feed(spark, folder, 1 if not left else 2, done), job, f"{tmp_path}/checkpoint")
        assert query.awaitTermination(240)
        left.append(drop_empty_days(spark, folder))
    # Two days in two batches, then four in two; only the last batch's files may still be there.
    assert query.lastProgress["batchId"] == 3 and left[0] <= 1 and left[1] <= 2
    assert len(os.listdir(folder)) <= 2 + 2  # and the success marks
    # Days in order, whatever task wrote them: the cost rises to the last one.
    row = job.table("product").read(spark, 4).collect()[0]
    assert (row.today_cost, row.state) == (5.5, "sellable")
    assert sorted(r.price for r in price_history(spark, job, 3).collect()) == [5.0, 5.1, 5.2, 5.3, 5.4, 5.5]


def test_state_grows_with_the_batch_and_is_compacted(spark, tmp_path):
    start = spark.range(20_000).select("id", F.concat(F.lit("name "), "id").alias("name"), F.lit(0).alias("version"))
    table = KeyedTable(str(tmp_path / "state"), start.schema, ("id",), buckets=8, compact_every=4)
    table.start(start)
    size = lambda kind, n: sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(f"{table.folder}/{kind}/batch={n}") for f in names)
    for n in range(6):
        touched = spark.createDataFrame([(n, f"new {n}", n + 1), (5, f"five {n}", n + 1), (100_000 + n, "added", n + 1)][: 2 if n == 5 else 3], start.schema)
        for _ in range(2):  # a repeated batch overwrites itself
            table.write(touched.dropDuplicates(["id"]), n)
        assert size("delta", n) < 0.05 * size("base", -1)
    got = {r.id: (r.name, r.version) for r in table.read(spark, 6).filter("version > 0").collect()}
    assert got[0] == ("new 0", 1) and got[4] == ("new 4", 5) and got[5][1] == 6 and got[100_002] == ("added", 3)
    assert table.read(spark, 6).count() == 20_005 and table.read(spark, 3).count() == 20_003
    some = spark.createDataFrame([(5,), (100_001,), (77,)], "id long")
    rows = table.read(spark, 6, some)
    assert {r.id for r in rows.collect()} == {5, 100_001, 77}
    # From the second base on, and in the buckets of the keys only.
    assert not any("batch=-1" in f or "delta/batch=3" in f for f in rows.inputFiles())
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan), plan
    table.skip(spark, 6)
    assert table.read(spark, 7).count() == 20_005
    with pytest.raises(FileNotFoundError, match="base/batch=7"):
        table.read(spark, 10)
