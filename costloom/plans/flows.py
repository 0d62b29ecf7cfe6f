"""Queries that go through files: sources, sinks and the feed stream.

The files are written from the given tables into a new shared folder and read
back by the sources.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sinks
from ..operators import catalogue, kpis, stock
from ..schemas import FEED_COLUMNS
from ..session import shared_folder
from ..sources import files
from ..sources.tables import DEFINITIONS, Tables, read_erp
from ..streaming.feed import FeedJob, start_feed, stream_feed
from . import audits as sheet_plans
from .catalogue import CODES_SQL, CURRENT_SQL, FEED_SQL, HELD_SQL, PARSED, TAX_SQL, feed, flat, good_feed
from .common import CUR_RATE, TODAY, purchase_lines, rounded
from .kpis import ACCOUNT_SQL, MONTH_END
from .registry import CHECKS, query, r4
from .stock import POSTED


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS n_rows FROM {n}" for n in ("customer", "orders", "lineitem", *DEFINITIONS)))
def erp_tables(t: Tables):
    out = None
    for name in ("customer", "orders", "lineitem", *DEFINITIONS):
        one = t.get(name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")).select("table_name", "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


@query(f""", {PARSED} SELECT default_code, {r4("cost")} AS cost, upv, wholesaler_bulk, iva, item_code, write_date FROM good""")
def feed_files(t: Tables):
    folder = shared_folder(t.spark)
    sinks.write_daily(feed(t), folder)
    read = files.read_product_feed(t.spark, folder).drop("day")
    out = catalogue.good_rows(catalogue.parse_feed(read))
    return rounded(out.select("default_code", "cost", "upv", "wholesaler_bulk", "iva", "item_code", "write_date"), "cost")


@query(f""", feed_raw AS ({flat(FEED_SQL)}) SELECT default_code, pack_cost, TRUE AS rejected FROM feed_raw WHERE description_sale = ''""")
def feed_width_check(t: Tables):
    # Rows without description are written one column short.
    folder = shared_folder(t.spark)
    cells = [F.concat(F.lit('"'), c, F.lit('"')) for c in FEED_COLUMNS]
    short = F.concat_ws(",", *cells[:-1])
    line = F.when(F.col("description_sale") == "", short).otherwise(F.concat_ws(",", *cells))
    feed(t).select(line.alias("value")).write.mode("overwrite").text(folder)
    read = files.read_product_feed(t.spark, folder)
    wrong = catalogue.feed_width_check(read)
    return wrong.select("default_code", "pack_cost", F.lit(True).alias("rejected"))


@query("""SELECT code, name, section, family, margin, 'Origin ' || code AS origin FROM item""")
def item_files(t: Tables):
    folder = shared_folder(t.spark)
    pad = lambda c: F.concat(F.col(c), F.lit("  "))
    item = t.item.withColumns({"section_code": F.md5("section"), "family_code": F.md5("family")})
    options = {"quoteAll": True, "ignoreTrailingWhiteSpace": False}
    item.select("section_code", "section").distinct().write.options(**options).csv(f"{folder}/section")
    item.select("family_code", pad("family")).distinct().write.options(**options).csv(f"{folder}/family")
    item.select(pad("code"), pad("name"), F.concat(F.lit("Origin "), pad("code")), "section_code", "family_code", F.col("margin").cast("string")).write.options(
        **options
    ).csv(f"{folder}/item")
    sections = files.read_sections(t.spark, f"{folder}/section")
    families = files.read_families(t.spark, f"{folder}/family")
    return files.read_items(t.spark, f"{folder}/item", sections, families)


@query(f""", codes AS ({flat(CODES_SQL)}) SELECT product_code, barcode, 25 AS uxb FROM codes""")
def barcode_files(t: Tables):
    folder = shared_folder(t.spark)
    rows = t.sql(CODES_SQL).select(F.concat(F.lit(" "), "barcode"), F.concat("product_code", F.lit(" ")), F.lit("25"))
    rows.write.option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).mode("overwrite").csv(folder)
    return files.read_barcodes(t.spark, folder)


def _cell_sql(c: str) -> str:
    """Text, number and kind of a staged cell as it must be read back."""
    text, number = (f"{c}_text" if c in sheet_plans.TEXT else "'x'"), (f"{c}_num" if c in sheet_plans.NUMBER else "1")
    return f"""CASE WHEN {c}_kind = 'text' THEN {text} END AS {c}_text, {r4(f"CASE WHEN {c}_kind IN ('int', 'float') THEN {number} END")} AS {c}_num, {c}_kind"""


@query(f""", sheet AS ({flat(sheet_plans.SHEET_SQL)})
    SELECT vendor_ref, sheet_no, CAST(row_no % 2147483647 AS INT) AS row_no, 'A' AS upload_id, {", ".join(map(_cell_sql, sheet_plans.SHEET_COLUMNS))}
    FROM sheet WHERE default_code_kind IS NOT NULL""")
def supplier_sheet_files(t: Tables):
    folder = shared_folder(t.spark)
    staged = sheet_plans.sheets(t).drop("upload_id").withColumn("row_no", (F.col("row_no") % 2147483647).cast("int"))
    sinks.write_supplier_sheets(staged, folder)
    read = files.read_supplier_sheets(t.spark, folder, upload_id="A")
    cells = [F.col(f"{c}.{part}").alias(f"{c}_{part}") for c in sheet_plans.SHEET_COLUMNS for part in ("text", "num", "kind")]
    out = read.select("vendor_ref", "sheet_no", "row_no", "upload_id", *cells)
    return rounded(out, *[f"{c}_num" for c in sheet_plans.SHEET_COLUMNS])


@query(""", line AS (SELECT *, row_number() OVER (
        ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS line_id FROM lineitem)
    SELECT line_id AS id, l_orderkey AS invoice_id, l_partkey AS product_id, l_suppkey AS source_vendor_id, l_linenumber AS line_no, l_quantity AS quantity FROM line""")
def dense_lines(t: Tables):
    numbered = read_erp(t.spark, t.folder, dense=True).invoice_line
    return numbered.select("id", "invoice_id", "product_id", "source_vendor_id", "line_no", "quantity")


@query(f""", {POSTED}, first_supplier AS (SELECT product_tmpl_id, arg_min(vendor_id, id) AS vendor_id FROM supplierinfo GROUP BY 1)
    SELECT p.default_code AS "Codigo", p.name AS "Descripcion", v.ref AS "Proveedor", p.qty_available AS "En Mano", p.virtual_available AS "Previsto",
           coalesce(CAST(CAST(q.qty AS DECIMAL(18,2)) AS VARCHAR), 'S/Fact') AS "Factura", {r4("p.today_cost")} AS "Costo Hoy", {r4("p.standard_product_price")} AS "Costo Compra"
    FROM product p LEFT JOIN first_supplier f ON f.product_tmpl_id = p.tmpl_id LEFT JOIN vendor v ON v.id = f.vendor_id
    LEFT JOIN posted q ON q.default_code = p.default_code WHERE p.virtual_available <> 0 AND p.type = 'product'""")
def stock_export(t: Tables):
    folder = shared_folder(t.spark)
    posted = stock.stock_by_posted_invoices(t.invoice_line, t.invoice, t.product)
    sinks.export_stock_csv(stock.stock_reconciliation(t.product, posted, t.supplierinfo, t.vendor), folder)
    numeric = ("on_hand", "forecast", "cost_today", "cost_purchase")
    schema = ", ".join(f"`{h}` {'double' if c in numeric else 'string'}" for c, h in sinks.STOCK_HEADER.items())
    read = t.spark.read.schema(schema).option("header", True).option("escape", '"').csv(folder)
    return rounded(read, "Costo Hoy", "Costo Compra")


@query()
def kpi_month_append(t: Tables):
    folder = shared_folder(t.spark)
    row = kpis.month_end_valuation(t.stock_layer, t.product, t.sql(ACCOUNT_SQL), t.currency_rate, MONTH_END)
    for _ in range(2):  # a repeated run replaces its own row
        sinks.append_kpi_month(row, folder)
    return t.spark.read.parquet(folder)


CHECKS["kpi_month_append"] = CHECKS["month_end_valuation"]


@query(f""", {PARSED}, cur AS ({flat(CURRENT_SQL)}), codes AS ({flat(CODES_SQL)}), held AS ({flat(HELD_SQL)}),
    n AS (SELECT DISTINCT default_code FROM good),
    ok AS (SELECT * FROM codes WHERE barcode NOT IN (SELECT barcode FROM codes GROUP BY barcode HAVING COUNT(*) > 1)),
    b AS (SELECT p.id, c.barcode, h.product_id FROM ok c JOIN product p ON p.default_code = c.product_code LEFT JOIN held h ON h.barcode = c.barcode)
    SELECT (SELECT COUNT(*) FROM n JOIN cur USING (default_code) WHERE default_code NOT LIKE '996.%') AS processed,
           (SELECT COUNT(*) FROM n WHERE default_code NOT IN (SELECT default_code FROM cur)) AS created,
           (SELECT COUNT(*) FROM b WHERE product_id IS NULL) AS barcodes_created,
           (SELECT COUNT(*) FROM b WHERE product_id <> id) AS barcodes_changed""")
def run_stats(t: Tables):
    products = catalogue.upsert_products(t.sql(CURRENT_SQL), good_feed(t), ["name", "upv"], ["write_date", "line_id"])
    codes = t.sql(CODES_SQL)
    clean = codes.join(catalogue.duplicate_barcodes(codes), "barcode", "left_anti")
    return sinks.run_stats(products, catalogue.link_barcodes(t.product, clean, t.sql(HELD_SQL)))


def feed_job(t: Tables, state: str) -> FeedJob:
    """The feed run over the given tables: the sellable half exists already."""
    price = ["list_price", "standard_price", "standard_product_price", "today_cost", "invoice_cost"]
    catalogue_now = t.product.filter("state = 'sellable'").select(
        "id",
        "tmpl_id",
        "default_code",
        "currency",
        "state",
        *price,
        F.lit(0.0).alias("margin"),
        "name",
        F.lit(None).cast("string").alias("description_sale"),
        F.lit(1).cast("bigint").alias("upv"),
        *[F.lit(0.0).alias(c) for c in ("weight", "volume", "warranty", "iva")],
        *[F.lit(0).cast("bigint").alias(c) for c in ("wholesaler_bulk", "retail_bulk")],
        "item_code",
        F.lit(None).cast("timestamp").alias("write_date"),
        *[F.lit(None).cast("string").alias(c) for c in ("invoice_policy", "purchase_method")],
        F.lit(None).cast("string").alias("type"),
        *[F.lit(None).cast("bigint").alias(c) for c in ("sale_tax_id", "purchase_tax_id")],
        F.lit(False).alias("category_stale"),
    )
    codes = t.sql(CODES_SQL)
    dims = {
        "items": t.item.withColumn("origin", F.col("code")),
        "tax": t.sql(TAX_SQL.replace("'other'", "'vat'")),
        "rates": t.currency_rate,
        "layers": t.stock_layer,
        "lines": purchase_lines(t),
        "barcodes": codes.join(catalogue.duplicate_barcodes(codes), "barcode", "left_anti"),
    }
    history = t.spark.createDataFrame([], "vendor_id bigint, product_tmpl_id bigint, min_qty bigint, vendor_code string, price double, date_start date, date_end date")
    initial = {
        "product": catalogue_now,
        "item": dims["items"].filter("code <> 'SMALL'"),
        "history": history,
        "barcode": t.sql(HELD_SQL),
    }
    return FeedJob(state, 1, lambda spark: dims, initial, TODAY, buckets=8, compact_every=4)


# The feed arrives in runs of daily files, and a run takes so many files at a time.
RUNS = ["9999"]
FILES = 1250
PRICES = ["today_cost", "standard_price", "standard_product_price", "list_price", "margin"]


@query(f""", {PARSED}, {CUR_RATE}, day AS (
        SELECT DISTINCT substr(write_date, 1, 10) AS day, CASE WHEN write_date < '{RUNS[0]}' THEN 0 ELSE 1 END AS run FROM feed_raw),
    batch AS (SELECT day, dense_rank() OVER (ORDER BY run, (place - 1) // {FILES}) AS n FROM (
        SELECT *, row_number() OVER (PARTITION BY run ORDER BY day) AS place FROM day)),
    run AS (SELECT g.*, b.n FROM good g JOIN batch b ON b.day = CAST(CAST(g.write_date AS DATE) AS VARCHAR)),
    known AS (SELECT * FROM product WHERE state = 'sellable'),
    loaded AS (
        SELECT * FROM run r WHERE default_code NOT LIKE '996.%' OR (
            n = (SELECT MIN(n) FROM run f WHERE f.default_code = r.default_code)
            AND NOT EXISTS (SELECT 1 FROM known p WHERE p.default_code = r.default_code))),
    newest AS (
        SELECT * FROM loaded QUALIFY row_number() OVER (PARTITION BY default_code ORDER BY CAST(write_date AS DATE) DESC, line_id DESC) = 1),
    numbered AS (
        SELECT default_code, cost, row_number() OVER (PARTITION BY default_code ORDER BY CAST(write_date AS DATE), line_id) AS n FROM loaded),
    side AS (
        SELECT coalesce(p.default_code, w.default_code) AS default_code, coalesce(p.today_cost, 0) AS today_cost, coalesce(p.standard_price, 0) AS standard_price,
               coalesce(p.standard_product_price, 0) AS standard_product_price, coalesce(p.list_price, 0) AS list_price,
               coalesce(i.margin, 0) AS m, coalesce(r.rate, 1) AS rate,
               EXISTS (SELECT 1 FROM stock_layer s WHERE s.product_id = p.id AND s.location_usage = 'internal') AS stock
        FROM known p FULL JOIN newest w ON w.default_code = p.default_code
        LEFT JOIN item i ON i.code = coalesce(w.item_code, p.item_code) LEFT JOIN cur_rate r ON r.currency = coalesce(p.currency, 'ARS')),
    fold AS (
        SELECT default_code, CAST(0 AS BIGINT) AS n, today_cost, 'sellable' AS state, standard_price, standard_product_price, list_price, CAST(0 AS DOUBLE) AS margin FROM side
        UNION ALL
        SELECT f.default_code, e.n,
               CASE WHEN e.cost = 0 OR (stock AND lower) THEN f.today_cost ELSE e.cost END,
               CASE WHEN e.cost = 0 THEN 'obsolete' WHEN lower THEN 'offer' ELSE 'sellable' END,
               CASE WHEN e.cost = 0 OR stock THEN f.standard_price ELSE e.cost / s.rate END,
               CASE WHEN e.cost = 0 OR stock THEN f.standard_product_price ELSE e.cost END,
               CASE WHEN e.cost = 0 OR (stock AND lower) THEN f.list_price ELSE e.cost * (1 + s.m) END,
               CASE WHEN e.cost = 0 OR (stock AND lower) THEN f.margin ELSE 100 * s.m END
        FROM fold f JOIN numbered e ON e.default_code = f.default_code AND e.n = f.n + 1 JOIN side s ON s.default_code = f.default_code,
        LATERAL (SELECT f.today_cost <> 0 AND f.today_cost + 0.05e0 > e.cost AS lower) x),
    priced AS (SELECT * FROM fold QUALIFY row_number() OVER (PARTITION BY default_code ORDER BY n DESC) = 1),
    tax AS ({TAX_SQL.replace("'other'", "'vat'")}), pick AS (
        SELECT amount, use, MIN(id) AS tax_id FROM tax WHERE tax_group = 'vat' AND (amount <> 0 OR group_code = 2) GROUP BY amount, use)
    SELECT f.default_code, n.default_code IS NOT NULL AS category_stale,
           coalesce(n.name, p.name) AS name, CASE WHEN n.default_code IS NULL THEN 1 ELSE n.upv END AS upv,
           CASE WHEN n.default_code IS NULL THEN 0 ELSE n.wholesaler_bulk END AS wholesaler_bulk, n.description_sale,
           CAST(n.write_date AS VARCHAR) AS write_date, CASE WHEN n.default_code IS NOT NULL THEN 'product' END AS type,
           CASE WHEN n.default_code IS NOT NULL THEN 'order' END AS invoice_policy, CASE WHEN n.default_code IS NOT NULL THEN 'purchase' END AS purchase_method,
           CAST(s.tax_id AS BIGINT) AS sale_tax_id, CAST(b.tax_id AS BIGINT) AS purchase_tax_id, f.state,
           {", ".join(f"{r4(f'f.{c}')} AS {c}" for c in PRICES)}
    FROM priced f LEFT JOIN known p ON p.default_code = f.default_code LEFT JOIN newest n ON n.default_code = f.default_code
    LEFT JOIN pick s ON s.use = 'sale' AND s.amount = n.iva LEFT JOIN pick b ON b.use = 'purchase' AND b.amount = n.iva""")
def feed_stream(t: Tables):
    """The whole feed as a stream: daily files, several batches a run, finished files archived, then the final catalogue with its prices."""
    folder = shared_folder(t.spark)
    job = feed_job(t, f"{folder}/state")
    rows = feed(t)
    since = ""
    for until in RUNS:
        sinks.write_daily(rows.filter((F.col("write_date") >= since) & (F.col("write_date") < until)), f"{folder}/feed", order=["line_id"])
        stream = stream_feed(t.spark, f"{folder}/feed", FILES, f"{folder}/done")
        query = start_feed(stream, job, f"{folder}/checkpoint")
        query.awaitTermination()
        sinks.drop_empty_days(t.spark, f"{folder}/feed")
        since = until
    batches = query.lastProgress["batchId"] + 1
    columns = ["default_code", "category_stale", "name", "upv", "wholesaler_bulk", "description_sale", "type", "invoice_policy", "purchase_method", "sale_tax_id", "purchase_tax_id", "state"]
    last = job.table("product").read(t.spark, batches)
    return rounded(last.select(*columns, *PRICES, F.col("write_date").cast("string").alias("write_date")), *PRICES)
