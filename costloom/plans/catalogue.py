"""Feed, item, category, barcode, tax and brand queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as fx
from ..operators import catalogue
from ..sources.tables import DEFINITIONS, Tables
from .common import rounded
from .registry import query, r4


def flat(text: str) -> str:
    """Spark's braces around table names removed, for the check SQL."""
    for name in (*DEFINITIONS, "part"):
        text = text.replace("{" + name + "}", name)
    return text


# -- inputs ------------------------------------------------------------------

# One feed row per invoice line, as text; every kind of bad cell occurs.
FEED_SQL = """
    SELECT l.id AS line_id,
           CASE WHEN p.id % 15 = 0 THEN concat('996.', p.default_code) ELSE p.default_code END AS default_code,
           p.name AS name,
           CASE WHEN l.line_no = 2 THEN '' ELSE concat(p.name, ', boxed') END AS description_sale,
           CASE WHEN l.line_no = 7 AND p.id % 7 = 0 THEN 'n/a'
                WHEN l.line_no = 6 AND p.id % 7 = 0 THEN ''
                ELSE concat(CAST(CAST(floor(abs(l.price_unit)) AS BIGINT) AS STRING), '.',
                            lpad(CAST(l.id % 100 AS STRING), 2, '0')) END AS pack_cost,
           CASE WHEN l.line_no = 5 AND p.id % 5 = 0 THEN '0'
                WHEN l.line_no = 4 AND p.id % 6 = 0 THEN ''
                WHEN l.line_no = 3 AND p.id % 9 = 0 THEN '1.5'
                ELSE CAST(1 + l.line_no * 10 AS STRING) END AS upv,
           CASE WHEN l.line_no = 1 THEN '.000' ELSE '21.000' END AS weight,
           CASE WHEN l.line_no = 1 AND p.id % 11 = 0 THEN 'heavy' ELSE '' END AS volume,
           CASE WHEN l.line_no = 3 AND p.id % 25 = 1 THEN '' ELSE CAST(CAST(l.quantity AS BIGINT) AS STRING) END AS wholesaler_bulk,
           '50' AS retail_bulk, '' AS image_name, '0' AS warranty,
           CASE WHEN l.line_no % 2 = 1 THEN '21.00' ELSE '10.50' END AS iva,
           p.item_code AS item_code,
           CASE WHEN l.line_no = 1 AND p.id % 30 = 2 THEN '2018-25-01 00:00:00'
                ELSE concat(CAST(i.date_invoice AS STRING), ' 10:00:00') END AS write_date
    FROM {invoice_line} l JOIN {product} p ON p.id = l.product_id JOIN {invoice} i ON i.id = l.invoice_id"""

PARSED = f"""feed_raw AS ({flat(FEED_SQL)}), bad AS (
    SELECT line_id, 'pack_cost: not a number: ' || pack_cost AS reason FROM feed_raw WHERE pack_cost <> '' AND TRY_CAST(pack_cost AS DOUBLE) IS NULL
    UNION ALL SELECT line_id, 'upv: not a number: ' || upv FROM feed_raw WHERE upv <> '' AND NOT regexp_full_match(upv, '[0-9]+')
    UNION ALL SELECT line_id, 'upv: pack size is zero' FROM feed_raw WHERE upv IN ('', '0')
    UNION ALL SELECT line_id, 'volume: not a number: ' || volume FROM feed_raw WHERE volume <> '' AND TRY_CAST(volume AS DOUBLE) IS NULL
    UNION ALL SELECT line_id, 'wholesaler_bulk: not a number: ' || wholesaler_bulk FROM feed_raw WHERE NOT regexp_full_match(wholesaler_bulk, '[0-9]+')
    UNION ALL SELECT line_id, 'write_date: not a timestamp' FROM feed_raw WHERE TRY_CAST(write_date AS TIMESTAMP) IS NULL),
good AS (
    SELECT line_id, default_code, name, CASE WHEN description_sale <> '' THEN description_sale END AS description_sale,
           CASE WHEN pack_cost = '' THEN 0 ELSE CAST(pack_cost AS DOUBLE) END / CAST(upv AS BIGINT) AS cost,
           CAST(upv AS BIGINT) AS upv, CAST(weight AS DOUBLE) AS weight, CAST(wholesaler_bulk AS BIGINT) AS wholesaler_bulk,
           CAST(iva AS DOUBLE) AS iva, item_code, CAST(write_date AS TIMESTAMP) AS write_date
    FROM feed_raw f WHERE NOT EXISTS (SELECT 1 FROM bad b WHERE b.line_id = f.line_id))"""

# The catalogue before the feed: the sellable half, protected codes prefixed.
CURRENT_SQL = """
    SELECT id, CASE WHEN id % 15 = 0 THEN concat('996.', default_code) ELSE default_code END AS default_code,
           concat('old ', name) AS name, CAST(7 AS BIGINT) AS upv, list_price
    FROM {product} WHERE state = 'sellable'"""

INCOMING_ITEM_SQL = """
    SELECT DISTINCT p_type AS code, concat('Item ', p_type) AS name, p_type AS origin,
           concat('Section ', substr(p_type, 1, 1)) AS section, concat('Family ', substr(p_type, 1, 2)) AS family,
           CAST(length(p_type) % 5 AS DOUBLE) / 10 + CASE WHEN length(p_type) > 5 THEN CAST(0.4 AS DOUBLE) ELSE CAST(0.3 AS DOUBLE) END AS margin
    FROM {part} WHERE p_type <> 'SMALL'"""

CODES_SQL = """
    SELECT default_code AS product_code,
           concat('779', CAST(CASE WHEN id % 50 = 1 THEN id - 1 ELSE id END AS STRING)) AS barcode FROM {product}"""
HELD_SQL = """
    SELECT concat('779', CAST(id AS STRING)) AS barcode, CASE WHEN can_modify_prices THEN id + 1 ELSE id END AS product_id
    FROM {product} WHERE currency = 'USD' OR can_modify_prices"""

TAX_ROWS = [(1, 21.0, "sale", "vat", 5), (2, 21.0, "sale", "vat", 5), (3, 10.5, "sale", "vat", 4), (4, 0.0, "sale", "vat", 1), (5, 0.0, "sale", "vat", 2),
            (6, 21.0, "purchase", "vat", 5), (7, 10.5, "purchase", "other", 4), (8, 0.0, "purchase", "vat", 2), (9, 10.5, "sale", "vat", 4)]
TAX_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, CAST({a} AS DOUBLE), '{u}', '{g}', {c})" for i, a, u, g, c in TAX_ROWS
) + ") AS tax(id, amount, use, tax_group, group_code)"

BRAND_SQL = """
    SELECT n AS id, (n * 7) % 25 AS checked_order,
           CASE WHEN n % 3 = 0 THEN concat('C', CAST(n AS STRING), '-%')
                WHEN n % 3 = 1 THEN concat('C', CAST(n AS STRING), '-1_%')
                ELSE concat('%-', CAST(n AS STRING), '%') END AS mask
    FROM (SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS n FROM {part})"""
BRAND = f"brand AS ({flat(BRAND_SQL)})"
BRANDED = f"""{BRAND}, branded AS (
    SELECT p.id, p.default_code, b.id AS brand_id FROM product p LEFT JOIN brand b ON p.default_code LIKE b.mask
    QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY b.checked_order DESC, b.id DESC) = 1)"""


def feed(t: Tables):
    return t.sql(FEED_SQL)


def good_feed(t: Tables):
    return catalogue.good_rows(catalogue.parse_feed(feed(t)))


# -- feed --------------------------------------------------------------------


@query(f""", {PARSED} SELECT line_id, default_code, name, description_sale, {r4("cost")} AS cost, upv, weight, wholesaler_bulk, iva, item_code,
           'product' AS type, 'order' AS invoice_policy FROM good""")
def parse_feed(t: Tables):
    out = good_feed(t).select(
        "line_id", "default_code", "name", "description_sale", "cost", "upv", "weight", "wholesaler_bulk", "iva", "item_code", "type", "invoice_policy"
    )
    return rounded(out, "cost")


@query(f""", {PARSED} SELECT line_id, reason FROM bad""")
def feed_rejects(t: Tables):
    return catalogue.reject_rows(catalogue.parse_feed(feed(t))).select("line_id", "reason")


@query(f"""SELECT id, {r4("price_unit / (1 + line_no * 10)")} AS cost FROM invoice_line""")
def cost_per_unit(t: Tables):
    cost = fx.cost_per_unit(F.col("price_unit"), 1 + F.col("line_no") * 10)
    return rounded(t.invoice_line.select("id", cost.alias("cost")), "cost")


@query(f""", feed_raw AS ({flat(FEED_SQL)}) SELECT line_id, write_date FROM feed_raw WHERE write_date > '1999-06-30 00:00:00'""")
def newer_than(t: Tables):
    return catalogue.newer_than(feed(t), "1999-06-30 00:00:00").select("line_id", "write_date")


@query(f""", {PARSED}, cur AS ({flat(CURRENT_SQL)})
    SELECT line_id, default_code FROM good WHERE NOT (default_code LIKE '996.%' AND default_code IN (SELECT default_code FROM cur))""")
def protected_prefix(t: Tables):
    return catalogue.protected_prefix(good_feed(t), t.sql(CURRENT_SQL)).select("line_id", "default_code")


@query(f""", {PARSED}, cur AS ({flat(CURRENT_SQL)}),
    newest AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY default_code ORDER BY write_date DESC, line_id DESC) = 1)
    SELECT coalesce(c.default_code, n.default_code) AS default_code,
           CASE WHEN n.default_code IS NULL THEN 'kept' WHEN c.default_code IS NULL THEN 'created'
                WHEN c.default_code LIKE '996.%' THEN 'protected' ELSE 'updated' END AS action,
           CASE WHEN n.default_code IS NULL OR (c.default_code LIKE '996.%') THEN c.name ELSE n.name END AS name,
           CASE WHEN n.default_code IS NULL OR (c.default_code LIKE '996.%') THEN c.upv ELSE n.upv END AS upv,
           c.list_price, n.default_code IS NOT NULL AND NOT coalesce(c.default_code LIKE '996.%', FALSE) AS category_stale
    FROM cur c FULL JOIN newest n ON n.default_code = c.default_code""")
def upsert_products(t: Tables):
    out = catalogue.upsert_products(t.sql(CURRENT_SQL), good_feed(t), ["name", "upv"], ["write_date", "line_id"])
    return out.select("default_code", "action", "name", "upv", "list_price", "category_stale")


@query(f""", incoming AS ({flat(INCOMING_ITEM_SQL)})
    SELECT coalesce(n.code, o.code) AS code, coalesce(n.margin, o.margin) AS margin,
           CASE WHEN o.code IS NULL THEN 'created' WHEN n.code IS NULL THEN 'unchanged'
                WHEN n.margin <> o.margin THEN 'updated' ELSE 'unchanged' END AS action
    FROM item o FULL JOIN incoming n ON n.code = o.code""")
def upsert_items(t: Tables):
    current = t.item.withColumn("origin", F.col("code"))
    return catalogue.upsert_items(current, t.sql(INCOMING_ITEM_SQL)).select("code", "margin", "action")


# -- items and categories ----------------------------------------------------


@query("""SELECT p.id, i.name AS item_name, i.section, i.family, coalesce(i.margin, 0) AS item_margin
    FROM product p LEFT JOIN item i ON i.code = p.item_code""")
def with_item(t: Tables):
    return catalogue.with_item(t.product, t.item).select("id", "item_name", "section", "family", "item_margin")


@query("""SELECT id, default_code, item_code FROM product WHERE item_code NOT IN (SELECT code FROM item)""")
def missing_item_report(t: Tables):
    return catalogue.missing_item_report(t.product, t.item).select("id", "default_code", "item_code")


@query("""SELECT section AS path, section AS name, NULL AS parent_path, 1 AS level, 'real' AS cost_method FROM item
    UNION SELECT section || '/' || family, family, section, 2, 'real' FROM item
    UNION SELECT section || '/' || family || '/' || name, name, section || '/' || family, 3, 'real' FROM item""")
def build_categories(t: Tables):
    return catalogue.build_categories(t.item).select("path", "name", "parent_path", "level", "cost_method")


@query("""SELECT code, 'real' AS cost_method, 'real_time' AS valuation, 1 AS removal_strategy_id, '1.1.05.01.010' AS valuation_account,
           '1.1.05.01.020' AS input_account, '1.1.05.01.030' AS output_account FROM item""")
def stamp_category_defaults(t: Tables):
    return catalogue.stamp_category_defaults(t.item.select("code"))


@query("""SELECT p.id, CASE WHEN p.discontinued AND i.code IS NOT NULL THEN i.section || '/' || i.family || '/' || i.name END AS categ_path,
           p.discontinued AND i.code IS NULL AS category_stale
    FROM product p LEFT JOIN item i ON i.code = p.item_code""")
def set_category(t: Tables):
    stale = catalogue.mark_category_stale(F.col("discontinued"))
    product = t.product.withColumns({"category_stale": stale, "categ_path": F.lit(None).cast("string"), "categ_id": F.lit(None).cast("bigint")})
    return catalogue.set_category(product, t.item).select("id", "categ_path", "category_stale")


# -- barcodes and taxes ------------------------------------------------------


@query(f""", codes AS ({flat(CODES_SQL)}) SELECT barcode, COUNT(*) AS n_rows FROM codes GROUP BY barcode HAVING COUNT(*) > 1""")
def duplicate_barcodes(t: Tables):
    return catalogue.duplicate_barcodes(t.sql(CODES_SQL))


@query(f""", codes AS ({flat(CODES_SQL)}), held AS ({flat(HELD_SQL)}),
    ok AS (SELECT * FROM codes WHERE barcode NOT IN (SELECT barcode FROM codes GROUP BY barcode HAVING COUNT(*) > 1))
    SELECT p.id AS product_id, c.barcode, CASE WHEN h.barcode IS NULL THEN 'created' WHEN h.product_id <> p.id THEN 'changed' ELSE 'unchanged' END AS action
    FROM ok c JOIN product p ON p.default_code = c.product_code LEFT JOIN held h ON h.barcode = c.barcode""")
def link_barcodes(t: Tables):
    codes = t.sql(CODES_SQL)
    clean = codes.join(catalogue.duplicate_barcodes(codes), "barcode", "left_anti")
    return catalogue.link_barcodes(t.product, clean, t.sql(HELD_SQL)).drop("product_code")


@query(f""", tax AS ({TAX_SQL}), pick AS (
        SELECT amount, use, MIN(id) AS tax_id FROM tax WHERE tax_group = 'vat' AND (amount <> 0 OR group_code = 2) GROUP BY amount, use)
    SELECT p.id, s.tax_id AS sale_tax_id, b.tax_id AS purchase_tax_id, s.tax_id IS NULL OR b.tax_id IS NULL AS tax_missing
    FROM product p LEFT JOIN pick s ON s.use = 'sale' AND s.amount = coalesce(p.tax_rate, 0)
    LEFT JOIN pick b ON b.use = 'purchase' AND b.amount = coalesce(p.tax_rate, 0)""")
def choose_tax(t: Tables):
    product = t.product.select("id", F.coalesce("tax_rate", F.lit(0.0)).alias("iva"))
    return catalogue.choose_tax(product, t.sql(TAX_SQL)).drop("iva")


# -- codes and brands --------------------------------------------------------


@query("""SELECT id, trim(replace(default_code, '-', '')) AS clean_code FROM product""")
def normalize_code(t: Tables):
    return t.product.select("id", fx.normalize_code(F.col("default_code")).alias("clean_code"))


@query("""SELECT replace(default_code, '-', '') AS clean_code, COUNT(*) AS n_products, MIN(id) AS first_id, MAX(id) AS last_id
    FROM product GROUP BY 1 HAVING COUNT(*) > 1""")
def duplicate_codes(t: Tables):
    return catalogue.duplicate_codes(t.product)


@query("""SELECT id, default_code, replace(default_code, '-', '') AS clean_code FROM product
    WHERE replace(default_code, '-', '') IN (SELECT replace(default_code, '-', '') FROM product GROUP BY 1 HAVING COUNT(*) > 1)""")
def duplicate_code_members(t: Tables):
    return catalogue.duplicate_code_members(t.product).select("id", "default_code", "clean_code")


@query("""SELECT n.default_code, n.id, EXISTS (
        SELECT 1 FROM product p WHERE replace(p.default_code, '-', '') = replace(n.default_code, '-', '') AND p.id <> coalesce(n.id, -1)) AS rejected
    FROM (SELECT CASE WHEN discontinued THEN NULL ELSE id END AS id,
                 CASE WHEN currency = 'USD' THEN concat('NEW-', default_code) ELSE concat(default_code, '-') END AS default_code FROM product) n""")
def duplicate_gate(t: Tables):
    incoming = t.product.select(
        F.when(~F.col("discontinued"), F.col("id")).alias("id"),
        F.when(F.col("currency") == "USD", F.concat(F.lit("NEW-"), "default_code")).otherwise(F.concat("default_code", F.lit("-"))).alias("default_code"),
    )
    return catalogue.duplicate_gate(incoming, t.product).select("default_code", "id", "rejected")


@query("""SELECT id, default_code FROM product WHERE default_code LIKE 'C7-1%'""")
def code_like(t: Tables):
    return catalogue.code_like(t.product, "C7-1%").select("id", "default_code")


@query("""SELECT id, default_code FROM product WHERE discontinued""")
def discontinued(t: Tables):
    return catalogue.discontinued(t.product).select("id", "default_code")


@query("""SELECT l.id, p.discontinued FROM invoice_line l LEFT JOIN product p ON p.id = l.product_id""")
def discontinued_lines(t: Tables):
    return catalogue.discontinued_lines(t.invoice_line, t.product).select("id", "discontinued")


@query(f""", {BRANDED} SELECT id, default_code, brand_id FROM branded""")
def assign_brands(t: Tables):
    return catalogue.assign_brands(t.product, t.sql(BRAND_SQL)).select("id", "default_code", "brand_id")


@query(f""", {BRANDED} SELECT b.id AS brand_id, COUNT(p.id) AS product_count FROM brand b LEFT JOIN branded p ON p.brand_id = b.id GROUP BY b.id""")
def brand_product_count(t: Tables):
    brand = t.sql(BRAND_SQL)
    return catalogue.brand_product_count(catalogue.assign_brands(t.product, brand), brand)
