"""Supplier-sheet and business-rule queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sinks
from ..operators import audits
from ..schemas import SHEET_COLUMNS
from ..sources.tables import Tables
from .catalogue import flat
from .common import dated_lines, rounded
from .registry import query, r4

# -- supplier sheets ---------------------------------------------------------

# Price lines as sheet rows; rare quantities carry the bad cells.
SHEET_SQL = """
    SELECT concat('U', CAST(l.product_id % 500 AS STRING)) AS upload_id,
           CAST(l.source_vendor_id AS INT) AS sheet_no, l.id AS row_no,
           CASE WHEN l.source_vendor_id % 40 = 39 AND l.product_id % 6 = 1 THEN 'Nobody' ELSE v.ref END AS vendor_ref,
           CASE WHEN l.quantity > 46 THEN concat('N', p.default_code) ELSE concat(p.default_code, ' ') END AS default_code_text,
           CASE WHEN l.quantity = 3 AND l.line_no = 7 THEN 'int' WHEN l.quantity = 4 AND l.line_no = 7 THEN NULL ELSE 'text' END AS default_code_kind,
           CASE WHEN l.quantity = 44 AND l.line_no < 3 THEN 'EUR' ELSE p.currency END AS currency_text,
           CASE WHEN l.quantity = 40 THEN NULL ELSE 'text' END AS currency_kind,
           CASE WHEN l.quantity = 13 AND l.line_no = 1 THEN 'text' ELSE 'float' END AS cost_kind, abs(l.price_unit) AS cost_num,
           CASE WHEN l.quantity = 14 AND l.line_no = 1 THEN NULL ELSE 'int' END AS price_kind, CAST(floor(abs(l.price_unit) * 1.5e0) AS DOUBLE) AS price_num,
           p.name AS name_text, CASE WHEN l.line_no = 5 THEN NULL ELSE 'text' END AS name_kind,
           CASE WHEN l.quantity = 17 AND l.line_no = 2 THEN 0.5e0 WHEN l.vat_21 THEN 0.21e0 ELSE 0.105e0 END AS purchase_tax_num,
           CASE WHEN l.line_no = 6 THEN NULL ELSE 'float' END AS purchase_tax_kind,
           0.21e0 AS sale_tax_num, CASE WHEN l.quantity = 18 AND l.line_no = 2 THEN 'text' WHEN l.line_no = 6 THEN NULL ELSE 'float' END AS sale_tax_kind,
           concat(' 779', CAST(l.product_id AS STRING)) AS barcode_text, l.product_id * 1e0 AS barcode_num,
           CASE WHEN l.quantity = 19 AND l.line_no = 3 THEN 'int' WHEN l.line_no % 2 = 0 THEN NULL ELSE 'text' END AS barcode_kind,
           CASE WHEN l.line_no = 3 THEN '  ' ELSE 'MLA1' END AS meli_text, CASE WHEN l.line_no = 2 THEN NULL ELSE 'text' END AS meli_kind,
           CASE WHEN l.quantity = 23 AND l.line_no = 4 THEN 'ZZZ' ELSE 'C0-0' END AS parent_text,
           CASE WHEN l.line_no IN (1, 4) THEN 'text' WHEN l.quantity = 29 AND l.line_no = 3 THEN 'int' ELSE NULL END AS parent_kind, 7e0 AS parent_num
    FROM {invoice_line} l JOIN {product} p ON p.id = l.product_id JOIN {vendor} v ON v.id = l.source_vendor_id"""

TEXT = {"default_code", "currency", "name", "barcode", "meli", "parent"}
NUMBER = {"cost", "price", "purchase_tax", "sale_tax", "barcode", "parent"}


def sheets(t: Tables):
    raw = t.sql(SHEET_SQL)

    def cell(c: str):
        kind = F.col(f"{c}_kind")
        text = F.when(kind == "text", F.col(f"{c}_text") if c in TEXT else F.lit("x"))
        number = F.when(kind.isin("int", "float"), F.col(f"{c}_num") if c in NUMBER else F.lit(1.0))
        return F.struct(text.alias("text"), number.alias("num"), kind.alias("kind")).alias(c)

    return raw.select("upload_id", "sheet_no", "row_no", "vendor_ref", *[cell(c) for c in SHEET_COLUMNS])


SHEET = f"""sheet AS ({flat(SHEET_SQL)}), row_ AS (
    SELECT s.*, p.id IS NOT NULL AS product_exists FROM sheet s
    LEFT JOIN product p ON s.default_code_kind = 'text' AND p.default_code = trim(s.default_code_text)
    WHERE s.default_code_kind IS NOT NULL),
error AS (
    SELECT upload_id, vendor_ref, sheet_no, row_no, 'default_code' AS "column", 'product code must be text' AS reason FROM row_ WHERE default_code_kind <> 'text'
    UNION ALL SELECT upload_id, vendor_ref, sheet_no, row_no, 'currency', 'currency must be ARS or USD' FROM row_
        WHERE (currency_kind = 'text' AND currency_text NOT IN ('ARS', 'USD')) OR (currency_kind IS NULL AND NOT product_exists)
    UNION ALL SELECT upload_id, vendor_ref, sheet_no, row_no, 'cost', 'must be an amount of money' FROM row_ WHERE cost_kind = 'text'
    UNION ALL SELECT upload_id, vendor_ref, sheet_no, row_no, 'price', 'must be an amount of money' FROM row_ WHERE price_kind IS NULL
    UNION ALL SELECT upload_id, vendor_ref, sheet_no, row_no, 'name', 'description must be text' FROM row_ WHERE name_kind IS NULL AND NOT product_exists
    UNION ALL SELECT upload_id, vendor_ref, sheet_no, row_no, 'purchase_tax', 'must be a VAT fraction' FROM row_
        WHERE (purchase_tax_kind = 'float' AND purchase_tax_num NOT IN (0.21e0, 0.105e0)) OR (purchase_tax_kind IS NULL AND NOT product_exists)
    UNION ALL SELECT upload_id, vendor_ref, sheet_no, row_no, 'sale_tax', 'must be a VAT fraction' FROM row_
        WHERE sale_tax_kind = 'text' OR (sale_tax_kind IS NULL AND NOT product_exists)
    UNION ALL SELECT upload_id, vendor_ref, sheet_no, row_no, 'barcode', 'must be text' FROM row_ WHERE barcode_kind = 'int' AND barcode_num <> 0
    UNION ALL SELECT upload_id, vendor_ref, sheet_no, row_no, 'parent', 'parent product does not exist' FROM row_ WHERE parent_kind = 'text' AND parent_text = 'ZZZ'
    UNION ALL SELECT upload_id, vendor_ref, sheet_no, row_no, 'parent', 'parent must be text' FROM row_ WHERE parent_kind = 'int'),
vendor_status AS (
    SELECT DISTINCT s.upload_id, s.sheet_no, s.vendor_ref, v.id AS vendor_id, CASE WHEN v.id IS NULL THEN 'unknown' ELSE 'ok' END AS status
    FROM row_ s LEFT JOIN vendor v ON v.ref = s.vendor_ref),
first_bad AS (
    SELECT upload_id, MIN(sheet_no) AS bad FROM (SELECT upload_id, sheet_no FROM error UNION ALL SELECT upload_id, sheet_no FROM vendor_status WHERE status <> 'ok') GROUP BY 1),
loaded AS (
    SELECT r.*, trim(default_code_text) AS default_code FROM row_ r LEFT JOIN first_bad b ON b.upload_id = r.upload_id WHERE b.bad IS NULL OR r.sheet_no < b.bad)"""


def checked_sheets(t: Tables):
    return audits.validate_sheet(sheets(t), t.product)


def loaded_sheets(t: Tables):
    return audits.load_sheets(sheets(t), t.product, t.vendor)[1]


@query(f""", {SHEET} SELECT upload_id, vendor_ref, sheet_no, row_no, "column", reason FROM error""")
def validate_sheet(t: Tables):
    return audits.sheet_errors(checked_sheets(t))


@query(f""", {SHEET} SELECT upload_id, sheet_no, vendor_ref, vendor_id, status FROM vendor_status""")
def check_vendors(t: Tables):
    rows = sheets(t).filter(F.col("default_code.kind").isNotNull())
    return audits.check_vendors(rows, t.vendor)


@query(f""", {SHEET} SELECT upload_id, sheet_no, row_no, default_code, {r4("cost_num")} AS cost, price_num AS price,
           CASE WHEN currency_kind = 'text' THEN currency_text END AS currency,
           CASE WHEN barcode_kind = 'text' THEN trim(barcode_text) END AS barcode,
           CASE WHEN meli_kind = 'text' AND trim(meli_text) <> '' THEN trim(meli_text) END AS meli, product_exists FROM loaded""")
def sheet_gate(t: Tables):
    out = loaded_sheets(t).select("upload_id", "sheet_no", "row_no", "default_code", "cost", "price", "currency", "barcode", "meli", "product_exists")
    return rounded(out, "cost")


def sheet_catalogue(t: Tables):
    none = lambda: F.lit(None).cast("string")
    return t.product.select(
        "default_code", "name", none().alias("force_currency"), none().alias("meli"), "parent_price_product", F.lit(None).cast("double").alias("supplier_tax_rate"), "tax_rate"
    )


@query(f""", {SHEET}, newest AS (
        SELECT default_code, arg_max(currency_text, (sheet_no, row_no)) FILTER (currency_kind = 'text') AS currency,
               arg_max(name_text, (sheet_no, row_no)) FILTER (name_kind = 'text') AS name,
               arg_max(parent_text, (sheet_no, row_no)) FILTER (parent_kind = 'text') AS parent,
               arg_max(trim(meli_text), (sheet_no, row_no)) FILTER (meli_kind = 'text' AND trim(meli_text) <> '') AS meli,
               arg_max(purchase_tax_num, (sheet_no, row_no)) FILTER (purchase_tax_kind = 'float') AS purchase_tax,
               arg_max(sale_tax_num, (sheet_no, row_no)) FILTER (sale_tax_kind = 'float') AS sale_tax,
               arg_max(trim(barcode_text), (sheet_no, row_no)) FILTER (barcode_kind = 'text') AS barcode,
               arg_max(cost_num, (sheet_no, row_no)) AS cost, arg_max(price_num, (sheet_no, row_no)) AS price, arg_max(vendor_ref, (sheet_no, row_no)) AS vendor_ref
        FROM loaded GROUP BY default_code)
    SELECT coalesce(n.default_code, p.default_code) AS default_code, coalesce(n.name, p.name) AS name,
           CASE WHEN n.currency <> 'ARS' THEN n.currency END AS force_currency, n.meli, coalesce(n.parent, p.parent_price_product) AS parent_price_product,
           n.purchase_tax * 100 AS supplier_tax_rate, coalesce(n.sale_tax * 100, p.tax_rate) AS tax_rate, n.barcode AS new_barcode,
           {r4("n.cost")} AS new_cost, n.price AS new_price, n.vendor_ref,
           CASE WHEN n.default_code IS NULL THEN 'kept' WHEN p.default_code IS NULL THEN 'created' ELSE 'updated' END AS action
    FROM product p FULL JOIN newest n ON n.default_code = p.default_code""")
def upsert_supplier_products(t: Tables):
    return rounded(audits.upsert_supplier_products(sheet_catalogue(t), loaded_sheets(t), "ARS"), "new_cost")


@query(f""", {SHEET}, act AS (SELECT DISTINCT upload_id, default_code, product_exists FROM loaded),
    v AS (SELECT DISTINCT upload_id, sheet_no, vendor_ref FROM row_),
    names AS (SELECT upload_id, string_agg(vendor_ref, ', ' ORDER BY sheet_no, vendor_ref) AS vendors
              FROM (SELECT upload_id, vendor_ref, MIN(sheet_no) AS sheet_no FROM v GROUP BY 1, 2) GROUP BY 1),
    done AS (SELECT upload_id, COUNT(*) FILTER (NOT product_exists) AS c, COUNT(*) FILTER (product_exists) AS u FROM act GROUP BY 1),
    bad AS (SELECT upload_id, COUNT(*) AS e FROM error GROUP BY 1)
    SELECT n.upload_id, n.vendors, coalesce(d.c, 0) AS created_products, coalesce(d.u, 0) AS updated_products, coalesce(b.e, 0) AS errors,
           CASE WHEN coalesce(b.e, 0) > 0 THEN 'error' ELSE 'done' END AS state
    FROM names n LEFT JOIN done d ON d.upload_id = n.upload_id LEFT JOIN bad b ON b.upload_id = n.upload_id""")
def import_log(t: Tables):
    checked, loaded = audits.load_sheets(sheets(t), t.product, t.vendor, ["default_code"])
    loaded = loaded.select("upload_id", "default_code", "product_exists").distinct()
    actions = loaded.withColumn("action", F.when(F.col("product_exists"), "updated").otherwise("created"))
    return sinks.import_log(actions, audits.sheet_errors(checked), checked)


# -- discounts and priorities ------------------------------------------------

RULE_SQL = """
    SELECT id, id % 12 AS user_id, CASE WHEN balance < 3000 THEN pricelist_id ELSE NULL END AS pricelist_id,
           CAST(id % 3 AS DOUBLE) AS min_discount, CAST(id % 3 + id % 7 AS DOUBLE) AS max_discount FROM {partner}"""
RULE = f"rule AS ({flat(RULE_SQL)})"

AUDIT_LINE_SQL = """
    SELECT l.id, i.user_id, p.pricelist_id, l.discount, CASE WHEN l.line_no = 2 THEN 3e0 ELSE NULL END AS pricelist_discount,
           i.type, i.user_id <> 3 AS restricted, g.can_modify_prices
    FROM {invoice_line} l JOIN {invoice} i ON i.id = l.invoice_id JOIN {partner} p ON p.id = i.partner_id JOIN {product} g ON g.id = l.product_id"""
AUDIT_LINE = f"audit_line AS ({flat(AUDIT_LINE_SQL)})"

SALE_LINE_SQL = """SELECT id AS invoice_line_id, discount - 1e0 + line_no % 3 AS discount FROM {invoice_line} WHERE vat_105"""

USED_RULE = """exact_rule AS (SELECT * FROM rule QUALIFY row_number() OVER (PARTITION BY user_id, pricelist_id ORDER BY id) = 1),
any_rule AS (SELECT * FROM rule QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY id) = 1)"""

VIOLATION = f"""SELECT id, net AS net_discount,
        CASE WHEN lo IS NULL THEN 'no discount allowed' ELSE 'outside the allowed range' END AS reason, lo + pl AS min_allowed, hi + pl AS max_allowed
    FROM (SELECT l.id, l.discount - coalesce(l.pricelist_discount, 0) AS net, coalesce(l.pricelist_discount, 0) AS pl,
                 CASE WHEN e.id IS NOT NULL THEN e.min_discount ELSE a.min_discount END AS lo,
                 CASE WHEN e.id IS NOT NULL THEN e.max_discount ELSE a.max_discount END AS hi
          FROM checked l LEFT JOIN exact_rule e ON e.user_id = l.user_id AND e.pricelist_id = l.pricelist_id
          LEFT JOIN any_rule a ON a.user_id = l.user_id)
    WHERE net <> 0 AND (lo IS NULL OR net < lo OR net > hi)"""


@query(f""", {RULE}, {AUDIT_LINE}, {USED_RULE}, checked AS (SELECT * FROM audit_line) {VIOLATION}""")
def discount_violations(t: Tables):
    out = audits.discount_violations(t.sql(AUDIT_LINE_SQL), t.sql(RULE_SQL))
    return out.select("id", "net_discount", "reason", "min_allowed", "max_allowed")


@query(f""", {RULE}, {AUDIT_LINE}, {USED_RULE}, sale_line AS ({flat(SALE_LINE_SQL)}), checked AS (
        SELECT * FROM audit_line l WHERE type IN ('out_invoice', 'out_refund') AND restricted AND NOT can_modify_prices
        AND NOT EXISTS (SELECT 1 FROM sale_line s WHERE s.invoice_line_id = l.id AND round(s.discount, 3) >= round(l.discount, 3))) {VIOLATION}""")
def invoice_discount_violations(t: Tables):
    out = audits.invoice_discount_violations(t.sql(AUDIT_LINE_SQL), t.sql(SALE_LINE_SQL), t.sql(RULE_SQL))
    return out.select("id", "net_discount", "reason", "min_allowed", "max_allowed")


LIST_SQL = "SELECT pricelist_id AS id, 10 - CAST(MAX(id) % 7 AS INT) AS sequence FROM {partner} GROUP BY pricelist_id"
TERM_SQL = "SELECT payment_term_id AS id, CAST(MIN(id) AS INT) + 1 AS sequence FROM {partner} GROUP BY payment_term_id"
ORDER_SQL = """SELECT id, partner_id, document_type_id AS pricelist_id, journal_id AS payment_term_id, user_id <> 3 AS restricted FROM {invoice}"""


@query(f""", lists AS ({flat(LIST_SQL)}), terms AS ({flat(TERM_SQL)}), o AS ({flat(ORDER_SQL)}), x AS (
        SELECT o.*, coalesce(hl.sequence < ul.sequence, FALSE) AS pricelist_violation, coalesce(ht.sequence < ut.sequence, FALSE) AS payment_term_violation
        FROM o JOIN partner p ON p.id = o.partner_id
        LEFT JOIN lists ul ON ul.id = o.pricelist_id LEFT JOIN lists hl ON hl.id = p.pricelist_id
        LEFT JOIN terms ut ON ut.id = o.payment_term_id LEFT JOIN terms ht ON ht.id = p.payment_term_id WHERE o.restricted)
    SELECT id, pricelist_violation, payment_term_violation FROM x WHERE pricelist_violation OR payment_term_violation""")
def priority_violations(t: Tables):
    out = audits.priority_violations(t.sql(ORDER_SQL), t.partner, t.sql(LIST_SQL), t.sql(TERM_SQL))
    return out.select("id", "pricelist_violation", "payment_term_violation")


# -- availability ------------------------------------------------------------


def order_lines(t: Tables):
    """Customer lines as sale lines: draft invoices are open orders."""
    return dated_lines(t).select(
        "id",
        F.col("invoice_id").alias("order_id"),
        "product_id",
        F.col("state").alias("order_state"),
        F.col("quantity").alias("product_uom_qty"),
        F.when(F.col("line_no") == 3, F.lit(12.0)).otherwise(F.lit(1.0)).alias("line_uom_factor"),
        F.lit(1.0).alias("product_uom_factor"),
        F.col("vat_105").alias("routed"),
    )


AVAILABLE = """available AS (
    SELECT l.id, l.invoice_id AS order_id, i.state,
           CASE WHEN p.type = 'product' AND i.state IN ('draft', 'sent')
                     AND NOT round(p.virtual_available, 3) >= round(l.quantity / CASE WHEN l.line_no = 3 THEN 12e0 ELSE 1e0 END, 3)
                THEN l.vat_105 ELSE TRUE END AS is_available
    FROM invoice_line l JOIN invoice i ON i.id = l.invoice_id JOIN product p ON p.id = l.product_id)"""


@query(f""", {AVAILABLE} SELECT id, is_available FROM available""")
def line_available(t: Tables):
    return audits.line_available(order_lines(t), t.product).select("id", "is_available")


@query(f""", {AVAILABLE} SELECT order_id, bool_and(is_available OR state NOT IN ('draft', 'sent')) AS is_available FROM available GROUP BY order_id""")
def order_available(t: Tables):
    return audits.order_available(audits.line_available(order_lines(t), t.product))
