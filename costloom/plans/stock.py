"""Stock ledger and reconciliation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stock
from ..sources.tables import Tables
from .common import CUR_RATE, rounded
from .registry import query, r4, xsum

SIGNED_SQL = """CASE WHEN i.type IN ('in_invoice', 'out_refund') THEN l.quantity
                     WHEN i.type IN ('in_refund', 'out_invoice') THEN -l.quantity ELSE 0 END"""

POSTED = f"""posted AS (
    SELECT p.default_code, {xsum(SIGNED_SQL)} AS qty
    FROM invoice_line l JOIN product p ON p.id = l.product_id JOIN invoice i ON i.id = l.invoice_id
    WHERE i.state <> 'draft' GROUP BY p.default_code)"""


def stock_moves(t: Tables):
    """One move per invoice line: purchases come in, sales leave internal stock."""
    return t.sql(MOVE_SQL)


MOVE_SQL = """
    SELECT l.id, l.product_id, l.quantity + CAST(l.line_no AS DOUBLE) / 8 AS qty, l.quantity AS product_qty,
           CASE WHEN l.line_no % 2 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0.25 AS DOUBLE) END AS uom_step,
           l.price_unit, CASE WHEN l.line_no = 3 THEN CAST(0 AS DOUBLE) ELSE l.price_unit / 2 END AS price_product_unit,
           CASE WHEN i.type IN ('out_invoice', 'in_refund') THEN 12 ELSE 8 END AS location_id,
           CASE WHEN i.type IN ('out_invoice', 'in_refund') THEN 9 ELSE 12 END AS location_dest_id,
           CASE WHEN i.type IN ('out_invoice', 'in_refund') THEN 'internal' ELSE 'supplier' END AS source_usage,
           CASE WHEN l.line_no = 1 THEN l.id ELSE NULL END AS lot_id,
           CASE WHEN l.product_id % 2 = 0 THEN 'serial' ELSE 'none' END AS tracking,
           CASE WHEN i.type = 'in_invoice' THEN i.currency ELSE NULL END AS po_currency,
           l.price_unit * (1 - l.discount / 100) AS po_unit,
           p.currency AS product_currency,
           i.date_invoice AS create_date
    FROM {invoice_line} l JOIN {invoice} i ON i.id = l.invoice_id JOIN {product} p ON p.id = l.product_id"""

MOVE = "stock_move AS (" + MOVE_SQL.replace("{", "").replace("}", "") + ")"


@query(f"""SELECT p.default_code, {xsum(SIGNED_SQL)} AS stock_by_invoices
    FROM invoice_line l JOIN product p ON p.id = l.product_id JOIN invoice i ON i.id = l.invoice_id
    GROUP BY p.default_code""")
def stock_by_invoices(t: Tables):
    return stock.stock_by_invoices(t.invoice_line, t.invoice, t.product)


@query(f""", {POSTED} SELECT default_code, qty FROM posted""")
def stock_by_posted_invoices(t: Tables):
    return stock.stock_by_posted_invoices(t.invoice_line, t.invoice, t.product)


@query(f""", {POSTED}, first_supplier AS (SELECT product_tmpl_id, arg_min(vendor_id, id) AS vendor_id FROM supplierinfo GROUP BY 1)
    SELECT p.default_code AS code, p.name, coalesce(v.ref, '') AS vendor, p.qty_available AS on_hand,
           p.virtual_available AS forecast, coalesce(CAST(CAST(q.qty AS DECIMAL(18,2)) AS VARCHAR), 'S/Fact') AS invoiced,
           {r4("p.today_cost")} AS cost_today, {r4("p.standard_product_price")} AS cost_purchase
    FROM product p LEFT JOIN first_supplier f ON f.product_tmpl_id = p.tmpl_id LEFT JOIN vendor v ON v.id = f.vendor_id
    LEFT JOIN posted q ON q.default_code = p.default_code
    WHERE p.virtual_available <> 0 AND p.type = 'product'""")
def stock_reconciliation(t: Tables):
    posted = stock.stock_by_posted_invoices(t.invoice_line, t.invoice, t.product)
    out = stock.stock_reconciliation(t.product, posted, t.supplierinfo, t.vendor)
    return rounded(out, "cost_today", "cost_purchase")


@query(f""", m AS (
        SELECT s.invoice_id AS id, MIN(s.product_id) AS product_id, SUM(abs(s.qty)) AS product_qty FROM stock_layer s GROUP BY 1),
    v AS (SELECT invoice_id, bool_and(qty > 0) AS good, {xsum("qty * cost")} AS a, {xsum("qty * cost_product")} AS b FROM stock_layer GROUP BY 1)
    SELECT m.id, m.product_id, {r4("a / product_qty")} AS price_unit, {r4("b / product_qty")} AS price_product_unit
    FROM m JOIN v ON v.invoice_id = m.id WHERE good AND product_qty <> 0""")
def average_layer_cost(t: Tables):
    layers = t.stock_layer.withColumnRenamed("invoice_id", "move_id")
    move = layers.groupBy(F.col("move_id").alias("id")).agg(F.min("product_id").alias("product_id"), F.sum(F.abs("qty")).alias("product_qty"))
    out = stock.average_layer_cost(move, layers.select("move_id", "qty", "cost", "cost_product"))
    return rounded(out, "price_unit", "price_product_unit")


@query(f""", {MOVE}, e AS (
        SELECT *, floor(qty / uom_step + 0.5) * uom_step AS q,
               NOT (lot_id IS NOT NULL AND tracking = 'serial' AND qty <> 1) AS valid FROM stock_move)
    SELECT id AS move_id, product_id, location_dest_id AS location_id, q AS qty, valid FROM e
    UNION ALL
    SELECT id, product_id, location_id, -q, valid FROM e WHERE source_usage = 'internal'""")
def stock_ledger(t: Tables):
    moves = stock_moves(t).withColumns({"cost": F.col("price_unit"), "cost_product": F.col("price_product_unit")})
    return stock.stock_ledger(moves).select("move_id", "product_id", "location_id", "qty", "valid")


@query(f""", {MOVE}, {CUR_RATE}, m AS (
        SELECT s.*, po_unit / coalesce(r.rate, 1) AS company, po_unit / coalesce(r.rate, 1) * coalesce(u.rate, 1) AS product
        FROM stock_move s LEFT JOIN cur_rate r ON r.currency = s.po_currency LEFT JOIN cur_rate u ON u.currency = s.product_currency)
    SELECT id, {r4("CASE WHEN po_currency = 'USD' THEN company ELSE price_unit END")} AS price_unit,
           {r4("CASE WHEN po_currency = 'USD' THEN product WHEN po_currency IS NOT NULL THEN price_product_unit ELSE price_unit END")} AS price_product_unit
    FROM m""")
def revalue_moves(t: Tables):
    out = stock.revalue_moves(stock_moves(t), t.currency_rate, "ARS")
    return rounded(out.select("id", "price_unit", "price_product_unit"), "price_unit", "price_product_unit")
