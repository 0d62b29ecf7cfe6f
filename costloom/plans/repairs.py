"""Cost and currency repair queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import costing, repairs
from ..sources.tables import Tables
from .common import DATED_LINE, MARGINED, PURCHASE_LINE, TODAY, dated_lines, margined_lines, purchase_lines, rounded
from .costing import INVOICE_COST, OLDEST, PAID
from .registry import query, r4
from .stock import MOVE, stock_moves

HISTORIC = f"""historic AS (
    SELECT l.id AS line_id, s.price FROM dated_line l JOIN supplierinfo s ON s.product_tmpl_id = l.product_id
      AND s.date_start <= l.date_invoice AND (s.date_end IS NULL OR s.date_end >= l.date_invoice)
    QUALIFY row_number() OVER (PARTITION BY l.id ORDER BY s.date_start DESC, s.id) = 1)"""


def past_prices(t: Tables):
    dates = dated_lines(t).select(F.col("id").alias("line_id"), F.col("product_id").alias("product_tmpl_id"), F.col("date_invoice").alias("date"))
    return repairs.historic_price(dates, t.supplierinfo, keyed=t.invoice_line.select(F.col("product_id").alias("product_tmpl_id")))


@query(f""", {DATED_LINE}, {HISTORIC} SELECT line_id, price FROM historic""")
def historic_price(t: Tables):
    return past_prices(t)


@query("""SELECT id, product_id FROM invoice_line WHERE product_id IN (
        SELECT p.id FROM product p JOIN supplierinfo s ON s.product_tmpl_id = p.tmpl_id JOIN vendor v ON v.id = s.vendor_id
        WHERE v.business_mode = 'consignment')""")
def consignment_lines(t: Tables):
    return repairs.consignment_lines(t.invoice_line, t.product, t.supplierinfo, t.vendor).select("id", "product_id")


@query(f""", {MARGINED}, {HISTORIC}, h AS (
        SELECT m.*, coalesce(CASE WHEN m.business_mode = 'consignment' THEN x.price / coalesce(r.rate, 1) ELSE m.cost END, 0) AS past_cost
        FROM margined m LEFT JOIN historic x ON x.line_id = m.id LEFT JOIN product p ON p.id = m.product_id LEFT JOIN cur_rate r ON r.currency = p.currency)
    SELECT id, {r4("CASE WHEN type NOT IN ('out_invoice', 'out_refund') THEN NULL WHEN business_mode = 'undefined' THEN 1e10 WHEN net_price <> 0 AND past_cost <> 0 THEN net_price / past_cost - 1 ELSE 1e10 END")} AS product_margin
    FROM h WHERE product_id IN (SELECT s.product_tmpl_id FROM supplierinfo s JOIN vendor v ON v.id = s.vendor_id WHERE v.business_mode = 'consignment')""")
def consignment_margin(t: Tables):
    line = repairs.consignment_lines(dated_lines(t), t.product, t.supplierinfo, t.vendor)
    mode = costing.business_mode(t.product, t.supplierinfo, t.vendor)
    return rounded(costing.line_margin(line, mode, t.currency_rate, historic=past_prices(t)).select("id", "product_margin"), "product_margin")


@query("""SELECT id, date_start, CASE WHEN date_end < date_start THEN date_start ELSE date_end END AS date_end FROM supplierinfo""")
def repair_date_ranges(t: Tables):
    return repairs.repair_date_ranges(t.supplierinfo).select("id", "date_start", "date_end")


@query("""SELECT id, CASE WHEN price < 1000 THEN 0 ELSE price END AS price FROM supplierinfo WHERE price >= 1000""")
def drop_zero_prices(t: Tables):
    cheap = t.supplierinfo.withColumn("price", F.when(F.col("price") < 1000, 0.0).otherwise(F.col("price")))
    return repairs.drop_zero_prices(cheap).select("id", "price")


@query(f""", newest AS (SELECT product_id, arg_max(cost, id) AS cost FROM stock_layer GROUP BY 1)
    SELECT p.id, {r4("CASE WHEN p.standard_price = 0 THEN coalesce(n.cost, 0) ELSE p.standard_price END")} AS standard_price
    FROM product p LEFT JOIN newest n ON n.product_id = p.id""")
def latest_cost_fill(t: Tables):
    return rounded(repairs.latest_cost_fill(t.product, t.stock_layer).select("id", "standard_price"), "standard_price")


@query(f""", newest AS (SELECT product_id, arg_max(price_unit * (1 - discount / 100), id) AS net FROM invoice_line GROUP BY 1)
    SELECT s.id, {r4("CASE WHEN s.cost = 0 AND s.location = 'Stock' THEN coalesce(nullif(p.invoice_cost, 0), nullif(p.today_cost, 0), n.net, 0) ELSE s.cost END")} AS cost
    FROM stock_layer s LEFT JOIN product p ON p.id = s.product_id LEFT JOIN newest n ON n.product_id = s.product_id""")
def latest_invoice_cost(t: Tables):
    return rounded(repairs.latest_invoice_cost(t.stock_layer, t.product, t.invoice_line).select("id", "cost"), "cost")


CAP = f"""{MARGINED}, first_price AS (
    SELECT product_tmpl_id, date_start, price FROM supplierinfo WHERE date_start IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY product_tmpl_id ORDER BY date_start, id) = 1),
primary_product AS (SELECT DISTINCT s.product_tmpl_id FROM supplierinfo s JOIN vendor v ON v.id = s.vendor_id WHERE v.is_primary),
loss AS (
    SELECT m.id, m.product_id, m.date_invoice, m.price_unit,
           CASE WHEN f.date_start <= m.date_invoice AND f.price <> 0 THEN least(f.price, p.today_cost) ELSE p.today_cost END AS base
    FROM margined m JOIN product p ON p.id = m.product_id JOIN primary_product pp ON pp.product_tmpl_id = p.tmpl_id
    LEFT JOIN first_price f ON f.product_tmpl_id = p.tmpl_id
    WHERE m.product_margin < 0 AND m.state <> 'draft' AND m.date_invoice > DATE '1997-01-01' AND m.type = 'out_invoice'),
cap AS (SELECT *, CASE WHEN base * CAST(1.35 AS DOUBLE) > price_unit THEN price_unit / CAST(1.35 AS DOUBLE) ELSE base END AS cap FROM loss)"""


def caps(t: Tables):
    return repairs.sale_cost_caps(margined_lines(t), t.product, t.supplierinfo, t.vendor, "1997-01-01")


@query(f""", {CAP} SELECT id, {r4("cap")} AS cap, {r4("CASE WHEN cap <> 0 AND price_unit <> 0 THEN price_unit / cap - 1 ELSE 1e10 END")} AS product_margin FROM cap""")
def sale_cost_caps(t: Tables):
    return rounded(caps(t).select("id", "cap", "product_margin"), "cap", "product_margin")


@query(f""", {CAP}, low AS (
        SELECT s.id, MIN(c.cap) AS cap FROM stock_layer s JOIN cap c ON c.product_id = s.product_id AND s.in_date < c.date_invoice
        WHERE s.location = 'Stock' GROUP BY s.id)
    SELECT s.id, {r4("least(s.cost, coalesce(l.cap, s.cost))")} AS cost FROM stock_layer s LEFT JOIN low l ON l.id = s.id""")
def cap_layer_cost(t: Tables):
    return rounded(repairs.cap_layer_cost(t.stock_layer, caps(t)).select("id", "cost"), "cost")


@query(f""", {PURCHASE_LINE}, {OLDEST}, asked AS (
        SELECT DISTINCT d.product_id, coalesce(CAST(o.in_date AS DATE), d.date_invoice) AS day
        FROM dated_line d JOIN product p ON p.id = d.product_id LEFT JOIN oldest o ON o.product_id = d.product_id
        WHERE d.type = 'out_invoice' AND NOT contains(p.default_code, '-13')),
    near AS (
        SELECT a.product_id, a.day, {PAID} AS net, price_unit FROM asked a JOIN purchase_line l ON l.product_id = a.product_id WHERE l.discount_processed
        QUALIFY row_number() OVER (PARTITION BY a.product_id, a.day ORDER BY abs(date_diff('day', a.day, l.date_invoice)), l.date_invoice, l.id) = 1),
    low AS (SELECT product_id, MIN(net) AS low FROM near WHERE price_unit <> 0 GROUP BY 1)
    SELECT p.id, {r4("least(p.standard_price, coalesce(l.low, p.standard_price))")} AS standard_price,
           {r4("CASE WHEN l.low < p.standard_price THEN l.low ELSE p.standard_product_price END")} AS standard_product_price
    FROM product p LEFT JOIN low l ON l.product_id = p.id""")
def lower_standard_price(t: Tables):
    out = repairs.lower_standard_price(dated_lines(t), purchase_lines(t), t.stock_layer, t.product, skip_text="-13")
    return rounded(out.select("id", "standard_price", "standard_product_price"), "standard_price", "standard_product_price")


@query(f""", {DATED_LINE}
    SELECT l.id, {r4("CASE WHEN p.invoice_cost <> 0 THEN l.price_unit / coalesce(r.rate, 1) * (1 - l.discount / 100) / p.invoice_cost - 1 ELSE 1e10 END")} AS product_margin
    FROM dated_line l JOIN product p ON p.id = l.product_id
    ASOF LEFT JOIN currency_rate r ON r.currency = l.currency AND r.date <= l.date_invoice""")
def margin_at_invoice_fx(t: Tables):
    out = repairs.margin_at_invoice_fx(dated_lines(t), t.product, t.currency_rate)
    return rounded(out.select("id", "product_margin"), "product_margin")


@query(f""", {INVOICE_COST} SELECT id, {r4("invoice_cost")} AS invoice_cost FROM fresh_cost""")
def backfill_invoice_cost(t: Tables):
    out = repairs.backfill_invoice_cost(t.product, purchase_lines(t), t.stock_layer, t.currency_rate, TODAY)
    return rounded(out.select("id", "invoice_cost"), "invoice_cost")


@query(f""", first_price AS (SELECT product_tmpl_id, arg_min(price, id) AS price FROM supplierinfo GROUP BY 1), x AS (
        SELECT s.*, p.currency, f.price, CAST(s.in_date AS DATE) AS day FROM stock_layer s LEFT JOIN product p ON p.id = s.product_id
        LEFT JOIN first_price f ON f.product_tmpl_id = p.tmpl_id),
    y AS (SELECT x.*, r.rate FROM x ASOF LEFT JOIN currency_rate r ON r.currency = x.currency AND r.date <= x.day)
    SELECT id, {r4("CASE WHEN cost_product = 0 AND cost <> 0 AND currency = 'USD' AND price IS NOT NULL THEN price / coalesce(rate, 1) ELSE cost END")} AS cost,
           {r4("CASE WHEN cost_product = 0 AND cost <> 0 THEN CASE WHEN currency <> 'USD' THEN cost ELSE coalesce(price, 0) END ELSE cost_product END")} AS cost_product
    FROM y""")
def repair_layer_currency(t: Tables):
    out = repairs.repair_layer_currency(t.stock_layer, t.product, t.supplierinfo, t.currency_rate)
    return rounded(out.select("id", "cost", "cost_product"), "cost", "cost_product")


@query(f""", {MOVE}
    SELECT m.id, {r4("CASE WHEN m.price_product_unit = 0 AND m.price_unit <> 0 THEN m.price_unit * coalesce(r.rate, 1) ELSE m.price_product_unit END")} AS price_product_unit
    FROM stock_move m ASOF LEFT JOIN currency_rate r ON r.currency = m.product_currency AND r.date <= m.create_date""")
def repair_move_currency(t: Tables):
    out = repairs.repair_move_currency(stock_moves(t), t.currency_rate)
    return rounded(out.select("id", "price_product_unit"), "price_product_unit")


@query(f""", {OLDEST}
    SELECT p.id, {r4("CASE WHEN p.standard_product_price = 0 AND o.id IS NOT NULL THEN o.cost ELSE p.standard_price END")} AS standard_price,
           {r4("CASE WHEN p.standard_product_price = 0 AND o.id IS NOT NULL THEN o.cost_product ELSE p.standard_product_price END")} AS standard_product_price
    FROM product p LEFT JOIN oldest o ON o.product_id = p.id""")
def repair_standard_cost(t: Tables):
    out = repairs.repair_standard_cost(t.product, t.stock_layer)
    return rounded(out.select("id", "standard_price", "standard_product_price"), "standard_price", "standard_product_price")
