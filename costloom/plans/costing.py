"""Vendor, margin, discount and purchase-cost queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as fx
from ..operators import costing, currency
from ..sources.tables import Tables
from .common import (
    CUR_RATE,
    CURRENT_VENDOR,
    DATED_LINE,
    MARGINED,
    MODED,
    PURCHASE_LINE,
    TODAY,
    dated_lines,
    margined_lines,
    moded_product,
    purchase_lines,
    rounded,
)
from .registry import query, r4, xsum

# -- inputs ------------------------------------------------------------------


def receipts(t: Tables):
    """Stock receipts: purchase lines put into location 12 or another one."""
    return t.sql("""
        SELECT l.id, product_id, CASE WHEN line_no % 2 = 1 THEN 12 ELSE 8 END AS location_dest_id,
               source_vendor_id AS partner_id
        FROM {invoice_line} l JOIN {invoice} i ON i.id = l.invoice_id WHERE i.type = 'in_invoice'""")


RECEIPT = """receipt AS (
    SELECT l.id, product_id, source_vendor_id AS partner_id FROM invoice_line l
    JOIN invoice i ON i.id = l.invoice_id WHERE i.type = 'in_invoice' AND line_no % 2 = 1)"""

def partner_tags(t: Tables):
    """Two tags per partner in key-dependent order; one segment is untagged."""
    return t.sql("""
        SELECT id AS partner_id, segment AS tag, 1 + id % 2 AS tag_order FROM {partner} WHERE segment <> 'FURNITURE'
        UNION ALL
        SELECT id, concat('Nation ', CAST(nation_id AS STRING)), 2 - id % 2 FROM {partner} WHERE segment <> 'FURNITURE'""")


def product_taxes(t: Tables):
    none = F.array().cast("array<double>")
    taxes = F.when(F.col("tax_rate").isNull(), none).otherwise(F.array(F.lit(3.0), F.col("tax_rate")))
    return t.product.select(F.col("id").alias("product_id"), taxes.alias("taxes"))


def taxed_lines(t: Tables):
    """Lines with an array of VAT percentages."""
    rates = F.array_compact(F.array(F.when(F.col("vat_21"), F.lit(21.0)), F.when(F.col("vat_105"), F.lit(10.5))))
    return t.invoice_line.withColumn("vat_rates", rates)


# -- vendors -----------------------------------------------------------------


@query(f""", {CURRENT_VENDOR}
    SELECT p.id, n.vendor_id FROM product p LEFT JOIN newest_supplier n ON n.product_tmpl_id = p.tmpl_id""")
def current_vendor(t: Tables):
    return costing.current_vendor(t.product, t.supplierinfo).select("id", "vendor_id")


@query(f""", {RECEIPT}, dear AS (
        SELECT product_tmpl_id, vendor_id FROM supplierinfo
        QUALIFY row_number() OVER (PARTITION BY product_tmpl_id ORDER BY date_start DESC NULLS FIRST, id) = 1),
    last_receipt AS (
        SELECT product_id, partner_id FROM receipt QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY id DESC) = 1)
    SELECT l.id, coalesce(d.vendor_id, CASE WHEN v.supplier THEN r.partner_id END) AS vendor_id
    FROM invoice_line l LEFT JOIN dear d ON d.product_tmpl_id = l.product_id
    LEFT JOIN last_receipt r ON r.product_id = l.product_id LEFT JOIN vendor v ON v.id = r.partner_id""")
def vendor_with_fallback(t: Tables):
    line = t.invoice_line.withColumn("vendor_id", F.lit(None).cast("bigint"))
    out = costing.vendor_with_fallback(line, t.product, t.supplierinfo, receipts(t), t.vendor)
    return out.select("id", "vendor_id")


@query(f""", dear AS (
        SELECT product_tmpl_id, vendor_id FROM supplierinfo
        QUALIFY row_number() OVER (PARTITION BY product_tmpl_id ORDER BY date_start DESC NULLS FIRST, id) = 1)
    SELECT l.id, coalesce(d.vendor_id, l.source_vendor_id) AS vendor_id
    FROM invoice_line l LEFT JOIN dear d ON d.product_tmpl_id = l.product_id""")
def backfill_vendor(t: Tables):
    line = t.invoice_line.withColumn("vendor_id", F.col("source_vendor_id"))
    return costing.backfill_vendor(line, t.product, t.supplierinfo).select("id", "vendor_id")


@query(f""", {MODED} SELECT id, business_mode FROM moded""")
def business_mode(t: Tables):
    return moded_product(t).select("id", "business_mode")


@query("""SELECT id, coalesce(business_mode, 'standard') AS business_mode FROM vendor""")
def default_business_mode(t: Tables):
    return costing.default_business_mode(t.vendor).select("id", "business_mode")


@query("""SELECT i.id, CASE WHEN p.segment = 'FURNITURE' THEN NULL WHEN p.id % 2 = 0 THEN p.segment
                 ELSE 'Nation ' || p.nation_id END AS tag
    FROM invoice i LEFT JOIN partner p ON p.id = i.partner_id""")
def first_partner_tag(t: Tables):
    return costing.first_partner_tag(t.invoice, partner_tags(t)).select("id", "tag")


# -- prices and margins ------------------------------------------------------


@query(f"""SELECT id, {r4("price_unit * (1 - discount / 100)")} AS net_unit_price FROM invoice_line""")
def net_unit_price(t: Tables):
    out = t.invoice_line.withColumn("net_unit_price", fx.net_unit_price(F.col("price_unit"), F.col("discount")))
    return rounded(out.select("id", "net_unit_price"), "net_unit_price")


@query(f"""SELECT id, {r4("CASE WHEN list_price <> 0 AND today_cost <> 0 THEN list_price / today_cost - 1 ELSE 1e10 END")} AS margin
    FROM product""")
def margin_ratio(t: Tables):
    out = t.product.withColumn("margin", fx.margin_ratio(F.col("list_price"), F.col("today_cost")))
    return rounded(out.select("id", "margin"), "margin")


@query(f""", {MARGINED} SELECT id, {r4("product_margin")} AS product_margin FROM margined""")
def line_margin(t: Tables):
    return rounded(margined_lines(t).select("id", "product_margin"), "product_margin")


@query(f""", {CUR_RATE}, {DATED_LINE}, {MODED}, p AS (
        SELECT d.*, m.business_mode, d.price_unit * (1 - d.discount / 100) / coalesce(ri.rate, 1) AS net_price,
               CASE WHEN m.business_mode = 'consignment' THEN m.today_cost / coalesce(rp.rate, 1)
                    WHEN m.virtual_available >= 0 THEN m.standard_price
                    ELSE m.today_cost / coalesce(rp.rate, 1) END AS cost
        FROM dated_line d LEFT JOIN moded m ON m.id = d.product_id
        LEFT JOIN cur_rate ri ON ri.currency = d.currency LEFT JOIN cur_rate rp ON rp.currency = m.currency)
    SELECT id, {r4("CASE WHEN type NOT IN ('out_invoice', 'out_refund') THEN NULL WHEN business_mode = 'undefined' THEN 1e10 WHEN net_price <> 0 AND cost <> 0 THEN net_price / cost - 1 ELSE 1e10 END")} AS product_margin
    FROM p""")
def line_margin_converted(t: Tables):
    out = costing.line_margin(dated_lines(t), moded_product(t), t.currency_rate, convert_negative_stock=True)
    return rounded(out.select("id", "product_margin"), "product_margin")


@query("""SELECT id, CASE WHEN tax_rate IS NULL THEN 0 ELSE tax_rate / 100 END AS product_iva
    FROM (SELECT l.id, p.tax_rate FROM invoice_line l LEFT JOIN product p ON p.id = l.product_id)""")
def line_vat(t: Tables):
    return costing.line_vat(t.invoice_line, product_taxes(t)).select("id", "product_iva")


@query(f""", {DATED_LINE}
    SELECT l.id, CASE WHEN l.date_invoice < DATE '2000-01-27' THEN l.product_iva
                      WHEN p.tax_rate IS NULL THEN 0 ELSE p.tax_rate / 100 END AS product_iva
    FROM dated_line l LEFT JOIN product p ON p.id = l.product_id""")
def backfill_vat(t: Tables):
    return costing.backfill_vat(dated_lines(t), product_taxes(t), "2000-01-27").select("id", "product_iva")


@query(f""", {CUR_RATE}
    SELECT p.id, {r4("list_price / coalesce(r.rate, 1) * (1 + coalesce(tax_rate, 0) / 100)")} AS final_price
    FROM product p LEFT JOIN cur_rate r ON r.currency = p.currency""")
def final_price(t: Tables):
    return rounded(costing.final_price(t.product, t.currency_rate).select("id", "final_price"), "final_price")


@query(f"""SELECT l.id, {r4("l.price_unit * (1 + p.loyalty / 100)")} AS loyalty_price
    FROM invoice_line l JOIN invoice i ON i.id = l.invoice_id LEFT JOIN partner p ON p.id = i.partner_id""")
def loyalty_price(t: Tables):
    sale = t.invoice_line.join(t.invoice.select(F.col("id").alias("invoice_id"), "partner_id"), "invoice_id")
    out = costing.loyalty_price(sale.withColumn("price", F.col("price_unit")), t.partner)
    return rounded(out.select("id", "loyalty_price"), "loyalty_price")


@query(f""", s AS (
        SELECT id, price_unit * (1 + CASE WHEN line_no % 3 = 0 THEN 0 ELSE CAST(line_no AS DOUBLE) END / 100)
                   * (1 - discount / 100) * quantity AS subtotal,
               CASE WHEN vat_21 THEN 21 ELSE 0 END + CASE WHEN vat_105 THEN 10.5 ELSE 0 END AS rate
        FROM invoice_line)
    SELECT id, {r4("subtotal")} AS price_subtotal, {r4("subtotal * CAST(rate AS DOUBLE) / 100")} AS price_tax,
           {r4("subtotal + subtotal * CAST(rate AS DOUBLE) / 100")} AS price_total
    FROM s""")
def sale_line_amount(t: Tables):
    ml = F.when(F.col("line_no") % 3 == 0, None).otherwise(F.col("line_no").cast("double"))
    line = taxed_lines(t).select("id", "price_unit", "discount", ml.alias("price_unit_ml"), F.col("quantity").alias("product_uom_qty"), F.col("vat_rates").alias("tax_rates"))
    names = ["price_subtotal", "price_tax", "price_total"]
    return rounded(costing.sale_line_amount(line).select("id", *names), *names)


@query(f"""SELECT id,
        {r4("CASE WHEN line_no = 2 THEN price_unit ELSE price_unit / ((1 - CAST(0.25 AS DOUBLE)) * (1 - discount / 100)) END")} AS list_price,
        {r4("CASE WHEN line_no = 2 THEN price_unit * ((1 - CAST(0.25 AS DOUBLE)) * (1 - discount / 100)) ELSE price_unit END")} AS price_unit
    FROM invoice_line""")
def gross_up(t: Tables):
    line = t.invoice_line.select(
        "id",
        "discount",
        F.when(F.col("line_no") == 2, F.col("price_unit")).otherwise(F.lit(0.0)).alias("list_price"),
        F.when(F.col("line_no") == 2, F.lit(0.0)).otherwise(F.col("price_unit")).alias("price_unit"),
    )
    return rounded(costing.gross_up(line, 25.0).drop("discount"), "list_price", "price_unit")


@query(f"""SELECT id, {r4("CASE WHEN list_price <> 0 AND today_cost <> 0 THEN 100 * (list_price / today_cost - 1) ELSE 7 END")} AS margin
    FROM product""")
def margin_backfill(t: Tables):
    out = costing.margin_backfill(t.product.withColumn("margin", F.lit(7.0)))
    return rounded(out.select("id", "margin"), "margin")


# -- currency ----------------------------------------------------------------

ASOF = """dated_rate AS (
    SELECT l.id, l.date_invoice, l.currency, r.rate FROM dated_line l
    ASOF LEFT JOIN currency_rate r ON r.currency = l.currency AND r.date <= l.date_invoice)"""


@query(f""", {DATED_LINE}, {ASOF} SELECT id, currency, {r4("rate * 1000")} AS rate FROM dated_rate""")
def fx_asof(t: Tables):
    out = currency.fx_asof(dated_lines(t), t.currency_rate, "currency", "date_invoice")
    return rounded(out.select("id", "currency", (F.col("rate") * 1000).alias("rate")), "rate")


@query(f""", {DATED_LINE}, {ASOF}, {CUR_RATE}
    SELECT l.id, {r4("l.price_unit / coalesce(a.rate, 1)")} AS dated, {r4("l.price_unit / coalesce(c.rate, 1)")} AS current,
           {r4("l.price_unit / coalesce(c.rate, 1) * coalesce(u.rate, 1)")} AS product_currency
    FROM dated_line l JOIN dated_rate a ON a.id = l.id LEFT JOIN cur_rate c ON c.currency = l.currency
    LEFT JOIN product p ON p.id = l.product_id LEFT JOIN cur_rate u ON u.currency = p.currency""")
def convert(t: Tables):
    line = dated_lines(t).select("id", "product_id", "price_unit", "currency", "date_invoice")
    out = currency.convert(line, t.currency_rate, "price_unit", "currency", None, "dated", date_col="date_invoice")
    out = currency.convert(out, t.currency_rate, "price_unit", "currency", None, "current")
    out = out.join(t.product.select(F.col("id").alias("product_id"), F.col("currency").alias("to_currency")), "product_id", "left")
    out = currency.convert_from_company(out, t.currency_rate, "current", "to_currency", "product_currency")
    names = ["dated", "current", "product_currency"]
    return rounded(out.select("id", *names), *names)


@query(f""", {CUR_RATE}
    SELECT l.id,
           {r4("l.price_unit / (1 + CASE WHEN l.vat_21 THEN 21 ELSE CAST(0 AS DOUBLE) END / 100) * (CAST(1 + l.line_no % 2 * 11 AS DOUBLE) / CAST(1 AS DOUBLE)) / coalesce(r.rate, 1)")} AS move_price_unit,
           {r4("l.price_unit / (1 + CASE WHEN l.vat_21 THEN 21 ELSE CAST(0 AS DOUBLE) END / 100) * (CAST(1 + l.line_no % 2 * 11 AS DOUBLE) / CAST(1 AS DOUBLE)) / coalesce(r.rate, 1) * coalesce(u.rate, 1)")} AS move_price_product_unit
    FROM invoice_line l JOIN invoice i ON i.id = l.invoice_id LEFT JOIN product p ON p.id = l.product_id
    LEFT JOIN cur_rate r ON r.currency = i.currency LEFT JOIN cur_rate u ON u.currency = p.currency
    WHERE i.type = 'in_invoice'""")
def move_unit_price(t: Tables):
    line = dated_lines(t).filter("type = 'in_invoice'")
    line = line.join(t.product.select(F.col("id").alias("product_id"), F.col("currency").alias("product_currency")), "product_id", "left")
    line = line.withColumns(
        {
            "included_tax_rate": F.when(F.col("vat_21"), F.lit(21.0)),
            "line_uom_factor": (1 + F.col("line_no") % 2 * 11).cast("double"),
            "product_uom_factor": F.lit(1.0),
        }
    )
    names = ["move_price_unit", "move_price_product_unit"]
    return rounded(costing.move_unit_price(line, t.currency_rate).select("id", *names), *names)


@query(f""", {DATED_LINE}, u AS (
        SELECT l.id, l.date_invoice, l.currency,
               CASE WHEN l.line_no % 2 = 0 THEN p.standard_price ELSE p.standard_price * CAST(12 AS DOUBLE) / CAST(1 AS DOUBLE) END AS unit
        FROM dated_line l JOIN product p ON p.id = l.product_id)
    SELECT u.id, {r4("u.unit * coalesce(r.rate, 1)")} AS purchase_price
    FROM u ASOF LEFT JOIN currency_rate r ON r.currency = u.currency AND r.date <= u.date_invoice""")
def sale_purchase_price(t: Tables):
    line = dated_lines(t).join(t.product.select(F.col("id").alias("product_id"), "standard_price"), "product_id")
    even = F.col("line_no") % 2 == 0
    line = line.withColumns({"product_uom_factor": F.when(even, 1.0).otherwise(12.0), "line_uom_factor": F.lit(1.0)})
    out = costing.sale_purchase_price(line, t.currency_rate, "date_invoice")
    return rounded(out.select("id", "purchase_price"), "purchase_price")


# -- global discounts --------------------------------------------------------


@query("""SELECT id, state, type FROM invoice
    WHERE NOT discount_processed AND state IN ('open', 'paid') AND type = 'in_invoice'""")
def pending_invoices(t: Tables):
    return costing.pending_invoices(t.invoice).select("id", "state", "type")


VAT_SUM = f"""taxed AS (
    SELECT l.*, CAST(21 AS DOUBLE) AS vat_rate, price_unit * (1 - discount / 100) * quantity AS subtotal FROM invoice_line l WHERE vat_21
    UNION ALL
    SELECT l.*, CAST(10.5 AS DOUBLE), price_unit * (1 - discount / 100) * quantity FROM invoice_line l WHERE vat_105),
vat_sum AS (
    SELECT invoice_id, vat_rate,
           {xsum("CASE WHEN price_subtotal_signed >= 0 THEN subtotal ELSE 0 END")} AS goods,
           {xsum("CASE WHEN price_subtotal_signed < 0 THEN subtotal ELSE 0 END")} AS discounts
    FROM taxed GROUP BY invoice_id, vat_rate),
vat_discount AS (SELECT *, CASE WHEN goods = 0 THEN 0 ELSE discounts / goods END AS rate FROM vat_sum)"""


@query(f""", {VAT_SUM} SELECT invoice_id, vat_rate, goods, discounts, {r4("rate")} AS rate FROM vat_discount""")
def discount_rate_by_vat(t: Tables):
    return rounded(costing.discount_rate_by_vat(taxed_lines(t)), "rate")


@query(f""", {VAT_SUM}
    SELECT l.id, {r4("CASE WHEN price_subtotal_signed > 0 AND vat_105 THEN b.rate WHEN price_subtotal_signed > 0 AND vat_21 THEN a.rate ELSE l.invoice_discount END")} AS invoice_discount
    FROM invoice_line l LEFT JOIN vat_discount a ON a.invoice_id = l.invoice_id AND a.vat_rate = 21
    LEFT JOIN vat_discount b ON b.invoice_id = l.invoice_id AND b.vat_rate = 10.5""")
def allocate_invoice_discount(t: Tables):
    return rounded(costing.allocate_invoice_discount(taxed_lines(t)).select("id", "invoice_discount"), "invoice_discount")


# -- purchase cost -----------------------------------------------------------

OLDEST = """oldest AS (
    SELECT * FROM stock_layer WHERE location_usage = 'internal'
    QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY in_date NULLS LAST, id) = 1)"""

NEAREST = f"""{PURCHASE_LINE}, {OLDEST}, nearest AS (
    SELECT l.*, coalesce(CAST(o.in_date AS DATE), DATE '{TODAY}') AS since
    FROM purchase_line l JOIN product p ON p.id = l.product_id LEFT JOIN oldest o ON o.product_id = l.product_id
    WHERE l.discount_processed
    QUALIFY row_number() OVER (PARTITION BY l.product_id
        ORDER BY abs(date_diff('day', since, l.date_invoice)) NULLS LAST, l.date_invoice NULLS LAST, l.id) = 1)"""

PAID = "price_unit * (1 - discount / 100) * (1 + coalesce(invoice_discount, 0)) * CASE WHEN is_primary THEN CAST(0.95 AS DOUBLE) ELSE 1 END"


@query(f""", {OLDEST} SELECT id, product_id, CAST(in_date AS DATE) AS in_date FROM oldest""")
def oldest_layer(t: Tables):
    return costing.oldest_layer(t.stock_layer).select("id", "product_id", F.col("in_date").cast("date").alias("in_date"))


@query(f""", {NEAREST} SELECT product_id, id, date_invoice FROM nearest""")
def closest_invoice_line(t: Tables):
    return costing.closest_invoice_line(t.product, purchase_lines(t), t.stock_layer, TODAY).select("product_id", "id", "date_invoice")


INVOICE_COST = f"""{NEAREST}, conv AS (
    SELECT n.product_id, n.date_invoice, {PAID} AS net, n.price_unit, n.currency AS cur_from, p.currency AS cur_to
    FROM nearest n JOIN product p ON p.id = n.product_id),
conv2 AS (SELECT c.*, r.rate AS rate_from FROM conv c ASOF LEFT JOIN currency_rate r ON r.currency = c.cur_from AND r.date <= c.date_invoice),
conv3 AS (SELECT c.*, r.rate AS rate_to FROM conv2 c ASOF LEFT JOIN currency_rate r ON r.currency = c.cur_to AND r.date <= c.date_invoice),
fresh_cost AS (
    SELECT p.id, coalesce(CASE WHEN c.price_unit <> 0 THEN c.net * coalesce(c.rate_to, 1) / coalesce(c.rate_from, 1) END, 0) AS invoice_cost
    FROM product p LEFT JOIN conv3 c ON c.product_id = p.id)"""


@query(f""", {INVOICE_COST} SELECT id, {r4("invoice_cost")} AS invoice_cost FROM fresh_cost""")
def invoice_cost(t: Tables):
    out = costing.invoice_cost(t.product, purchase_lines(t), t.stock_layer, t.currency_rate, TODAY)
    return rounded(out.select("id", "invoice_cost"), "invoice_cost")


@query("""SELECT s.id, p.tmpl_id AS product_tmpl_id, p.currency FROM stock_layer s LEFT JOIN product p ON p.id = s.product_id""")
def denormalize_layers(t: Tables):
    return costing.denormalize(t.stock_layer, t.product).select("id", "product_tmpl_id", "currency")


@query(f""", {DATED_LINE} SELECT id, invoice_id, date_invoice FROM dated_line""")
def denormalize_lines(t: Tables):
    return costing.with_invoice(t.invoice_line, t.invoice, "date_invoice").select("id", "invoice_id", "date_invoice")


@query("""SELECT id, product_id, row_number() OVER (PARTITION BY product_id ORDER BY in_date NULLS LAST, id) AS history_no
    FROM stock_layer WHERE location_usage = 'internal'""")
def cost_history(t: Tables):
    return costing.cost_history(t.product, t.stock_layer).select("id", "product_id", "history_no")


@query("""SELECT product_tmpl_id, id, n FROM (
        SELECT product_tmpl_id, id, row_number() OVER (PARTITION BY product_tmpl_id ORDER BY date_start DESC NULLS FIRST, id) AS n
        FROM supplierinfo) WHERE n <= 3""")
def top_k_per_key(t: Tables):
    out = costing.top_k(t.supplierinfo, ["product_tmpl_id"], [F.col("date_start").desc_nulls_first(), F.col("id")], 3, "n")
    return out.select("product_tmpl_id", "id", F.col("n").cast("bigint").alias("n"))


@query("""SELECT id, date_invoice FROM invoice ORDER BY date_invoice DESC, id DESC LIMIT 25""")
def newest_invoices(t: Tables):
    # A global top 25 is the feature here: a listing's first page.
    return costing.ordered(t.invoice.select("id", "date_invoice"), "date_invoice", "id", newest_first=True).limit(25)


@query("""SELECT id, date_invoice, row_number() OVER (ORDER BY date_invoice DESC, id DESC) AS position FROM invoice""")
def invoice_listing(t: Tables):
    return costing.listed(t.invoice.select("id", "date_invoice"), "date_invoice", "id", newest_first=True)
