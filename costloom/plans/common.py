"""Inputs shared by queries, as DataFrames and as the matching SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_point import round_units
from ..operators import catalogue, costing, sales
from ..sources.tables import Tables

TODAY = "2001-08-01"  # reporting day of the data set


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Round the named columns to ten-thousandths, as the check SQL does."""
    return df.withColumns({c: round_units(F.col(c)) for c in columns})


def dated_lines(t: Tables) -> DataFrame:
    """Invoice lines with their invoice's columns."""
    return costing.with_invoice(t.invoice_line, t.invoice, "type", "state", "currency", "date_invoice", "discount_processed")


def purchase_lines(t: Tables) -> DataFrame:
    """Dated lines with the primary-vendor flag."""
    primary = t.vendor.select(F.col("id").alias("source_vendor_id"), "is_primary")
    return dated_lines(t).join(primary, "source_vendor_id", "left")


def moded_product(t: Tables) -> DataFrame:
    return costing.business_mode(t.product, t.supplierinfo, t.vendor)


def margined_lines(t: Tables) -> DataFrame:
    return costing.line_margin(dated_lines(t), moded_product(t), t.currency_rate)


def categorised_product(t: Tables) -> DataFrame:
    """Product with the category of its item and its brand name as brand."""
    blank = t.product.withColumns(
        {
            "categ_path": F.lit(None).cast("string"),
            "categ_id": F.lit(None).cast("bigint"),
            "category_stale": F.lit(True),
            "brand_id": F.col("brand_name"),
        }
    )
    return catalogue.set_category(blank, t.item)


def fact(t: Tables) -> DataFrame:
    product = costing.mode_and_vendor(categorised_product(t), t.supplierinfo, t.vendor)
    return sales.margin_fact(t.invoice_line, t.invoice, product, t.partner, t.currency_rate)


CUR_RATE = "cur_rate AS (SELECT currency, arg_max(rate, date) AS rate FROM currency_rate GROUP BY currency)"

DATED_LINE = """dated_line AS (
    SELECT l.*, i.type, i.state, i.currency, i.date_invoice, i.discount_processed
    FROM invoice_line l LEFT JOIN invoice i ON i.id = l.invoice_id)"""

PURCHASE_LINE = DATED_LINE + """, purchase_line AS (
    SELECT d.*, v.is_primary FROM dated_line d LEFT JOIN vendor v ON v.id = d.source_vendor_id)"""

MODED = """moded AS (
    SELECT p.*, CASE WHEN s.vendor_id IS NULL THEN 'undefined' ELSE v.business_mode END AS business_mode
    FROM product p
    LEFT JOIN (SELECT product_tmpl_id, vendor_id FROM supplierinfo
               QUALIFY row_number() OVER (PARTITION BY product_tmpl_id ORDER BY date_start DESC NULLS LAST, id) = 1) s
      ON s.product_tmpl_id = p.tmpl_id
    LEFT JOIN vendor v ON v.id = s.vendor_id)"""

CURRENT_VENDOR = """newest_supplier AS (
    SELECT product_tmpl_id, vendor_id FROM supplierinfo
    QUALIFY row_number() OVER (PARTITION BY product_tmpl_id ORDER BY date_start DESC NULLS FIRST, id) = 1)"""

NET = "(price_unit * (1 - discount / 100))"

MARGINED = (
    f"{CUR_RATE}, {DATED_LINE}, {MODED}"
    """, priced_line AS (
    SELECT d.*, d.price_unit * (1 - d.discount / 100) / coalesce(ri.rate, 1) AS net_price,
           m.business_mode,
           CASE WHEN m.business_mode = 'consignment' THEN m.today_cost / coalesce(rp.rate, 1)
                WHEN m.virtual_available >= 0 THEN m.standard_price
                ELSE m.today_cost END AS cost
    FROM dated_line d
    LEFT JOIN moded m ON m.id = d.product_id
    LEFT JOIN cur_rate ri ON ri.currency = d.currency
    LEFT JOIN cur_rate rp ON rp.currency = m.currency
), margined AS (
    SELECT *, CASE WHEN type NOT IN ('out_invoice', 'out_refund') THEN NULL
                   WHEN business_mode = 'undefined' THEN 1e10
                   WHEN coalesce(net_price, 0) <> 0 AND coalesce(cost, 0) <> 0 THEN net_price / cost - 1
                   ELSE 1e10 END AS product_margin
    FROM priced_line)"""
)

FACT = (
    f"{MARGINED}, {CURRENT_VENDOR}"
    """, fact AS (
    SELECT l.id, l.price_subtotal_signed AS price_total,
           l.price_subtotal_signed * (1 + l.product_iva) AS price_total_taxed,
           CASE WHEN 1 + l.product_margin = 0 THEN NULL ELSE l.price_subtotal_signed / (1 + l.product_margin) END AS cost_total,
           CASE WHEN 1 + l.product_margin = 0 THEN NULL ELSE l.price_subtotal_signed / (1 + l.product_margin) * (1 + l.product_iva) END AS cost_total_taxed,
           l.product_margin * 100 AS margin_percent,
           CASE WHEN 1 + l.product_margin = 0 THEN NULL ELSE l.price_subtotal_signed * l.product_margin / (1 + l.product_margin) END AS margin_total,
           CASE WHEN 1 + l.product_margin = 0 THEN NULL ELSE l.price_subtotal_signed * l.product_margin / (1 + l.product_margin) * (1 + l.product_iva) END AS margin_total_taxed,
           l.price_subtotal_signed * (l.discount / 100) * (-l.sign) AS discount_total,
           l.price_subtotal_signed * (l.discount / 100) * (-l.sign) * (1 + l.product_iva) AS discount_total_taxed,
           l.quantity, i.partner_id, l.product_id, i.date_due,
           coalesce(i.document_number, i.number) AS number, i.journal_id, i.user_id, i.type, i.state_id,
           i.document_type_id, i.state, i.date, i.date_invoice, p.name AS name_template,
           it.section || '/' || it.family || '/' || it.name AS category_path,
           c.customer, c.supplier, p.brand_name AS brand_id, ns.vendor_id
    FROM margined l
    JOIN invoice i ON i.id = l.invoice_id
    JOIN partner c ON c.id = i.partner_id
    LEFT JOIN product p ON p.id = l.product_id
    LEFT JOIN item it ON it.code = p.item_code
    LEFT JOIN newest_supplier ns ON ns.product_tmpl_id = p.tmpl_id)"""
)
