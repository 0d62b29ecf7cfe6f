"""Sales analysis queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as fx
from ..operators import catalogue, costing, sales
from ..sources.tables import Tables
from .common import FACT, MARGINED, TODAY, categorised_product, fact, margined_lines, rounded
from .registry import query, r4, xsum

MONEY = [m for m in sales.MEASURES if m != "quantity"] + ["margin_percent"]
MONEY_SQL = ", ".join(f"{r4(m)} AS {m}" for m in MONEY)
PIVOT = ["price_total", "cost_total", "margin_total"]
PIVOT_SQL = ", ".join(f"{xsum(m)} AS {m}" for m in PIVOT)
PERCENT_SQL = "CASE WHEN cost_total = 0 THEN NULL ELSE " + r4("margin_total / cost_total * 100") + " END AS margin_percent"
KEYS = ["id", "partner_id", "product_id", "number", "type", "state", "date_invoice"]
CUSTOMER = "type IN ('out_invoice', 'out_refund')"
INVOICED = "state NOT IN ('draft', 'cancel')"


@query(f""", {MARGINED}
    SELECT id, {r4("price_subtotal_signed * (1 + product_iva)")} AS price_total_taxed,
           {r4("price_subtotal_signed / (1 + product_margin)")} AS cost_total,
           {r4("price_subtotal_signed * product_margin / (1 + product_margin)")} AS margin_total,
           {r4("price_subtotal_signed * (discount / 100) * (-sign)")} AS discount_total
    FROM margined""")
def sales_measures(t: Tables):
    names = ["price_total_taxed", "cost_total", "margin_total", "discount_total"]
    return rounded(sales.sales_measures(margined_lines(t)).select("id", *names), *names)


@query("""SELECT id, CASE WHEN type IN ('in_refund', 'out_refund') THEN -1 ELSE 1 END AS sign FROM invoice""")
def invoice_sign(t: Tables):
    return t.invoice.select("id", fx.invoice_sign(F.col("type")).alias("sign"))


@query("""SELECT id, coalesce(document_number, number) AS number FROM invoice""")
def document_number(t: Tables):
    return t.invoice.select("id", fx.document_number(F.col("document_number"), F.col("number")).alias("number"))


@query(f""", {FACT}
    SELECT id, {MONEY_SQL}, quantity, partner_id, product_id, date_due, number, journal_id, user_id, type,
           state_id, document_type_id, state, date, date_invoice, name_template, category_path,
           customer, supplier, brand_id, vendor_id
    FROM fact""")
def sales_fact(t: Tables):
    paths = catalogue.build_categories(t.item).select(F.col("id").alias("product_category_id"), F.col("path").alias("category_path"))
    out = rounded(fact(t), *MONEY).join(paths, "product_category_id", "left")
    return out.drop("product_category_id")


@query(f""", {FACT} SELECT id, {r4("margin_total")} AS margin_total, number, name_template, vendor_id FROM fact""")
def sales_fact_from_stored_margin(t: Tables):
    """The plain star join, over lines that carry margin and vendor already."""
    vendor = costing.current_vendor(t.product, t.supplierinfo).select(F.col("id").alias("product_id"), "vendor_id")
    stored = margined_lines(t).drop("type", "state", "currency", "date_invoice").join(vendor, "product_id", "left")
    out = sales.sales_fact(stored, t.invoice, categorised_product(t), t.partner)
    return rounded(out.select("id", "margin_total", "number", "name_template", "vendor_id"), "margin_total")


@query(f""", {FACT} SELECT {", ".join(KEYS)} FROM fact WHERE {CUSTOMER}""")
def filter_side(t: Tables):
    return sales.sales_filter(fact(t), side="customer").select(*KEYS)


@query(f""", {FACT} SELECT {", ".join(KEYS)} FROM fact WHERE type IN ('in_refund', 'out_refund')""")
def filter_document(t: Tables):
    return sales.sales_filter(fact(t), document="refund").select(*KEYS)


@query(f""", {FACT} SELECT {", ".join(KEYS)} FROM fact WHERE {INVOICED}""")
def filter_status(t: Tables):
    return sales.sales_filter(fact(t), status="invoiced").select(*KEYS)


@query(f""", {FACT} SELECT {", ".join(KEYS)} FROM fact WHERE state IN ('draft', 'proforma', 'proforma2')""")
def filter_draft(t: Tables):
    return sales.sales_filter(fact(t), status="draft").select(*KEYS)


PERIODS = ("last_month", "this_month", "last_year", "this_year")


@query(f""", {FACT}, span AS (
        SELECT 'last_month' AS period, DATE '2001-07-01' AS lo, DATE '2001-08-01' AS hi UNION ALL
        SELECT 'this_month', DATE '2001-08-01', DATE '2001-09-01' UNION ALL
        SELECT 'last_year', DATE '2000-01-01', DATE '2001-01-01' UNION ALL
        SELECT 'this_year', DATE '2001-01-01', DATE '2002-01-01')
    SELECT period, {", ".join(KEYS)} FROM fact JOIN span ON date_invoice >= lo AND date_invoice < hi""")
def filter_period(t: Tables):
    held = F.array_compact(F.array(*[F.when(sales.in_period(p, TODAY), p) for p in PERIODS]))
    return fact(t).select(*KEYS, F.explode(held).alias("period"))


@query(f""", {FACT} SELECT {", ".join(KEYS)} FROM fact
    WHERE date_invoice BETWEEN DATE '1998-03-01' AND DATE '1999-02-28'""")
def filter_dates(t: Tables):
    return sales.date_between(fact(t), "1998-03-01", "1999-02-28").select(*KEYS)


@query(f""", {FACT} SELECT id, number, {r4("margin_percent")} AS margin_percent FROM fact WHERE margin_percent <= 10""")
def low_margin(t: Tables):
    return rounded(sales.low_margin(fact(t)).select("id", "number", "margin_percent"), "margin_percent")


@query(f""", {FACT} SELECT {", ".join(KEYS)} FROM fact WHERE category_path = 'Section S' OR category_path LIKE 'Section S/%'""")
def under_category(t: Tables):
    return sales.under_category(fact(t), catalogue.build_categories(t.item), "Section S").select(*KEYS)


@query(f""", {FACT} SELECT {", ".join(KEYS)} FROM fact
    WHERE contains(lower(name_template), 'bolt') AND user_id = 7 AND document_type_id = 3""")
def text_search(t: Tables):
    return sales.text_search(fact(t), "Bolt", user_id=7, document_type_id=3).select(*KEYS)


@query(f""", {FACT}, p AS (
        SELECT CAST(date_trunc('month', date_invoice) AS DATE) AS date_invoice, {PIVOT_SQL}
        FROM fact WHERE {CUSTOMER} AND {INVOICED} GROUP BY 1)
    SELECT date_invoice, price_total, cost_total, margin_total, {PERCENT_SQL} FROM p""")
def sales_pivot_by_month(t: Tables):
    posted = sales.sales_filter(fact(t), side="customer", status="invoiced")
    return rounded(sales.sales_pivot(posted, interval="month"), "margin_percent")


@query(f""", {FACT}, p AS (SELECT date_invoice, {PIVOT_SQL} FROM fact WHERE {CUSTOMER} GROUP BY date_invoice)
    SELECT date_invoice, price_total, cost_total, margin_total, {PERCENT_SQL} FROM p""")
def sales_pivot_by_day(t: Tables):
    return rounded(sales.sales_pivot(sales.sales_filter(fact(t), side="customer")), "margin_percent")


@query(f""", {FACT}
    SELECT user_id, CAST(date_trunc('year', date_invoice) AS DATE) AS date_invoice,
           {xsum("CASE WHEN type = 'out_invoice' THEN price_total_taxed END")} AS out_invoice,
           {xsum("CASE WHEN type = 'out_refund' THEN price_total_taxed END")} AS out_refund,
           {xsum("CASE WHEN type = 'in_invoice' THEN price_total_taxed END")} AS in_invoice,
           {xsum("CASE WHEN type = 'in_refund' THEN price_total_taxed END")} AS in_refund
    FROM fact GROUP BY 1, 2""")
def sales_pivot_by_type(t: Tables):
    types = ["out_invoice", "out_refund", "in_invoice", "in_refund"]
    return sales.sales_pivot(fact(t), ["user_id", "date_invoice"], ["price_total_taxed"], "type", types, "year")


@query(f""", {FACT}, p AS (
        SELECT brand_id, vendor_id, {PIVOT_SQL}, {xsum("quantity")} AS quantity, {xsum("discount_total")} AS discount_total
        FROM fact WHERE {CUSTOMER} AND {INVOICED} GROUP BY brand_id, vendor_id)
    SELECT *, {PERCENT_SQL} FROM p""")
def sales_pivot_by_vendor(t: Tables):
    posted = sales.sales_filter(fact(t), side="customer", status="invoiced")
    measures = [*PIVOT, "quantity", "discount_total"]
    return rounded(sales.sales_pivot(posted, ["brand_id", "vendor_id"], measures), "margin_percent")


@query(f""", {FACT} SELECT state, COUNT(*) AS n_lines, {xsum("margin_total")} AS margin_total FROM fact GROUP BY state""")
def sales_view(t: Tables):
    name = sales.register_sales_view(fact(t))
    view = t.spark.table(name)
    return view.groupBy("state").agg(F.count(F.lit(1)).alias("n_lines"), sales.exact_sum(F.col("margin_total")).alias("margin_total"))
