"""Vendor KPI and month-end queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import costing, kpis
from ..sources.tables import Tables
from .common import CUR_RATE, TODAY, rounded
from .registry import query, r4, xsum

MONTH_END = "2001-07-31"

# KPI rows as left by earlier runs: vendors with a positive balance.
KPI_SQL = """
    SELECT id AS vendor_id, debit AS total_payable, CAST(0 AS DOUBLE) AS stock_valuation, CAST(0 AS DOUBLE) AS count,
           CASE WHEN debit > 5000 THEN TIMESTAMP '2001-08-02 00:00:00' ELSE TIMESTAMP '2001-07-31 00:00:00' END AS updated
    FROM {vendor} WHERE debit > 2000"""
KPI = "kpi AS (" + KPI_SQL.replace("{vendor}", "vendor") + ")"

# Ledger entries: customer invoices are receivable, vendor invoices payable.
ACCOUNT_SQL = """
    SELECT CASE WHEN type IN ('out_invoice', 'out_refund') THEN 'receivable' ELSE 'payable' END AS account_type, date,
           CASE WHEN type IN ('out_invoice', 'in_refund') THEN o_totalprice ELSE CAST(0 AS DOUBLE) END AS debit,
           CASE WHEN type IN ('out_invoice', 'in_refund') THEN CAST(0 AS DOUBLE) ELSE o_totalprice END AS credit
    FROM {invoice} i JOIN {orders} o ON o.o_orderkey = i.id WHERE state <> 'draft'"""
ACCOUNT = "account AS (" + ACCOUNT_SQL.replace("{", "").replace("}", "") + ")"

FINAL = f"""{CUR_RATE}, priced_product AS (
    SELECT p.*, list_price / coalesce(r.rate, 1) * (1 + coalesce(tax_rate, 0) / 100) AS final_price
    FROM product p LEFT JOIN cur_rate r ON r.currency = p.currency)"""


@query(f""", {KPI}
    SELECT vendor_id, total_payable, stock_valuation, count, updated FROM kpi
    WHERE vendor_id IN (SELECT id FROM vendor WHERE tagged)
    UNION ALL
    SELECT id, 0, 0, 0, NULL FROM vendor WHERE tagged AND id NOT IN (SELECT vendor_id FROM kpi)""")
def sync_members(t: Tables):
    return kpis.sync_members(t.sql(KPI_SQL), t.vendor.filter("tagged").select(F.col("id").alias("vendor_id")))


@query(f""", {KPI} SELECT vendor_id, total_payable FROM kpi WHERE updated <= TIMESTAMP '{TODAY} 00:00:00'""")
def due_for_refresh(t: Tables):
    return kpis.due_for_refresh(t.sql(KPI_SQL), F.lit(TODAY).cast("timestamp")).select("vendor_id", "total_payable")


@query(f""", {FINAL}, owner AS (
        SELECT product_tmpl_id, CASE WHEN COUNT(*) = 1 THEN MIN(vendor_id)
               ELSE arg_max(vendor_id, (date_start, -id)) FILTER (date_start IS NOT NULL) END AS vendor_id
        FROM supplierinfo GROUP BY product_tmpl_id),
    total AS (
        SELECT o.vendor_id, {xsum("virtual_available * final_price")} AS stock_valuation, {xsum("virtual_available")} AS count
        FROM priced_product p JOIN owner o ON o.product_tmpl_id = p.tmpl_id WHERE virtual_available > 0 GROUP BY 1)
    SELECT v.id AS vendor_id, v.debit AS total_payable, coalesce(t.stock_valuation, 0) AS stock_valuation, coalesce(t.count, 0) AS count
    FROM vendor v LEFT JOIN total t ON t.vendor_id = v.id WHERE v.tagged""")
def vendor_kpis(t: Tables):
    members = t.vendor.filter("tagged").select(F.col("id").alias("vendor_id"))
    return kpis.vendor_kpis(members, costing.final_price(t.product, t.currency_rate), t.supplierinfo, t.vendor)


@query(f""", {ACCOUNT}, month_rate AS (SELECT currency, arg_max(rate, date) AS rate FROM currency_rate WHERE date <= DATE '{MONTH_END}' GROUP BY 1),
    a AS (SELECT {xsum("qty * cost")} AS v FROM stock_layer WHERE location_parent = 'WH' AND qty > 0),
    b AS (SELECT {xsum("today_cost / coalesce(r.rate, 1) * virtual_available")} AS cost, {xsum("list_price / coalesce(r.rate, 1) * virtual_available")} AS list
          FROM product p LEFT JOIN month_rate r ON r.currency = p.currency WHERE virtual_available > 0),
    c AS (SELECT {xsum("CASE WHEN account_type = 'payable' THEN debit - credit END")} AS payable,
                 {xsum("CASE WHEN account_type = 'receivable' THEN debit - credit END")} AS receivable
          FROM account WHERE date <= DATE '{MONTH_END}')
    SELECT DATE '{MONTH_END}' AS date, a.v AS stock_value_purchase_historic, b.cost AS stock_value_purchase,
           b.list AS stock_value_sell, c.payable, c.receivable FROM a, b, c""")
def month_end_valuation(t: Tables):
    return kpis.month_end_valuation(t.stock_layer, t.product, t.sql(ACCOUNT_SQL), t.currency_rate, MONTH_END)


SNAPSHOT_SQL = """
    SELECT CAST(last_day(date) AS DATE) AS date, CAST(COUNT(*) AS DOUBLE) AS stock_value_purchase, CAST(MAX(id) AS DOUBLE) AS payable
    FROM {invoice} WHERE type = 'in_invoice' GROUP BY CAST(last_day(date) AS DATE)"""
PATCH_SQL = """
    SELECT CAST(last_day(date_due) AS DATE) AS date, CASE WHEN COUNT(*) % 2 = 0 THEN CAST(SUM(id) AS DOUBLE) ELSE NULL END AS stock_value_purchase
    FROM {invoice} WHERE type = 'in_refund' GROUP BY CAST(last_day(date_due) AS DATE)"""


@query(f""", k AS ({SNAPSHOT_SQL.replace("{invoice}", "invoice")}), p AS ({PATCH_SQL.replace("{invoice}", "invoice")})
    SELECT coalesce(k.date, p.date) AS date, coalesce(p.stock_value_purchase, k.stock_value_purchase) AS stock_value_purchase, k.payable
    FROM k FULL JOIN p ON p.date = k.date""")
def patch_snapshot(t: Tables):
    return kpis.patch_snapshot(t.sql(SNAPSHOT_SQL), t.sql(PATCH_SQL))


@query("""SELECT id, date_invoice FROM invoice WHERE last_day(date_invoice) = date_invoice""")
def is_month_end(t: Tables):
    return kpis.month_end_days(t.invoice, "date_invoice").select("id", "date_invoice")
