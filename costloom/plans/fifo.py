"""FIFO costing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import fifo
from ..sources.tables import Tables
from .common import DATED_LINE, dated_lines, rounded
from .registry import query, r4


def layers_and_issues(t: Tables):
    """Purchase lines are layers, customer lines are issues; prices to 4 decimals."""
    line = dated_lines(t).filter("line_no <> 7")
    price = F.floor(F.col("price_unit") * 10000 + 0.5) / 10000
    base = line.select("product_id", "id", F.col("date_invoice").alias("date"), F.col("quantity").alias("qty"), price.alias("price"), "type")
    return base.filter("type = 'in_invoice'").drop("type"), base.filter("type = 'out_invoice'").drop("type", "price")


# Interval overlap, written the long way: every issue against every layer.
SPANS = f"""{DATED_LINE}, event AS (
    SELECT product_id, id, date_invoice AS day, CASE WHEN type = 'in_invoice' THEN 0 ELSE 1 END AS kind,
           CAST(quantity AS DECIMAL(18,4)) AS qty, CAST(floor(price_unit * 10000 + 0.5) / 10000 AS DECIMAL(18,4)) AS price
    FROM dated_line WHERE line_no <> 7 AND type IN ('in_invoice', 'out_invoice')),
summed AS (
    SELECT *, SUM(CASE WHEN kind = 0 THEN qty ELSE 0 END) OVER w AS cum_in, SUM(CASE WHEN kind = 1 THEN qty ELSE 0 END) OVER w AS cum_out,
           last_value(CASE WHEN kind = 0 THEN price END IGNORE NULLS) OVER w AS last_price
    FROM event WINDOW w AS (PARTITION BY product_id ORDER BY day, kind, id ROWS UNBOUNDED PRECEDING)),
short AS (
    SELECT *, greatest(0, MAX(cum_out - cum_in) OVER (PARTITION BY product_id ORDER BY day, kind, id ROWS UNBOUNDED PRECEDING)) AS lost,
           greatest(0, coalesce(MAX(cum_out - cum_in) OVER (PARTITION BY product_id ORDER BY day, kind, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lost_before
    FROM summed),
span AS (
    SELECT product_id, id, day, kind, qty, price, last_price,
           CASE WHEN kind = 0 THEN cum_in - qty ELSE cum_out - qty - lost_before END AS lo,
           CASE WHEN kind = 0 THEN cum_in ELSE cum_out - lost END AS hi
    FROM short)"""


@query(f""", {SPANS}, taken AS (
        SELECT i.product_id, i.id, SUM(greatest(0, least(l.hi, i.hi) - greatest(l.lo, i.lo)) * l.price) AS cost
        FROM span i JOIN span l ON l.product_id = i.product_id AND l.kind = 0 AND l.lo < i.hi AND i.lo < l.hi WHERE i.kind = 1 GROUP BY 1, 2)
    SELECT i.product_id, i.id, CAST(i.qty AS DOUBLE) AS qty, CAST(i.hi - i.lo AS DOUBLE) AS covered,
           {r4("CAST(coalesce(t.cost, 0) + coalesce((i.qty - (i.hi - i.lo)) * i.last_price, 0) AS DOUBLE) / CAST(i.qty AS DOUBLE)")} AS unit_cost
    FROM span i LEFT JOIN taken t ON t.product_id = i.product_id AND t.id = i.id WHERE i.kind = 1""")
def fifo_cost(t: Tables):
    layers, issues = layers_and_issues(t)
    return rounded(fifo.fifo_cost(layers, issues), "unit_cost")


@query(f""", {SPANS}, used AS (SELECT product_id, MAX(hi) AS hi FROM span WHERE kind = 1 GROUP BY 1),
    rest AS (SELECT l.product_id, l.id, l.day, l.price, greatest(0, least(l.qty, l.hi - coalesce(u.hi, 0))) AS remaining
             FROM span l LEFT JOIN used u ON u.product_id = l.product_id WHERE l.kind = 0),
    run AS (SELECT *, SUM(remaining) OVER w AS q, SUM(remaining * price) OVER w AS v
            FROM rest WINDOW w AS (PARTITION BY product_id ORDER BY day, id ROWS UNBOUNDED PRECEDING))
    SELECT product_id, id, CAST(remaining AS DOUBLE) AS remaining, CAST(q AS DOUBLE) AS qty_to_here,
           CASE WHEN q = 0 THEN 0 ELSE {r4("CAST(v AS DOUBLE) / CAST(q AS DOUBLE)")} END AS price_to_here FROM run""")
def fifo_balance(t: Tables):
    layers, issues = layers_and_issues(t)
    return rounded(fifo.fifo_balance(layers, issues), "price_to_here")


# Orders buy half of what their lines ask for; the lines queue as procurements.
PO_SQL = """SELECT invoice_id AS id, floor(SUM(quantity) * (invoice_id % 3) / 2) AS quantity FROM {invoice_line} GROUP BY invoice_id"""
PROCUREMENT_SQL = """SELECT id, invoice_id AS po_line_id, CAST(line_no AS BIGINT) AS seq,
    CASE WHEN line_no = 2 THEN CAST(0 AS DOUBLE) ELSE quantity END AS quantity FROM {invoice_line}"""


@query(f""", po AS ({PO_SQL.replace("{invoice_line}", "invoice_line")}), pr AS ({PROCUREMENT_SQL.replace("{invoice_line}", "invoice_line")}),
    q AS (SELECT pr.*, coalesce(SUM(pr.quantity) OVER (PARTITION BY po_line_id ORDER BY seq, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
          FROM pr WHERE quantity > 0),
    s AS (
        SELECT q.po_line_id, q.id AS procurement_id, least(q.quantity, greatest(0, po.quantity - q.ahead)) AS quantity FROM q JOIN po ON po.id = q.po_line_id
        UNION ALL
        SELECT po.id, NULL, greatest(0, po.quantity - coalesce((SELECT SUM(quantity) FROM pr WHERE pr.po_line_id = po.id), 0)) FROM po)
    SELECT po_line_id, procurement_id, CAST(quantity AS DOUBLE) AS quantity FROM s WHERE quantity > 0""")
def allocate_procurements(t: Tables):
    return fifo.allocate_procurements(t.sql(PO_SQL), t.sql(PROCUREMENT_SQL))
