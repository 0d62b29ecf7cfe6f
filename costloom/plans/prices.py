"""Price history and price state queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prices
from ..sources.tables import Tables
from .catalogue import flat
from .common import CUR_RATE, rounded
from .costing import OLDEST
from .registry import query, r4

# One price event per purchase line. Costs step by thousands, so repeats, rises,
# falls and zeros all occur; three vendors share the products.
EVENT_SQL = """
    SELECT s.product_tmpl_id AS tmpl_id, v.id % 3 AS vendor_id, CAST(s.day AS DATE) AS date, s.id AS seq,
           floor(s.price / 1000) * 1000 AS cost, s.price * 1.25e0 AS price, v.is_primary,
           s.vendor_id % 5 = 2 AND s.min_qty = 1 AS manual
    FROM (SELECT *, coalesce(date_start, DATE '1999-12-31') AS day FROM {supplierinfo}) s JOIN {vendor} v ON v.id = s.vendor_id"""
EVENT = f"event AS ({flat(EVENT_SQL)})"

HISTORY_SQL = """
    SELECT vendor_id % 3 AS vendor_id, product_tmpl_id, floor(MIN(price) / 1000) * 1000 AS price,
           DATE '1994-06-01' AS date_start, CAST(NULL AS DATE) AS date_end
    FROM {supplierinfo} WHERE min_qty = 1 GROUP BY vendor_id % 3, product_tmpl_id
    UNION ALL
    SELECT vendor_id % 3, product_tmpl_id, MAX(price), DATE '1994-01-01', DATE '1994-05-31'
    FROM {supplierinfo} WHERE min_qty = 2 GROUP BY vendor_id % 3, product_tmpl_id"""
HISTORY = f"history AS ({flat(HISTORY_SQL)})"


def events(t: Tables):
    return t.sql(EVENT_SQL)


def priced_product(t: Tables):
    """Products as they enter the price run; margin starts at zero."""
    return t.product.withColumn("margin", F.lit(0.0))


@query(f""", {EVENT}, {HISTORY}, line AS (
        SELECT vendor_id, product_tmpl_id, price, date_start AS date, CAST(-1 AS BIGINT) AS seq, FALSE AS is_new FROM history WHERE date_end IS NULL
        UNION ALL
        SELECT vendor_id, tmpl_id, cost, date, seq, TRUE FROM event WHERE NOT (cost = 0 AND is_primary)),
    seen AS (SELECT *, lag(price) OVER (PARTITION BY vendor_id, product_tmpl_id ORDER BY date, seq) AS before FROM line),
    kept AS (SELECT *, lead(date) OVER (PARTITION BY vendor_id, product_tmpl_id ORDER BY date, seq) AS following
             FROM seen WHERE NOT is_new OR price IS DISTINCT FROM before)
    SELECT vendor_id, product_tmpl_id, price, date AS date_start,
           CASE WHEN following IS NOT NULL THEN greatest(CAST(following - INTERVAL 1 DAY AS DATE), date) END AS date_end,
           CASE WHEN is_new THEN 'added' WHEN following IS NOT NULL THEN 'closed' ELSE 'unchanged' END AS action FROM kept
    UNION ALL
    SELECT vendor_id, product_tmpl_id, price, date_start, date_end, 'unchanged' FROM history WHERE date_end IS NOT NULL""")
def scd2_prices(t: Tables):
    feed = events(t).select("vendor_id", F.col("tmpl_id").alias("product_tmpl_id"), F.col("cost").alias("price"), "date", "seq", "is_primary")
    return prices.scd2_prices(t.sql(HISTORY_SQL), feed)


# One event after the other, as a recursion over the event number.
@query(f""", {EVENT}, {CUR_RATE}, numbered AS (
        SELECT e.*, row_number() OVER (PARTITION BY tmpl_id ORDER BY date, seq) AS n FROM event e),
    side AS (
        SELECT p.tmpl_id, coalesce(i.margin, 0) AS m, coalesce(r.rate, 1) AS rate,
               EXISTS (SELECT 1 FROM stock_layer s WHERE s.product_id = p.id AND s.location_usage = 'internal') AS stock
        FROM product p LEFT JOIN item i ON i.code = p.item_code LEFT JOIN cur_rate r ON r.currency = p.currency),
    fold AS (
        SELECT tmpl_id, CAST(0 AS BIGINT) AS n, today_cost, state, standard_price, standard_product_price, list_price, CAST(0 AS DOUBLE) AS margin FROM product
        UNION ALL
        SELECT f.tmpl_id, e.n,
               CASE WHEN dead OR (stock AND lower) THEN f.today_cost ELSE e.cost END,
               CASE WHEN dead THEN 'obsolete' WHEN lower THEN 'offer' ELSE 'sellable' END,
               CASE WHEN dead OR stock THEN f.standard_price ELSE e.cost / s.rate END,
               CASE WHEN dead OR stock THEN f.standard_product_price ELSE e.cost END,
               CASE WHEN dead OR (stock AND lower) THEN f.list_price WHEN e.is_primary AND NOT e.manual THEN e.cost * (1 + s.m) ELSE e.price END,
               CASE WHEN dead OR (stock AND lower) THEN f.margin WHEN e.is_primary AND NOT e.manual THEN 100 * s.m
                    WHEN e.cost = 0 THEN 1e10 ELSE 100 * (e.price / e.cost - 1) END
        FROM fold f JOIN numbered e ON e.tmpl_id = f.tmpl_id AND e.n = f.n + 1 JOIN side s ON s.tmpl_id = f.tmpl_id,
        LATERAL (SELECT e.cost = 0 AND e.is_primary AS dead, NOT e.manual AND f.today_cost <> 0 AND f.today_cost + 0.05e0 > e.cost AS lower) x)
    SELECT tmpl_id, state, {r4("today_cost")} AS today_cost, {r4("standard_price")} AS standard_price,
           {r4("standard_product_price")} AS standard_product_price, {r4("list_price")} AS list_price, {r4("margin")} AS margin
    FROM fold QUALIFY row_number() OVER (PARTITION BY tmpl_id ORDER BY n DESC) = 1""")
def apply_prices(t: Tables):
    names = ["today_cost", "standard_price", "standard_product_price", "list_price", "margin"]
    out = prices.apply_prices(priced_product(t), events(t), t.item, t.stock_layer, t.currency_rate)
    return rounded(out.select("tmpl_id", "state", *names), *names)


@query(f""", last_two AS (
        SELECT product_tmpl_id, price, row_number() OVER (PARTITION BY product_tmpl_id ORDER BY date_start DESC NULLS FIRST, id) AS n FROM supplierinfo),
    pair AS (SELECT a.product_tmpl_id, a.price AS last_price, b.price AS previous_price FROM last_two a JOIN last_two b USING (product_tmpl_id)
             WHERE a.n = 1 AND b.n = 2 AND b.price > a.price)
    SELECT p.tmpl_id, {r4("previous_price")} AS today_cost, 'offer' AS state, {r4("100 * coalesce(i.margin, 0)")} AS margin,
           {r4("previous_price * (coalesce(i.margin, 0) + 1)")} AS list_price
    FROM product p JOIN pair ON pair.product_tmpl_id = p.tmpl_id LEFT JOIN item i ON i.code = p.item_code
    WHERE p.virtual_available <> 0
      AND EXISTS (SELECT 1 FROM supplierinfo s JOIN vendor v ON v.id = s.vendor_id WHERE s.product_tmpl_id = p.tmpl_id AND v.is_primary)""")
def price_drops(t: Tables):
    names = ["today_cost", "margin", "list_price"]
    out = prices.price_drops(t.supplierinfo, t.product, t.item, t.vendor.filter("is_primary").select(F.col("id").alias("vendor_id")))
    return rounded(out.select("tmpl_id", "state", *names), *names)


@query(f"""SELECT c.tmpl_id, c.parent_price_product, {r4("p.list_price / 10")} AS cost, p.list_price AS price
    FROM product c JOIN product p ON p.default_code = c.parent_price_product WHERE p.list_price <> c.list_price""")
def price_from_parent(t: Tables):
    out = prices.price_from_parent(t.product).select("tmpl_id", "parent_price_product", "cost", "price")
    return rounded(out, "cost")


@query(f""", {EVENT}, {OLDEST}, last_manual AS (
        SELECT tmpl_id, cost FROM event WHERE manual AND is_primary AND cost <> 0
        QUALIFY row_number() OVER (PARTITION BY tmpl_id ORDER BY date DESC, seq DESC) = 1)
    SELECT s.id, {r4("coalesce(m.cost, s.cost)")} AS cost, {r4("coalesce(m.cost, s.cost_product)")} AS cost_product
    FROM stock_layer s LEFT JOIN oldest o ON o.id = s.id LEFT JOIN last_manual m ON m.tmpl_id = o.product_id""")
def set_layer_cost_manual(t: Tables):
    out = prices.set_layer_cost_manual(t.stock_layer, events(t))
    return rounded(out.select("id", "cost", "cost_product"), "cost", "cost_product")
