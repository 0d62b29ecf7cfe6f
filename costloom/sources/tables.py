"""Canonical retail tables derived from the star-schema parquet files.

Each definition is one SQL text that Spark and an ANSI engine both accept; the
base tables stand in braces. ``Tables`` hands the operators lazy DataFrames.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordered import numbered

# A line has no key of its own: order and line number repeat. This packs them with
# product, vendor, quantity and price, in that order of weight. It fits 64 bits up to
# order key 1.1e10 and is an error beyond; ``dense_lines`` numbers lines of any size.
LINE_ID = """(l_orderkey * 8 + l_linenumber) * 100000000 + (l_partkey % 1000) * 100000 + (l_suppkey % 100) * 1000
               + CAST(l_quantity AS BIGINT) * 10 + CAST(floor(l_extendedprice) AS BIGINT) % 10"""

DEFINITIONS = {
    # Invoices: kind from the order key, state from the order status.
    "invoice": """
        SELECT o_orderkey AS id,
               CASE WHEN o_orderkey % 10 < 6 THEN 'out_invoice'
                    WHEN o_orderkey % 10 = 6 THEN 'out_refund'
                    WHEN o_orderkey % 10 < 9 THEN 'in_invoice'
                    ELSE 'in_refund' END AS type,
               CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'open' ELSE 'draft' END AS state,
               o_custkey AS partner_id,
               CASE WHEN o_orderkey % 7 = 0 THEN 'USD' ELSE 'ARS' END AS currency,
               CAST(o_orderdate AS DATE) AS date,
               CAST(o_orderdate AS DATE) AS date_invoice,
               CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY AS DATE) AS date_due,
               concat('INV-', CAST(o_orderkey AS STRING)) AS number,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL
                    ELSE concat('FA-', CAST(o_orderkey AS STRING)) END AS document_number,
               o_orderkey % 4 AS journal_id,
               o_orderkey % 16 AS user_id,
               o_orderkey % 24 AS state_id,
               o_orderkey % 5 AS document_type_id,
               o_orderkey % 2 = 0 AS discount_processed
        FROM {orders}""",
    # Invoice lines; line 7 is a global-discount line with a negative amount.
    "invoice_line": """
        SELECT {line_id} AS id,
               l_orderkey AS invoice_id,
               l_partkey AS product_id,
               l_suppkey AS source_vendor_id,
               l_linenumber AS line_no,
               l_quantity AS quantity,
               CASE WHEN l_linenumber = 7 THEN -1 ELSE 1 END * (l_extendedprice / l_quantity) AS price_unit,
               100 * l_discount AS discount,
               CASE WHEN l_linenumber = 7 THEN -1 ELSE 1 END
                   * CASE WHEN l_orderkey % 10 IN (6, 9) THEN -1 ELSE 1 END
                   * (l_extendedprice * (1 - l_discount)) AS price_subtotal_signed,
               l_tax AS product_iva,
               CASE WHEN l_orderkey % 10 IN (6, 9) THEN -1 ELSE 1 END AS sign,
               l_linenumber % 2 = 1 AS vat_21,
               l_linenumber % 2 = 0 OR l_linenumber = 5 AS vat_105,
               CASE WHEN l_linenumber % 3 = 0 THEN CAST(0 AS DOUBLE)
                    ELSE -l_discount END AS invoice_discount
        FROM {lineitem}""",
    "product": """
        SELECT p_partkey AS id,
               p_partkey AS tmpl_id,
               CASE WHEN p_partkey % 100 = 99
                    THEN concat('C', CAST((p_partkey - 1) % 25 AS STRING), '-', CAST(p_partkey - 1 AS STRING), '-')
                    ELSE concat('C', CAST(p_partkey % 25 AS STRING), '-', CAST(p_partkey AS STRING)) END AS default_code,
               p_name AS name,
               p_type AS item_code,
               p_brand AS brand_name,
               CASE WHEN p_partkey % 50 = 0 THEN 'service' ELSE 'product' END AS type,
               CASE WHEN p_partkey % 5 = 0 THEN 'USD' ELSE 'ARS' END AS currency,
               p_retailprice AS list_price,
               CASE WHEN p_partkey % 40 = 3 THEN CAST(0 AS DOUBLE) ELSE p_retailprice * 6 / 10 END AS standard_price,
               CASE WHEN p_partkey % 30 = 0 THEN CAST(0 AS DOUBLE) ELSE p_retailprice * 6 / 10 END AS standard_product_price,
               CASE WHEN p_partkey % 60 = 7 THEN CAST(0 AS DOUBLE) ELSE p_retailprice * 55 / 100 END AS today_cost,
               CASE WHEN p_partkey % 4 = 0 THEN CAST(0 AS DOUBLE) ELSE p_retailprice * 58 / 100 END AS invoice_cost,
               CAST((p_partkey * 7) % 41 - 10 AS DOUBLE) AS virtual_available,
               CAST((p_partkey * 5) % 37 - 5 AS DOUBLE) AS qty_available,
               CASE WHEN p_partkey % 3 = 0 THEN CAST(10.5 AS DOUBLE)
                    WHEN p_partkey % 17 = 1 THEN NULL
                    ELSE CAST(21 AS DOUBLE) END AS tax_rate,
               p_partkey % 13 = 0 AS discontinued,
               CASE WHEN p_partkey % 9 = 4
                    THEN concat('C', CAST((p_partkey - 4) % 25 AS STRING), '-', CAST(p_partkey - 4 AS STRING))
                    WHEN p_partkey % 90 = 5 THEN 'C0-0'
                    ELSE NULL END AS parent_price_product,
               p_partkey % 6 = 0 AS can_modify_prices,
               CASE WHEN p_partkey % 2 = 0 THEN 'sellable' ELSE 'obsolete' END AS state
        FROM {part}""",
    # Item table: one row per product family of the part table.
    "item": """
        SELECT DISTINCT p_type AS code,
               concat('Item ', p_type) AS name,
               concat('Section ', substr(p_type, 1, 1)) AS section,
               concat('Family ', substr(p_type, 1, 2)) AS family,
               CAST(length(p_type) % 5 AS DOUBLE) / 10 + CAST(0.3 AS DOUBLE) AS margin
        FROM {part}
        WHERE p_type <> 'PROMO'""",
    "vendor": """
        SELECT s_suppkey AS id,
               s_name AS ref,
               s_name AS name,
               CASE WHEN s_suppkey % 4 = 0 THEN 'consignment'
                    WHEN s_suppkey % 9 = 5 THEN NULL
                    ELSE 'standard' END AS business_mode,
               s_suppkey % 5 <> 1 AS supplier,
               s_acctbal AS debit,
               s_suppkey % 2 = 0 AS tagged,
               s_suppkey % 3 = 1 AS is_primary
        FROM {supplier}""",
    "partner": """
        SELECT c_custkey AS id,
               c_name AS name,
               TRUE AS customer,
               c_custkey % 2 = 0 AS supplier,
               CAST(c_custkey % 7 AS DOUBLE) AS loyalty,
               c_acctbal AS balance,
               c_custkey % 5 AS pricelist_id,
               c_custkey % 3 AS payment_term_id,
               c_mktsegment AS segment,
               c_nationkey AS nation_id
        FROM {customer}""",
    # Price history: one row per purchase price seen for a product and vendor.
    # Some products were never bought, so they have no price row.
    "supplierinfo": """
        SELECT {line_id} AS id,
               l_partkey AS product_tmpl_id,
               l_suppkey AS vendor_id,
               floor(l_extendedprice / l_quantity * 10000 + 0.5) / 10000 AS price,
               1 + l_linenumber % 3 AS min_qty,
               CASE WHEN (l_partkey + l_suppkey) % 11 = 0 THEN NULL
                    ELSE CAST(l_shipdate AS DATE) END AS date_start,
               CASE WHEN l_linenumber % 3 = 0 THEN NULL
                    WHEN l_linenumber = 4 THEN CAST(CAST(l_shipdate AS DATE) - INTERVAL 10 DAY AS DATE)
                    ELSE CAST(CAST(l_shipdate AS DATE) + INTERVAL 90 DAY AS DATE) END AS date_end
        FROM {lineitem}
        WHERE l_partkey % 12 <> 5""",
    # Stock layers: received purchase lines.
    "stock_layer": """
        SELECT {line_id} AS id,
               l_partkey AS product_id,
               l_orderkey AS invoice_id,
               CASE WHEN l_linenumber = 6 THEN -l_quantity ELSE l_quantity END AS qty,
               CASE WHEN l_orderkey % 30 = 8 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice / l_quantity END AS cost,
               CASE WHEN l_orderkey % 20 = 7 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice / l_quantity END AS cost_product,
               CAST(date_invoice AS TIMESTAMP) AS in_date,
               CASE WHEN l_linenumber % 3 = 0 THEN 'Output' ELSE 'Stock' END AS location,
               CASE WHEN l_partkey % 3 = 1 THEN 'customer' ELSE 'internal' END AS location_usage,
               CASE WHEN l_linenumber = 5 THEN 'Partners' ELSE 'WH' END AS location_parent
        FROM {lineitem} JOIN {invoice} i ON l_orderkey = i.id
        WHERE i.type = 'in_invoice'""",
    # Monthly exchange rates, in units per company-currency unit.
    "currency_rate": """
        SELECT 'USD' AS currency,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
               CAST(1 AS DOUBLE) / (20 + COUNT(*) % 40) AS rate
        FROM {orders}
        WHERE o_orderdate >= TIMESTAMP '1995-04-01 00:00:00'
        GROUP BY CAST(date_trunc('month', o_orderdate) AS DATE)""",
}

DEFINITIONS = {name: text.replace("{line_id}", LINE_ID) for name, text in DEFINITIONS.items()}

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
DENSE_ID = "line_id"


def dense_lines(lineitem: DataFrame) -> DataFrame:
    """Lines with ``line_id``, their place in the order of their natural columns, then of the others: dense, unique, and no wider than their count.

    Lines are range-partitioned by that order, numbered in their partitions and
    moved by the counts of those before; equal lines take any of their places.
    """
    others = [c for c in lineitem.columns if c not in LINE_ORDER and c != DENSE_ID]
    return numbered(lineitem.drop(DENSE_ID), [F.col(c) for c in (*LINE_ORDER, *others)], DENSE_ID)


class Tables:
    """Base and canonical tables of one data folder, read lazily.

    ``dense`` numbers lines instead of packing their columns into a key: for order
    keys beyond 1.1e10, or where packed keys might meet.
    """

    def __init__(self, spark: SparkSession, folder: str, dense: bool = False):
        self.spark = spark
        self.folder = folder
        self.dense = dense
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> Any:
        if name in BASE_TABLES or name in DEFINITIONS:
            return self.get(name)
        raise AttributeError(name)

    def get(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in BASE_TABLES:
                base = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
                self._cache[name] = dense_lines(base) if self.dense and name == "lineitem" else base
            else:
                text = DEFINITIONS[name]
                self._cache[name] = self.sql(text.replace(LINE_ID, DENSE_ID) if self.dense else text)
        return self._cache[name]

    def sql(self, text: str) -> DataFrame:
        """SQL over base and canonical tables named in braces."""
        names = [n for n in (*BASE_TABLES, *DEFINITIONS) if "{" + n + "}" in text]
        return self.spark.sql(text, **{n: self.get(n) for n in names})


def read_erp(spark: SparkSession, folder: str, dense: bool = False) -> Tables:
    """All tables of a data folder; nothing is read until a column is used, but for lines that are to be numbered."""
    return Tables(spark, folder, dense)


def ansi_prelude() -> str:
    """The same definitions as one WITH clause for an ANSI SQL engine."""
    parts = []
    for name, text in DEFINITIONS.items():
        for base in (*BASE_TABLES, *DEFINITIONS):
            text = text.replace("{" + base + "}", base)
        parts.append(f"{name} AS ({text})")
    return "WITH RECURSIVE " + ",\n".join(parts)
