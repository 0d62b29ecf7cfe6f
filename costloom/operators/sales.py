"""Sales analysis: the invoice-line fact, its measures, filters and pivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    CUSTOMER_TYPES,
    DRAFT_STATES,
    INVOICE_TYPES,
    NOT_INVOICED_STATES,
    REFUNDS,
    VENDOR_TYPES,
    document_number,
)
from ..functions.fixed_point import exact_sum
from .costing import margin_column
from .currency import with_current_rate

MEASURES = (
    "price_total",
    "price_total_taxed",
    "cost_total",
    "cost_total_taxed",
    "margin_total",
    "margin_total_taxed",
    "discount_total",
    "discount_total_taxed",
    "quantity",
)
DIMENSIONS = (
    "partner_id",
    "user_id",
    "state_id",
    "document_type_id",
    "product_id",
    "product_category_id",
    "state",
    "type",
    "journal_id",
)


def sales_measures(line: DataFrame) -> DataFrame:
    """Price, cost, margin and discount of a line, with and without VAT.

    A margin of -1 leaves cost undefined: NULL instead of a division error.
    """
    price, margin = F.col("price_subtotal_signed"), F.col("product_margin")
    taxed = F.lit(1.0) + F.col("product_iva")
    cost = F.try_divide(price, F.lit(1.0) + margin)
    profit = F.try_divide(price * margin, F.lit(1.0) + margin)
    discount = price * (F.col("discount") / F.lit(100.0)) * (-F.col("sign"))
    return line.withColumns(
        {
            "price_total": price,
            "price_total_taxed": price * taxed,
            "cost_total": cost,
            "cost_total_taxed": cost * taxed,
            "margin_percent": margin * F.lit(100.0),
            "margin_total": profit,
            "margin_total_taxed": profit * taxed,
            "discount_total": discount,
            "discount_total_taxed": discount * taxed,
        }
    )


def sales_fact(line: DataFrame, invoice: DataFrame, product: DataFrame, partner: DataFrame) -> DataFrame:
    """Invoice lines with invoice, partner and product columns.

    Lines without invoice or partner drop out; a missing product does not drop
    a line. Join strategies are left to statistics and adaptive execution.
    """
    head = _invoice_head(invoice, partner)
    what = product.select(
        F.col("id").alias("product_id"),
        F.col("name").alias("name_template"),
        F.col("categ_id").alias("product_category_id"),
        "brand_id",
    )
    out = sales_measures(line).join(head, "invoice_id").join(what, "product_id", "left")
    return _fact_columns(out)


def margin_fact(
    line: DataFrame, invoice: DataFrame, product: DataFrame, partner: DataFrame, rates: DataFrame, as_of: str | None = None
) -> DataFrame:
    """``sales_fact`` with margins and vendors computed on the way.

    ``product`` also has business_mode, vendor_id and the columns of
    ``costing.margin_column``. Everything of an invoice is joined at invoice
    grain and everything of a product at product grain, so the lines meet each
    side once.
    """
    head = _invoice_head(with_current_rate(invoice, rates, "currency", "__rate_i", as_of), partner, "__rate_i")
    what = with_current_rate(product, rates, "currency", "__rate_p", as_of).select(
        F.col("id").alias("product_id"),
        F.col("name").alias("name_template"),
        F.col("categ_id").alias("product_category_id"),
        "brand_id",
        "vendor_id",
        "business_mode",
        "standard_price",
        "today_cost",
        "virtual_available",
        "__rate_p",
    )
    out = line.join(head, "invoice_id").join(what, "product_id", "left")
    return _fact_columns(sales_measures(out.withColumn("product_margin", margin_column())))


def _invoice_head(invoice: DataFrame, partner: DataFrame, *extra: str) -> DataFrame:
    who = partner.select(F.col("id").alias("partner_id"), "customer", "supplier")
    return invoice.join(who, "partner_id").select(
        F.col("id").alias("invoice_id"),
        "partner_id",
        "customer",
        "supplier",
        "date_due",
        document_number(F.col("document_number"), F.col("number")).alias("number"),
        "journal_id",
        "user_id",
        "type",
        "state_id",
        "document_type_id",
        "state",
        "date",
        "date_invoice",
        *extra,
    )


def _fact_columns(joined: DataFrame) -> DataFrame:
    return joined.select(
        "id",
        *MEASURES,
        "margin_percent",
        "partner_id",
        "product_id",
        "date_due",
        "number",
        "journal_id",
        "user_id",
        "type",
        "state_id",
        "document_type_id",
        "state",
        "date",
        "date_invoice",
        "name_template",
        "product_category_id",
        "customer",
        "supplier",
        "brand_id",
        "vendor_id",
    )


def register_sales_view(fact: DataFrame, name: str = "invoice_line_report") -> str:
    """Publish the fact under a name for SQL users; ordering is left to them."""
    fact.createOrReplaceTempView(name)
    return name


def sales_filter(
    fact: DataFrame, side: str | None = None, document: str | None = None, status: str | None = None
) -> DataFrame:
    """side: customer / vendor; document: invoice / refund; status: draft / invoiced."""
    sides = {"customer": CUSTOMER_TYPES, "vendor": VENDOR_TYPES}
    documents = {"invoice": INVOICE_TYPES, "refund": REFUNDS}
    if side is not None:
        fact = fact.filter(F.col("type").isin(*sides[side]))
    if document is not None:
        fact = fact.filter(F.col("type").isin(*documents[document]))
    if status == "draft":
        fact = fact.filter(F.col("state").isin(*DRAFT_STATES))
    elif status == "invoiced":
        fact = fact.filter(~F.col("state").isin(*NOT_INVOICED_STATES))
    elif status is not None:
        raise ValueError(f"unknown status {status!r}")
    return fact


def in_period(period: str, today: str) -> Column:
    """Whether the invoice date is in this_month, last_month, this_year or last_year relative to ``today``; half open."""
    which, unit = period.split("_")
    months = {"month": 1, "year": 12}[unit]
    start = F.trunc(F.lit(today).cast("date"), unit)
    shift = {"this": 0, "last": -months}[which]
    low, high = F.add_months(start, shift), F.add_months(start, shift + months)
    return (F.col("date_invoice") >= low) & (F.col("date_invoice") < high)


def period_filter(fact: DataFrame, period: str, today: str) -> DataFrame:
    return fact.filter(in_period(period, today))


def date_between(fact: DataFrame, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """Both ends are included and either may be left out."""
    if date_from is not None:
        fact = fact.filter(F.col("date_invoice") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        fact = fact.filter(F.col("date_invoice") <= F.lit(date_to).cast("date"))
    return fact


def low_margin(fact: DataFrame, pct: float = 10.0) -> DataFrame:
    return fact.filter(F.col("margin_percent") <= F.lit(float(pct)))


def under_category(fact: DataFrame, category: DataFrame, root_path: str) -> DataFrame:
    """Facts whose category is ``root_path`` or lies below it.

    ``category`` has id and path ('section/family/item'), so a subtree is a path
    prefix and needs no recursion.
    """
    inside = category.filter((F.col("path") == root_path) | F.col("path").startswith(root_path + "/"))
    return fact.join(inside.select(F.col("id").alias("product_category_id")), "product_category_id", "left_semi")


def text_search(fact: DataFrame, text: str | None = None, **equal) -> DataFrame:
    """Product text contains ``text`` (any case); other search fields by equality."""
    if text is not None:
        fact = fact.filter(F.lower("name_template").contains(text.lower()))
    for name, value in equal.items():
        fact = fact.filter(F.col(name) == F.lit(value))
    return fact


def sales_pivot(
    fact: DataFrame,
    rows: Sequence[str] = ("date_invoice",),
    measures: Sequence[str] = ("price_total", "cost_total", "margin_total"),
    cols: str | None = None,
    col_values: Sequence | None = None,
    interval: str = "day",
) -> DataFrame:
    """Sum measures by any dimensions; dates are cut to ``interval``.

    With ``cols`` the values to spread must be given, so no job runs to find
    them. The margin percent of a group is total margin over total cost.
    """
    keys: list[Column] = [
        F.trunc(c, interval).alias(c) if c.startswith("date") and interval != "day" else F.col(c) for c in rows
    ]
    grouped = fact.groupBy(*keys)
    if cols is not None:
        if col_values is None:
            raise ValueError("col_values must be given with cols")
        grouped = grouped.pivot(cols, list(col_values))
    out = grouped.agg(*[exact_sum(F.col(m)).alias(m) for m in measures])
    if cols is None and {"margin_total", "cost_total"} <= set(measures):
        percent = F.try_divide(F.col("margin_total"), F.col("cost_total")) * F.lit(100.0)
        out = out.withColumn("margin_percent", percent)
    return out
