"""Vendor KPIs and month-end valuation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_month_end
from ..functions.fixed_point import exact_sum
from .currency import convert

KPI_MONTH_VALUES = (
    "stock_value_purchase_historic",
    "stock_value_purchase",
    "stock_value_sell",
    "payable",
    "receivable",
)


def sync_members(target: DataFrame, tagged: DataFrame) -> DataFrame:
    """KPI rows after adding tagged vendors without a row and dropping untagged ones.

    ``target``: vendor_id, total_payable, stock_valuation, count, updated;
    ``tagged``: vendor_id.
    """
    members = tagged.select("vendor_id").distinct()
    kept = target.join(members, "vendor_id", "left_semi")
    new = members.join(target, "vendor_id", "left_anti").select(
        "vendor_id",
        *[F.lit(0).cast(target.schema[c].dataType).alias(c) for c in ("total_payable", "stock_valuation", "count")],
        F.lit(None).cast(target.schema["updated"].dataType).alias("updated"),
    )
    return kept.unionByName(new)


def due_for_refresh(kpi: DataFrame, now: Column) -> DataFrame:
    """Every KPI row due now; a row never refreshed is due."""
    return kpi.filter(F.coalesce(F.col("updated") <= now, F.lit(True)))


def kpi_supplier(supplierinfo: DataFrame) -> DataFrame:
    """The vendor a product is valued under.

    A single price row counts as it is. Among several the newest dated one
    counts, the lowest id on ties; a product with only undated rows has none.
    """
    dated = F.col("date_start").isNotNull()
    newest = F.struct(F.col("date_start"), (-F.col("id")).alias("id"))
    per_product = supplierinfo.groupBy("product_tmpl_id").agg(
        F.count(F.lit(1)).alias("__n"),
        F.min_by("vendor_id", "id").alias("__only"),
        F.max_by("vendor_id", F.when(dated, newest)).alias("__newest"),
    )
    vendor = F.when(F.col("__n") == 1, F.col("__only")).otherwise(F.col("__newest"))
    return per_product.select("product_tmpl_id", vendor.alias("vendor_id")).filter(F.col("vendor_id").isNotNull())


def vendor_kpis(kpi: DataFrame, product: DataFrame, supplierinfo: DataFrame, vendor: DataFrame) -> DataFrame:
    """Payable, stock valuation at taxed sale price, and units per KPI vendor.

    ``product`` has final_price; only a positive forecast counts.
    """
    stocked = product.filter(F.col("virtual_available") > 0).select("tmpl_id", "virtual_available", "final_price")
    owner = kpi_supplier(supplierinfo).withColumnRenamed("product_tmpl_id", "tmpl_id")
    totals = stocked.join(owner, "tmpl_id").groupBy("vendor_id").agg(
        exact_sum(F.col("virtual_available") * F.col("final_price")).alias("stock_valuation"),
        exact_sum(F.col("virtual_available")).alias("count"),
    )
    debit = vendor.select(F.col("id").alias("vendor_id"), F.col("debit").alias("total_payable"))
    zero = F.lit(0.0)
    out = kpi.select("vendor_id").join(debit, "vendor_id", "left").join(totals, "vendor_id", "left")
    return out.select(
        "vendor_id",
        F.coalesce("total_payable", zero).alias("total_payable"),
        F.coalesce("stock_valuation", zero).alias("stock_valuation"),
        F.coalesce("count", zero).alias("count"),
    )


def month_end_valuation(
    layers: DataFrame,
    product: DataFrame,
    accounts: DataFrame,
    rates: DataFrame,
    date: str,
    parent_location: str = "WH",
) -> DataFrame:
    """One snapshot row: stock at historic, current and sale price, and both balances.

    ``accounts``: account_type ('payable' / 'receivable'), date, debit, credit.
    Returns no row unless ``date`` is the last day of a month. Each part is
    reduced to one row before they meet, so nothing is paired up.
    """
    day = F.lit(date).cast("date")
    none = F.lit(None).cast("double")

    def part(df: DataFrame, **sums: Column) -> DataFrame:
        return df.agg(*[(exact_sum(sums[c]) if c in sums else F.max(none)).alias(c) for c in KPI_MONTH_VALUES])

    owned = layers.filter((F.col("location_parent") == parent_location) & (F.col("qty") > 0))
    stocked = product.filter(F.col("virtual_available") > 0)
    stocked = convert(stocked, rates, "today_cost", "currency", None, "__cost", as_of=date)
    stocked = convert(stocked, rates, "list_price", "currency", None, "__list", as_of=date)
    posted = accounts.filter(F.col("date") <= day)
    balance = F.col("debit") - F.col("credit")
    parts = [
        part(owned, stock_value_purchase_historic=F.col("qty") * F.col("cost")),
        part(
            stocked,
            stock_value_purchase=F.col("__cost") * F.col("virtual_available"),
            stock_value_sell=F.col("__list") * F.col("virtual_available"),
        ),
        part(
            posted,
            payable=F.when(F.col("account_type") == "payable", balance),
            receivable=F.when(F.col("account_type") == "receivable", balance),
        ),
    ]
    merged = reduce(DataFrame.unionByName, parts).agg(
        *[F.coalesce(F.max(c), F.lit(0.0)).alias(c) for c in KPI_MONTH_VALUES]
    )
    return merged.filter(is_month_end(day)).select(day.alias("date"), *KPI_MONTH_VALUES)


def patch_snapshot(kpi: DataFrame, patches: DataFrame) -> DataFrame:
    """Snapshots with values overwritten, or whole dates added, by ``patches``."""
    values = [c for c in patches.columns if c != "date"]
    renamed = patches.select("date", *[F.col(c).alias(f"__new_{c}") for c in values])
    out = kpi.join(renamed, "date", "full_outer")
    patched = [F.coalesce(f"__new_{c}", c).alias(c) if c in values else F.col(c) for c in kpi.columns if c != "date"]
    return out.select("date", *patched)


def month_end_days(df: DataFrame, date_col: str) -> DataFrame:
    return df.filter(is_month_end(F.col(date_col)))
