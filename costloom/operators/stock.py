"""Stock moves, layers and the reconciliation of stock with invoices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import exchange, round_to_step
from ..functions.fixed_point import exact_sum
from .costing import top_k
from .currency import convert, convert_from_company

NOT_INVOICED = "S/Fact"  # fixed text of the export


def _signed(plus: tuple[str, ...], minus: tuple[str, ...]) -> Column:
    q = F.coalesce("quantity", F.lit(0.0))
    return F.when(F.col("type").isin(*plus), q).when(F.col("type").isin(*minus), -q).otherwise(0.0)


def _by_code(line: DataFrame, invoice: DataFrame, product: DataFrame, quantity: Column, name: str) -> DataFrame:
    # Pre-aggregated per product before the code is looked up, so the join side
    # is one row per product whatever the number of lines.
    moved = line.join(invoice, "invoice_id").groupBy("product_id").agg(exact_sum(quantity).alias("__q"))
    coded = moved.join(product.select(F.col("id").alias("product_id"), "default_code"), "product_id")
    return coded.groupBy("default_code").agg(exact_sum(F.col("__q")).alias(name))


def stock_by_invoices(line: DataFrame, invoice: DataFrame, product: DataFrame) -> DataFrame:
    """Stock per code as purchases minus sales, refunds reversed; every state counts."""
    head = invoice.select(F.col("id").alias("invoice_id"), "type")
    quantity = _signed(("in_invoice", "out_refund"), ("in_refund", "out_invoice"))
    coded = product.filter(F.coalesce("default_code", F.lit("")) != "")
    return _by_code(line.select("invoice_id", "product_id", "quantity"), head, coded, quantity, "stock_by_invoices")


def stock_by_posted_invoices(line: DataFrame, invoice: DataFrame, product: DataFrame) -> DataFrame:
    """The same per code, drafts left out."""
    head = invoice.filter(F.col("state") != "draft").select(F.col("id").alias("invoice_id"), "type")
    quantity = _signed(("in_invoice", "out_refund"), ("in_refund", "out_invoice"))
    return _by_code(line.select("invoice_id", "product_id", "quantity"), head, product, quantity, "qty")


def stock_reconciliation(product: DataFrame, posted: DataFrame, supplierinfo: DataFrame, vendor: DataFrame) -> DataFrame:
    """Stocked products with a forecast, next to what invoices say.

    The vendor is the first price row of the product (lowest id).
    """
    first = supplierinfo.groupBy("product_tmpl_id").agg(F.min_by("vendor_id", "id").alias("vendor_id"))
    named = first.join(vendor.select(F.col("id").alias("vendor_id"), "ref"), "vendor_id", "left")
    shown = product.filter((F.col("virtual_available") != 0) & (F.col("type") == "product"))
    out = shown.join(named.select(F.col("product_tmpl_id").alias("tmpl_id"), "ref"), "tmpl_id", "left")
    out = out.join(posted, "default_code", "left")
    return out.select(
        F.col("default_code").alias("code"),
        "name",
        F.coalesce("ref", F.lit("")).alias("vendor"),
        F.col("qty_available").alias("on_hand"),
        F.col("virtual_available").alias("forecast"),
        F.coalesce(F.col("qty").cast("decimal(18,2)").cast("string"), F.lit(NOT_INVOICED)).alias("invoiced"),
        F.col("today_cost").alias("cost_today"),
        F.col("standard_product_price").alias("cost_purchase"),
    )


def average_layer_cost(move: DataFrame, layers: DataFrame) -> DataFrame:
    """Average cost of a move's layers in both currencies.

    ``move``: id, product_id, product_qty; ``layers`` has move_id, qty, cost,
    cost_product. No row when a layer is not positive or nothing was moved.
    """
    value = layers.groupBy("move_id").agg(
        F.bool_and(F.col("qty") > 0).alias("__ok"),
        exact_sum(F.col("qty") * F.col("cost")).alias("__value"),
        exact_sum(F.col("qty") * F.col("cost_product")).alias("__value_product"),
    )
    out = move.filter(F.col("product_qty") != 0).join(value.withColumnRenamed("move_id", "id"), "id", "left")
    out = out.filter(F.coalesce("__ok", F.lit(True)))
    each = lambda c: F.coalesce(F.col(c), F.lit(0.0)) / F.col("product_qty")
    return out.select(
        "id", "product_id", each("__value").alias("price_unit"), each("__value_product").alias("price_product_unit")
    )


def stock_ledger(moves: DataFrame) -> DataFrame:
    """Signed quantities a move writes: in at its destination, out at an internal source.

    ``moves``: id, product_id, qty, uom_step, cost, cost_product, location_id,
    location_dest_id, source_usage, lot_id, tracking. ``valid`` is false when a
    serial-tracked lot is not a single piece.
    """
    valid = ~(F.col("lot_id").isNotNull() & (F.col("tracking") == "serial") & (F.col("qty") != 1.0))
    row = lambda place, qty: F.struct(F.col(place).alias("location_id"), round_to_step(qty, F.col("uom_step")).alias("qty"))
    inward = row("location_dest_id", F.col("qty"))
    outward = row("location_id", -F.col("qty"))
    entries = F.when(F.col("source_usage") == "internal", F.array(inward, outward)).otherwise(F.array(inward))
    out = moves.withColumns({"valid": F.coalesce(valid, F.lit(True)), "__entry": F.explode(entries)})
    return out.select(
        F.col("id").alias("move_id"), "product_id", "__entry.location_id", "__entry.qty", "cost", "cost_product", "lot_id", "valid"
    )


def revalue_moves(moves: DataFrame, rates: DataFrame, company_currency: str, as_of: str | None = None) -> DataFrame:
    """Layer prices of a move: foreign purchases at the rate of execution.

    ``moves``: id, price_unit, price_product_unit, po_currency (NULL without a
    purchase), po_unit (order price per product unit, tax excluded) and
    product_currency. Without purchase both prices are the move's price.
    """
    out = convert(moves, rates, "po_unit", "po_currency", None, "__company", as_of=as_of)
    out = convert_from_company(out, rates, "__company", "product_currency", "__product", as_of=as_of)
    bought = F.col("po_currency").isNotNull()
    foreign = bought & (F.col("po_currency") != company_currency)
    return out.withColumns(
        {
            "price_product_unit": F.when(foreign, F.col("__product")).when(bought, F.col("price_product_unit")).otherwise(F.col("price_unit")),
            "price_unit": F.when(foreign, F.col("__company")).otherwise(F.col("price_unit")),
        }
    ).drop("__company", "__product")
