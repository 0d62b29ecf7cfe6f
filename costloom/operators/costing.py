"""Vendors, margins, discounts and purchase costs of invoice lines and products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    CUSTOMER_TYPES,
    MARGIN_UNKNOWN,
    exchange,
    last_tax_rate,
    margin_ratio,
    net_unit_price,
    purchase_net_price,
)
from ..functions.fixed_point import exact_sum
from ..functions.ordered import Running, numbered, ordered_scan, top_k
from .currency import convert, convert_from_company, current_rates, with_current_rate

INVOICED_STATES = ("open", "paid")
VAT_RATES = (21.0, 10.5)


# -- vendors -----------------------------------------------------------------


def latest_supplier(supplierinfo: DataFrame) -> DataFrame:
    """Newest price row of each product; an undated row counts as newest."""
    return top_k(supplierinfo, ["product_tmpl_id"], [F.col("date_start").desc_nulls_first(), F.col("id")])


def current_vendor(product: DataFrame, supplierinfo: DataFrame) -> DataFrame:
    """Product with ``vendor_id`` of its newest price row, NULL if it has none."""
    vendor = latest_supplier(supplierinfo).select(F.col("product_tmpl_id").alias("tmpl_id"), "vendor_id")
    return product.join(vendor, "tmpl_id", "left")


def mode_and_vendor(product: DataFrame, supplierinfo: DataFrame, vendor: DataFrame) -> DataFrame:
    """``business_mode`` and ``current_vendor`` in one pass over the price rows."""
    undated, newest = F.col("date_start").isNull(), -F.unix_date("date_start")
    best = supplierinfo.groupBy(F.col("product_tmpl_id").alias("tmpl_id")).agg(
        F.min(F.struct(~undated, newest, F.col("id"), F.col("vendor_id")))["vendor_id"].alias("vendor_id"),
        F.min(F.struct(undated, newest, F.col("id"), F.col("vendor_id")))["vendor_id"].alias("__recent"),
        F.lit(True).alias("__known"),
    )
    modes = vendor.select(F.col("id").alias("__recent"), F.col("business_mode").alias("__mode"))
    side = best.join(modes, "__recent", "left").drop("__recent")
    out = product.drop("business_mode", "vendor_id").join(side, "tmpl_id", "left")
    return out.withColumn("business_mode", F.when(F.col("__known"), F.col("__mode")).otherwise(F.lit("undefined"))).drop("__mode", "__known")


def vendor_with_fallback(
    line: DataFrame,
    product: DataFrame,
    supplierinfo: DataFrame,
    receipts: DataFrame,
    vendor: DataFrame,
    location: int = 12,
) -> DataFrame:
    """Line vendor from the price list, else partner of the last receipt.

    ``receipts``: id, product_id, location_dest_id, partner_id. The fallback
    partner counts only when it is flagged as supplier.
    """
    listed = current_vendor(product, supplierinfo).select(F.col("id").alias("product_id"), F.col("vendor_id").alias("__listed"))
    last = (
        receipts.filter(F.col("location_dest_id") == location)
        .groupBy("product_id")
        .agg(F.max_by("partner_id", "id").alias("__received"))
    )
    flagged = vendor.filter("supplier").select(F.col("id").alias("__received"))
    last = last.join(flagged, "__received", "left_semi")
    out = line.drop("vendor_id").join(listed, "product_id", "left").join(last, "product_id", "left")
    return out.withColumn("vendor_id", F.coalesce("__listed", "__received")).drop("__listed", "__received")


def backfill_vendor(line: DataFrame, product: DataFrame, supplierinfo: DataFrame) -> DataFrame:
    """Price-list vendor for every line that has one; other lines keep theirs."""
    listed = current_vendor(product, supplierinfo).select(F.col("id").alias("product_id"), F.col("vendor_id").alias("__listed"))
    return (
        line.join(listed, "product_id", "left")
        .withColumn("vendor_id", F.coalesce("__listed", "vendor_id"))
        .drop("__listed")
    )


def business_mode(product: DataFrame, supplierinfo: DataFrame, vendor: DataFrame) -> DataFrame:
    """Mode of the most recent supplier, undated rows last; 'undefined' if none."""
    newest = top_k(supplierinfo, ["product_tmpl_id"], [F.col("date_start").desc_nulls_last(), F.col("id")])
    mode = newest.join(vendor.select(F.col("id").alias("vendor_id"), F.col("business_mode").alias("__mode")), "vendor_id", "left")
    mode = mode.select(F.col("product_tmpl_id").alias("tmpl_id"), "__mode", F.lit(True).alias("__known"))
    out = product.drop("business_mode").join(mode, "tmpl_id", "left")
    return out.withColumn("business_mode", F.when(F.col("__known"), F.col("__mode")).otherwise(F.lit("undefined"))).drop(
        "__mode", "__known"
    )


def default_business_mode(partner: DataFrame) -> DataFrame:
    return partner.withColumn("business_mode", F.coalesce("business_mode", F.lit("standard")))


def first_partner_tag(invoice: DataFrame, partner_tag: DataFrame) -> DataFrame:
    """Invoice with the first tag of its partner; ``partner_tag``: partner_id, tag, tag_order."""
    first = partner_tag.groupBy("partner_id").agg(F.min_by("tag", "tag_order").alias("tag"))
    return invoice.join(first, "partner_id", "left")


# -- prices and margins ------------------------------------------------------


def line_vat(line: DataFrame, product_taxes: DataFrame) -> DataFrame:
    """Line VAT fraction: last tax of its product; ``product_taxes``: product_id, taxes."""
    taxes = product_taxes.select("product_id", last_tax_rate(F.col("taxes")).alias("__iva"))
    out = line.drop("product_iva").join(taxes, "product_id", "left")
    return out.withColumn("product_iva", F.coalesce("__iva", F.lit(0.0))).drop("__iva")


def backfill_vat(line: DataFrame, product_taxes: DataFrame, since: str) -> DataFrame:
    """``line_vat`` for lines dated ``since`` or later; earlier lines keep theirs."""
    taxes = product_taxes.select("product_id", last_tax_rate(F.col("taxes")).alias("__iva"))
    out = line.join(taxes, "product_id", "left")
    recent = F.col("date_invoice") >= F.lit(since).cast("date")
    iva = F.when(recent, F.coalesce("__iva", F.lit(0.0))).otherwise(F.col("product_iva"))
    return out.withColumn("product_iva", iva).drop("__iva")


def final_price(product: DataFrame, rates: DataFrame, as_of: str | None = None) -> DataFrame:
    """List price in company currency with the first tax; ``tax_rate`` NULL means none."""
    out = convert(product, rates, "list_price", "currency", None, "__list", as_of=as_of)
    tax = F.lit(1.0) + F.coalesce("tax_rate", F.lit(0.0)) / F.lit(100.0)
    return out.withColumn("final_price", F.col("__list") * tax).drop("__list")


def loyalty_price(sale: DataFrame, partner: DataFrame) -> DataFrame:
    """Price raised by the partner's loyalty percentage, for every row."""
    loyal = partner.select(F.col("id").alias("partner_id"), "loyalty")
    factor = F.lit(1.0) + F.col("loyalty") / F.lit(100.0)
    return sale.join(loyal, "partner_id", "left").withColumn(
        "loyalty_price", F.when(F.col("loyalty").isNull(), F.col("price")).otherwise(F.col("price") * factor)
    )


def net_price() -> Column:
    """Net unit price of a line in company currency; reads price_unit, discount and ``__rate_i``."""
    return exchange(net_unit_price(F.col("price_unit"), F.col("discount")), F.col("__rate_i"), F.lit(1.0))


def customer_line() -> Column:
    return F.col("type").isin(*CUSTOMER_TYPES) & F.col("product_id").isNotNull()


def margin_column(agreed: Column | None = None, convert_negative_stock: bool = False) -> Column:
    """The margin rule over a line joined with its product and both current rates.

    Reads type, product_id, price_unit, discount, ``__rate_i`` (of the invoice
    currency), business_mode, standard_price, today_cost, virtual_available and
    ``__rate_p`` (of the product currency).
    """
    agreed = F.col("today_cost") if agreed is None else agreed
    own = F.col("today_cost")
    if convert_negative_stock:
        own = exchange(own, F.col("__rate_p"), F.lit(1.0))
    mode = F.coalesce("business_mode", F.lit("standard"))
    cost = (
        F.when(mode == "consignment", exchange(agreed, F.col("__rate_p"), F.lit(1.0)))
        .when(F.col("virtual_available") >= 0, F.col("standard_price"))
        .otherwise(own)
    )
    margin = F.when(mode == "undefined", F.lit(MARGIN_UNKNOWN)).otherwise(margin_ratio(net_price(), cost))
    return F.when(customer_line(), margin)


def line_margin(
    line: DataFrame,
    product: DataFrame,
    rates: DataFrame,
    as_of: str | None = None,
    historic: DataFrame | None = None,
    convert_negative_stock: bool = False,
) -> DataFrame:
    """Margin of customer lines; other lines get NULL.

    ``line``: id, product_id, type, currency, price_unit, discount.
    ``product``: id, business_mode, standard_price, today_cost,
    virtual_available, currency. Standard goods cost the standard price, or the
    unconverted cost of today when the forecast is negative; consigned goods
    cost today's cost (or the ``historic`` price by line id) in company
    currency; an unknown mode gives the sentinel.
    """
    what = with_current_rate(product, rates, "currency", "__rate_p", as_of).select(
        F.col("id").alias("product_id"),
        "business_mode",
        "standard_price",
        "today_cost",
        "virtual_available",
        "__rate_p",
    )
    out = with_current_rate(line, rates, "currency", "__rate_i", as_of).join(what, "product_id", "left")
    margin = margin_column(None, convert_negative_stock)
    if historic is not None:
        # Only the price and rate of lines that ask for it, or the margin of the others, go through the join by line.
        consigned = customer_line() & (F.coalesce("business_mode", F.lit("standard")) == "consignment")
        asks = {"__asked": F.when(consigned, net_price()).otherwise(margin), "__rate": F.when(consigned, F.coalesce("__rate_p", F.lit(1.0)))}
        past = historic.select(F.col("line_id").alias("id"), F.col("price").alias("__past"))
        out = out.withColumns(asks).join(past, "id", "left")
        agreed = margin_ratio(F.col("__asked"), exchange(F.col("__past"), F.col("__rate"), F.lit(1.0)))
        margin = F.when(F.col("__rate").isNotNull(), agreed).otherwise(F.col("__asked"))
    return out.withColumn("product_margin", margin).select(*line.columns, "product_margin")


def margin_backfill(product: DataFrame) -> DataFrame:
    """Product margin percent from list price and cost, where both are set."""
    both = (F.col("list_price") != 0) & (F.col("today_cost") != 0)
    value = F.lit(100.0) * (F.try_divide(F.col("list_price"), F.col("today_cost")) - F.lit(1.0))
    return product.withColumn("margin", F.when(both, value).otherwise(F.col("margin")))


def sale_line_amount(line: DataFrame) -> DataFrame:
    """Subtotal, tax and total of a sale line with marketplace surcharge and discount.

    ``line``: price_unit, price_unit_ml, discount, product_uom_qty, tax_rates
    (array of percentages on top of the price).
    """
    zero = F.lit(0.0)
    unit = F.col("price_unit") * (F.lit(1.0) + F.coalesce("price_unit_ml", zero) / F.lit(100.0))
    price = unit * (F.lit(1.0) - F.coalesce("discount", zero) / F.lit(100.0))
    subtotal = price * F.col("product_uom_qty")
    rate = F.aggregate(F.coalesce("tax_rates", F.array().cast("array<double>")), zero, lambda a, x: a + x)
    out = line.withColumn("price_subtotal", subtotal).withColumn("price_tax", F.col("price_subtotal") * rate / F.lit(100.0))
    return out.withColumn("price_total", F.col("price_subtotal") + F.col("price_tax"))


def gross_up(line: DataFrame, global_discount: float = 25.0) -> DataFrame:
    """List price from net price, or net from list, under line and global discount."""
    factor = (F.lit(1.0) - F.lit(global_discount / 100.0)) * (F.lit(1.0) - F.col("discount") / F.lit(100.0))
    priced = F.coalesce("price_unit", F.lit(0.0)) != 0
    return line.withColumns(
        {
            "list_price": F.when(priced, F.try_divide(F.col("price_unit"), factor)).otherwise(F.col("list_price")),
            "price_unit": F.when(priced, F.col("price_unit")).otherwise(F.col("list_price") * factor),
        }
    )


def sale_purchase_price(line: DataFrame, rates: DataFrame, date_col: str = "date") -> DataFrame:
    """Standard price per sale unit in the price list's currency at a date.

    ``line``: standard_price, product_uom_factor, line_uom_factor, currency,
    ``date_col``. A unit factor is the number of units per reference unit.
    """
    unit = F.col("standard_price") * F.col("product_uom_factor") / F.col("line_uom_factor")
    same = F.col("product_uom_factor") == F.col("line_uom_factor")
    out = line.withColumn("__unit", F.when(same, F.col("standard_price")).otherwise(unit))
    return convert_from_company(out, rates, "__unit", "currency", "purchase_price", date_col).drop("__unit")


# -- global discounts --------------------------------------------------------


def pending_invoices(invoice: DataFrame) -> DataFrame:
    """Vendor invoices, open or paid, whose global discount is not spread yet."""
    return invoice.filter(
        ~F.coalesce("discount_processed", F.lit(False))
        & F.col("state").isin(*INVOICED_STATES)
        & (F.col("type") == "in_invoice")
    )


def _line_subtotal() -> Column:
    return F.col("price_unit") * (F.lit(1.0) - F.col("discount") / F.lit(100.0)) * F.col("quantity")


def discount_rate_by_vat(line: DataFrame) -> DataFrame:
    """Global discount of each invoice and VAT rate: negative over other lines.

    ``line`` has ``vat_rates``, an array of percentages. No product lines: 0.
    """
    taxed = line.withColumn("__subtotal", _line_subtotal()).withColumn("vat_rate", F.explode("vat_rates"))
    goods = F.col("price_subtotal_signed") >= 0
    sums = taxed.groupBy("invoice_id", "vat_rate").agg(
        exact_sum(F.when(goods, F.col("__subtotal")).otherwise(0.0)).alias("goods"),
        exact_sum(F.when(~goods, F.col("__subtotal")).otherwise(0.0)).alias("discounts"),
    )
    rate = F.coalesce(F.try_divide(F.col("discounts"), F.col("goods")), F.lit(0.0))
    return sums.withColumn("rate", rate)


def allocate_invoice_discount(line: DataFrame) -> DataFrame:
    """Lines with the global discount of their VAT rate as ``invoice_discount``.

    Only lines with a positive subtotal change; the lower rate wins on a line
    with both, and lines without either keep their value.
    """
    rates = discount_rate_by_vat(line).filter(F.col("vat_rate").isin(*VAT_RATES))
    per_invoice = rates.groupBy("invoice_id").agg(
        *[F.max(F.when(F.col("vat_rate") == r, F.col("rate"))).alias(f"__r{i}") for i, r in enumerate(VAT_RATES)]
    )
    out = line.join(per_invoice, "invoice_id", "left")
    positive = F.col("price_subtotal_signed") > 0
    value = F.col("invoice_discount")
    for i, rate in enumerate(VAT_RATES):
        value = F.when(positive & F.array_contains("vat_rates", rate), F.col(f"__r{i}")).otherwise(value)
    return out.withColumn("invoice_discount", value).select(*line.columns)


# -- purchase cost -----------------------------------------------------------


def oldest_layer(layers: DataFrame) -> DataFrame:
    """Earliest internal layer of each product, undated layers last."""
    internal = layers.filter(F.col("location_usage") == "internal")
    return top_k(internal, ["product_id"], [F.col("in_date").asc_nulls_last(), F.col("id")])


def closest_invoice_line(product: DataFrame, lines: DataFrame, layers: DataFrame, fallback_date: str) -> DataFrame:
    """For each product the processed invoice line nearest in date to its oldest layer.

    ``lines``: id, product_id, date_invoice, discount_processed and whatever is
    to be kept. Products without stock use ``fallback_date``. Undated lines come
    last; ties go to the earlier date, then the lower id.
    """
    since = oldest_layer(layers).select("product_id", F.col("in_date").cast("date").alias("__since"))
    want = product.select(F.col("id").alias("product_id")).join(since, "product_id", "left")
    want = want.withColumn("__since", F.coalesce("__since", F.lit(fallback_date).cast("date")))
    done = lines.filter(F.coalesce("discount_processed", F.lit(False)))
    pairs = done.join(want, "product_id")
    gap = F.abs(F.date_diff("date_invoice", "__since"))
    return top_k(
        pairs, ["product_id"], [gap.asc_nulls_last(), F.col("date_invoice").asc_nulls_last(), F.col("id")]
    ).drop("__since")


def purchase_nets(product: DataFrame, lines: DataFrame, layers: DataFrame, fallback_date: str) -> DataFrame:
    """Net price, currency and date of the purchase line nearest to each product's oldest layer.

    ``product``: id. ``lines`` also has price_unit, discount, invoice_discount, is_primary and currency.
    """
    near = closest_invoice_line(product, lines, layers, fallback_date)
    net = purchase_net_price(F.col("price_unit"), F.col("discount"), F.col("invoice_discount"), F.col("is_primary"))
    return near.select("product_id", F.when(F.col("price_unit") != 0, net).alias("net"), F.col("currency").alias("net_currency"), "date_invoice")


def with_invoice_cost(product: DataFrame, nets: DataFrame, rates: DataFrame) -> DataFrame:
    """Product with ``invoice_cost`` from ``purchase_nets``, in product currency at the invoice date; 0 without line."""
    priced = nets.join(product.select(F.col("id").alias("product_id"), F.col("currency").alias("__to")), "product_id")
    priced = convert(priced, rates, "net", "net_currency", "__to", "__cost", date_col="date_invoice")
    priced = priced.select(F.col("product_id").alias("id"), "__cost")
    out = product.drop("invoice_cost").join(priced, "id", "left")
    return out.withColumn("invoice_cost", F.coalesce("__cost", F.lit(0.0))).drop("__cost")


def invoice_cost(
    product: DataFrame, lines: DataFrame, layers: DataFrame, rates: DataFrame, fallback_date: str
) -> DataFrame:
    """Product with ``invoice_cost`` from its nearest purchase line, in product currency.

    The conversion uses the rates of the invoice date; 0 without line.
    """
    return with_invoice_cost(product, purchase_nets(product, lines, layers, fallback_date), rates)


def move_unit_price(po_line: DataFrame, rates: DataFrame, as_of: str | None = None) -> DataFrame:
    """Unit price of an incoming move in company and in product currency.

    ``po_line``: price_unit, included_tax_rate (percent contained in the price),
    line_uom_factor, product_uom_factor, currency, product_currency.
    """
    bare = F.col("price_unit") / (F.lit(1.0) + F.coalesce("included_tax_rate", F.lit(0.0)) / F.lit(100.0))
    unit = bare * (F.col("line_uom_factor") / F.col("product_uom_factor"))
    out = po_line.withColumn("__unit", unit)
    out = convert(out, rates, "__unit", "currency", None, "move_price_unit", as_of=as_of)
    return convert_from_company(
        out, rates, "move_price_unit", "product_currency", "move_price_product_unit", as_of=as_of
    ).drop("__unit")


def denormalize(layer: DataFrame, product: DataFrame) -> DataFrame:
    """Layer with template and currency of its product."""
    what = product.select(F.col("id").alias("product_id"), F.col("tmpl_id").alias("product_tmpl_id"), "currency")
    return layer.join(what, "product_id", "left")


def with_invoice(line: DataFrame, invoice: DataFrame, *columns: str) -> DataFrame:
    """Line with columns of its invoice; lines without invoice keep NULL."""
    head = invoice.select(F.col("id").alias("invoice_id"), *columns)
    return line.join(head, "invoice_id", "left")


def cost_history(product: DataFrame, layers: DataFrame) -> DataFrame:
    """Internal layers of each product, numbered in date order.

    One row per layer: a long history is never gathered into one value.
    """
    internal = layers.filter(F.col("location_usage") == "internal")
    kept = internal.join(product.select(F.col("id").alias("product_id")), "product_id", "left_semi")
    dated = kept.withColumn("__at", F.coalesce("in_date", F.lit("9999-12-31").cast("timestamp")))
    return ordered_scan(
        dated,
        ["product_id"],
        ["__at", "id"],
        [Running("history_no", "sum", F.lit(1).cast("bigint"))],
    ).drop("__at")


def _listing_order(keys: tuple[str, ...], newest_first: bool) -> list[Column]:
    return [F.col(k).desc_nulls_last() if newest_first else F.col(k).asc_nulls_first() for k in keys]


def ordered(df: DataFrame, *keys: str, newest_first: bool = False) -> DataFrame:
    """Listing order for a sink; views and operators never sort."""
    return df.orderBy(*_listing_order(keys, newest_first))


def listed(df: DataFrame, *keys: str, newest_first: bool = False, position: str = "position") -> DataFrame:
    """Every row with its place in the listing, from 1: a page of it is a plain filter."""
    return numbered(df, _listing_order(keys, newest_first), position)
