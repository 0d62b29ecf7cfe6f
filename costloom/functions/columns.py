"""Scalar rules as column expressions; everything stays in whole-stage codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values shared with the data being replaced.
MARGIN_UNKNOWN = 1e10
REFUNDS = ("in_refund", "out_refund")
CUSTOMER_TYPES = ("out_invoice", "out_refund")
VENDOR_TYPES = ("in_invoice", "in_refund")
INVOICE_TYPES = ("out_invoice", "in_invoice")
DRAFT_STATES = ("draft", "proforma", "proforma2")
NOT_INVOICED_STATES = ("draft", "cancel")
PRIMARY_VENDOR_REBATE = 0.05


def invoice_sign(type_: Column) -> Column:
    return F.when(type_.isin(*REFUNDS), F.lit(-1)).otherwise(F.lit(1))


def net_unit_price(price_unit: Column, discount: Column) -> Column:
    return price_unit * (F.lit(1.0) - discount / F.lit(100.0))


def margin_ratio(price: Column, cost: Column) -> Column:
    """price / cost - 1; an unknown or zero side gives the sentinel."""
    usable = (F.coalesce(price, F.lit(0.0)) != 0) & (F.coalesce(cost, F.lit(0.0)) != 0)
    return F.when(usable, F.try_divide(price, cost) - F.lit(1.0)).otherwise(F.lit(MARGIN_UNKNOWN))


def cost_per_unit(pack_cost: Column, pack_size: Column) -> Column:
    return F.try_divide(pack_cost, pack_size)


def document_number(document: Column, number: Column) -> Column:
    return F.coalesce(document, number)


def last_tax_rate(taxes: Column) -> Column:
    """Rate of the last tax in an array, as a fraction; none means 0."""
    return F.coalesce(F.try_element_at(taxes, F.lit(-1)) / F.lit(100.0), F.lit(0.0))


WHITE_SPACE = " \t\n\x0b\x0c\r"


def py_strip(text: Column) -> Column:
    """Strip every kind of white space, not only blanks as ``trim`` does."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def any_of(conditions: list[Column]) -> Column:
    """True when a condition holds; an unknown one does not."""
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions], F.lit(False))


def normalize_code(code: Column) -> Column:
    """Code without dashes and outer white space, for duplicate detection."""
    return py_strip(F.translate(code, "-", ""))


def exchange(amount: Column, rate_from: Column, rate_to: Column, decimals: int | None = None) -> Column:
    """Convert by two rates, each in units per company-currency unit; no rate means 1."""
    one = F.lit(1.0)
    out = amount * F.coalesce(rate_to, one) / F.coalesce(rate_from, one)
    return out if decimals is None else F.round(out, decimals)


def purchase_net_price(
    price_unit: Column,
    discount: Column,
    invoice_discount: Column,
    is_primary: Column,
    rebate: float = PRIMARY_VENDOR_REBATE,
) -> Column:
    """Price really paid: line discount, global discount, month-end rebate."""
    net = price_unit * (F.lit(1.0) - discount / F.lit(100.0))
    net = net * (F.lit(1.0) + F.coalesce(invoice_discount, F.lit(0.0)))
    return F.when(is_primary, net * F.lit(1.0 - rebate)).otherwise(net)


def cost_decreased(previous: Column, cost: Column, tolerance: float = 0.05) -> Column:
    """A cost within ``tolerance`` above the previous one still counts as lower."""
    return (previous != 0) & (previous + F.lit(tolerance) > cost)


def round_to_step(qty: Column, step: Column | float) -> Column:
    """Round half away from zero to a multiple of the unit's precision."""
    step = F.lit(step) if not isinstance(step, Column) else step
    return F.signum(qty) * F.floor(F.abs(qty) / step + F.lit(0.5)).cast("double") * step


def is_month_end(day: Column) -> Column:
    return F.last_day(day) == day
