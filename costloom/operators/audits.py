"""Validation and business rules; a violation is a row, never an exception."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import CUSTOMER_TYPES, any_of, py_strip
from ..schemas import SHEET_COLUMNS
from ..session import written

# Fixed values of the supplier sheets.
CURRENCIES = ("ARS", "USD")
VAT_FRACTIONS = (0.21, 0.105)
OPEN_ORDER_STATES = ("draft", "sent")
ERRORS = "array<struct<column:string,reason:string>>"


# -- supplier sheets ---------------------------------------------------------


def validate_sheet(rows: DataFrame, product: DataFrame) -> DataFrame:
    """Typed sheet rows with ``product_exists``, ``invalid`` and ``errors`` of (column, reason).

    Rows with an empty code are skipped. A required cell may be empty only when
    the product exists already; empty cells then keep the stored value.
    """
    codes = product.select("default_code").distinct()
    rows = rows.filter(F.col("default_code.kind").isNotNull())
    code_text = F.when(F.col("default_code.kind") == "text", py_strip(F.col("default_code.text")))
    parent_text = F.when(F.col("parent.kind") == "text", F.col("parent.text"))
    step = rows.withColumns({"__code": code_text, "__parent": parent_text})
    known = codes.select(F.col("default_code").alias("__code"), F.lit(True).alias("product_exists"))
    parents = codes.select(F.col("default_code").alias("__parent"), F.lit(True).alias("__parent_exists"))
    step = step.join(known, "__code", "left").join(parents, "__parent", "left")
    exists = F.coalesce("product_exists", F.lit(False))

    errors: list[tuple[Column, Column]] = []
    values: dict[str, Column] = {}

    def fail(column: str, when: Column, reason: str) -> None:
        errors.append((when, F.struct(F.lit(column).alias("column"), F.lit(reason).alias("reason"))))

    def filled(column: str) -> Column:
        cell = F.col(column)
        text = (cell["kind"] == "text") & (F.coalesce(cell["text"], F.lit("")) != "")
        number = cell["kind"].isin("int", "float") & (F.coalesce(cell["num"], F.lit(0.0)) != 0)
        return F.coalesce(text | number, F.lit(False))

    def checked(column: str, ok: Column, value: Column, reason: str, present: Column | None = None, optional: bool = False) -> None:
        present = filled(column) if present is None else present
        ok = F.coalesce(ok, F.lit(False))
        lacking = ~present & ~exists if not optional else F.lit(False)
        fail(column, (present & ~ok) | lacking, reason)
        values[column] = F.when(present & ok, value)

    is_text = lambda c: F.col(c)["kind"] == "text"
    fail("default_code", F.col("__code").isNull(), "product code must be text")
    values["default_code"] = F.col("__code")
    checked("currency", is_text("currency") & F.col("currency.text").isin(*CURRENCIES), F.col("currency.text"), "currency must be ARS or USD")
    for column in ("cost", "price"):
        number = F.coalesce(F.col(column)["kind"].isin("int", "float"), F.lit(False))
        fail(column, ~number, "must be an amount of money")
        values[column] = F.when(number, F.col(column)["num"])
    checked("name", is_text("name"), F.col("name.text"), "description must be text")
    for column in ("purchase_tax", "sale_tax"):
        rate = (F.col(column)["kind"] == "float") & F.col(column)["num"].isin(*VAT_FRACTIONS)
        checked(column, rate, F.col(column)["num"], "must be a VAT fraction")
    for column in ("barcode", "meli"):
        stripped = py_strip(F.col(column)["text"])
        present = F.when(is_text(column), stripped != "").otherwise(filled(column))
        checked(column, is_text(column), stripped, "must be text", F.coalesce(present, F.lit(False)), optional=True)
    present = filled("parent")
    fail("parent", present & is_text("parent") & F.col("__parent_exists").isNull(), "parent product does not exist")
    fail("parent", present & ~is_text("parent"), "parent must be text")
    values["parent"] = F.when(present & F.col("__parent_exists"), F.col("__parent"))

    keep = [c for c in rows.columns if c not in SHEET_COLUMNS]
    invalid = any_of([bad for bad, _ in errors])
    return step.select(
        *keep,
        *[values[c].alias(c) for c in SHEET_COLUMNS],
        exists.alias("product_exists"),
        invalid.alias("invalid"),
        # Most rows have no error: theirs is a constant, and only the others are gone through reason by reason.
        F.when(invalid, F.array_compact(F.array(*[F.when(bad, why) for bad, why in errors]))).otherwise(F.array().cast(ERRORS)).alias("errors"),
    )


def sheet_errors(checked: DataFrame) -> DataFrame:
    """One row per error of a validated sheet row."""
    bad = checked.filter("invalid")
    return bad.select("upload_id", "vendor_ref", "sheet_no", "row_no", F.explode("errors").alias("e")).select(
        "upload_id", "vendor_ref", "sheet_no", "row_no", "e.column", "e.reason"
    )


def check_vendors(sheets: DataFrame, partner: DataFrame) -> DataFrame:
    """Each sheet with ``status``: ok, unknown or ambiguous supplier reference."""
    found = partner.filter(F.col("ref").isNotNull()).groupBy(F.col("ref").alias("vendor_ref")).agg(
        F.count(F.lit(1)).alias("n_partners"), F.min("id").alias("vendor_id")
    )
    each = sheets.select("upload_id", "sheet_no", "vendor_ref").distinct().join(found, "vendor_ref", "left")
    n = F.coalesce("n_partners", F.lit(0))
    status = F.when(n == 0, "unknown").when(n > 1, "ambiguous").otherwise("ok")
    return each.select("upload_id", "sheet_no", "vendor_ref", F.when(n == 1, F.col("vendor_id")).alias("vendor_id"), status.alias("status"))


def sheet_gate(checked: DataFrame, vendors: DataFrame | None = None) -> DataFrame:
    """Rows that load: sheets before the first failing one of their upload.

    A sheet fails through any row error or its vendor ``status``. Earlier
    sheets stay loaded; nothing of the failing one or later ones is. An
    ambiguous vendor aborts the upload, so none of its sheets load.
    """
    bad = checked.filter("invalid").select("upload_id", "sheet_no")
    if vendors is not None:
        failed = F.when(F.col("status") == "ambiguous", F.lit(-1)).otherwise(F.col("sheet_no"))
        bad = bad.unionByName(vendors.filter(F.col("status") != "ok").select("upload_id", failed.alias("sheet_no")))
    first = bad.groupBy("upload_id").agg(F.min("sheet_no").alias("__first_bad"))
    out = checked.join(first, "upload_id", "left")
    return out.filter(F.col("__first_bad").isNull() | (F.col("sheet_no") < F.col("__first_bad"))).drop("__first_bad", "invalid", "errors")


def load_sheets(sheets: DataFrame, product: DataFrame, partner: DataFrame, cells: Sequence[str] = SHEET_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """(validated rows, rows that load) of sheets.

    The rows are validated once and written; the failing sheets, the errors and
    the rows that load all come from that table. Every cell is validated; the
    values of those in ``cells`` are kept.
    """
    checked = written(validate_sheet(sheets, product).drop(*[c for c in SHEET_COLUMNS if c not in cells]))
    return checked, sheet_gate(checked, check_vendors(checked, partner))


def upsert_supplier_products(current: DataFrame, loaded: DataFrame, company_currency: str) -> DataFrame:
    """Catalogue after accepted sheet rows; only cells that were filled overwrite.

    The last row of a code wins per cell. The currency is stored only where it
    differs from the company's. ``loaded`` comes from ``sheet_gate``.
    """
    fields = ["currency", "name", "meli", "parent", "barcode", "purchase_tax", "sale_tax"]
    place = F.struct("sheet_no", "row_no")
    newest = loaded.groupBy("default_code").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in fields],
        *[F.max_by(c, place).alias(c) for c in ("cost", "price", "vendor_ref")],
    )
    joined = current.alias("old").join(newest.alias("new"), F.col("old.default_code") == F.col("new.default_code"), "full_outer")
    arrives, exists = F.col("new.default_code").isNotNull(), F.col("old.default_code").isNotNull()
    foreign = F.when(F.col("new.currency") != company_currency, F.col("new.currency"))
    values = {
        "name": F.col("new.name"),
        "force_currency": foreign,
        "meli": F.col("new.meli"),
        "parent_price_product": F.col("new.parent"),
        "supplier_tax_rate": F.col("new.purchase_tax") * F.lit(100.0),
        "tax_rate": F.col("new.sale_tax") * F.lit(100.0),
    }
    return joined.select(
        F.coalesce("new.default_code", "old.default_code").alias("default_code"),
        *[F.coalesce(v, F.col(f"old.{c}")).alias(c) for c, v in values.items()],
        F.col("new.barcode").alias("new_barcode"),
        F.col("new.cost").alias("new_cost"),
        F.col("new.price").alias("new_price"),
        F.col("new.vendor_ref").alias("vendor_ref"),
        F.when(~arrives, "kept").when(exists, "updated").otherwise("created").alias("action"),
    )


# -- discounts and priorities ------------------------------------------------


def discount_violations(line: DataFrame, restriction: DataFrame) -> DataFrame:
    """Lines whose discount the user may not give, with the allowed range.

    ``line``: id, user_id, pricelist_id, discount, pricelist_discount;
    ``restriction``: id, user_id, pricelist_id, min_discount, max_discount. The
    rule of the price list counts, else any rule of the user (lowest id).
    """
    rule = F.struct("min_discount", "max_discount")
    exact = restriction.groupBy("user_id", "pricelist_id").agg(F.min_by(rule, "id").alias("__exact"))
    any_ = restriction.groupBy("user_id").agg(F.min_by(rule, "id").alias("__any"))
    net = F.col("discount") - F.coalesce("pricelist_discount", F.lit(0.0))
    out = line.withColumn("net_discount", net).filter(F.col("net_discount") != 0)
    out = out.join(exact, ["user_id", "pricelist_id"], "left").join(any_, "user_id", "left")
    used = F.coalesce("__exact", "__any")
    base = F.coalesce("pricelist_discount", F.lit(0.0))
    outside = (F.col("net_discount") < used["min_discount"]) | (F.col("net_discount") > used["max_discount"])
    reason = F.when(used.isNull(), "no discount allowed").when(outside, "outside the allowed range")
    out = out.withColumns(
        {"reason": reason, "min_allowed": used["min_discount"] + base, "max_allowed": used["max_discount"] + base}
    )
    return out.filter(F.col("reason").isNotNull()).drop("__exact", "__any")


def invoice_discount_violations(line: DataFrame, sale_line: DataFrame, restriction: DataFrame, precision: int = 3) -> DataFrame:
    """``discount_violations`` of restricted customer invoice lines.

    ``line`` also has type, restricted and can_modify_prices. A line is exempt
    when a linked sale line (``sale_line``: invoice_line_id, discount) had at
    least its discount.
    """
    checked = line.filter(F.col("type").isin(*CUSTOMER_TYPES) & F.col("restricted") & ~F.col("can_modify_prices"))
    granted = sale_line.groupBy(F.col("invoice_line_id").alias("id")).agg(F.max("discount").alias("__granted"))
    checked = checked.join(granted, "id", "left")
    exempt = F.round("__granted", precision) >= F.round("discount", precision)
    return discount_violations(checked.filter(~F.coalesce(exempt, F.lit(False))).drop("__granted"), restriction)


def priority_violations(order: DataFrame, partner: DataFrame, pricelist: DataFrame, payment_term: DataFrame) -> DataFrame:
    """Orders whose price list or payment term ranks behind the partner's own.

    ``order``: id, partner_id, pricelist_id, payment_term_id, restricted;
    ``pricelist`` and ``payment_term``: id, sequence.
    """
    home = partner.select(
        F.col("id").alias("partner_id"),
        F.col("pricelist_id").alias("__home_pricelist"),
        F.col("payment_term_id").alias("__home_term"),
    )
    out = order.filter("restricted").join(home, "partner_id", "left")
    for table, used, own in ((pricelist, "pricelist_id", "__home_pricelist"), (payment_term, "payment_term_id", "__home_term")):
        for key, name in ((used, f"__{used}_seq"), (own, f"{own}_seq")):
            out = out.join(table.select(F.col("id").alias(key), F.col("sequence").alias(name)), key, "left")
    behind = lambda used, own: F.coalesce(F.col(f"{own}_seq") < F.col(f"__{used}_seq"), F.lit(False))
    out = out.withColumns(
        {
            "pricelist_violation": behind("pricelist_id", "__home_pricelist"),
            "payment_term_violation": behind("payment_term_id", "__home_term"),
        }
    )
    return out.filter(F.col("pricelist_violation") | F.col("payment_term_violation")).select(
        *order.columns, "pricelist_violation", "payment_term_violation"
    )


# -- availability ------------------------------------------------------------


def line_available(line: DataFrame, product: DataFrame, precision: int = 3) -> DataFrame:
    """Sale line with ``is_available``.

    ``line``: product_id, order_state, product_uom_qty, line_uom_factor,
    product_uom_factor, routed (what routing decides). Only stockable goods of
    unconfirmed orders are checked; quantities compare at unit precision.
    """
    what = product.select(F.col("id").alias("product_id"), F.col("type").alias("__type"), "virtual_available")
    out = line.join(what, "product_id", "left")
    wanted = F.col("product_uom_qty") / F.col("line_uom_factor") * F.col("product_uom_factor")
    enough = F.round("virtual_available", precision) >= F.round(wanted, precision)
    checked = (F.col("__type") == "product") & F.col("order_state").isin(*OPEN_ORDER_STATES)
    available = F.when(checked & ~F.coalesce(enough, F.lit(False)), F.col("routed")).otherwise(F.lit(True))
    return out.withColumn("is_available", available).drop("__type", "virtual_available")


def order_available(line: DataFrame) -> DataFrame:
    """An order is available when every line is; only unconfirmed orders are checked."""
    counts = F.col("is_available") | ~F.col("order_state").isin(*OPEN_ORDER_STATES)
    return line.groupBy("order_id").agg(F.bool_and(counts).alias("is_available"))
