"""Margins, nearest invoices, KPIs and audits on literal cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from costloom.operators import audits, costing, currency, kpis, sales
from costloom.schemas import SHEET

D = dt.date


def test_margin_cases(spark):
    rates = spark.createDataFrame([("USD", D(2020, 1, 1), 0.05)], "currency string, date date, rate double")
    product = spark.createDataFrame(
        [
            (1, "standard", 5000.0, 6000.0, 1.0, "ARS"),
            (2, "consignment", 5000.0, 6000.0, 1.0, "ARS"),
            (3, "consignment", 5000.0, 300.0, 1.0, "USD"),
            (4, "standard", 5000.0, 300.0, -1.0, "USD"),
            (5, "undefined", 5000.0, 300.0, 1.0, "ARS"),
            (6, "standard", 0.0, 0.0, 1.0, "ARS"),
        ],
        "id long, business_mode string, standard_price double, today_cost double, virtual_available double, currency string",
    )
    line = spark.createDataFrame([(n, n, "out_invoice", "ARS", 8400.0, 0.0) for n in range(1, 7)] + [(7, 1, "in_invoice", "ARS", 1.0, 0.0), (8, 1, "out_refund", "USD", 840.0, 50.0)], "id long, product_id long, type string, currency string, price_unit double, discount double")
    got = {r.id: r.product_margin for r in costing.line_margin(line, product, rates).collect()}
    want = {1: 8400 / 5000 - 1, 2: 8400 / 6000 - 1, 3: 8400 / 6000 - 1, 4: 8400 / 300 - 1, 5: 1e10, 6: 1e10, 7: None, 8: 8400 / 5000 - 1}
    assert {k: v and pytest.approx(v) for k, v in want.items()} == got
    fixed = {r.id: r.product_margin for r in costing.line_margin(line, product, rates, convert_negative_stock=True).collect()}
    assert fixed[4] == pytest.approx(8400 / 6000 - 1)


def test_measures_and_margin_of_minus_one(spark):
    line = spark.createDataFrame([(100.0, 0.25, 0.21, 10.0, 1), (100.0, -1.0, 0.21, 0.0, 1)], "price_subtotal_signed double, product_margin double, product_iva double, discount double, sign int")
    ok, lost = sales.sales_measures(line).collect()
    assert (ok.cost_total, ok.margin_total, ok.discount_total) == (80.0, 20.0, -10.0)
    assert ok.cost_total_taxed == pytest.approx(96.8) and ok.margin_percent == 25.0
    assert lost.cost_total is None and lost.margin_total is None


def test_nearest_invoice_line(spark):
    lines = spark.createDataFrame([(n, 1, D(2018, 9, d), ok) for n, d, ok in ((1, 1, True), (2, 10, True), (3, 20, True), (4, 12, False))], "id long, product_id long, date_invoice date, discount_processed boolean")
    layers = spark.createDataFrame([(1, 1, dt.datetime(2018, 9, 12), "internal"), (2, 1, dt.datetime(2018, 9, 1), "customer")], "id long, product_id long, in_date timestamp, location_usage string")
    product = spark.createDataFrame([(1,)], "id long")
    assert costing.closest_invoice_line(product, lines, layers, "2018-09-30").collect()[0].id == 2
    assert costing.closest_invoice_line(product, lines, layers.filter("id = 2"), "2018-09-30").collect()[0].id == 3


def test_vendor_and_mode_disagree_on_undated_rows(spark):
    info = spark.createDataFrame([(1, 1, 10, None), (2, 1, 20, D(2020, 1, 1)), (3, 2, 30, None), (4, 2, 40, None)], "id long, product_tmpl_id long, vendor_id long, date_start date")
    vendor = spark.createDataFrame([(10, "a"), (20, "b"), (30, "c"), (40, "d")], "id long, business_mode string")
    product = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "id long, tmpl_id long")
    assert {r.id: r.vendor_id for r in costing.current_vendor(product, info).collect()} == {1: 10, 2: 30, 3: None}
    assert {r.id: r.business_mode for r in costing.business_mode(product, info, vendor).collect()} == {1: "b", 2: "c", 3: "undefined"}
    # The KPI rule skips a product with several rows and no date.
    assert {r.product_tmpl_id: r.vendor_id for r in kpis.kpi_supplier(info).collect()} == {1: 20}


def test_dated_rates(spark):
    rates = spark.createDataFrame([("USD", D(2020, 1, 10), 1.0), ("USD", D(2020, 1, 20), 2.0), ("USD", D(2020, 5, 1), 3.0), ("EUR", D(2020, 3, 1), 9.0)], "currency string, date date, rate double")
    days = [("USD", D(2020, 1, 9)), ("USD", D(2020, 1, 10)), ("USD", D(2020, 1, 25)), ("USD", D(2020, 4, 30)), ("USD", D(2021, 1, 1)), ("EUR", D(2022, 1, 1)), ("ARS", D(2020, 3, 1))]
    df = spark.createDataFrame(days, "currency string, d date")
    got = {(r.currency, r.d): r.rate for r in currency.fx_asof(df, rates, "currency", "d").collect()}
    assert list(map(got.get, days)) == [None, 1.0, 2.0, 2.0, 3.0, 9.0, None]


def test_members_end_with_the_tagged_vendors(spark):
    kpi = spark.createDataFrame([(1, 5.0, 6.0, 7.0, None), (3, 0.0, 0.0, 0.0, None)], "vendor_id long, total_payable double, stock_valuation double, count double, updated timestamp")
    tagged = spark.createDataFrame([(1,), (2,)], "vendor_id long")
    got = {r.vendor_id: r.total_payable for r in kpis.sync_members(kpi, tagged).collect()}
    assert got == {1: 5.0, 2: 0.0}


def test_month_end_only(spark):
    empty = {
        "layers": spark.createDataFrame([], "location_parent string, qty double, cost double"),
        "product": spark.createDataFrame([(2.0, 3.0, 4.0, "ARS")], "virtual_available double, today_cost double, list_price double, currency string"),
        "accounts": spark.createDataFrame([("payable", D(2020, 1, 1), 1.0, 5.0)], "account_type string, date date, debit double, credit double"),
        "rates": spark.createDataFrame([], "currency string, date date, rate double"),
    }
    row = kpis.month_end_valuation(**empty, date="2020-01-31").collect()[0]
    assert (row.stock_value_purchase, row.stock_value_sell, row.payable, row.receivable, row.stock_value_purchase_historic) == (6.0, 8.0, -4.0, 0.0, 0.0)
    assert kpis.month_end_valuation(**empty, date="2020-01-30").count() == 0


def test_periods_are_half_open(spark):
    fact = spark.createDataFrame([(D(2019, 12, 31),), (D(2020, 2, 1),), (D(2020, 2, 29),), (D(2020, 3, 1),)], "date_invoice date")
    days = lambda p: [str(r.date_invoice) for r in sales.period_filter(fact, p, "2020-03-15").collect()]
    assert days("last_month") == ["2020-02-01", "2020-02-29"] and days("this_month") == ["2020-03-01"]
    assert days("last_year") == ["2019-12-31"] and len(days("this_year")) == 3


def cell(value):
    if value is None:
        return (None, None, None)
    if isinstance(value, str):
        return (value, None, "text")
    return (None, float(value), "float" if isinstance(value, float) else "int")


def sheet(spark, *rows):
    data = [(vendor, no, i, *map(cell, values)) for i, (vendor, no, values) in enumerate(rows)]
    return spark.createDataFrame(data, SHEET).withColumn("upload_id", F.lit("u"))


FULL = ["NEW-1 ", "ARS", 9490.76, 10000.0, "drill", 0.105, 0.21, " 779 ", None, "OLD"]


def test_sheet_rules(spark):
    product = spark.createDataFrame([("OLD",)], "default_code string")
    change = lambda **kw: [kw.get(c, v) for c, v in zip([f.name for f in SHEET.fields[3:]], FULL)]
    rows = [
        FULL,
        change(default_code="OLD", name=None, purchase_tax=None, sale_tax=None, barcode=None, parent=None),
        change(name=None),
        change(name=""),
        change(currency="EUR"),
        change(cost="x"),
        change(sale_tax=1),
        change(barcode=5),
        change(parent="NONE"),
        change(default_code=7),
        change(default_code=None),
    ]
    checked = audits.validate_sheet(sheet(spark, *[("v", 1, r) for r in rows]), product)
    got = {r.row_no: [e.column for e in r.errors] for r in checked.collect()}
    assert got == {0: [], 1: [], 2: ["name"], 3: ["name"], 4: ["currency"], 5: ["cost"], 6: ["sale_tax"], 7: ["barcode"], 8: ["parent"], 9: ["default_code"]}
    first = checked.filter("row_no = 0").collect()[0]
    assert (first.default_code, first.barcode, first.parent, first.cost) == ("NEW-1", "779", "OLD", 9490.76)


def test_failing_sheet_stops_later_ones(spark):
    product = spark.createDataFrame([("OLD",)], "default_code string")
    bad = [*FULL[:1], "EUR", *FULL[2:]]
    rows = sheet(spark, ("a", 1, FULL), ("b", 2, bad), ("b", 2, FULL), ("c", 3, FULL))
    checked = audits.validate_sheet(rows, product)
    assert [r.vendor_ref for r in audits.sheet_gate(checked).collect()] == ["a"]
    partner = spark.createDataFrame([(1, "b"), (2, "c")], "id long, ref string")
    vendors = audits.check_vendors(rows, partner)
    assert {r.vendor_ref: r.status for r in vendors.collect()} == {"a": "unknown", "b": "ok", "c": "ok"}
    assert audits.sheet_gate(checked, vendors).count() == 0


def test_validation_keeps_the_cells_that_are_asked_for(spark):
    product = spark.createDataFrame([("OLD",)], "default_code string")
    partner = spark.createDataFrame([(1, "v")], "id long, ref string")
    rows = sheet(spark, ("v", 1, FULL), ("v", 2, [*FULL[:2], "x", *FULL[3:5], 0.3, *FULL[6:]]))
    whole, all_loaded = audits.load_sheets(rows, product, partner)
    few, loaded = audits.load_sheets(rows, product, partner, ["default_code"])
    assert {"cost", "name", "sale_tax"}.isdisjoint(few.columns) and {"invalid", "errors", "default_code"} <= set(few.columns)
    errors = lambda df: sorted(map(str, audits.sheet_errors(df).collect()))
    assert errors(few) == errors(whole) and len(errors(few)) == 2
    assert [r.errors for r in whole.filter("not invalid").collect()] == [[]]
    assert loaded.select(*loaded.columns).collect() == all_loaded.select(*loaded.columns).collect() and loaded.count() == 1


def test_discounts(spark):
    rule = spark.createDataFrame([(1, 1, 7, 0.0, 10.0), (2, 1, None, 0.0, 5.0)], "id long, user_id long, pricelist_id long, min_discount double, max_discount double")
    lines = spark.createDataFrame([(1, 1, 7, 8.0, None), (2, 1, 7, 12.0, None), (3, 1, 9, 12.0, None), (4, 2, 7, 1.0, None), (5, 2, 7, 3.0, 3.0)], "id long, user_id long, pricelist_id long, discount double, pricelist_discount double")
    got = {r.id: r.reason for r in audits.discount_violations(lines, rule).collect()}
    assert set(got) == {2, 3, 4} and got[4] == "no discount allowed"


def test_availability(spark):
    product = spark.createDataFrame([(1, "product", 5.0), (2, "service", 0.0)], "id long, type string, virtual_available double")
    line = spark.createDataFrame(
        [(1, 1, "draft", 5.0, False), (1, 1, "draft", 5.0004, False), (2, 1, "draft", 6.0, False), (2, 2, "draft", 6.0, False), (3, 1, "done", 9.0, False), (4, 1, "sent", 9.0, True)],
        "order_id long, product_id long, order_state string, product_uom_qty double, routed boolean",
    ).withColumns({"line_uom_factor": F.lit(1.0), "product_uom_factor": F.lit(1.0)})
    got = {r.order_id: r.is_available for r in audits.order_available(audits.line_available(line, product)).collect()}
    assert got == {1: True, 2: False, 3: True, 4: True}
