"""Lookups by an index of the data: masks by grams, dates by blocks, lines and listings by position."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from costloom import sinks
from costloom.functions.ordered import numbered
from costloom.operators import catalogue, costing, repairs
from costloom.sources.tables import LINE_ORDER, dense_lines

FAR = dt.date(9999, 12, 31)


def like(code, mask):
    parts = re.findall(r"\\.|%|_|[^%_\\]+", mask)
    return re.fullmatch("".join({"%": ".*", "_": "."}.get(p, re.escape(p[1:] if p[0] == "\\" else p)) for p in parts), code, re.S) is not None


@pytest.mark.parametrize("free_masks", [0, 100])
def test_masks_of_every_kind(spark, free_masks):
    rng = random.Random(free_masks)
    codes = ["".join(rng.choices("AB-12_%", k=rng.randrange(0, 9))) for _ in range(120)] + [None]
    masks = ["%", "_%", "____", "%-12%", "A%", "%B", "A_%-1%2", "%-%", r"%\_%", r"\%%", "AB-12", "", "1", "%12_B%"]
    masks += ["".join(rng.choices(["%", "_", "A", "B", "-1", "2"], k=rng.randrange(1, 6))) for _ in range(25)]
    order = rng.sample(range(100), len(masks))
    product = spark.createDataFrame(list(enumerate(codes)), "id long, default_code string")
    brand = spark.createDataFrame([(i, m, o) for i, (m, o) in enumerate(zip(masks, order, strict=True))], "id long, mask string, checked_order int")
    got = {r.id: r.brand_id for r in catalogue.assign_brands(product, brand, free_masks=free_masks).collect()}
    for i, code in enumerate(codes):
        hits = [(o, n) for n, (m, o) in enumerate(zip(masks, order, strict=True)) if code is not None and like(code, m)]
        assert got[i] == (max(hits)[1] if hits else None), code


def test_masks_with_a_literal_need_no_nested_loop(spark):
    product = spark.range(1000).select("id", F.concat(F.lit("C"), F.col("id") % 25, F.lit("-"), "id").alias("default_code"))
    brand = spark.range(300).select("id", F.concat(F.lit("%-"), "id", F.lit("%")).alias("mask"), F.lit(1).alias("checked_order"))
    out = catalogue.assign_brands(product, brand)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert out.filter("brand_id is not null").count() == 1000


@pytest.mark.parametrize("free_masks", [3, 100])
def test_the_grams_of_codes_are_never_broadcast(spark, free_masks):
    # The planner takes the brands, which come from the same table, for larger than the codes' many grams.
    product = spark.range(5000).select("id", F.concat(F.lit("C"), F.col("id") % 25, F.lit("-"), "id").alias("default_code"))
    n = F.col("n")
    brand = product.select((F.col("id") % 25).alias("n")).distinct()
    brand = brand.select(n.alias("id"), F.when(n % 5 == 0, F.lit("%_")).otherwise(F.concat(F.lit("C"), n, F.lit("-%"))).alias("mask"), n.alias("checked_order"))
    out = catalogue.assign_brands(product, brand, free_masks=free_masks)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" not in plan and ("SortMergeJoin [__gram" in plan) == (free_masks < 20)
    wrong = out.filter(~F.col("brand_id").eqNullSafe(F.when(F.col("id") % 25 < 20, F.lit(20)).when(F.col("id") % 5 == 0, F.lit(20)).otherwise(F.col("id") % 25)))
    assert out.count() == 5000 and wrong.count() == 0


def test_blocks_cover_a_range_once(spark):
    rng = random.Random(1)
    days = [dt.date(1970, 1, 1) + dt.timedelta(rng.randrange(-20_000, 20_000)) for _ in range(60)]
    ranges = [(a, a + dt.timedelta(rng.choice([0, 1, 2, 30, 365, 5000]))) for a in days] + [(dt.date(2000, 2, 29), FAR), (dt.date(1, 1, 1), FAR)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(ranges)], "i int, a date, b date")
    got = {}
    for r in repairs.in_day_blocks(df, "a", "b").collect():
        got.setdefault(r.i, []).append((r.block << r.level, (r.block + 1) << r.level))
    for i, (a, b) in enumerate(ranges):
        spans = sorted(got[i])
        first = (a - dt.date(1970, 1, 1)).days + repairs.DAY_ZERO
        assert spans[0][0] == first and spans[-1][1] == first + (b - a).days + 1 and len(spans) <= 44
        assert all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_historic_price_of_long_and_overlapping_ranges(spark):
    rng = random.Random(2)
    day = lambda n: dt.date(2000, 1, 1) + dt.timedelta(n)
    info = []
    for i in range(150):
        start = rng.randrange(400)
        end = rng.choice([None, FAR, day(start), day(start + rng.randrange(300)), day(start - 3)])
        info.append((i, i % 3, float(i), None if i == 7 else day(start), end))
    lines = [(n, n % 4, day(rng.randrange(-5, 800))) for n in range(200)] + [(900, 0, None)]
    supplier = spark.createDataFrame(info, "id long, product_tmpl_id long, price double, date_start date, date_end date")
    got = {r.line_id: r.price for r in repairs.historic_price(spark.createDataFrame(lines, "line_id long, product_tmpl_id long, date date"), supplier).collect()}
    want = {}
    for n, product, at in lines:
        fit = [(s, -i, p) for i, t, p, s, e in info if t == product and at and s and s <= at and (e is None or at <= e)]
        if fit:
            want[n] = max(fit)[2]
    assert got == want


def test_days_whose_last_price_holds_look_up_no_block(spark, monkeypatch):
    day = lambda n: dt.date(2000, 1, 1) + dt.timedelta(n)
    # The second price of each product starts inside the first one, which holds again for ten days after it.
    info = [(p * 2 + k, p, float(k), day(40 * k), day((100, 90)[k])) for p in range(20) for k in range(2)]
    supplier = spark.createDataFrame(info, "id long, product_tmpl_id long, price double, date_start date, date_end date")
    line = spark.range(20 * 100).select(F.col("id").alias("line_id"), (F.col("id") % 20).alias("product_tmpl_id"), F.date_add(F.lit(day(0)), (F.col("id") / 20).cast("int")).alias("date"))
    asked, whole = [], repairs.in_day_blocks
    monkeypatch.setattr(repairs, "in_day_blocks", lambda df, first, last: asked.append(df.select(F.col(first).alias("a"), F.col(last).alias("b"))) or whole(df, first, last))
    got = {r.line_id: r.price for r in repairs.historic_price(line, supplier).collect()}
    assert got == {n: float(40 <= n // 20 <= 90) for n in range(2000)}
    assert {(r.a, r.b) for r in asked[0].collect()} == {(day(40), day(100))}


@pytest.mark.parametrize("crowded", [0, 70, 10**6])
def test_historic_price_of_odd_rows_and_crowded_products(spark, monkeypatch, crowded):
    monkeypatch.setattr(repairs, "CROWDED", crowded)
    rng = random.Random(crowded)
    day = lambda n: dt.date(2000, 1, 1) + dt.timedelta(n)
    info = []
    for i in range(400):
        start = rng.randrange(-20, 300)
        end = rng.choice([None, FAR, *(day(start + rng.choice([-3, 0, 1, rng.randrange(20), rng.randrange(200)])) for _ in range(10))])
        product = rng.choice([None, 0, 0, 0, 1, 2, 3, 4, 5])
        info += [(i, product, rng.choice([None, float(i)]), rng.choice([None] + [day(start)] * 20), end)] * rng.choice([1, 1, 2])
    lines = [(rng.randrange(300), rng.choice([None, 0, 0, 1, 2, 3, 4, 5, 6]), rng.choice([None] + [day(rng.randrange(-30, 500)) for _ in range(15)])) for _ in range(400)]
    supplier = spark.createDataFrame(info, "id long, product_tmpl_id long, price double, date_start date, date_end date")
    line = spark.createDataFrame(lines, "line_id long, product_tmpl_id int, date date")
    want = []
    for n, product, at in lines:
        fit = [(s, -i, p) for i, t, p, s, e in info if product is not None and t == product and at and s and s <= at and (e is None or at <= e)]
        if fit:
            want.append((n, max(fit, key=lambda f: f[:2])[2]))
    order = lambda rows: sorted(rows, key=repr)
    for keyed in (None, line.select("product_tmpl_id")):
        assert order((r.line_id, r.price) for r in repairs.historic_price(line, supplier, keyed).collect()) == order(want)


def shuffles(df):
    """Records that the collected ``df`` has shuffled and their columns, by exchange."""
    def walk(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(plan.plan())
        if kind == "ReusedExchangeExec":
            return []
        columns = {plan.output().apply(i).name() for i in range(plan.output().size())}
        own = [(plan.metrics().apply("shuffleRecordsWritten").value(), columns)] if kind == "ShuffleExchangeExec" else []
        return own + [n for i in range(plan.children().size()) for n in walk(plan.children().apply(i))]

    return walk(df._jdf.queryExecution().executedPlan())


def test_historic_price_moves_each_line_and_price_row_once(spark):
    # Every second price row is hidden by a shorter one that starts inside it, so half the lines look up blocks.
    n = F.col("id")
    start = F.date_add(F.lit(dt.date(2000, 1, 1)), (n / 50).cast("int") * 30)
    supplier = spark.range(2000).select("id", (n % 50).alias("product_tmpl_id"), n.cast("double").alias("price"), start.alias("date_start"), F.date_add(start, F.when(n / 50 % 2 < 1, 80).otherwise(10)).alias("date_end"))
    line = spark.range(3000).select(n.alias("line_id"), (n % 50).alias("product_tmpl_id"), F.date_add(F.lit(dt.date(2000, 1, 1)), (n / 50).cast("int") * 20).alias("date"))
    out = repairs.historic_price(line, supplier)
    rows = {r.line_id: r.price for r in out.collect()}
    want = {}
    for i in range(3000):
        fit = [k for k in range(40) if k * 30 <= i // 50 * 20 <= k * 30 + (10 if k % 2 else 80)]
        if fit:
            want[i] = float(max(fit) * 50 + i % 50)
    assert rows == want
    assert sum(n for n, _ in shuffles(out)) == 5000, shuffles(out)


def test_margin_at_past_prices_moves_three_columns_by_line(spark):
    modes = ["consignment", "standard", None, "undefined"]
    what = [(p, modes[p % 4], 50.0, 0.0 if p == 5 else 40.0, 1.0 if p % 3 else -1.0, "USD" if p % 2 else "ARS") for p in range(12)]
    product = spark.createDataFrame(what, "id long, business_mode string, standard_price double, today_cost double, virtual_available double, currency string")
    rates = spark.createDataFrame([("USD", dt.date(2000, 1, 1), 0.5), ("EUR", dt.date(2000, 1, 1), 0.25)], "currency string, date date, rate double")
    types = ["out_invoice", "out_refund", "in_invoice", None]
    sold = [(i // 2 if i < 20 else i, i % 13 if i % 31 else None, types[i % 7 % 4], "EUR" if i % 5 else "ARS", 100.0 if i % 11 else 0.0, 10.0) for i in range(200)]
    line = spark.createDataFrame(sold, "id long, product_id long, type string, currency string, price_unit double, discount double")
    paid = [(i, None if i % 17 == 0 else float(i % 6)) for i in range(200) if i % 4 < 2]
    past = spark.createDataFrame([*paid, *paid[:3]], "line_id long, price double")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = costing.line_margin(line, product, rates, historic=past).select("id", "product_margin")
        got = sorted((r.id, repr(r.product_margin)) for r in out.collect())
        assert {"id", "__asked", "__rate"} in [c for _, c in shuffles(out)], shuffles(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want, of = [], {p: rest for p, *rest in what}
    for i, p, kind, currency, price, discount in sold:
        mode, standard, today, stock, at = of.get(p, (None, None, None, None, None))
        net = price * (1.0 - discount / 100.0) * 1.0 / (0.25 if currency == "EUR" else 1.0)
        for agreed in [x for n, x in [*paid, *paid[:3]] if n == i] or [None]:
            cost = today if stock is None or stock < 0 else standard
            if mode == "consignment":
                cost = None if agreed is None else agreed / (0.5 if at == "USD" else 1.0)
            margin = net / cost - 1.0 if net and cost else 1e10
            want.append((i, repr(None if p is None or kind not in types[:2] else 1e10 if mode == "undefined" else margin)))
    assert got == sorted(want)


def test_every_row_has_its_place(spark, parts):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 11).alias("day"))
    rows = numbered(df, [F.col("day").desc(), F.col("id").asc()], "n").collect()
    want = sorted(((-r.day, r.id) for r in rows))
    assert [(-r.day, r.id) for r in sorted(rows, key=lambda r: r.n)] == want and sorted(r.n for r in rows) == list(range(1, 3001))
    empty = numbered(df.filter("false"), [F.col("id")], "n")
    assert empty.count() == 0 and empty.columns == ["id", "day", "n"]


def test_listing_places_rows_without_a_date_last(spark):
    df = spark.createDataFrame([(1, None), (2, "2020-01-02"), (3, "2020-01-05")], "id long, day string")
    assert {r.id: r.position for r in costing.listed(df, "day", "id", newest_first=True).collect()} == {3: 1, 2: 2, 1: 3}


def test_line_keys_beyond_64_bits_of_packed_columns(spark, parts):
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_tax double"
    rng = random.Random(4)
    # Residues of the packed key meet: parts and suppliers differ by multiples of what it keeps.
    rows = [(10**12 + rng.randrange(3), 1, 5 + 1000 * rng.randrange(4), 7 + 100 * rng.randrange(3), 1.0, 10.5, 0.1 * rng.randrange(2)) for _ in range(400)]
    df = spark.createDataFrame(rows, schema)
    got = dense_lines(df).collect()
    assert sorted(r.line_id for r in got) == list(range(1, 401))
    assert [tuple(r[c] for c in (*LINE_ORDER, "l_tax")) for r in sorted(got, key=lambda r: r.line_id)] == sorted(rows)


def test_an_upload_recorded_again_replaces_itself(spark, tmp_path):
    actions = spark.createDataFrame([("U1", "created"), ("U1", "updated"), ("U2", "updated")], "upload_id string, action string")
    errors = spark.createDataFrame([("U2", "V", 1, 3, "cost", "must be an amount of money")], "upload_id string, vendor_ref string, sheet_no int, row_no int, column string, reason string")
    vendors = spark.createDataFrame([("U1", 2, "B"), ("U1", 1, "A"), ("U2", 1, "V")], "upload_id string, sheet_no int, vendor_ref string")
    path = str(tmp_path / "imports")
    for _ in range(2):
        log = sinks.record_import(actions, errors, vendors, path)
    read = {r.upload_id: r for r in spark.read.parquet(f"{path}/log").collect()}
    assert len(read) == log.count() == 2
    assert (read["U1"].vendors, read["U1"].created_products, read["U1"].updated_products, read["U1"].state) == ("A, B", 1, 1, "done")
    assert (read["U2"].errors, read["U2"].state) == (1, "error")
    assert [r.reason for r in spark.read.parquet(f"{path}/errors").collect()] == ["must be an amount of money"]
