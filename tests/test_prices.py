"""Price history and price state, against one-event-at-a-time restatements."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from costloom.operators.prices import apply_prices, price_drops, scd2_prices
from costloom.operators.transitions import Chunk

DAY = dt.date(2020, 1, 1)
PRODUCT = "id long, tmpl_id long, item_code string, currency string, today_cost double, state string, standard_price double, standard_product_price double, list_price double, margin double"
EVENT = "tmpl_id long, date date, seq long, cost double, price double, is_primary boolean, manual boolean"
ITEM = "code string, margin double"
LAYER = "id long, product_id long, location_usage string, in_date timestamp"
RATE = "currency string, date date, rate double"


def rates(spark):
    return spark.createDataFrame([("USD", DAY, 0.05)], RATE)


def run(spark, products, events, layers=()):
    items = spark.createDataFrame([("A", 0.5), ("B", 0.6)], ITEM)
    out = apply_prices(
        spark.createDataFrame(products, PRODUCT),
        spark.createDataFrame(events, EVENT),
        items,
        spark.createDataFrame(list(layers), LAYER),
        rates(spark),
    )
    return {r.tmpl_id: r for r in out.collect()}


def product(n, cost=0.0, item="A", currency="ARS"):
    return (n, n, item, currency, cost, "sellable", 1.0, 1.0, 2.0, 0.0)


def event(n, seq, cost, primary=True, manual=False, price=9.0):
    return (n, DAY + dt.timedelta(seq // 4), seq, cost, price, primary, manual)


def test_first_load_and_list_price(spark):
    got = run(spark, [product(1), product(2, item="B"), product(3, currency="USD")], [event(1, 1, 2.2372), event(2, 1, 2.0), event(3, 1, 4.0)])
    assert got[1].today_cost == 2.2372 and got[1].list_price == pytest.approx(2.2372 * 1.5)
    assert got[1].standard_price == 2.2372 and got[1].state == "sellable"
    assert got[2].list_price == pytest.approx(3.2)
    assert got[3].standard_price == pytest.approx(80.0) and got[3].standard_product_price == 4.0


def test_drop_with_and_without_stock_then_rise(spark):
    stock = [(1, 2, "internal", dt.datetime(2020, 1, 1))]
    got = run(spark, [product(1, 7.7832), product(2, 7.7832), product(3, 7.0)], [event(1, 1, 7.0), event(2, 1, 7.0), event(3, 1, 7.7832)], stock)
    assert (got[1].today_cost, got[1].state) == (7.0, "offer")
    assert (got[2].today_cost, got[2].state) == (7.7832, "offer")
    assert (got[3].today_cost, got[3].state) == (7.7832, "sellable")


def test_zero_cost_is_obsolete_and_equal_cost_is_offer(spark):
    got = run(spark, [product(1, 5.0), product(2, 5.0)], [event(1, 1, 0.0), event(2, 1, 5.0)])
    assert (got[1].today_cost, got[1].state) == (5.0, "obsolete")
    assert got[2].state == "offer"


def fold(p, events, stock):
    cost, state, std, lst, margin = p[4], p[5], p[6], p[8], p[9]
    for _, _, _, c, price, primary, manual in events:
        if c == 0 and primary:
            state = "obsolete"
            continue
        lower = cost != 0 and cost + 0.05 > c and not manual
        if stock and lower:
            state = "offer"
            continue
        state = "offer" if lower else "sellable"
        std = std if stock else c
        cost = c
        lst, margin = (c * 1.5, 50.0) if primary and not manual else (price, 100 * (price / c - 1) if c else 1e10)
    return cost, state, std, lst, margin


def test_pruned_fold_equals_full_fold(spark, parts):
    rng = random.Random(3)
    products, events, layers, want = [], [], [], {}
    for n in range(60):
        start = rng.choice([0.0, 3.0, 5.0])
        count = 60 if n < 3 else rng.randrange(1, 12)
        costs = [0.0, 0.0, 3.0, 3.02, 3.04, 3.06, 3.1, 4.0, 5.0, 5.05, 6.0]
        mine = [event(n, s, rng.choice(costs), rng.random() < 0.6, rng.random() < 0.15) for s in range(count)]
        stock = n % 2 == 0
        products.append(product(n, start))
        events += mine
        if stock:
            layers.append((n, n, "internal", dt.datetime(2020, 1, 1)))
        want[n] = fold(products[-1], mine, stock)
    got = run(spark, products, events, layers)
    for n, expected in want.items():
        r = got[n]
        assert (r.today_cost, r.state, r.standard_price, r.list_price, r.margin) == pytest.approx(expected), n


def test_a_million_rising_costs_of_one_product(spark):
    n, step = 1_000_000, 0.0001
    events = spark.range(n).select(
        F.lit(1).cast("long").alias("tmpl_id"),
        F.lit(DAY).alias("date"),
        F.col("id").alias("seq"),
        (F.lit(1.0) + F.col("id") * step).alias("cost"),
        F.lit(9.0).alias("price"),
        F.lit(True).alias("is_primary"),
        F.lit(False).alias("manual"),
    )
    layers = spark.createDataFrame([(1, 1, "internal", dt.datetime(2020, 1, 1))], LAYER)
    out = apply_prices(spark.createDataFrame([product(1, 0.97)], PRODUCT), events, spark.createDataFrame([("A", 0.5)], ITEM), layers, rates(spark))
    cost, taken = 0.97, None
    for i in range(n):
        c = 1.0 + i * step
        if not cost + 0.05 > c:
            cost, taken = c, i
    row = out.collect()[0]
    assert (row.today_cost, row.list_price, row.state) == (cost, cost * 1.5, "sellable" if taken == n - 1 else "offer")
    plan = out._jdf.queryExecution().toString()
    assert "collect_list" not in plan


def test_records_tell_the_outcome_of_every_entry():
    rng = random.Random(8)
    for _ in range(300):
        above = rng.choice([1.0, 2.5])
        costs = sorted({round(above + rng.random() * rng.choice([0.02, 0.2, 2.0]), 4) for _ in range(rng.randrange(1, 60))} - {above})
        chunk = Chunk(0.5, above, 0.05)
        for n, c in enumerate(costs):
            chunk.add((c, 0.0, True, n == len(costs) - 1))
        bounds, ways, taken = chunk.record()
        assert len(bounds) <= sum(not c >= above + 0.05 for c in costs) + 1
        for _ in range(20):
            x = cost = above - rng.random() * 0.049
            for c in costs:
                if not cost + 0.05 > c:
                    cost = c
            at = next((i for i, b in enumerate(bounds) if not x + 0.05 > b), None)
            assert cost == (x if at is None else taken[ways[at]]["cost"])


def history(rows):
    """One feed row at a time, as (price, start, end) lists."""
    out = []
    for date, price in rows:
        if out and out[-1][0] == price:
            continue
        if out:
            out[-1][2] = max(date - dt.timedelta(1), out[-1][1])
        out.append([price, date, None])
    return sorted(map(tuple, out), key=str)


def test_history_matches_loop_and_does_not_overlap(spark, parts):
    rng = random.Random(5)
    feed, want = [], {}
    for n in range(30):
        days = sorted(rng.randrange(12) for _ in range(40 if n == 0 else 8))
        rows = [(DAY + dt.timedelta(d), float(rng.choice([1, 2, 3]))) for d in days]
        feed += [(1, n, price, date, seq, False) for seq, (date, price) in enumerate(rows)]
        want[n] = history(rows)
    f = spark.createDataFrame(feed, "vendor_id long, product_tmpl_id long, price double, date date, seq long, is_primary boolean")
    empty = spark.createDataFrame([], "vendor_id long, product_tmpl_id long, price double, date_start date, date_end date")
    got = {}
    for r in scd2_prices(empty, f).collect():
        got.setdefault(r.product_tmpl_id, []).append((r.price, r.date_start, r.date_end))
    assert {k: sorted(v, key=str) for k, v in got.items()} == want


def test_price_drop_restores_previous(spark):
    info = spark.createDataFrame([(1, 1, 16, 8.0, DAY), (2, 1, 16, 6.0, DAY + dt.timedelta(1))], "id long, product_tmpl_id long, vendor_id long, price double, date_start date")
    p = spark.createDataFrame([(1, "A", 3.0, 6.0, "sellable", 0.0, 9.0)], "tmpl_id long, item_code string, virtual_available double, today_cost double, state string, margin double, list_price double")
    row = price_drops(info, p, spark.createDataFrame([("A", 0.5)], ITEM), spark.createDataFrame([(16,)], "vendor_id long")).collect()[0]
    assert (row.today_cost, row.state, row.list_price) == (8.0, "offer", 12.0)
