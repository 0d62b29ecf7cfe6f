"""FIFO costing against a queue worked off by hand, cold and chunked."""

import datetime as dt
import random
from fractions import Fraction

import pytest

from costloom.operators.fifo import allocate_procurements, fifo_balance, fifo_cost

DAY = dt.date(2020, 1, 1)


def queue_cost(events):
    """Sequential restatement: events are (kind, id, qty, price) in order."""
    queue, last, out = [], None, {}
    for kind, id_, qty, price in events:
        if kind == 0:
            queue.append([Fraction(qty), Fraction(price), id_])
            last = Fraction(price)
            continue
        need, cost = Fraction(qty), Fraction(0)
        while need > 0 and queue:
            take = min(need, queue[0][0])
            cost += take * queue[0][1]
            queue[0][0] -= take
            need -= take
            if queue[0][0] == 0:
                queue.pop(0)
        cost += need * (last or 0)
        out[id_] = float(cost / qty) if qty else 0.0
    return out, {q[2]: float(q[0]) for q in queue}


def random_events(rng, product, n):
    rows = [(rng.randrange(2), product * 1000 + i, rng.randrange(1, 9), rng.randrange(1, 20), rng.randrange(0, 10)) for i in range(n)]
    return sorted(rows, key=lambda r: (r[4], r[0], r[1]))


def test_fifo_matches_queue(spark, parts):
    rng = random.Random(7)
    layers, issues, want, left = [], [], {}, {}
    for product in range(12):
        events = random_events(rng, product, 60 if product == 0 else 12)
        cost, rest = queue_cost([e[:4] for e in events])
        want.update(cost)
        for kind, id_, qty, price, day in events:
            date = DAY + dt.timedelta(days=day)
            if kind == 0:
                layers.append((product, id_, date, float(qty), float(price)))
                left[id_] = rest.get(id_, 0.0)
            else:
                issues.append((product, id_, date, float(qty)))
    l = spark.createDataFrame(layers, "product_id long, id long, date date, qty double, price double")
    i = spark.createDataFrame(issues, "product_id long, id long, date date, qty double")
    got = {r.id: r.unit_cost for r in fifo_cost(l, i).collect()}
    assert got == pytest.approx(want)
    balance = {r.id: r.remaining for r in fifo_balance(l, i).collect()}
    assert balance == pytest.approx(left)


def test_sold_one_by_one_costs_5000_6000_6000(spark):
    l = spark.createDataFrame([(1, 1, DAY, 1.0, 5000.0), (1, 2, DAY, 2.0, 6000.0)], "product_id long, id long, date date, qty double, price double")
    i = spark.createDataFrame([(1, n, DAY + dt.timedelta(n), 1.0) for n in (1, 2, 3)], "product_id long, id long, date date, qty double")
    assert [r.unit_cost for r in fifo_cost(l, i).orderBy("id").collect()] == [5000.0, 6000.0, 6000.0]


def test_procurements_take_in_order_and_leave_a_rest(spark, parts):
    po = spark.createDataFrame([(1, 10.0), (2, 3.0), (3, 4.0)], "id long, quantity double")
    pr = spark.createDataFrame([(11, 1, 1, 4.0), (12, 1, 2, 0.0), (13, 1, 3, 5.0), (21, 2, 1, 2.0), (22, 2, 2, 9.0), (23, 2, 3, 1.0)], "id long, po_line_id long, seq long, quantity double")
    got = {(r.po_line_id, r.procurement_id): r.quantity for r in allocate_procurements(po, pr).collect()}
    assert got == {(1, 11): 4.0, (1, 13): 5.0, (1, None): 1.0, (2, 21): 2.0, (2, 22): 1.0, (3, None): 4.0}


def test_one_product_without_receipts(spark, parts):
    schema = "product_id long, id long, date date, qty double"
    l = spark.createDataFrame([(2, 1, DAY, 4.0, 10.0)], f"{schema}, price double")
    i = spark.createDataFrame([(1, n, DAY, 1.0) for n in range(400)] + [(2, 1000, DAY, 6.0)], schema)
    got = {r.id: (r.covered, r.unit_cost) for r in fifo_cost(l, i).collect()}
    assert len(got) == 401 and {got[n] for n in range(400)} == {(0.0, 0.0)} and got[1000] == (4.0, 10.0)
