"""First-in first-out costing as positions on a cumulative-quantity axis.

Receipts fill the axis one after the other; an issue takes the stretch
[a, b) that follows the issues before it. With the cumulative cost P(x) of the
first x received units, an issue costs P(b) - P(a). P is piecewise linear with
one knot per layer, so each end of an issue needs only the last knot at or
before it: an ordered scan instead of a join of every layer with every issue.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import CHUNK, Chunks, Running, in_chunks, ordered_scan

QTY = "decimal(18,4)"
MONEY = "decimal(36,8)"
UNITS = 10_000  # quantities on the axis are whole numbers of this part of a unit
KNOT = f"struct<at: bigint, cost: {MONEY}, price: {QTY}>"
EVENT_ORDER = ["day", "kind", "id"]


def _units(qty: Column) -> Column:
    return (qty.cast(QTY) * UNITS).cast("bigint")


def _quantity(units: Column) -> Column:
    """Units as a decimal quantity."""
    return (units.cast("decimal(19,0)") * F.lit(Decimal("0.0001"))).cast("decimal(28,4)")


def _events(layers: DataFrame, issues: DataFrame) -> DataFrame:
    """Receipts and issues on one time line; receipts come first within a day."""
    received = layers.select("product_id", "id", F.col("date").alias("day"), F.lit(0).alias("kind"), _units(F.col("qty")).alias("qty"), F.col("price").cast(QTY))
    issued = issues.select("product_id", "id", F.col("date").alias("day"), F.lit(1).alias("kind"), _units(F.col("qty")).alias("qty"), F.lit(None).cast(QTY).alias("price"))
    return received.unionByName(issued)


def _intervals(layers: DataFrame, issues: DataFrame) -> Chunks:
    """Events in chunks, with their stretch [lo, hi) of the received-quantity axis and ``taken``, where the last issue ends.

    Received, issued and the greatest shortage so far combine in one scan over
    one written table.
    """
    is_layer = F.col("kind") == 0
    zero = F.lit(0).cast("bigint")
    # A shortage is dropped for good: later receipts never make up for it.
    short = F.col("cum_out") - F.col("cum_in")
    value = _quantity(F.col("qty")).cast(QTY) * F.col("price")
    events = in_chunks(_events(layers, issues), ["product_id"], EVENT_ORDER).scan(
        [
            Running("cum_in", "sum", F.when(is_layer, F.col("qty")).otherwise(zero)),
            Running("cum_out", "sum", F.when(is_layer, zero).otherwise(F.col("qty")), whole="all_out"),
            Running("cost_before", "sum", F.when(is_layer, value).otherwise(F.lit(0).cast(MONEY)), exclusive=True),
            Running("last_price", "last", F.when(is_layer, F.col("price"))),
            Running("lost", "peak", short, whole="all_lost"),
            Running("lost_before", "peak", short, exclusive=True),
        ]
    )
    lost = F.greatest(zero, "lost")
    lost_before = F.greatest(zero, F.coalesce("lost_before", zero))
    lo = F.when(is_layer, F.col("cum_in") - F.col("qty")).otherwise(F.col("cum_out") - F.col("qty") - lost_before)
    hi = F.when(is_layer, F.col("cum_in")).otherwise(F.col("cum_out") - lost)
    # The ends of issues never fall, and after the last one neither sum nor shortage changes.
    taken = F.col("all_out") - F.greatest(zero, "all_lost")
    return events.map(lambda df: df.withColumns({"lo": lo, "hi": hi, "taken": taken}).drop("cum_in", "cum_out", "lost", "lost_before", "all_out", "all_lost"))


def fifo_cost(layers: DataFrame, issues: DataFrame) -> DataFrame:
    """Weighted unit cost of every issue.

    ``layers``: product_id, id, date, qty, price; ``issues``: product_id, id,
    date, qty. What stock cannot cover is priced at the newest layer received
    so far; an issue before any receipt costs 0.
    """
    spans = _intervals(layers, issues).rows()
    no_cost = F.lit(0).cast(MONEY)
    knot = F.struct(F.col("lo").alias("at"), F.coalesce("cost_before", no_cost).cast(MONEY).alias("cost"), F.col("price")).cast(KNOT)
    no_knot = F.lit(None).cast(KNOT)
    point = lambda pos, probe, at: F.struct(F.col(pos).alias("pos"), F.lit(probe).alias("probe"), at.alias("knot"))
    # A layer is one knot, an issue two probes; an issue that found no stock keeps one point that is worth nothing.
    issue = F.when(F.col("hi") > F.col("lo"), F.array(point("lo", 1, no_knot), point("hi", 2, no_knot))).otherwise(F.array(point("hi", 3, no_knot)))
    rows = F.when(F.col("kind") == 1, issue).when(F.col("qty") > 0, F.array(point("lo", 0, knot)))
    marks = spans.select(
        "product_id", "id", "qty", F.greatest(F.lit(0), F.col("hi") - F.col("lo")).alias("covered"), "last_price", F.explode(rows).alias("point")
    ).select("product_id", "id", "qty", "covered", "last_price", "point.*")
    points = ordered_scan(marks, ["product_id"], ["pos", "probe", "id"], [Running("at_knot", "last", F.col("knot"))])
    knot = F.col("at_knot")
    into = _quantity(F.col("pos") - knot["at"]).cast(QTY)
    total = (knot["cost"] + (into * knot["price"]).cast(MONEY)).cast(MONEY)
    signed = F.when(F.col("probe") == 2, total).when(F.col("probe") == 1, -total)
    per_issue = points.filter(F.col("probe") > 0).groupBy("product_id", "id").agg(
        F.coalesce(F.sum(signed), no_cost).cast(MONEY).alias("taken"), F.first("qty").alias("qty"), F.first("covered").alias("covered"), F.first("last_price").alias("last_price")
    )
    missing = _quantity(F.col("qty") - F.col("covered")).cast(QTY)
    cost = F.col("taken") + F.coalesce(missing * F.col("last_price"), no_cost)
    qty, covered = (F.col(c) / float(UNITS) for c in ("qty", "covered"))
    unit = F.try_divide(cost.cast("double"), qty)
    return per_issue.select("product_id", "id", qty.alias("qty"), covered.alias("covered"), F.coalesce(unit, F.lit(0.0)).alias("unit_cost"))


def fifo_balance(layers: DataFrame, issues: DataFrame) -> DataFrame:
    """What is left of every layer, with running quantity and average price.

    ``qty_to_here`` and ``price_to_here`` describe the first n remaining layers.
    """
    remaining = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("qty"), F.col("hi") - F.col("taken")))
    # Layers keep the chunks of their events.
    left = _intervals(layers, issues).map(lambda df: df.filter("kind = 0").select("product_id", *EVENT_ORDER, "price", remaining.alias("remaining"), CHUNK))
    value = _quantity(F.col("remaining")).cast(QTY) * F.col("price")
    out = left.scan([Running("__q", "sum", F.col("remaining")), Running("__v", "sum", value)]).rows()
    q = F.col("__q") / float(UNITS)
    average = F.coalesce(F.try_divide(F.col("__v").cast("double"), q), F.lit(0.0))
    return out.select("product_id", "id", (F.col("remaining") / float(UNITS)).alias("remaining"), q.alias("qty_to_here"), average.alias("price_to_here"))


def allocate_procurements(po_line: DataFrame, procurement: DataFrame, step: float = 0.0001) -> DataFrame:
    """Greedy split of an ordered quantity over its procurements, plus the rest.

    ``po_line``: id, quantity; ``procurement``: id, po_line_id, seq (bigint),
    quantity. Quantities that round to nothing are skipped. The remainder row
    has no procurement id.
    """
    wanted = procurement.filter(F.round(F.col("quantity") / F.lit(step)) > 0).select(
        "po_line_id", "seq", F.col("id").alias("procurement_id"), F.col("quantity").cast(QTY).alias("want")
    )
    queued = ordered_scan(
        wanted,
        ["po_line_id"],
        ["seq", "procurement_id"],
        [Running("ahead", "sum", F.col("want"), exclusive=True)],
    )
    ahead = F.coalesce("ahead", F.lit(0).cast(QTY))
    total = po_line.select(F.col("id").alias("po_line_id"), F.col("quantity").cast(QTY).alias("total"))
    room = F.greatest(F.lit(0).cast(QTY), F.col("total") - ahead)
    split = queued.join(total, "po_line_id").select(
        "po_line_id", "procurement_id", F.least(F.col("want"), room).cast(QTY).alias("quantity")
    )
    asked = wanted.groupBy("po_line_id").agg(F.sum("want").alias("asked"))
    rest = total.join(asked, "po_line_id", "left").select(
        "po_line_id",
        F.lit(None).cast("bigint").alias("procurement_id"),
        F.greatest(F.lit(0).cast(QTY), F.col("total") - F.coalesce("asked", F.lit(0).cast(QTY))).cast(QTY).alias("quantity"),
    )
    both = split.unionByName(rest).withColumn("quantity", F.col("quantity").cast("double"))
    return both.filter(F.round(F.col("quantity") / F.lit(step)) > 0)
