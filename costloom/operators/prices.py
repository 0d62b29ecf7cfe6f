"""Price history and the price state machine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import MARGIN_UNKNOWN, cost_decreased, exchange, margin_ratio
from ..functions.ordered import CHUNK, Running, in_chunks, top_k
from ..session import written
from .costing import oldest_layer
from .currency import with_current_rate
from .transitions import OUTCOME, RECORD, composed, followed

OBSOLETE, SELLABLE, OFFER = "obsolete", "sellable", "offer"


def scd2_prices(current: DataFrame, feed: DataFrame) -> DataFrame:
    """Price history per vendor and product after a feed.

    ``current``: vendor_id, product_tmpl_id, price, date_start, date_end.
    ``feed``: vendor_id, product_tmpl_id, price, date, seq, is_primary; it is
    newer than ``current`` and ordered by (date, seq), ``seq`` of any ordered
    type. A repeated price writes nothing; a new one closes the open row a day
    before, or on its own start day. A zero price of a primary vendor never
    reaches the history. Further columns of both, such as minimum quantity and
    vendor code, are kept with their row.
    """
    keys = ["vendor_id", "product_tmpl_id"]
    details = [c for c in current.columns if c in feed.columns and c not in (*keys, "price")]
    closed = current.filter(F.col("date_end").isNotNull())
    none = F.lit(None).cast(feed.schema["seq"].dataType)
    opened = current.filter(F.col("date_end").isNull()).select(
        *keys, *details, "price", F.col("date_start").alias("date"), none.alias("seq"), F.lit(False).alias("is_new")
    )
    news = feed.filter(~((F.col("price") == 0) & F.col("is_primary"))).select(
        *keys, *details, "price", F.col("date").cast("date").alias("date"), "seq", F.lit(True).alias("is_new")
    )
    order = ["date", "is_new", "seq"]
    # Both scans start from the same written chunks.
    seen = in_chunks(opened.unionByName(news), keys, order).scan([Running("before", "last", F.col("price"), exclusive=True)])
    changed = seen.map(lambda df: df.filter(~F.col("is_new") | ~F.col("price").eqNullSafe(F.col("before"))))
    dated = changed.scan([Running("following", "last", F.col("date"), exclusive=True)], reverse=True)
    out = dated.rows().select(
        *keys,
        *details,
        "price",
        F.col("date").alias("date_start"),
        F.when(F.col("following").isNotNull(), F.greatest(F.date_sub("following", 1), F.col("date"))).alias("date_end"),
        F.when(F.col("is_new"), "added").when(F.col("following").isNotNull(), "closed").otherwise("unchanged").alias("action"),
    )
    past = closed.select(*keys, *details, "price", "date_start", "date_end", F.lit("unchanged").alias("action"))
    return past.unionByName(out)


def _event(*more: str) -> Column:
    return F.struct("date", "seq", "cost", "price", "is_primary", "manual", *more)


def _accepted_with_stock(events: DataFrame, tolerance: float) -> DataFrame:
    """tmpl_id, cost, price, is_primary and is_last of the last automatic cost that was taken over.

    ``events``: automatic costs that follow the start of their product, with its
    ``start`` cost. Once a cost was taken or refused, the current cost is above
    it less the tolerance, so only a cost above all earlier ones can be taken:
    the others are dropped by a running peak. A chunk of what is left becomes
    one record, which tells the outcome for any cost it can be entered with
    (see ``transitions``), and a product's records are followed one after the other.
    """
    chunks = in_chunks(events, ["tmpl_id"], ["date", "seq"]).scan([Running("peak", "max", F.col("cost"), exclusive=True)])
    above = F.greatest("start", F.coalesce("peak", F.col("start")))
    rising = chunks.df.withColumn("above", above).filter(F.col("cost") > F.col("above"))
    # Rising costs are in order by themselves.
    rising = rising.select("tmpl_id", F.col(CHUNK).alias("chunk"), "start", "above", "cost", "price", "is_primary", "is_last")
    rising = rising.repartition("tmpl_id", "chunk").sortWithinPartitions("tmpl_id", "chunk", "cost")
    records = rising.mapInPandas(composed(tolerance), RECORD)
    in_turn = records.repartition("tmpl_id").sortWithinPartitions("tmpl_id", "chunk")
    return in_turn.mapInPandas(followed(tolerance), OUTCOME)


def apply_prices(
    product: DataFrame,
    events: DataFrame,
    item: DataFrame,
    layers: DataFrame,
    rates: DataFrame,
    tolerance: float = 0.05,
    as_of: str | None = None,
) -> DataFrame:
    """Product prices and state after a sequence of cost events.

    ``events``: tmpl_id, date, seq, cost, price, is_primary, manual; costs are
    not negative, and events without a cost are left out. A primary vendor's
    zero cost makes a product obsolete. A lower automatic cost puts it on offer,
    and is not taken over while there is stock. Otherwise cost, list price and
    margin follow the event, and the standard price too when there is no stock.
    The first matching price row of an event is written by ``scd2_prices``.

    No group holds a product's events. Without stock every event overwrites the
    one before, so the last two decide. With stock a manual event resets what
    came before it, and the automatic ones after it compose.
    """
    stocked = layers.filter(F.col("location_usage") == "internal").select(F.col("product_id").alias("tmpl_id")).distinct()
    flags = product.select("tmpl_id", "today_cost").join(stocked.withColumn("has_stock", F.lit(True)), "tmpl_id", "left")
    flags = flags.select("tmpl_id", F.coalesce("today_cost", F.lit(0.0)).alias("__cost"), F.coalesce("has_stock", F.lit(False)).alias("has_stock"))
    # A primary vendor's zero cost only marks the product.
    events = events.filter(F.col("cost").isNotNull()).withColumn("counts", ~((F.col("cost") == 0) & F.col("is_primary")))
    at = F.struct("date", "seq")
    counted, reset = F.when(F.col("counts"), at), F.when(F.col("counts") & F.col("manual"), at)
    ends = events.groupBy("tmpl_id").agg(
        F.max_by(_event(), at).alias("__last"), F.max_by(_event(), counted).alias("__taken"), F.max_by(_event(), reset).alias("__reset")
    )
    known = written(flags.join(ends, "tmpl_id"))  # one row a product, read four times

    two = top_k(events.filter("counts").join(known.filter("not has_stock").select("tmpl_id"), "tmpl_id", "left_semi"), ["tmpl_id"], [F.col("date").desc(), F.col("seq").desc()], 2, rank="__n")
    before = two.filter("__n = 2").select("tmpl_id", F.col("cost").alias("__before"))

    starts = known.filter("has_stock").select(
        "tmpl_id",
        F.coalesce("__reset.cost", "__cost").alias("start"),
        F.when(F.col("__reset").isNotNull(), F.struct("__reset.date", "__reset.seq")).alias("__since"),
        F.struct("__last.date", "__last.seq").alias("__end"),
    )
    after = events.filter(F.col("counts") & ~F.col("manual")).join(starts, "tmpl_id")
    after = after.filter((F.col("__since").isNull() | (at > F.col("__since"))) & ~cost_decreased(F.col("start"), F.col("cost"), tolerance))
    after = after.select("tmpl_id", "date", "seq", "cost", "price", "is_primary", "start", (at == F.col("__end")).alias("is_last"))
    risen = _accepted_with_stock(after, tolerance)
    risen = risen.select("tmpl_id", F.struct("cost", "price", "is_primary", F.lit(False).alias("manual"), "is_last").alias("__risen"))

    margin = item.select(F.col("code").alias("item_code"), F.col("margin").alias("__item_margin"))
    base = with_current_rate(product, rates, "currency", "__rate", as_of).join(margin, "item_code", "left")
    base = base.join(known, "tmpl_id", "left").join(before, "tmpl_id", "left").join(risen, "tmpl_id", "left")

    stock, last = F.col("has_stock"), F.col("__last")
    plain = lambda c: F.when(c.isNotNull(), F.struct(c["cost"].alias("cost"), c["price"].alias("price"), c["is_primary"].alias("is_primary"), c["manual"].alias("manual"), (F.struct(c["date"], c["seq"]) == F.struct(last["date"], last["seq"])).alias("is_last")))
    # From a cost of zero any cost is taken, another zero too.
    from_zero = F.coalesce("__reset.cost", "__cost") == 0
    taken = F.when(stock, F.coalesce(F.col("__risen"), F.when(from_zero, plain(F.col("__taken"))), plain(F.col("__reset")))).otherwise(plain(F.col("__taken")))
    base = base.withColumn("__e", taken)
    e, rate = F.col("__e"), F.col("__rate")
    dead = (last["cost"] == 0) & last["is_primary"]
    lower = F.when(stock, ~F.coalesce(e["is_last"], F.lit(False))).otherwise(cost_decreased(F.coalesce("__before", "__cost"), e["cost"], tolerance) & ~e["manual"])
    item_margin = F.coalesce("__item_margin", F.lit(0.0))
    by_margin = e["is_primary"] & ~e["manual"]
    new = {
        "today_cost": e["cost"],
        "standard_price": F.when(stock, F.col("standard_price")).otherwise(exchange(e["cost"], rate, F.lit(1.0))),
        "standard_product_price": F.when(stock, F.col("standard_product_price")).otherwise(e["cost"]),
        "list_price": F.when(by_margin, e["cost"] * (F.lit(1.0) + item_margin)).otherwise(e["price"]),
        "margin": F.when(by_margin, F.lit(100.0) * item_margin)
        .when(e["cost"] == 0, F.lit(MARGIN_UNKNOWN))
        .otherwise(F.lit(100.0) * (F.try_divide(e["price"], e["cost"]) - F.lit(1.0))),
    }
    out = {c: F.when(e.isNull(), F.col(c)).otherwise(v) for c, v in new.items()}
    out["state"] = F.when(last.isNull(), F.col("state")).when(dead, OBSOLETE).when(lower, OFFER).otherwise(SELLABLE)
    return base.select(*[out.get(c, F.col(c)).alias(c) for c in product.columns])


def price_drops(supplierinfo: DataFrame, product: DataFrame, item: DataFrame, vendors: DataFrame | None = None) -> DataFrame:
    """Products whose last price fell while in stock: previous cost back, on offer.

    The last two price rows count, an undated one first. ``vendors``
    (vendor_id) limits the report to products that any of them has sold.
    """
    last_two = top_k(supplierinfo, ["product_tmpl_id"], [F.col("date_start").desc_nulls_first(), F.col("id")], k=2, rank="__n")
    pair = last_two.groupBy("product_tmpl_id").agg(
        F.max(F.when(F.col("__n") == 1, F.col("price"))).alias("last_price"),
        F.max(F.when(F.col("__n") == 2, F.col("price"))).alias("previous_price"),
    )
    fell = pair.filter(F.col("previous_price") > F.col("last_price")).withColumnRenamed("product_tmpl_id", "tmpl_id")
    if vendors is not None:
        sold = supplierinfo.join(vendors, "vendor_id", "left_semi").select(F.col("product_tmpl_id").alias("tmpl_id"))
        fell = fell.join(sold, "tmpl_id", "left_semi")
    margin = item.select(F.col("code").alias("item_code"), F.col("margin").alias("__m"))
    out = product.filter(F.col("virtual_available") != 0).join(fell, "tmpl_id").join(margin, "item_code", "left")
    m = F.coalesce("__m", F.lit(0.0))
    return out.withColumns(
        {
            "today_cost": F.col("previous_price"),
            "state": F.lit(OFFER),
            "margin": F.lit(100.0) * m,
            "list_price": F.col("previous_price") * (m + F.lit(1.0)),
        }
    ).drop("__m")


def price_from_parent(product: DataFrame, cost_share: float = 10.0) -> DataFrame:
    """Cost events for products priced by another product's list price.

    Only where the prices differ, so an unchanged price adds no history. The
    cost is taken as a tenth. The result feeds ``apply_prices`` and ``scd2_prices``.
    """
    parent = product.select(F.col("default_code").alias("parent_price_product"), F.col("list_price").alias("__parent"))
    out = product.join(parent, "parent_price_product").filter(F.col("__parent") != F.col("list_price"))
    return out.select(
        "tmpl_id",
        "default_code",
        "parent_price_product",
        (F.col("__parent") / F.lit(cost_share)).alias("cost"),
        F.col("__parent").alias("price"),
        F.lit(False).alias("is_primary"),
        F.lit(False).alias("manual"),
    )


def set_layer_cost_manual(layers: DataFrame, events: DataFrame) -> DataFrame:
    """Layers after manual prices of the primary vendor: the oldest one takes the cost.

    ``events``: tmpl_id, date, seq, cost, is_primary, manual; the last one counts.
    """
    manual = events.filter(F.col("manual") & F.col("is_primary") & (F.col("cost") != 0))
    last = manual.groupBy("tmpl_id").agg(F.max_by("cost", F.struct("date", "seq")).alias("__cost"))
    target = oldest_layer(layers).select("id", F.col("product_id").alias("tmpl_id")).join(last, "tmpl_id").select("id", "__cost")
    out = layers.join(target, "id", "left")
    return out.withColumns(
        {"cost": F.coalesce("__cost", "cost"), "cost_product": F.coalesce("__cost", "cost_product")}
    ).select(*layers.columns)
