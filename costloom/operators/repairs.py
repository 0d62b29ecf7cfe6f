"""Cost and currency repair jobs, and the dated price lookups behind them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import exchange, margin_ratio, net_unit_price, purchase_net_price
from ..functions.ordered import Running, asof_by_day, ordered_scan, top_k
from .costing import invoice_cost, oldest_layer
from .currency import convert, convert_from_company

CAP_MARKUP = 1.35  # fixed value: lowest accepted price over cost


# -- price history lookups ---------------------------------------------------


# Days count from year 0, so that a closed range splits into aligned blocks of 1, 2, 4, ... days.
DAY_ZERO = 719_528


def _day_number(day: str) -> str:
    return f"unix_date({day}) + {DAY_ZERO}"


def in_day_blocks(df: DataFrame, first: str, last: str) -> DataFrame:
    """``df`` with a row for each of the aligned blocks (level, block) that together are the days from ``first`` to ``last``.

    At most two blocks of a level, and none longer than the range, so the end of
    9999 is about forty rows away.
    """
    # The levels are exploded, not transformed in an array, so that all arithmetic is compiled.
    out = df.withColumns({"__low": F.expr(_day_number(first)), "__high": F.expr(f"{_day_number(last)} + 1")})
    out = out.withColumn("level", F.explode(F.sequence(F.lit(0), F.floor(F.log2(F.col("__high") - F.col("__low"))).cast("int"))))
    out = out.withColumns({"__low": F.expr("shiftright(__low + shiftleft(1, level) - 1, level)"), "__high": F.expr("shiftright(__high, level)")})
    out = out.filter("__low < __high and (__low % 2 = 1 or __high % 2 = 1)")
    left, right = F.when(F.col("__low") % 2 == 1, F.col("__low")), F.when(F.col("__high") % 2 == 1, F.col("__high") - 1)
    return out.withColumn("block", F.explode(F.array(left, right))).filter("block is not null").drop("__low", "__high")


# A product with more rows than this is not left to one task.
CROWDED = 1_000_000
BUCKETS = 65_536


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS))


def _crowded(key: str, *keyed: DataFrame) -> list[int]:
    """Hash buckets of the values of ``key`` with so many rows that one task should not hold them; usually none."""
    rows = reduce(DataFrame.union, keyed).groupBy(_bucket(key).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    full = F.collect_list(F.when(F.col("n") > CROWDED, F.struct("bucket", "n"))).alias("full")
    seen = rows.agg(F.sum("n").alias("n"), full).first()
    return [r["bucket"] for r in seen["full"] if r["n"] * BUCKETS > 8 * seen["n"]]


def historic_price(line: DataFrame, supplierinfo: DataFrame, keyed: DataFrame | None = None) -> DataFrame:
    """Price valid on each line's date: start on or before, end open or on or after.

    ``line``: line_id, product_tmpl_id, date. The latest start wins, then the
    lowest id. Lines and price rows are shuffled once, by product. Only for products of more
    than ``CROWDED`` rows, which are counted first, lines collapse to product and day and price rows
    to product, start and end, and lines look the result up. ``keyed`` is what is counted
    for ``line``: its product_tmpl_id from a source that is cheaper to read. Result: line_id,
    price; lines without price drop out.
    """
    key = "product_tmpl_id"
    asked = line.select("line_id", key, F.col("date").cast("date").alias("day")).filter("day IS NOT NULL")
    dated = supplierinfo.filter(F.col("date_start").isNotNull() & (F.col("date_end").isNull() | (F.col("date_end") >= F.col("date_start"))))
    ranges = dated.select(key, F.col("date_start").alias("day"), "date_end", (-F.col("id")).alias("rank"), "price")
    same = asked.select(key).union(ranges.select(key)).schema[key].dataType
    asked, ranges, counted = (df.filter(F.col(key).isNotNull()).withColumn(key, F.col(key).cast(same)) for df in (asked, ranges, asked if keyed is None else keyed))
    crowded = _crowded(key, counted.select(key), ranges.select(key))
    if not crowded:
        return _priced(asked, ranges).select("line_id", "found.price")

    busy = _bucket(key).isin(crowded)
    best = F.max(F.struct("rank", "price")).alias("best")
    fewer = ranges.filter(busy).groupBy(key, "day", "date_end").agg(best).select(key, "day", "date_end", "best.rank", "best.price")
    known = _priced(asked.filter(busy).select(key, "day").distinct(), fewer)
    others = _priced(asked.filter(~busy), ranges.filter(~busy))
    return others.select("line_id", "found.price").union(asked.filter(busy).join(known, [key, "day"]).select("line_id", "found.price"))


def _priced(asked: DataFrame, ranges: DataFrame) -> DataFrame:
    """``asked`` with the price row ``found`` for each row's product and day; rows without one drop out.

    The price row that started last decides a day where it still holds, and no open row
    before the last open one counts. A closed row that outlasts the next one may hold again
    from the end of that one up to the next open row. On the first and the day after the last of these
    days blocks are looked up: the days from the next start become the few aligned blocks they
    consist of, about two for each doubling of their number, and a day asks for the one block
    of each length that holds it. Between two of the days nothing changes, so other
    days take the last one's result. All of it is done where the shuffle by product put the rows.
    """
    key, is_open, place = "product_tmpl_id", F.col("date_end").isNull(), ["day", "rank", "price", "date_end"]
    own = asked.columns
    asked, ranges = asked.repartition(key), ranges.repartition(key)

    after = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in place])
    hidden = ranges.withColumns(
        {
            "__first": F.lag("day").over(after),
            "__next": F.lag("date_end").over(after),
            "__open": F.last(F.when(is_open, F.col("day")), ignorenulls=True).over(after.rowsBetween(Window.unboundedPreceding, -1)),
        }
    )
    # No block where the next row still holds: a row that it covers needs none.
    hidden = hidden.filter(~is_open).withColumn("__last", F.least("date_end", F.date_sub("__open", 1))).filter("__first <= __last AND __next < __last")
    held = hidden.select(key, "__first", "__last", "__next", F.struct(F.col("day").alias("start"), "rank", "price").alias("held"))
    blocks = in_day_blocks(held, "__first", "__last").withColumns({"__from": F.expr(f"{_day_number('__next')} + 1"), "__to": F.expr(f"{_day_number('__last')} + 1")})
    blocks = blocks.filter("shiftleft(block + 1, level) > __from").withColumn("__most", F.max("level").over(Window.partitionBy(key)))
    # Each block stays, and those that hold the first or end with the last day ask for these days.
    turns = F.array(F.lit(None), F.when(F.expr("shiftleft(block, level) <= __from"), F.col("__from")), F.when(F.expr("shiftleft(block + 1, level) = __to"), F.col("__to")))
    looks = blocks.select("*", F.posexplode(turns).alias("__place", "at")).filter("__place = 0 OR at IS NOT NULL")
    looks = looks.withColumn("__of", F.explode(F.when(F.col("at").isNull(), F.array("level")).otherwise(F.sequence(F.lit(0), F.col("__most")))))
    looks = looks.select(key, "at", "__of", F.expr("coalesce(shiftright(at, __of), block)").alias("block"), F.when(F.col("at").isNull(), F.col("held")).alias("held"))
    looks = looks.withColumn("held", F.max("held").over(Window.partitionBy(key, "__of", "block"))).filter("at IS NOT NULL")
    turned = looks.groupBy(key, "at").agg(F.max("held").alias("held"))
    turned = turned.select(key, F.expr(f"date_from_unix_date(at - {DAY_ZERO})").alias("day"), "held")

    kinds = [df.withColumn("kind", F.lit(n)) for n, df in enumerate((ranges, turned, asked))]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kinds)
    upto = Window.partitionBy(key).orderBy("day", "kind", *place[1:]).rowsBetween(Window.unboundedPreceding, 0)
    last = lambda when, *what: F.last(F.when(when, F.struct(*what)), ignorenulls=True).over(upto)
    row = F.struct(F.col("day").alias("start"), "rank", "price").alias("row")
    seen = both.withColumns({"latest": last(F.col("kind") == 0, row, "date_end"), "opened": last((F.col("kind") == 0) & is_open, row), "again": last(F.col("kind") == 1, "held")})
    # A day whose price is known looks no further.
    holds = F.col("latest.date_end").isNull() | (F.col("latest.date_end") >= F.col("day"))
    found = F.when(holds, F.col("latest.row")).otherwise(F.greatest("opened.row", "again.held"))
    return seen.filter("kind = 2 AND latest IS NOT NULL").select(*own, found.alias("found")).filter("found IS NOT NULL")


def consignment_lines(line: DataFrame, product: DataFrame, supplierinfo: DataFrame, vendor: DataFrame) -> DataFrame:
    """Lines of products that any consignment vendor supplies, each line once."""
    consigned = vendor.filter(F.col("business_mode") == "consignment").select(F.col("id").alias("vendor_id"))
    offered = supplierinfo.join(consigned, "vendor_id", "left_semi").select(F.col("product_tmpl_id").alias("tmpl_id"))
    goods = product.join(offered, "tmpl_id", "left_semi").select(F.col("id").alias("product_id"))
    return line.join(goods, "product_id", "left_semi")


def repair_date_ranges(supplierinfo: DataFrame) -> DataFrame:
    """An end before its start becomes the start; open rows stay open."""
    crossed = F.col("date_end") < F.col("date_start")
    return supplierinfo.withColumn("date_end", F.when(crossed, F.col("date_start")).otherwise(F.col("date_end")))


def drop_zero_prices(supplierinfo: DataFrame) -> DataFrame:
    return supplierinfo.filter(~F.col("price").eqNullSafe(0.0))


# -- layers ------------------------------------------------------------------


def latest_cost_fill(product: DataFrame, layers: DataFrame) -> DataFrame:
    """A zero standard price becomes the cost of the newest layer (highest id)."""
    newest = layers.groupBy(F.col("product_id").alias("id")).agg(F.max_by("cost", "id").alias("__cost"))
    out = product.join(newest, "id", "left")
    fill = F.coalesce("__cost", F.lit(0.0))
    return out.withColumn("standard_price", F.when(F.col("standard_price") == 0, fill).otherwise(F.col("standard_price"))).drop("__cost")


def latest_invoice_cost(layers: DataFrame, product: DataFrame, line: DataFrame, location: str = "Stock") -> DataFrame:
    """Zero-cost layers of a location: invoice cost, else today's, else the newest line's net price."""
    costs = product.select(F.col("id").alias("product_id"), F.col("invoice_cost").alias("__i"), F.col("today_cost").alias("__t"))
    newest = line.groupBy("product_id").agg(F.max_by(net_unit_price(F.col("price_unit"), F.col("discount")), "id").alias("__n"))
    out = layers.join(costs, "product_id", "left").join(newest, "product_id", "left")
    zero = F.lit(0.0)
    found = F.coalesce(F.nullif("__i", zero), F.nullif("__t", zero), "__n", zero)
    hit = (F.col("cost") == 0) & (F.col("location") == location)
    return out.withColumn("cost", F.when(hit, found).otherwise(F.col("cost"))).select(*layers.columns)


def sale_cost_caps(line: DataFrame, product: DataFrame, supplierinfo: DataFrame, vendor: DataFrame, since: str = "2020-01-01") -> DataFrame:
    """Highest believable cost of each loss-making sale of the primary vendor's goods.

    ``line``: id, product_id, type, state, date_invoice, price_unit,
    product_margin. The cap is the lower of the oldest dated price (when it is
    not after the sale) and today's cost; when the sale price is below cap
    times 1.35 the cap is price / 1.35. ``product_margin`` is recomputed.
    """
    loss = line.filter(
        (F.col("product_margin") < 0)
        & (F.col("state") != "draft")
        & (F.col("date_invoice") > F.lit(since).cast("date"))
        & (F.col("type") == "out_invoice")
    )
    primary = vendor.filter("is_primary").select(F.col("id").alias("vendor_id"))
    supplied = supplierinfo.join(primary, "vendor_id", "left_semi").select(F.col("product_tmpl_id").alias("tmpl_id"))
    first = supplierinfo.filter(F.col("date_start").isNotNull()).groupBy(F.col("product_tmpl_id").alias("tmpl_id")).agg(
        F.min(F.struct("date_start", "id", "price")).alias("__first")
    )
    what = product.join(supplied, "tmpl_id", "left_semi").join(first, "tmpl_id", "left")
    what = what.select(F.col("id").alias("product_id"), F.col("today_cost").alias("__today"), "__first")
    out = loss.join(what, "product_id")
    historic = F.when(F.col("__first.date_start") <= F.col("date_invoice"), F.nullif(F.col("__first.price"), F.lit(0.0)))
    cost = F.least("__today", historic)
    cap = F.when(cost * F.lit(CAP_MARKUP) > F.col("price_unit"), F.col("price_unit") / F.lit(CAP_MARKUP)).otherwise(cost)
    out = out.withColumn("cap", cap)
    return out.withColumn("product_margin", margin_ratio(F.col("price_unit"), F.col("cap"))).drop("__today", "__first")


def cap_layer_cost(layers: DataFrame, caps: DataFrame, location: str = "Stock") -> DataFrame:
    """Layers of a location lowered to the least cap of the sales after their arrival.

    ``caps`` comes from ``sale_cost_caps``. Sales and layers share one time
    line per product, so the least later cap is a backward running minimum.
    """
    here = layers.filter(F.col("location") == location)
    arrivals = here.select("product_id", F.col("in_date").cast("timestamp").alias("at"), F.lit(1).alias("kind"), "id", F.lit(None).cast("double").alias("cap"))
    sales = caps.select("product_id", F.col("date_invoice").cast("timestamp").alias("at"), F.lit(0).alias("kind"), "id", "cap")
    line = ordered_scan(
        arrivals.unionByName(sales).filter(F.col("at").isNotNull()),
        ["product_id"],
        ["at", "kind", "id"],
        [Running("__least", "max", -F.col("cap"))],
        reverse=True,
    )
    least = line.filter("kind = 1").select("id", (-F.col("__least")).alias("__cap"))
    out = layers.join(least, "id", "left")
    return out.withColumn("cost", F.least("cost", "__cap")).select(*layers.columns)


def lower_standard_price(line: DataFrame, purchase: DataFrame, layers: DataFrame, product: DataFrame, skip_text: str | None = None) -> DataFrame:
    """Standard price lowered to the closest purchase cost of each sale, never raised.

    ``line``: product_id, type, date_invoice; ``purchase``: id, product_id,
    date_invoice, discount_processed, price_unit, discount, invoice_discount,
    is_primary. Codes containing ``skip_text`` are left out. The closest
    purchase is taken around the oldest layer, or around the sale itself when
    the product has no stock.
    """
    sold = line.filter(F.col("type") == "out_invoice")
    goods = product.select(F.col("id").alias("product_id"), "default_code")
    if skip_text:
        goods = goods.filter(~F.coalesce(F.col("default_code").contains(skip_text), F.lit(False)))
    since = oldest_layer(layers).select("product_id", F.col("in_date").cast("date").alias("__since"))
    asked = sold.select("product_id", F.col("date_invoice").alias("day")).distinct()
    asked = asked.join(goods, "product_id", "left_semi").join(since, "product_id", "left")
    asked = asked.select("product_id", F.coalesce("__since", "day").alias("day")).filter("day IS NOT NULL").distinct()

    net = purchase_net_price(F.col("price_unit"), F.col("discount"), F.col("invoice_discount"), F.col("is_primary"))
    cost = F.when(F.col("price_unit") != 0, net)
    done = purchase.filter(F.coalesce("discount_processed", F.lit(False)) & F.col("date_invoice").isNotNull())
    daily = done.groupBy("product_id", F.col("date_invoice").alias("day")).agg(
        F.min_by(F.struct(F.col("date_invoice").alias("on"), cost.alias("cost")), "id").alias("near")
    )
    before = asof_by_day(asked, daily, ["product_id"], "day", "near").withColumnRenamed("near", "__before")
    both = asof_by_day(before, daily, ["product_id"], "day", "near", following=True).withColumnRenamed("near", "__after")
    gap = lambda c: F.abs(F.date_diff(F.col("day"), F.col(c)["on"]))
    closer = F.when(F.col("__after").isNull() | (gap("__before") <= gap("__after")), F.col("__before")).otherwise(F.col("__after"))
    least = both.select("product_id", closer["cost"].alias("cost")).groupBy("product_id").agg(F.min("cost").alias("__least"))
    out = product.join(least.withColumnRenamed("product_id", "id"), "id", "left")
    lower = F.col("__least") < F.col("standard_price")
    return out.withColumns(
        {
            "standard_product_price": F.when(lower, F.col("__least")).otherwise(F.col("standard_product_price")),
            "standard_price": F.when(lower, F.col("__least")).otherwise(F.col("standard_price")),
        }
    ).drop("__least")


def margin_at_invoice_fx(line: DataFrame, product: DataFrame, rates: DataFrame, invoice_ids: Sequence[int] | None = None) -> DataFrame:
    """Line margin with the exchange rate of the invoice date and the invoice cost.

    ``line``: id, invoice_id, product_id, currency, date_invoice, price_unit,
    discount; ``product`` has a fresh invoice_cost.
    """
    if invoice_ids is not None:
        line = line.filter(F.col("invoice_id").isin(*invoice_ids))
    out = convert(line, rates, "price_unit", "currency", None, "__unit", date_col="date_invoice")
    cost = product.select(F.col("id").alias("product_id"), F.col("invoice_cost").alias("__cost"))
    out = out.join(cost, "product_id", "left")
    price = net_unit_price(F.col("__unit"), F.col("discount"))
    ratio = F.try_divide(price, F.col("__cost")) - F.lit(1.0)
    margin = F.when(F.coalesce("__cost", F.lit(0.0)) != 0, ratio).otherwise(F.lit(1e10))
    return out.withColumn("product_margin", margin).drop("__unit", "__cost")


def backfill_invoice_cost(product: DataFrame, lines: DataFrame, layers: DataFrame, rates: DataFrame, today: str) -> DataFrame:
    """Invoice cost of every product, as of ``today`` for those without stock."""
    return invoice_cost(product, lines, layers, rates, today)


# -- currencies --------------------------------------------------------------


def repair_layer_currency(layers: DataFrame, product: DataFrame, supplierinfo: DataFrame, rates: DataFrame, foreign: str = "USD") -> DataFrame:
    """Layers with a cost but no product-currency cost.

    Foreign products take the first supplier price (lowest id), and their cost
    is converted again at arrival; the rest copy the cost.
    """
    first = supplierinfo.groupBy(F.col("product_tmpl_id").alias("tmpl_id")).agg(F.min_by("price", "id").alias("__price"))
    what = product.select(F.col("id").alias("product_id"), "tmpl_id", F.col("currency").alias("__cur"))
    what = what.join(first, "tmpl_id", "left").drop("tmpl_id")
    out = convert(layers.join(what, "product_id", "left"), rates, "__price", "__cur", None, "__cost", date_col="in_date")
    lacking = (F.col("cost_product") == 0) & (F.col("cost") != 0)
    away = F.col("__cur") == foreign
    priced = lacking & away & F.col("__price").isNotNull()
    return out.withColumns(
        {
            "cost_product": F.when(priced, F.col("__price")).when(lacking & ~F.coalesce(away, F.lit(False)), F.col("cost")).otherwise(F.col("cost_product")),
            "cost": F.when(priced, F.col("__cost")).otherwise(F.col("cost")),
        }
    ).select(*layers.columns)


def repair_move_currency(moves: DataFrame, rates: DataFrame) -> DataFrame:
    """Moves without a product-currency price: the price converted at creation.

    ``moves``: price_unit, price_product_unit, product_currency, create_date.
    """
    out = convert_from_company(moves, rates, "price_unit", "product_currency", "__new", date_col="create_date")
    lacking = (F.col("price_product_unit") == 0) & (F.col("price_unit") != 0)
    return out.withColumn("price_product_unit", F.when(lacking, F.col("__new")).otherwise(F.col("price_product_unit"))).drop("__new")


def repair_standard_cost(product: DataFrame, layers: DataFrame) -> DataFrame:
    """Products without a product-currency cost take both costs of their oldest layer."""
    oldest = oldest_layer(layers).select(F.col("product_id").alias("id"), F.col("cost").alias("__c"), F.col("cost_product").alias("__p"), F.lit(True).alias("__has"))
    out = product.join(oldest, "id", "left")
    hit = (F.col("standard_product_price") == 0) & F.coalesce("__has", F.lit(False))
    return out.withColumns(
        {
            "standard_price": F.when(hit, F.col("__c")).otherwise(F.col("standard_price")),
            "standard_product_price": F.when(hit, F.col("__p")).otherwise(F.col("standard_product_price")),
        }
    ).drop("__c", "__p", "__has")
