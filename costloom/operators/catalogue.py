"""Product feed, items, categories, barcodes, taxes and brands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import any_of, cost_per_unit, normalize_code
from ..functions.ordered import top_k
from ..schemas import CORRUPT, FEED_COLUMNS
from ..session import written

# Fixed values of created products and categories.
PRODUCT_DEFAULTS = {"type": "product", "invoice_policy": "order", "purchase_method": "purchase"}
CATEGORY_DEFAULTS = {"cost_method": "real", "valuation": "real_time", "removal_strategy_id": 1}
CATEGORY_ACCOUNTS = {
    "valuation_account": "1.1.05.01.010",
    "input_account": "1.1.05.01.020",
    "output_account": "1.1.05.01.030",
}
PROTECTED_PREFIX = "996."
FULL_RELOAD_WATERMARK = "2000-01-01 00:00:00"

NUMERIC_TEXT = "0123456789+-.eE \t"
REPLACEMENT = "�"  # what a decoder leaves where bytes were not UTF-8


# -- feed --------------------------------------------------------------------


def newer_than(feed: DataFrame, watermark: str | None = None) -> DataFrame:
    """Rows written after the watermark; without one everything since 2000.

    Raw feeds compare as ISO text, so a malformed date is not lost here but
    rejected with its reason by ``parse_feed``.
    """
    kind = feed.schema["write_date"].dataType
    return feed.filter(F.col("write_date") > F.lit(watermark or FULL_RELOAD_WATERMARK).cast(kind))


def feed_width_check(raw: DataFrame) -> DataFrame:
    """Feed rows that do not have exactly the expected number of columns."""
    return raw.filter(F.col(CORRUPT).isNotNull())


def parse_feed(raw: DataFrame) -> DataFrame:
    """Typed feed rows with ``invalid`` and the ``errors`` behind it.

    See ``good_rows`` and ``reject_rows``: the flag is a plain predicate, and
    the array of reasons is only built for rows that have one, also where both
    are written. Empty optional cells keep a default. The pack cost is divided by the pack
    size. A row with any error is rejected alone.
    """
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    errors: list[tuple[Column, Column]] = []

    def text(name: str, optional: bool) -> Column:
        bad = ~F.is_valid_utf8(F.col(name)) | F.col(name).contains(REPLACEMENT)
        errors.append((bad, F.lit(f"{name}: not UTF-8")))
        return F.when(empty(name), F.lit(None)).otherwise(F.col(name)) if optional else F.coalesce(name, F.lit(""))

    def number(name: str, type_: str, required: bool = False) -> Column:
        missing = empty(name)
        value = F.expr(f"try_cast(trim({name}) AS {type_})")
        bad = value.isNull()
        if type_ == "double":  # the cast also takes NaN, hex and Java suffixes
            bad = bad | (F.translate(name, NUMERIC_TEXT, "") != "")
        errors.append((bad if required else ~missing & bad, F.concat(F.lit(f"{name}: not a number: "), F.coalesce(name, F.lit("")))))
        return F.when(missing, F.lit(0).cast(type_)).otherwise(value)

    typed = {
        "default_code": text("default_code", optional=False),
        "name": text("name", optional=True),
        "description_sale": text("description_sale", optional=True),
        "pack_cost": number("pack_cost", "double"),
        "upv": number("upv", "bigint"),
        "weight": number("weight", "double"),
        "volume": number("volume", "double"),
        "wholesaler_bulk": number("wholesaler_bulk", "bigint", required=True),
        "retail_bulk": number("retail_bulk", "bigint", required=True),
        "image_name": text("image_name", optional=True),
        "warranty": number("warranty", "double"),
        "iva": number("iva", "double"),
        "item_code": text("item_code", optional=False),
        "write_date": F.expr("try_to_timestamp(write_date, 'yyyy-MM-dd HH:mm:ss')"),
    }
    errors.append((typed["upv"] == 0, F.lit("upv: pack size is zero")))
    errors.append((typed["write_date"].isNull(), F.lit("write_date: not a timestamp")))
    if CORRUPT in raw.columns:
        errors.append((F.col(CORRUPT).isNotNull(), F.lit(f"row: not {len(FEED_COLUMNS)} columns")))
    keep = [c for c in raw.columns if c not in FEED_COLUMNS and c != CORRUPT]
    invalid = any_of([bad for bad, _ in errors])
    out = raw.select(
        *keep,
        *[v.alias(k) for k, v in typed.items()],
        invalid.alias("invalid"),
        F.when(invalid, F.array_compact(F.array(*[F.when(bad, why) for bad, why in errors]))).otherwise(F.array().cast("array<string>")).alias("errors"),
    )
    return out.withColumn("cost", cost_per_unit(F.col("pack_cost"), F.col("upv")))


def good_rows(parsed: DataFrame) -> DataFrame:
    """Accepted rows with the fixed product defaults."""
    good = parsed.filter(~F.col("invalid")).drop("invalid", "errors")
    return good.withColumns({k: F.lit(v) for k, v in PRODUCT_DEFAULTS.items()})


def reject_rows(parsed: DataFrame) -> DataFrame:
    """One row per reason of a rejected feed row."""
    return parsed.filter("invalid").select(
        *[c for c in parsed.columns if c not in ("invalid", "errors")], F.explode("errors").alias("reason")
    )


# -- upserts -----------------------------------------------------------------


def _differs(columns: Sequence[str], left: str, right: str) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | ~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def upsert_items(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Items after a load, with the action per code.

    Code is unique on both sides (see ``sources.files.read_items``); a row is
    updated only when a compared column changed.
    """
    columns = ["name", "origin", "section", "family", "margin"]
    joined = current.alias("old").join(incoming.alias("new"), F.col("old.code") == F.col("new.code"), "full_outer")
    arrives, exists = F.col("new.code").isNotNull(), F.col("old.code").isNotNull()
    action = (
        F.when(arrives & ~exists, "created")
        .when(arrives & _differs(columns, "old", "new"), "updated")
        .otherwise("unchanged")
    )
    return joined.select(
        F.coalesce("new.code", "old.code").alias("code"),
        *[F.when(arrives, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in columns],
        action.alias("action"),
    )


def protected_prefix(feed: DataFrame, product: DataFrame, prefix: str = PROTECTED_PREFIX) -> DataFrame:
    """Feed rows allowed to load: an existing protected product is never updated."""
    guarded = feed.filter(F.col("default_code").startswith(prefix))
    fresh = guarded.join(product.select("default_code"), "default_code", "left_anti")
    free = feed.filter(~F.coalesce(F.col("default_code").startswith(prefix), F.lit(False)))
    return free.unionByName(fresh.select(*feed.columns))


def upsert_products(
    current: DataFrame,
    parsed: DataFrame,
    columns: Sequence[str],
    order: Sequence[str] = ("write_date",),
    prefix: str = PROTECTED_PREFIX,
) -> DataFrame:
    """Catalogue after a feed, with the action per code.

    The last row of a code in the feed wins. Existing protected codes are left
    alone. A touched product's category is stale, and stays so until it is rebuilt.
    """
    newest = top_k(parsed, ["default_code"], [F.col(c).desc() for c in order])
    joined = current.alias("old").join(newest.alias("new"), F.col("old.default_code") == F.col("new.default_code"), "full_outer")
    arrives, exists = F.col("new.default_code").isNotNull(), F.col("old.default_code").isNotNull()
    guarded = exists & F.col("old.default_code").startswith(prefix)
    action = (
        F.when(~arrives, "kept").when(~exists, "created").when(guarded, "protected").otherwise("updated")
    )
    load = arrives & ~F.coalesce(guarded, F.lit(False))
    stale = F.coalesce("old.category_stale", F.lit(False)) if "category_stale" in current.columns else F.lit(False)
    rest = [c for c in current.columns if c not in columns and c not in ("default_code", "category_stale")]
    return joined.select(
        F.coalesce("old.default_code", "new.default_code").alias("default_code"),
        *[F.when(load, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in columns],
        *[F.col(f"old.{c}").alias(c) for c in rest],
        mark_category_stale(load | stale).alias("category_stale"),
        action.alias("action"),
    )


def mark_category_stale(touched: Column) -> Column:
    """Flag of products whose category must be rebuilt."""
    return F.coalesce(touched, F.lit(False))


# -- items and categories ----------------------------------------------------


def with_item(product: DataFrame, item: DataFrame) -> DataFrame:
    """Product with the names and margin of its item; a missing item has margin 0."""
    side = item.select(
        F.col("code").alias("item_code"),
        F.col("name").alias("item_name"),
        "section",
        "family",
        F.col("margin").alias("item_margin"),
    )
    return product.join(side, "item_code", "left").withColumn("item_margin", F.coalesce("item_margin", F.lit(0.0)))


def missing_item_report(product: DataFrame, item: DataFrame) -> DataFrame:
    """Products whose item code is unknown."""
    return product.join(item.select(F.col("code").alias("item_code")), "item_code", "left_anti")


def category_path(*names: str) -> Column:
    return F.concat_ws("/", *names)


def build_categories(items: DataFrame) -> DataFrame:
    """Three-level tree section / family / item, one row per path of names."""
    levels = [["section"], ["section", "family"], ["section", "family", "name"]]
    # One pass: each item lists its own path and the two above it.
    nodes = F.array(
        *[
            F.struct(
                category_path(*names).alias("path"),
                F.col(names[-1]).alias("name"),
                (category_path(*names[:-1]) if names[:-1] else F.lit(None).cast("string")).alias("parent_path"),
                F.lit(len(names)).alias("level"),
            )
            for names in levels
        ]
    )
    tree = items.select(F.explode(nodes).alias("node")).select("node.*").distinct()
    out = tree.withColumns({"id": F.xxhash64("path"), "parent_id": F.when(F.col("parent_path").isNotNull(), F.xxhash64("parent_path"))})
    return stamp_category_defaults(out)


def stamp_category_defaults(category: DataFrame) -> DataFrame:
    """Set the constant accounting properties on every category."""
    return category.withColumns({k: F.lit(v) for k, v in {**CATEGORY_DEFAULTS, **CATEGORY_ACCOUNTS}.items()})


def set_category(product: DataFrame, item: DataFrame) -> DataFrame:
    """Assign the category of stale products and clear the flag.

    Products with an unknown item stay stale; ``missing_item_report`` lists them.
    """
    named = with_item(product, item)
    path = F.when(F.col("item_name").isNotNull(), category_path("section", "family", "item_name"))
    ready = F.col("category_stale") & path.isNotNull()
    return named.withColumns(
        {
            "categ_path": F.when(ready, path).otherwise(F.col("categ_path")),
            "categ_id": F.when(ready, F.xxhash64(path)).otherwise(F.col("categ_id")),
            "category_stale": F.col("category_stale") & ~ready,
        }
    ).drop("item_name", "section", "family", "item_margin")


# -- barcodes ----------------------------------------------------------------


def duplicate_barcodes(codes: DataFrame) -> DataFrame:
    """Barcodes listed more than once in a load."""
    return codes.groupBy("barcode").agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def link_barcodes(product: DataFrame, codes: DataFrame, existing: DataFrame) -> DataFrame:
    """Barcodes to attach to products, with what happens to each.

    ``existing``: barcode, product_id. An unknown barcode is created, one of
    another product is changed, and one already in place is unchanged.
    """
    owner = product.select(F.col("id").alias("product_id"), F.col("default_code").alias("product_code"))
    linked = codes.select("barcode", "product_code").join(owner, "product_code")
    held = existing.select("barcode", F.col("product_id").alias("__held"))
    out = linked.join(held, "barcode", "left")
    action = (
        F.when(F.col("__held").isNull(), "created")
        .when(F.col("__held") != F.col("product_id"), "changed")
        .otherwise("unchanged")
    )
    return out.select("product_id", "product_code", "barcode", action.alias("action"))


# -- taxes -------------------------------------------------------------------


def tax_table(tax: DataFrame) -> DataFrame:
    """The one VAT of each rate and use: a non-zero rate, or the exempt zero (code 2)."""
    usable = tax.filter((F.col("tax_group") == "vat") & ((F.col("amount") != 0) | (F.col("group_code") == 2)))
    return usable.groupBy("amount", "use").agg(F.min("id").alias("tax_id"))


def choose_tax(product: DataFrame, tax: DataFrame, rate: str = "iva") -> DataFrame:
    """Product with sale and purchase tax ids of its rate; ``tax_missing`` marks a failed lookup."""
    # Rates meet as decimals: equal doubles are no key.
    table = tax_table(tax.withColumn("amount", F.col("amount").cast("decimal(9,4)")))
    out = product.withColumn("__rate", F.col(rate).cast("decimal(9,4)"))
    for use in ("sale", "purchase"):
        side = table.filter(F.col("use") == use).select(F.col("amount").alias("__rate"), F.col("tax_id").alias(f"{use}_tax_id"))
        out = out.join(side, "__rate", "left")
    return out.drop("__rate").withColumn("tax_missing", F.col("sale_tax_id").isNull() | F.col("purchase_tax_id").isNull())


# -- codes and brands --------------------------------------------------------


def duplicate_codes(product: DataFrame) -> DataFrame:
    """Normalised codes owned by more than one product."""
    coded = product.filter(F.coalesce("default_code", F.lit("")) != "")
    clean = coded.select("id", normalize_code(F.col("default_code")).alias("clean_code"))
    return clean.groupBy("clean_code").agg(
        F.count(F.lit(1)).alias("n_products"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    ).filter(F.col("n_products") > 1)


def duplicate_code_members(product: DataFrame) -> DataFrame:
    """The products behind ``duplicate_codes``, one row each."""
    named = product.withColumn("clean_code", normalize_code(F.col("default_code")))
    return named.join(duplicate_codes(product).select("clean_code"), "clean_code", "left_semi")


def duplicate_gate(incoming: DataFrame, product: DataFrame) -> DataFrame:
    """Incoming rows with ``rejected`` set when another product owns the normalised code.

    ``incoming``: id (NULL when new), default_code.
    """
    owned = product.filter(F.coalesce("default_code", F.lit("")) != "").select(
        F.col("id").alias("__owner"), normalize_code(F.col("default_code")).alias("clean_code")
    )
    # Two owners are enough to know whether someone else has the code.
    owners = owned.groupBy("clean_code").agg(F.min("__owner").alias("__lo"), F.max("__owner").alias("__hi"))
    out = incoming.withColumn("clean_code", normalize_code(F.col("default_code"))).join(owners, "clean_code", "left")
    me = F.coalesce("id", F.lit(-1))
    taken = F.col("__lo").isNotNull() & ((F.col("__lo") != me) | (F.col("__hi") != me))
    return out.withColumn("rejected", taken).drop("__lo", "__hi")


def code_like(product: DataFrame, mask: str) -> DataFrame:
    return product.filter(F.col("default_code").like(mask))


def discontinued(product: DataFrame) -> DataFrame:
    return product.filter("discontinued")


def discontinued_lines(po_line: DataFrame, product: DataFrame) -> DataFrame:
    """Order lines with the flag of their product."""
    flag = product.select(F.col("id").alias("product_id"), "discontinued")
    return po_line.join(flag, "product_id", "left")


GRAM = 3  # characters of a mask that codes are looked up by
FREE_MASKS = 10_000  # masks of a kind, with a literal part or without, that may be broadcast


def _gram(mask: Column) -> Column:
    """The last characters, up to GRAM, of the longest literal part of a mask, wherever it stands; empty if it has none."""
    parts = F.regexp_extract_all(mask, F.lit(r"([^%_\\]+)"), 1)
    longest = F.aggregate(parts, F.lit(""), lambda best, part: F.when(F.length(part) > F.length(best), part).otherwise(best))
    return F.right(longest, F.lit(GRAM))


def assign_brands(product: DataFrame, brand: DataFrame, salts: int = 16, free_masks: int = FREE_MASKS) -> DataFrame:
    """Product with the brand whose mask its code matches, the last checked one.

    ``brand``: id, mask, checked_order. A code that matches a mask holds each of
    its literal parts, so masks are indexed by a gram of their longest one and a
    code looks up the distinct grams it has; LIKE decides. The planner sees neither
    the grams of the codes nor copies of masks, so it is told the way: up to
    ``free_masks`` masks are broadcast, after their number has been checked; more of
    them meet the codes in a shuffle, those that share a gram spread over ``salts``
    copies. Masks of wildcards alone match almost any code: they are broadcast up to
    the same number, or else dealt to every partition of the products. Products that
    match no mask lose their brand.
    """
    masks = written(brand.select("id", "mask", "checked_order", _gram(F.col("mask")).alias("__gram")))  # read three times
    gram = F.col("__gram")
    n_free, n_indexed, lengths = masks.agg(F.count_if(gram == ""), F.count_if(gram != ""), F.collect_set(F.when(gram != "", F.length(gram)))).first()
    coded = product.filter(F.col("default_code").isNotNull()).select(F.col("id").alias("product_id"), "default_code")
    like = F.expr("default_code LIKE mask")
    found = ["product_id", "checked_order", "id"]

    lengths = F.array(*map(F.lit, lengths)).cast("array<int>")  # at most GRAM numbers
    held = coded.withColumn("__n", F.explode(lengths)).filter(F.col("__n") <= F.length("default_code"))
    places = F.sequence(F.lit(1), F.length("default_code") - F.col("__n") + 1)
    grams = F.array_distinct(F.transform(places, lambda at: F.substring(F.col("default_code"), at, F.col("__n"))))
    held = held.select("product_id", "default_code", F.explode(grams).alias("__gram"))
    indexed = masks.filter(gram != "")
    if n_indexed > free_masks:
        held = held.withColumn("__salt", F.pmod(F.hash("product_id"), F.lit(salts)))
        indexed = indexed.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        hits = held.join(indexed.hint("merge"), ["__gram", "__salt"])
    else:
        hits = held.join(F.broadcast(indexed), "__gram")
    hits = hits.filter(like).select(*found)

    free = masks.filter(gram == "").select("id", "mask", "checked_order")
    if n_free > free_masks:
        parts = int(product.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        spread = free.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        meets = coded.withColumn("__part", F.pmod(F.hash("product_id"), F.lit(parts))).join(spread.hint("merge"), "__part").filter(like)
        hits = hits.unionByName(meets.select(*found))
    elif n_free:
        hits = hits.unionByName(coded.join(F.broadcast(free), like).select(*found))
    best = hits.groupBy("product_id").agg(F.max(F.struct("checked_order", "id")).alias("__best"))
    side = best.select(F.col("product_id").alias("id"), F.col("__best.id").alias("brand_id"))
    return product.drop("brand_id").join(side, "id", "left")


def brand_product_count(product: DataFrame, brand: DataFrame) -> DataFrame:
    """Products per brand; a brand without products counts 0."""
    counted = product.filter(F.col("brand_id").isNotNull()).groupBy("brand_id").agg(F.count(F.lit(1)).alias("product_count"))
    out = brand.select(F.col("id").alias("brand_id")).join(counted, "brand_id", "left")
    return out.withColumn("product_count", F.coalesce("product_count", F.lit(0).cast("bigint")))
