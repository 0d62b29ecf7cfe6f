"""File sources: product feed, lookups, items, barcodes, supplier sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import py_strip
from ..functions.ordered import top_k
from ..schemas import BARCODE_FILE, CODE_NAME, CORRUPT, FEED, ITEM_FILE, SHEET

CSV = {"header": "false", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "encoding": "UTF-8"}
# Rows of a wrong width are only noticed when every column is parsed.
CSV["columnPruning"] = "false"

_PLACE = "__place"


def read_product_feed(spark: SparkSession, path: str) -> DataFrame:
    """Fourteen text columns and the raw text of rows with another width."""
    return spark.read.schema(FEED).options(**CSV).csv(path)


def _last_row_wins(df: DataFrame, key: str) -> DataFrame:
    """The last row of each key in file order.

    A row is placed by file, then block, then its number in the task that reads
    the block.
    """
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    placed = df.withColumn(_PLACE, place)
    return top_k(placed, [key], [F.col(_PLACE).desc()]).drop(_PLACE)


def read_code_names(spark: SparkSession, path: str) -> DataFrame:
    """Code and name; the last row of a repeated code wins."""
    return _last_row_wins(spark.read.schema(CODE_NAME).options(**CSV).csv(path), "code")


read_sections = read_code_names
read_families = read_code_names


def read_items(
    spark: SparkSession, path: str, sections: DataFrame, families: DataFrame, origin_from_code: bool = False
) -> DataFrame:
    """Items with section and family names, trimmed; last row of a code wins.

    ``origin_from_code`` fills origin from the code column, as older loads did.
    """
    raw = spark.read.schema(ITEM_FILE).options(**CSV).csv(path)
    section = sections.select(F.col("code").alias("section_code"), F.col("name").alias("section"))
    family = families.select(F.col("code").alias("family_code"), F.col("name").alias("family"))
    items = raw.withColumn("code", py_strip(F.col("code")))  # before the last row of a code is chosen
    items = _last_row_wins(items, "code").join(section, "section_code", "left").join(family, "family_code", "left")
    return items.select(
        "code",
        py_strip(F.col("name")).alias("name"),
        (F.col("code") if origin_from_code else py_strip(F.col("origin"))).alias("origin"),
        py_strip(F.col("section")).alias("section"),
        py_strip(F.col("family")).alias("family"),
        F.expr("try_cast(trim(margin) AS double)").alias("margin"),
    )


def read_barcodes(spark: SparkSession, path: str) -> DataFrame:
    """One trimmed row per barcode; a product may have many.

    Kept flat instead of gathered per product, so no product can grow without
    bound. ``operators.catalogue.duplicate_barcodes`` finds repeats.
    """
    raw = spark.read.schema(BARCODE_FILE).options(**CSV).csv(path)
    return raw.select(
        py_strip(F.col("product_code")).alias("product_code"),
        py_strip(F.col("barcode")).alias("barcode"),
        F.expr("try_cast(trim(uxb) AS int)").alias("uxb"),
    )


def read_supplier_sheets(spark: SparkSession, path: str, upload_id: str = "") -> DataFrame:
    """Staged supplier price rows (parquet, ``vendor_ref`` a column of the files or a folder each).

    Every cell is a struct of text, number and kind, because the rules depend on
    the cell type. Rows with an empty code are skipped.
    """
    rows = spark.read.schema(SHEET).parquet(path)
    return rows.filter(F.col("default_code.kind").isNotNull()).withColumn("upload_id", F.lit(upload_id))
