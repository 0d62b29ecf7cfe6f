"""Fixed schemas of the files and tables the operators read.

Nothing is inferred: file schemas are positional and every reader passes one
of these.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Product feed: headerless, positional. Everything is read as text and typed
# by ``operators.catalogue.parse_feed`` so a bad cell rejects one row only.
FEED_COLUMNS = [
    "default_code",
    "name",
    "description_sale",
    "pack_cost",
    "upv",
    "weight",
    "volume",
    "wholesaler_bulk",
    "retail_bulk",
    "image_name",
    "warranty",
    "iva",
    "item_code",
    "write_date",
]

CORRUPT = "_corrupt_record"


def text_schema(columns: list[str], corrupt: bool = False) -> T.StructType:
    fields = [T.StructField(c, T.StringType()) for c in columns]
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType()))
    return T.StructType(fields)


FEED = text_schema(FEED_COLUMNS, corrupt=True)
CODE_NAME = text_schema(["code", "name"])
ITEM_FILE = text_schema(["code", "name", "origin", "section_code", "family_code", "margin"])
BARCODE_FILE = text_schema(["barcode", "product_code", "uxb"])

# One worksheet cell keeps its type, because the rules depend on it.
CELL = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("num", T.DoubleType()),
        T.StructField("kind", T.StringType()),  # 'text', 'float', 'int' or NULL when empty
    ]
)

SHEET_COLUMNS = [
    "default_code",
    "currency",
    "cost",
    "price",
    "name",
    "purchase_tax",
    "sale_tax",
    "barcode",
    "meli",
    "parent",
]

SHEET = T.StructType(
    [
        T.StructField("vendor_ref", T.StringType()),
        T.StructField("sheet_no", T.IntegerType()),
        T.StructField("row_no", T.IntegerType()),
    ]
    + [T.StructField(c, CELL) for c in SHEET_COLUMNS]
)
