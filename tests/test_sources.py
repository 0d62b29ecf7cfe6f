"""Readers, the row parser and the sinks on small literal files."""

import datetime as dt
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from costloom import sinks
from costloom.operators import catalogue
from costloom.plans import QUERIES
from costloom.schemas import FEED_COLUMNS, SHEET_COLUMNS
from costloom.sources import files

GOOD = ["10.7811", "NUT, 3/4 W", "NUT 3/4", "897.68", "100", "21.000", ".000", "25", "25", "", "0", "21.00", "102", "2018-01-26 16:13:21"]


def feed(spark, *changes):
    rows = [[change.get(c, v) for c, v in zip(FEED_COLUMNS, GOOD)] for change in changes]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in FEED_COLUMNS))


def write(path, name, text):
    target = path / name
    target.write_text(text, encoding="utf-8")
    return str(target)


def test_good_row_is_typed_with_defaults(spark):
    row = catalogue.good_rows(catalogue.parse_feed(feed(spark, {}))).collect()[0]
    assert round(row.cost, 2) == 8.98 and row.upv == 100 and row.volume == 0.0
    assert row.write_date == dt.datetime(2018, 1, 26, 16, 13, 21)
    assert (row.type, row.invoice_policy, row.purchase_method) == ("product", "order", "purchase")


def test_each_bad_cell_rejects_only_its_row(spark):
    bad = [
        {"name": "broken � name"},
        {"upv": "ten"},
        {"pack_cost": "abc"},
        {"weight": "1d"},
        {"pack_cost": "NaN"},
        {"upv": "0"},
        {"upv": ""},
        {"wholesaler_bulk": ""},
        {"retail_bulk": "1.5"},
        {"write_date": "2018-25-01 10:00:00"},
    ]
    parsed = catalogue.parse_feed(feed(spark, {}, {"pack_cost": "", "iva": ""}, {"warranty": " 1e2 "}, *bad))
    assert catalogue.good_rows(parsed).count() == 3
    assert catalogue.reject_rows(parsed).count() == len(bad)


def test_feed_file_quotes_width_and_daily_split(spark, tmp_path):
    lines = ['A,"NUT, 3/4","say ""hi""",10,1,,,1,1,,0,21,102,2018-01-26 16:13:21', "B,short,row", 'C,x,,5,1,,,1,1,,0,21,102,2018-08-30 22:02:18']
    raw = files.read_product_feed(spark, write(tmp_path, "data.csv", "\n".join(lines)))
    assert [r.default_code for r in catalogue.feed_width_check(raw).collect()] == ["B"]
    whole = raw.filter("_corrupt_record IS NULL")
    out = str(tmp_path / "daily")
    sinks.write_daily(whole, out)
    assert {r.day for r in spark.read.option("basePath", out).csv(out).select(F.col("day").cast("string").alias("day")).collect()} == {"2018-01-26", "2018-08-30"}
    back = {r.default_code: r for r in files.read_product_feed(spark, out).collect()}
    assert back["A"].name == "NUT, 3/4" and back["A"].description_sale == 'say "hi"'
    assert [r.default_code for r in catalogue.newer_than(whole, "2018-02-01").collect()] == ["C"]
    assert catalogue.newer_than(whole).count() == 2


def test_daily_files_hold_the_same_cells_in_fewer_bytes(spark, tmp_path):
    odd = ["", None, 'say "hi"', "a, b", " padded ", "ñ\\", '"', "back\\slash", "#x"]
    days = ["2018-01-26 10:00:00", "2018-01-27 10:00:00", "", None, "no date"]
    rows = [tuple(odd[(n + i) % len(odd)] for i in range(13)) + (days[n % 5],) for n in range(3000)]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in FEED_COLUMNS))
    out, plain = str(tmp_path / "daily"), str(tmp_path / "plain")
    sinks.write_daily(raw, out)
    raw.write.option("quoteAll", "false").option("escape", '"').csv(plain)
    cells = lambda path: sorted(map(str, files.read_product_feed(spark, path).select(*FEED_COLUMNS).collect()))
    assert cells(out) == cells(plain)
    size = lambda path: sum(f.stat().st_size for f in Path(path).rglob("part-*"))
    assert 0 < 4 * size(out) < size(plain)


def test_items_trim_resolve_and_last_row_wins(spark, tmp_path):
    sections = files.read_sections(spark, write(tmp_path, "section.csv", "1,Bolts\n1,Bulonería\n2,Tools\n"))
    families = files.read_families(spark, write(tmp_path, "family.csv", "ARA,WASHERS \n"))
    path = write(tmp_path, "item.csv", "102,WASHER   ,Nacional,1,ARA,.5\n106,SAW,Nacional,9,XXX,.5\n102 ,WASHER 2\t,Nacional,1,ARA,.6\n")
    rows = {r.code: r for r in files.read_items(spark, path, sections, families).collect()}
    assert (rows["102"].name, rows["102"].section, rows["102"].family, rows["102"].margin) == ("WASHER 2", "Bulonería", "WASHERS", 0.6)
    assert rows["102"].origin == "Nacional" and rows["106"].section is None
    old = {r.code: r.origin for r in files.read_items(spark, path, sections, families, origin_from_code=True).collect()}
    assert old["102"] == "102"


def test_barcodes_are_flat_and_repeats_are_found(spark, tmp_path):
    codes = files.read_barcodes(spark, write(tmp_path, "codes.csv", " 779 ,A,25\n780,A,25\n779,B,1\n"))
    assert sorted((r.product_code, r.barcode, r.uxb) for r in codes.collect()) == [("A", "779", 25), ("A", "780", 25), ("B", "779", 1)]
    assert [(r.barcode, r.n_rows) for r in catalogue.duplicate_barcodes(codes).collect()] == [("779", 2)]


def test_protected_codes_are_created_but_never_updated(spark):
    current = spark.createDataFrame([("996.1", "old", 1)], "default_code string, name string, id long")
    rows = feed(spark, {"default_code": "996.1", "name": "new"}, {"default_code": "996.2"}, {"default_code": "A", "name": "x"}, {"default_code": "A", "name": "y", "write_date": "2019-01-01 00:00:00"})
    good = catalogue.good_rows(catalogue.parse_feed(rows))
    assert {r.default_code for r in catalogue.protected_prefix(good, current).collect()} == {"996.2", "A"}
    out = {r.default_code: r for r in catalogue.upsert_products(current, good, ["name"]).collect()}
    assert {k: v.action for k, v in out.items()} == {"996.1": "protected", "996.2": "created", "A": "created"}
    assert out["996.1"].name == "old" and out["A"].name == "y"


@pytest.mark.parametrize("free_masks", [10, 0])
def test_brand_masks(spark, free_masks):
    product = spark.createDataFrame([(1, "AB-10"), (2, "AB-2"), (3, "X_1"), (4, "Q"), (5, None)], "id long, default_code string")
    brand = spark.createDataFrame([(1, "AB-%", 1), (2, "%-1_", 2), (3, "X\\_%", 1), (4, "AB-2", 0)], "id long, mask string, checked_order int")
    got = {r.id: r.brand_id for r in catalogue.assign_brands(product, brand, free_masks=free_masks).collect()}
    assert got == {1: 2, 2: 1, 3: 3, 4: None, 5: None}


def test_snapshot_written_twice_is_one_row(spark, tmp_path):
    path = str(tmp_path / "kpi")
    row = spark.createDataFrame([(dt.date(2020, 1, 31), 5.0)], "date date, payable double")
    other = spark.createDataFrame([(dt.date(2020, 2, 29), 6.0)], "date date, payable double")
    for df in (row, other, row):
        sinks.append_kpi_month(df, path)
    assert spark.read.parquet(path).count() == 2


def test_stock_export_has_header_and_quotes(spark, tmp_path):
    path = tmp_path / "export"
    row = spark.createDataFrame([("A", 'n "1"', "V", 1.0, 2.0, "S/Fact", 3.0, 4.0)], ", ".join(f"{c} {'string' if c in ('code', 'name', 'vendor', 'invoiced') else 'double'}" for c in sinks.STOCK_HEADER))
    sinks.export_stock_csv(row, str(path))
    parts = [p.read_text() for p in path.glob("part-*")]
    assert {t.splitlines()[0] for t in parts} == {",".join(f'"{h}"' for h in sinks.STOCK_HEADER.values())}
    assert '"S/Fact"' in "".join(parts)


def test_staged_sheets_are_files_of_many_vendors(spark, tmp_path):
    cells = [F.struct(F.lit("x").alias("text"), F.lit(None).cast("double").alias("num"), F.lit("text").alias("kind")).alias(c) for c in SHEET_COLUMNS]
    vendor = F.when(F.col("id") % 50 != 0, F.concat(F.lit("V"), F.col("id") % 97))
    rows = spark.range(0, 400, numPartitions=8).select(vendor.alias("vendor_ref"), F.lit(1).alias("sheet_no"), F.col("id").cast("int").alias("row_no"), *cells)
    sinks.write_supplier_sheets(rows, f"{tmp_path}/files")
    assert len(list((tmp_path / "files").rglob("*.parquet"))) <= 8
    rows.write.partitionBy("vendor_ref").parquet(f"{tmp_path}/folders")
    want = sorted((r.row_no, r.vendor_ref) for r in rows.collect())
    for layout in ("files", "folders"):
        got = files.read_supplier_sheets(spark, f"{tmp_path}/{layout}", "A").collect()
        assert sorted((r.row_no, r.vendor_ref) for r in got) == want


def test_the_sheet_query_writes_no_folder_a_vendor(spark):
    assert QUERIES["supplier_sheet_files"](spark, "/root/testdata/sf0.001").count() > 0
    assert not list(Path(spark.conf.get("spark.checkpoint.dir")).rglob("vendor_ref=*"))
