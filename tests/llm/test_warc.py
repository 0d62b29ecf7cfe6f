"""Archives written and read back."""

import base64
import hashlib
import re

import pytest

from costloom.llm import warc
from costloom.llm.common import prepare, shared_path

EVIL = "<p>" + warc.MAGIC + "WARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" + warc.MAGIC + "Content-Length: 3\r\n\r\nabc\r\n\r\n</p>"


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("split", ["2000", "128m"])
def test_round_trip(spark, split):
    prepare(spark)
    rows = [(i, f"http://x/{i}", EVIL + str(i % 4) if i % 5 == 0 else "é" * i if i % 7 else "same") for i in range(60)] + [(500, None, None), (501, "a\r\nb", ""), (502, "u", warc.MAGIC)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = {r["page_id"]: r for r in warc.round_trip(pages).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == len(rows)
    first = {}
    for i, _, html in rows:
        first.setdefault(html or "", i)
    for i, _, html in rows:
        r, f = got[i], first[html or ""]
        assert (r["payload_bytes"], r["payload_digest"]) == (len((html or "").encode()), sha(html))
        assert (r["record_type"], r["refers_to"]) == (("response", None) if f == i else ("revisit", f))


def test_records_have_what_the_format_requires(spark):
    rows = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (2, "http://a/2", "same"), (None, "u", "x"), (None, "u", "x"), (4, None, None)]
    path = shared_path(spark, "warc-test")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    found = [warc._fields(bytes(r["head"])) for r in warc.read_warc(spark, path, with_payload=False).collect()]
    assert len(found) == 6
    ids = [f["warc-record-id"] for f in found]
    assert len(set(ids)) == 6 and all(re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", i) for i in ids)
    for f in found:
        assert {"warc-type", "warc-record-id", "warc-date", "content-length"} <= set(f)
        assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", f["warc-date"])
        if f["warc-type"] == "revisit":
            assert f["warc-refers-to-target-uri"] == "http://a/1" and "warc-refers-to-date" in f and f["warc-profile"] == warc.PROFILE
            assert f["x-page-id"] == "2" and f["x-refers-to-page"] == "1"


def test_payloads_come_back(spark):
    rows = [(1, "u", EVIL), (2, "u", "plain ä"), (3, "u", "")]
    path = shared_path(spark, "warc-test")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    got = warc.read_warc(spark, path).collect()
    assert sorted(bytes(r["payload"]).decode() for r in got) == sorted(x for _, _, x in rows)


def test_odd_rows(spark):
    rows = [(None, "u", "x"), (7, "u", "y"), (7, "u", "y"), (8, "u", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'own' AS digest", "1 AS first")
    got = sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in warc.round_trip(pages).collect())
    assert got == [("7", "response", None), ("7", "response", None), ("8", "revisit", 7), ("None", "response", None)]
    assert warc.round_trip(pages.filter("false")).collect() == []
    small = warc.round_trip(pages, least_bytes=2).collect()
    assert {r["record_type"] for r in small} == {"response"}
