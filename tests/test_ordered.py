"""Ordered scans: the chunked path equals the plain one, whatever the threshold."""

import random

import pytest
from pyspark.sql import functions as F

from costloom.functions.ordered import Running, asof_by_day, in_chunks, ordered_scan, top_k


def plain(rows, reverse):
    """One pass per key in Python."""
    out = {}
    by_key = {}
    for k, a, b, v in rows:
        by_key.setdefault(k, []).append((a, b, v))
    for k, items in by_key.items():
        total, peak, last = None, None, None
        for a, b, v in sorted(items, reverse=reverse):
            before = (total, peak, last)
            if v is not None:
                total = v if total is None else total + v
                peak = v if peak is None else max(peak, v)
                last = v
            out[(k, a, b)] = (total, peak, last, *before)
    return out


@pytest.mark.parametrize("reverse", [False, True])
def test_scan_matches_loop(spark, parts, reverse):
    rng = random.Random(parts + reverse)
    # Key 0 holds a third of all rows.
    rows = [(0 if rng.random() < 0.33 else rng.randrange(1, 9), rng.randrange(6), i, None if rng.random() < 0.2 else rng.randrange(-50, 50)) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, a int, b int, v long")
    v = F.col("v")
    running = [Running(f"{kind}{'_before' * x}", kind, v, bool(x)) for x in (0, 1) for kind in ("sum", "max", "last")]
    got = ordered_scan(df, ["k"], ["a", "b"], running, reverse)
    assert set(got.columns) == {"k", "a", "b", "v", *[r.name for r in running]}
    result = {(r.k, r.a, r.b): (r.sum, r.max, r.last, r.sum_before, r.max_before, r.last_before) for r in got.collect()}
    assert result == plain(rows, reverse)


def test_a_key_is_spread_over_chunks(spark, parts):
    df = spark.range(2000).select(F.when(F.col("id") % 20 == 0, F.col("id")).otherwise(-1).alias("k"), "id")
    sizes = in_chunks(df, ["k"], ["id"]).df.filter("k = -1").groupBy("__chunk").count().collect()
    assert len(sizes) >= min(parts, 0.8 * parts) and max(r["count"] for r in sizes) <= 2.2 * 2000 / parts


def test_peaks_and_whole_values(spark, parts):
    rng = random.Random(parts)
    rows = [(None if rng.random() < 0.4 else rng.randrange(1, 9), i, rng.randrange(0, 9), rng.randrange(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, i int, a long, b long")
    short = F.col("sb") - F.col("sa")
    running = [Running("sa", "sum", F.col("a"), whole="all_a"), Running("sb", "sum", F.col("b")), Running("p", "peak", short, whole="all_p"), Running("q", "peak", short, exclusive=True)]
    got = {r.i: (r.sa, r.sb, r.p, r.q, r.all_a, r.all_p) for r in ordered_scan(df, ["k"], ["i"], running).collect()}
    for key in {r[0] for r in rows}:
        mine, sa, sb, peak = [r for r in rows if r[0] == key], 0, 0, None
        want = {}
        for _, i, a, b in mine:
            sa, sb, before = sa + a, sb + b, peak
            peak = sb - sa if peak is None else max(peak, sb - sa)
            want[i] = (sa, sb, peak, before)
        assert {i: got[i] for i in want} == {i: (*v, sa, peak) for i, v in want.items()}


def test_a_null_key_in_two_chunks_is_whole(spark, parts):
    """The chunk where the NULL key ends also holds other keys, wherever the ranges are cut."""
    for nulls in (90, 110, 130):
        df = spark.createDataFrame([(None if i < nulls else i, i) for i in range(300)], "k int, i int")
        rows = ordered_scan(df, ["k"], ["i"], [Running("n", "sum", F.lit(1), whole="all")]).collect()
        assert {(r.i, r.n, r.all) for r in rows} == {(i, i + 1, nulls) if i < nulls else (i, 1, 1) for i in range(300)}


def test_top_k_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    best = top_k(df, ["k"], [F.col("id").desc()], 2)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert sorted(r.id for r in best.collect()) == [994, 995, 996, 997, 998, 999]


def test_asof_by_day_both_ways(spark):
    asked = spark.createDataFrame([(1, "2020-01-05"), (1, "2020-01-01"), (2, "2020-01-05")], "k int, d string").select("k", F.col("d").cast("date").alias("d"))
    facts = spark.createDataFrame([(1, "2020-01-03", 3), (1, "2020-01-05", 5), (1, "2020-01-09", 9)], "k int, d string, v int").select("k", F.col("d").cast("date").alias("d"), "v")
    before = {(r.k, str(r.d)): r.v for r in asof_by_day(asked, facts, ["k"], "d", "v").collect()}
    after = {(r.k, str(r.d)): r.v for r in asof_by_day(asked, facts, ["k"], "d", "v", following=True).collect()}
    assert before == {(1, "2020-01-05"): 5, (1, "2020-01-01"): None, (2, "2020-01-05"): None}
    assert after == {(1, "2020-01-05"): 5, (1, "2020-01-01"): 3, (2, "2020-01-05"): None}
