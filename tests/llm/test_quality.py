"""The additive model: look-ups, trees by brute force, held-out accuracy, and odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from costloom.llm import quality
from costloom.llm.common import prepare, table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return table(spark, SF, "documents")


def loss(y, z):
    return float(np.mean(np.log1p(np.exp(-np.where(y > 0, z, -z)))))


def test_held_out(spark, docs):
    labels = table(spark, SF, "labels")
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = quality.predict_held_out(docs, labels).collect()
    assert len(rows) == docs.count()
    assert {r["doc_id"] for r in rows if r["held_out"]} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1}
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    bad = [p for p, t in held if t == 0]
    good = [p for p, t in held if t == 1]
    assert len(bad) >= 10 and len(good) >= 50
    assert sum(p == 0 for p in bad) >= 0.9 * len(bad)
    assert sum(p == 1 for p in good) >= 0.98 * len(good)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_held_out_labels_do_not_matter(spark, docs):
    labels = table(spark, SF, "labels")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    some = docs.filter("doc_id < 100")
    got = [sorted(map(tuple, quality.predict_held_out(some, x).collect())) for x in (labels, turned)]
    assert got[0] == got[1]


def test_scores_are_sums_of_table_values():
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(600, 4)), 1)
    y = (x[:, 0] + (x[:, 1] > 0) * (x[:, 2] > 0) * 3 + rng.normal(size=600) * 0.3 > 1).astype(float)
    model = quality.boosted(x, y, rounds=40, pairs=2, pair_rounds=30)
    got = model.log_odds(x)
    for r in range(0, 600, 37):
        want = model.intercept + sum(t[sum(e <= x[r, j] for e in edge)] for j, (edge, t) in enumerate(zip(model.edges, model.tables, strict=True)))
        want += sum(t[sum(e <= x[r, i] for e in a), sum(e <= x[r, j] for e in b)] for i, j, a, b, t in model.pairs)
        assert abs(want - got[r]) < 1e-9
    # The pair that interacts is found, and its table lowers the loss.
    assert (1, 2) in {(i, j) for i, j, *_ in model.pairs}
    alone = quality.boosted(x, y, rounds=40, pairs=0, pair_rounds=0)
    assert loss(y, got) < loss(y, alone.log_odds(x)) < loss(y, np.full(600, alone.intercept))


def test_tree_cuts_where_brute_force_does():
    rng = np.random.default_rng(5)
    for _ in range(50):
        g, h, n = rng.normal(size=9), rng.uniform(1, 3, 9), rng.integers(0, 20, 9)
        part = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + quality.RIDGE)  # noqa: B023, E731
        able = [(part(0, c) + part(c, 9) - part(0, 9), c) for c in range(1, 9) if n[:c].sum() >= quality.LEAST and n[c:].sum() >= quality.LEAST]
        gain, cut = quality.split_of(g, h, n)
        assert (gain, cut) == pytest.approx(max(able)) if able and max(able)[0] > 1e-9 else not cut
        values = quality.tree(g, h, n, cuts=1)
        assert len(set(values)) <= 2 and (not cut or len(set(values[:cut])) == len(set(values[cut:])) == 1)


def test_pair_tree_gain_is_that_of_its_leaves():
    rng = np.random.default_rng(6)
    g, h, n = rng.normal(size=(4, 5)), rng.uniform(1, 3, (4, 5)), rng.integers(5, 20, (4, 5))
    gain, values = quality.pair_tree(g, h, n)
    leaves = [values == v for v in np.unique(values)]
    assert 1 < len(leaves) <= 4
    want = sum(g[x].sum() ** 2 / (h[x].sum() + quality.RIDGE) for x in leaves) - g.sum() ** 2 / (h.sum() + quality.RIDGE)
    assert gain == pytest.approx(want)


def test_measures():
    got = dict(zip(quality.MEASURES, quality.measured("AB cd1 é#.\nx!\nx!"), strict=True))
    assert got["words"] == pytest.approx(np.log(6)) and got["lines"] == pytest.approx(np.log(4))
    assert got["symbols"] == 1 / 16 and got["beyond"] == 1 / 16 and got["upper_words"] == 0.2 and got["symbol_words"] == 0.2
    assert got["line_repeats"] == pytest.approx(1 / 3) and got["line_ends"] == 1 and got["distinct"] == 0.8 and got["top_word"] == 0.4
    assert quality.measured("") == quality.measured(" \n ") == [0.0] * len(quality.MEASURES)
    assert all(np.isfinite(quality.measured(t)).all() for t in ("a", "\x00", " x", "#" * 500_000, "a b " * 200_000))


def test_odd_rows(spark):
    prepare(spark)
    schema = "doc_id long, text string, score string, quality int"
    rows = [(1, None, "x", 1), (2, "", "x", 0), (3, "a b " * 60_000, "x", 1), (None, "a", "x", 0), (3, "a b " * 60_000, "x", 1), (5, "b.", None, None)]
    odd = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (2, 1), (3, 1), (None, 1), (5, None), (6, 7)], "doc_id long, quality int")
    got = quality.predict_held_out(odd, labels).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 3}) == 1
    # Of equal texts, a null and an empty one, the scores are equal.
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1
    assert quality.predict_held_out(odd.filter("false"), labels).count() == 0
    assert {r["score"] for r in quality.predict_held_out(odd, labels.filter("false")).collect()} == {0.5}


def test_a_smaller_bound_keeps_the_class_shares(spark, docs):
    labels = table(spark, SF, "labels")
    x = np.array([quality.measured(r["text"]) for r in docs.limit(200).collect()])
    whole, part = (quality.fit(docs, labels, rows=n).probability(x) for n in (10_000, 150))
    assert abs(whole.mean() - part.mean()) < 0.1 and ((whole >= 0.5) == (part >= 0.5)).mean() > 0.95
