"""Exact products, heaps, and hard negatives against brute force."""

import math

import numpy as np
import pytest

from costloom.llm import negatives
from costloom.llm.common import prepare, table


@pytest.mark.parametrize("shape", [(1, 1, 1), (0, 4, 3), (5, 3, 7), (64, 64, 64), (33, 65, 100), (129, 40, 257)])
@pytest.mark.parametrize("leaf", [1, 4, 16])
def test_product_is_exact(shape, leaf):
    rng = np.random.default_rng(sum(shape) + leaf)
    m, k, n = shape
    a, b = rng.integers(-(1 << 27), 1 << 27, (m, k)), rng.integers(-(1 << 27), 1 << 27, (k, n))
    assert (negatives.strassen(a, b, leaf) == a @ b).all()


def test_additions_may_wrap():
    a = np.full((8, 8), 1 << 62)
    b = np.zeros((8, 8), np.int64)
    b[0] = 1
    assert (negatives.strassen(a, b, 1) == a @ b).all()


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(2)
    own, score, ids = rng.integers(0, 7, 500), rng.integers(-5, 5, 500), rng.integers(0, 60, 500)
    want = [sorted(zip(-score[own == o], ids[own == o], strict=True))[:4] for o in range(7)]
    for step in (1, 13, 500):
        heaps = negatives.Heaps(7, 4)
        for i in range(0, 500, step):
            heaps.merge(own[i : i + step], score[i : i + step], ids[i : i + step])
        assert [list(zip(-heaps.score[heaps.own == o], heaps.id[heaps.own == o], strict=True)) for o in range(7)] == want


def brute(rows, every=100, shift=7):
    """The contract, row by row."""
    sound = []
    for i, vec, label in rows:
        if None in (i, vec, label) or any(c is None or not math.isfinite(c) for c in vec):
            continue
        sound.append((i, (label + 1) % 10 if i % shift == 0 else label, [math.floor(256 * c) for c in vec]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, label, vec in sound:
        if i % every:
            continue
        scored = sorted((-dot(vec, v), j, other) for j, other, v in sound)
        for p, j, _ in [s for s in scored if s[2] == label and s[1] != i][:5]:
            near = [s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(i, j, n + 1, s[1], -p, -s[0]) for n, s in enumerate(near)]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


@pytest.mark.parametrize("blocks", [None, (40, 60)])
def test_against_brute_force(spark, monkeypatch, blocks):
    prepare(spark)
    if blocks:
        monkeypatch.setattr(negatives, "ANCHORS", 2)
        monkeypatch.setattr(negatives, "CANDIDATES", blocks)
        monkeypatch.setattr(negatives, "TILE", (3, 17))
    df = table(spark, "/root/testdata/sf0.001", "embeddings")
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in df.collect()]
    want = brute(rows, every=20)
    assert want and got(negatives.hard_negatives(df, anchor_every=20)) == want


def test_ties_and_odd_rows(spark):
    prepare(spark)
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 0.0], 3), (200, [1.0, 0.5], 3), (300, [], 4)]
    rows += [(i, [1.0, 0.0], 3) for i in (1, 2, 3, 4, 5, 6, 8)] + [(i, [0.9, 0.1], 5) for i in (11, 12, 13, 15, 16, 17)] + [(18, [0.9, 0.1], 3)]
    rows += [(20, [1.0], 5), (22, [-1.0, 0.0], 3), (23, [0.0, 0.0], 6), (24, [], 7)]
    odd = [(None, [1.0, 0.0], 3), (30, None, 3), (31, [1.0, 0.0], None), (32, [1.0, None], 5), (33, [nan, 0.0], 5), (34, [inf, 0.0], 5), (35, [-inf, 0.0], 5)]
    schema = "vec_id long, embedding array<float>, label int"
    df = spark.createDataFrame(rows + odd, schema)
    want = brute(rows)
    assert {r[0] for r in want} >= {100, 200} and got(negatives.hard_negatives(df)) == want
    # Other columns do not matter, whatever their names.
    more = df.selectExpr("*", "1 as a", "2 as anchors", "3 as x", "'y' as rank")
    assert got(negatives.hard_negatives(more)) == want
    # Repeated candidates are ranked one by one; repeated anchors repeat their rows.
    twice = brute(rows + rows[10:12])
    assert got(negatives.hard_negatives(spark.createDataFrame(rows + rows[10:12], schema))) == twice
    again = got(negatives.hard_negatives(spark.createDataFrame(rows + rows[:1], schema)))
    assert [r for r in again if r[0] == 100] == sorted(2 * [r for r in want if r[0] == 100])
    assert got(negatives.hard_negatives(df.filter("false"))) == []
    assert got(negatives.hard_negatives(df.filter("vec_id % 100 > 0"))) == []


def test_vectors_too_long_to_be_exact_are_refused(spark):
    prepare(spark)
    df = spark.createDataFrame([(100, [2.0**21], 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="scaled vector"):
        negatives.hard_negatives(df).count()
