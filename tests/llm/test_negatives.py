"""Hard negatives against a direct computation in whole numbers."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.llm.hard_negatives import Lists, best, field_bits, hard_negatives, packed_product

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute(rows, every, positives=5, negatives=10, low=30, high=90, scale=256):
    live = [(i, lab, [math.floor(scale * float(x)) for x in v]) for i, lab, v in rows
            if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (i, lab, v) in enumerate(live):
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, same) for n, (j, same, w) in enumerate(live) if n != at)
        for s, j, _ in [x for x in scored if x[2] == lab][:positives]:
            fit = [x for x in scored if x[2] != lab and low * -s <= 100 * -x[0] <= high * -s][:negatives]
            out += [(i, j, r, x[1], -s, -x[0]) for r, x in enumerate(fit, 1)]
    return sorted(out)


def check(spark, rows, every=10, schema=SCHEMA, **kw):
    df = spark.createDataFrame(rows, schema).repartition(4)
    out = hard_negatives(df, F.col("vec_id") % every == 0, **kw)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = sorted(tuple(r) for r in out.collect())
    assert got == brute(rows, every, **{k: v for k, v in kw.items() if k != "anchor_block"})
    return got


def vectors(rng, n, dims=8):
    return [(i, rng.randrange(4), np.float32([abs(rng.gauss(0.3, 0.4)) for _ in range(dims)]).tolist()) for i in rng.sample(range(-n, 2 * n), n)]


@pytest.mark.parametrize("block", [7, 10_000])
def test_random_vectors(spark, block):
    got = check(spark, vectors(random.Random(block), 300), anchor_block=block)
    assert len(got) > 500


def test_many_equal_vectors(spark):
    rng = random.Random(3)
    one = [0.5, 0.25, 0.125, 0.75]
    rows = vectors(rng, 120, 4) + [(1000 + i, i % 3, one) for i in range(200)] + [(2000 + i, i % 3, [x * 0.6 for x in one]) for i in range(200)]
    check(spark, rows, every=20)


def test_odd_rows(spark):
    rng = random.Random(4)
    rows = vectors(rng, 80)
    rows += [(None, 1, rows[0][2]), (500, None, rows[0][2]), (510, 1, None), (520, 1, [0.5, None]), (530, 2, [float("nan")] * 8),
             (540, 2, [float("inf")] + [0.5] * 7), (550, 3, []), (560, 1, [0.9]), (570, 1, [0.1] * 20), (580, 77, [0.5] * 8)]
    rows += [rows[3], rows[3]] + [(590, 0, [-0.4] * 8), (600, 1, [-0.2] * 8)]
    check(spark, rows)
    twice = [(0, 1, [0.5, 0.5]), (0, 1, [0.5, 0.5]), (3, 2, [0.25, 0.25]), (4, 2, [0.3, 0.3])]
    assert len(check(spark, twice)) == 4


def test_empty_table_and_further_columns(spark):
    assert hard_negatives(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 100 == 0).collect() == []
    rows = vectors(random.Random(6), 60)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"row": F.lit("x"), "parts": F.lit(1), "rank": F.lit(None), "score": F.lit(2), "tag": F.lit(0)})
    assert sorted(tuple(r) for r in hard_negatives(df, F.col("vec_id") % 10 == 0).collect()) == brute(rows, 10)


def test_wide_components(spark):
    rng = random.Random(7)
    rows = [(i, i % 2, [rng.uniform(0, 900_000.0) for _ in range(5)]) for i in range(60)]
    check(spark, rows, schema="vec_id int, label int, embedding array<double>")
    with pytest.raises(ValueError, match="64 bits"):
        hard_negatives(spark.createDataFrame([(0, 1, [1e30])], SCHEMA), F.col("vec_id") >= 0)


@pytest.mark.parametrize("most", [0, 1, 3, 160, 5000, 2**20, 2**28])
def test_packed_product_is_exact(most):
    rng = np.random.default_rng(most)
    a, b = (rng.integers(-most, most + 1, (n, 17)) for n in (9, 23))
    a[0], b[0], b[1] = most, most, -most
    assert (packed_product(a, b, most) == a @ b.T).all()
    assert most != 160 or field_bits(17, most) * 2 <= 53  # several candidates to a word


def test_best_breaks_ties_by_place():
    score = np.array([[5, 7, 7, 7, 1], [2, 2, 2, 2, 2]])
    a, j = best(score, np.array([[True] * 5, [False, True, True, True, False]]), 2)
    assert sorted(zip(a.tolist(), j.tolist())) == [(0, 1), (0, 2), (1, 1), (1, 2)]
    huge = score * 2**58
    a, j = best(huge, np.ones((2, 5), bool), 2)
    assert sorted(zip(a.tolist(), j.tolist())) == [(0, 1), (0, 2), (1, 0), (1, 1)]


def test_lists_keep_the_first():
    lists = Lists(2)
    lists.add(*map(np.array, ([0, 0, 1], [5, 9, 3], [1, 2, 3], [1, 2, 3])))
    lists.add(*map(np.array, ([0, 1], [9, 4], [1, 9], [7, 8])))
    assert lists.of.tolist() == [0, 0, 1, 1] and lists.vec_id.tolist() == [1, 2, 9, 3]
    assert lists.floor(3).tolist()[:2] == [9, 3] and lists.floor(3)[2] < -10**18
