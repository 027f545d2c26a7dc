"""The distributed ranking helpers equal the single-window / pandas reference."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cairn.functions import ranking
from cairn.functions.ranking import avg_rank_pct, ordered_running, qcut_rank_bin, value_prefix


def _frame(spark, n=3000, seed=7, hot=True):
    rng = np.random.default_rng(seed)
    v = rng.integers(0, 40, n).astype(float)
    if hot:
        v[: n // 3] = 17.0  # one value holds a third of the rows
    pdf = pd.DataFrame({"id": np.arange(n), "v": v, "w": rng.integers(0, 5, n).astype(float),
                        "g": rng.choice(["a", "b", "c"], n)})
    return pdf, spark.createDataFrame(pdf).repartition(7)


def test_avg_rank_pct_matches_pandas(spark):
    pdf, df = _frame(spark)
    got = avg_rank_pct(df, "v", "pct", nb=5).toPandas().set_index("id").sort_index()
    want = pdf.set_index("id")["v"].rank(method="average", pct=True)
    assert np.allclose(got["pct"].to_numpy(), want.to_numpy(), rtol=0, atol=1e-15)


def test_avg_rank_pct_partitioned(spark):
    pdf, df = _frame(spark)
    got = avg_rank_pct(df, "v", "pct", partition_by=["g"], nb=4).toPandas().set_index("id").sort_index()
    want = pdf.set_index("id").groupby("g")["v"].rank(method="average", pct=True).sort_index()
    assert np.allclose(got["pct"].to_numpy(), want.to_numpy(), atol=1e-15)


def test_ordered_running_matches_stable_sort(spark):
    pdf, df = _frame(spark)
    got = ordered_running(df, [("v", False), ("w", False)], "id", sums=["w"], nb=6).toPandas()
    ref = pdf.sort_values(["v", "w", "id"], ascending=[False, False, True], kind="mergesort").reset_index(drop=True)
    ref["rn"] = np.arange(1, len(ref) + 1)
    ref["run"] = ref["w"].cumsum()
    m = got.merge(ref[["id", "rn", "run"]], on="id")
    assert (m["_rn"] == m["rn"]).all()
    assert np.allclose(m["_run_w"], m["run"])
    assert (got["_n"] == len(pdf)).all()


def test_result_does_not_depend_on_bucket_count_or_partitioning(spark):
    pdf, df = _frame(spark)
    a = avg_rank_pct(df, "v", "pct", nb=2).select("id", "pct")
    b = avg_rank_pct(df.repartition(3), "v", "pct", nb=50).select("id", "pct")
    assert a.exceptAll(b).count() == 0


def test_value_prefix_descending_sums(spark):
    pdf, df = _frame(spark, hot=False)
    got = value_prefix(df, "v", sums=["w"], ascending=False, nb=4).toPandas().sort_values("v", ascending=False)
    per = pdf.groupby("v").agg(c=("id", "size"), s=("w", "sum")).sort_index(ascending=False)
    assert (got["_before"].to_numpy() == (per["c"].cumsum() - per["c"]).to_numpy()).all()
    assert np.allclose(got["_sb_w"].to_numpy(), (per["s"].cumsum() - per["s"]).to_numpy())


def test_qcut_rank_bin_matches_pandas_qcut(spark):
    for n, q in [(4173, 10), (1, 4), (2, 4), (10, 10), (37, 4), (1500, 4)]:
        ranks = np.arange(1, n + 1)
        want = pd.qcut(pd.Series(ranks, dtype=float), q=q, labels=False, duplicates="drop") if n > 1 else [0]
        df = spark.createDataFrame([(int(r),) for r in ranks], "rn long")
        got = df.select(qcut_rank_bin(F.col("rn"), F.lit(n), q).alias("b")).toPandas()["b"].to_numpy()
        assert list(got) == list(np.asarray(want, dtype=int)), (n, q)


def test_published_bin_sizes(spark):
    # 4173 rows in 10 bins: 418,417,417,417,418,417,417,417,417,418
    df = spark.range(1, 4174).select(qcut_rank_bin(F.col("id"), F.lit(4173), 10).alias("b"))
    sizes = [r["count"] for r in df.groupBy("b").count().orderBy("b").collect()]
    assert sizes == [418, 417, 417, 417, 418, 417, 417, 417, 417, 418]
    assert math.isclose(sum(sizes), 4173)


def test_ordered_running_hot_first_key_with_distinct_second_keys(spark):
    rng = np.random.default_rng(11)
    n = 4000
    first = rng.integers(0, 50, n).astype(float)
    first[: n // 2] = 7.0  # half the rows share the first key
    pdf = pd.DataFrame({"id": np.arange(n), "a": first, "b": rng.random(n).round(3), "w": rng.integers(0, 9, n)})
    df = spark.createDataFrame(pdf).repartition(5)
    got = ordered_running(df, [("a", False), ("b", True)], "id", sums=["w"], nb=8)
    ref = pdf.sort_values(["a", "b", "id"], ascending=[False, True, True], kind="mergesort").reset_index(drop=True)
    ref["rn"] = np.arange(1, n + 1)
    ref["run"] = ref["w"].cumsum()
    m = got.toPandas().merge(ref[["id", "rn", "run"]], on="id")
    assert (m["_rn"] == m["rn"]).all() and (m["_run_w"] == m["run"]).all()


def test_nulls_have_no_rank_and_come_last_when_descending(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0), (4, None)], "id long, v double")
    got = {r["id"]: r["p"] for r in ranking.avg_rank_pct(df, "v", "p").collect()}
    assert got == {1: pytest.approx(1 / 3), 2: pytest.approx(2 / 3), 3: pytest.approx(1.0), 4: None}
    for asc, want in ((False, {3: 1, 2: 2, 1: 3, 4: 4}), (True, {4: 1, 1: 2, 2: 3, 3: 4})):
        rn = ranking.ordered_running(df, [("v", asc)], "id")
        assert {r["id"]: r["_rn"] for r in rn.collect()} == want


def test_hot_values_and_many_buckets(spark):
    rng = np.random.default_rng(3)
    values = np.where(rng.random(4000) < 0.4, 0.0, rng.integers(0, 50, 4000)).astype(float)
    pdf = pd.DataFrame({"id": [f"c{i:05d}" for i in range(4000)], "v": values})
    df = spark.createDataFrame(pdf).repartition(6)
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4000")  # the bucket count does not follow it
    try:
        assert ranking._buckets(df, None) == ranking.MAX_BUCKETS
        ranking.value_prefix(df, "v", edges=list(map(float, range(200))))._jdf.queryExecution().optimizedPlan()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    got = ranking.avg_rank_pct(df, "v", "p").toPandas().set_index("id")["p"]
    want = pdf.set_index("id")["v"].rank(method="average", pct=True)
    assert np.allclose(got.sort_index(), want.sort_index())
    rn = ranking.ordered_running(df, [("v", False)], "id").toPandas().set_index("id")["_rn"]
    order = pdf.sort_values(["v", "id"], ascending=[False, True])["id"].tolist()
    assert [i for i in rn.sort_values().index] == order
