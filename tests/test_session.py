"""The shared folder, file round trips and publication gates."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cairn.operators import cohort, quality
from cairn.operators.contracts import ContractError
from cairn.session import ensure_checkpoint_dir
from cairn.sources import files


def fake(master, current=None, configured=None):
    seen = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: current, setCheckpointDir=seen.append)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: configured, set=lambda k, v: None)), seen


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"])
def test_a_cluster_without_a_shared_folder_is_refused(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake(master)[0])
    session, seen = fake(master, configured="hdfs:///shared")
    assert ensure_checkpoint_dir(session) == "hdfs:///shared" and seen == ["hdfs:///shared"]


def test_a_local_session_gets_a_folder():
    for master in ("local", "local[8]"):
        session, seen = fake(master)
        assert [ensure_checkpoint_dir(session)] == seen


def test_csv_keeps_empty_and_na_text(spark, tmp_path):
    df = spark.createDataFrame([(1, "NA"), (2, None), (3, "null"), (4, "a,b\"c"), (5, " x ")], "k int, v string")
    files.write_csv(df, str(tmp_path / "t"))
    back = files.read_csv(spark, str(tmp_path / "t"), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_json_record_and_type_map(spark, tmp_path):
    record = {"a": 1, "b": [1.5, None], "c": {"d": "é"}}
    files.write_json_record(spark, record, str(tmp_path / "r"))
    assert files.read_json_record(spark, str(tmp_path / "r")) == record
    df = spark.sql("SELECT 1 AS i, 1.5D AS d, 'x' AS t, DATE '2000-01-01' AS day, TRUE AS b, 1.25BD AS m")
    assert files.type_map(df) == {"i": "int", "d": "double", "t": "text", "day": "date", "b": "bool", "m": "double"}
    assert files.query_scalar(spark, "SELECT MAX(i) FROM {x} WHERE i > 5", x=df) == 0.0


def test_gates_fail_on_raw_orphans_and_stop_a_publication(spark):
    orders = spark.createDataFrame([(1, 5)], "order_id long, customer_id long")
    lines = spark.createDataFrame([(1,), (2,), (None,)], "order_id long")
    good = quality.report([quality.fk_valid(orders, orders, "order_id", "ok")])
    bad = quality.report([quality.fk_valid(lines, orders, "order_id", "lines_fk")])
    quality.raise_on_failure(good)
    with pytest.raises(ContractError) as e:
        quality.raise_on_failure(good.unionByName(bad))
    assert e.value.violations == {"lines_fk": 1}


def test_reconcile_counts_and_columns(spark):
    a = spark.createDataFrame([(1, 1.0, 2.0), (2, 5.0, None), (3, 1.0, 1.0)], "k int, x double, y double")
    b = spark.createDataFrame([(1, 1.0, 2.5), (2, 5.0 + 1e-12, None), (4, 1.0, 1.0)], "k int, x double, y double")
    got = {r.column: r for r in quality.reconcile(a, b, ["k"], ["x", "y"]).collect()}
    assert (got["x"].rows_compared, got["x"].missing_left, got["x"].missing_right, got["x"].mismatches) == (2, 1, 1, 0)
    assert (got["y"].mismatches, got["y"].first_mismatch_key) == (1, 1)
    with pytest.raises(ContractError) as e:
        quality.reconcile(a, b.withColumn("z", F.lit(1)), ["k"], ["x"])
    assert e.value.violations == {"z_only_right": 1}


def test_cohort_matrix_refuses_lags_outside_its_range(spark):
    long = spark.createDataFrame([("2000-01", 0, 1.0), ("2000-01", 2, 0.5), ("2000-02", 0, 1.0)],
                                 "cohort_month string, cohort_index int, retention_rate double")
    rows = {r.cohort_month: r for r in cohort.cohort_matrix(long, 3).collect()}
    assert (rows["2000-01"].M0, rows["2000-01"].M1, rows["2000-01"].M2, rows["2000-02"].M2) == (1.0, None, 0.5, None)
    with pytest.raises(ContractError):
        cohort.cohort_matrix(long, 1)


def test_threads_ship_the_package_once():
    import time
    from concurrent.futures import ThreadPoolExecutor
    from types import SimpleNamespace

    from cairn.session import ship_package

    sent = []
    context = SimpleNamespace(applicationId="threads-test", addPyFile=lambda path: (time.sleep(0.05), sent.append(path)))
    with ThreadPoolExecutor(max_workers=6) as pool:
        list(pool.map(ship_package, [SimpleNamespace(sparkContext=context)] * 6))
    assert len(sent) == 1
