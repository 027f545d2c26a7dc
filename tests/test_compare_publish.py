"""Whole-table comparison as multisets, and all-or-nothing publishing."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cairn.operators.compare import compare_marts, compare_records, compare_tables, ranked
from cairn.sources.publish import PublishError, open_mart, publish, retire, versions

SCHEMA = "id int, name string, day date, flag boolean, amount double, price decimal(10,2)"
DAY = dt.date(2001, 1, 1)


def rows(n):
    return [(i, f"n{i % 7}", DAY + dt.timedelta(days=i % 5), i % 3 == 0, i * 1.5, Decimal(i)) for i in range(n)]


def one(spark, a, b, **kw):
    r = compare_tables("t", spark.createDataFrame(a, SCHEMA).repartition(3), spark.createDataFrame(b, SCHEMA).repartition(4), **kw)
    return r.collect()[0].asDict()


def test_equal_tables_with_repeated_rows_in_any_order(spark):
    a = rows(50) + rows(50)[:20] + [(1, None, None, None, None, None)] * 3
    got = one(spark, a, a[::-1], keys=["id"])
    assert (got["status"], got["left_rows"], got["equal_rows"], got["unequal_buckets"], got["first_key"]) == ("EQUAL", 73, 73, 0, None)


def test_every_kind_of_difference(spark):
    a = rows(3000)
    b = [list(r) for r in a]
    b[10][4] += 1e-12          # within tolerance
    b[20][4] += 1e-3           # number
    b[30][1] = "other"         # text
    b[40][3] = None            # null against a value
    b[50][5] = Decimal("50.01")
    b = [tuple(r) for i, r in enumerate(b) if i not in (60, 61)] + [a[70]]
    got = one(spark, a, b, keys=["id"])
    assert got["status"] == "DIFFERENT"
    assert (got["left_rows"], got["right_rows"], got["close_rows"], got["changed_rows"], got["missing_right"], got["missing_left"]) == (3000, 2999, 1, 4, 2, 1)
    assert got["equal_rows"] == 3000 - 1 - 4 - 2
    assert (got["first_key"], got["first_column"], got["first_left"], got["first_right"]) == ("20", "amount", "30.0", "30.001")
    # without keys, a row whose text differs is another row
    got = one(spark, a, b)
    assert (got["close_rows"], got["changed_rows"], got["missing_right"], got["missing_left"]) == (1, 2, 4, 3)


def test_repeated_keys_are_compared_as_multisets(spark):
    a = [(1, "x", DAY, True, v, Decimal(0)) for v in (3.0, 1.0, 2.0, 2.0)]
    got = one(spark, a, a[::-1], keys=["id"])
    assert (got["status"], got["equal_rows"]) == ("EQUAL", 4)
    b = [(1, "x", DAY, True, v, Decimal(0)) for v in (1.0, 2.0, 3.0 + 1e-11, 9.0)]
    got = one(spark, a, b, keys=["id"])
    assert (got["equal_rows"], got["close_rows"], got["changed_rows"], got["missing_left"], got["missing_right"]) == (2, 0, 2, 0, 0)
    got = one(spark, a * 40, a * 41, keys=["id"])
    assert (got["equal_rows"], got["missing_left"], got["missing_right"]) == (160, 4, 0)


def test_special_numbers_empty_tables_and_swapped_nulls(spark):
    nan = float("nan")
    a = [(1, None, None, None, nan, None), (2, "b", None, None, -0.0, None), (3, None, None, True, float("inf"), None)]
    assert one(spark, a, [a[0], (2, "b", None, None, 0.0, None), a[2]])["status"] == "EQUAL"
    got = one(spark, a, [(1, None, None, None, 0.5, None), a[1], a[2]], keys=["id"])
    assert (got["changed_rows"], got["first_column"]) == (1, "amount")
    assert one(spark, [], [])["status"] == "EQUAL"
    got = one(spark, [], a)
    assert (got["status"], got["missing_left"], got["left_rows"], got["right_rows"]) == ("DIFFERENT", 3, 0, 3)
    two = "a string, b string"
    got = compare_tables("t", spark.createDataFrame([("x", None)], two), spark.createDataFrame([(None, "x")], two)).collect()[0]
    assert (got.missing_left, got.missing_right) == (1, 1)


def test_marts_schemas_and_order(spark):
    a = spark.createDataFrame(rows(20), SCHEMA)
    left = {"same": a, "gone": a, "kinds": a, "columns": a.withColumnRenamed("name", "title")}
    right = {"same": a.select(*a.columns), "new": a, "kinds": a.withColumn("id", F.col("id").cast("string")), "columns": a}
    got = {r.table: r for r in compare_marts(left, right).collect()}
    assert {k: r.status for k, r in got.items()} == {"same": "EQUAL", "gone": "MISSING", "new": "MISSING", "kinds": "DIFFERENT", "columns": "DIFFERENT"}
    assert got["kinds"].schema_difference == "id: int and text"
    assert got["columns"].schema_difference == "name: missing in left; title: missing in right"
    # the same rows, ranked in two orders
    by = lambda asc: ranked(a, [("amount", asc)], "id")
    assert compare_tables("t", by(True), by(True), keys=["id"]).first().status == "EQUAL"
    assert compare_tables("t", by(True), by(False), keys=["id"]).first().changed_rows == 20


def test_records():
    a = {"model": {"auc": 0.5, "names": ["a", "b"], "n": 3}, "python_version": "3.1"}
    assert compare_records(a, {"model": {"auc": 0.5 + 1e-13, "names": ["a", "b"], "n": 3.0}, "python_version": "x"}, ignored=["python_version"]) == []
    assert compare_records(a, {"model": {"auc": 0.6, "names": ["a"], "n": True}}, ignored=["python_version"]) == [".model.auc", ".model.n", ".model.names", ".model.names[1]"]


def test_published_versions_are_pinned(spark, tmp_path):
    root = str(tmp_path / "mart")
    df = spark.createDataFrame(rows(30), SCHEMA)
    first = publish(spark, root, {"a": df, "b": df.limit(5)})
    assert (first.number, first.tables, first.rows("a"), first.rows("b")) == (1, ["a", "b"], 30, 5)
    second = publish(spark, root, {"a": df.where("id < 10"), "c": df}, note={"why": "test"})
    assert second.number == 2 and open_mart(spark, root).tables == ["a", "c"] and second.manifest["note"] == {"why": "test"}
    assert first.table("a").count() == 30 and open_mart(spark, root, 1).table("b").count() == 5
    assert first.table("a").schema == df.schema
    second.register("m_")
    assert spark.sql("SELECT COUNT(*) FROM m_a").first()[0] == 10
    assert retire(spark, root, keep=1) == [1] and versions(spark, root) == [2]
    assert open_mart(spark, root).table("a").count() == 10
    third = publish(spark, root, {"a": df})
    assert third.number == 3


def test_a_failure_half_way_leaves_the_old_version(spark, tmp_path):
    root = tmp_path / "mart"
    df = spark.createDataFrame(rows(30), SCHEMA)
    with pytest.raises(PublishError):
        open_mart(spark, str(root))
    publish(spark, str(root), {"a": df, "b": df})
    broken = df.withColumn("amount", F.raise_error(F.lit("stop")).cast("double"))
    with pytest.raises(Exception, match="stop"):
        publish(spark, str(root), {"a": df.where("id < 3"), "b": broken})
    gate = lambda t: t["a"].agg(F.when(F.count(F.lit(1)) > 5, "PASS").otherwise("FAIL").alias("status")).withColumn("check_name", F.lit("enough_rows"))
    with pytest.raises(PublishError, match="enough_rows"):
        publish(spark, str(root), {"a": df.where("id < 3")}, gates=gate)
    mart = open_mart(spark, str(root))
    assert (mart.number, mart.tables, mart.table("a").count(), mart.table("b").count()) == (1, ["a", "b"], 30, 30)
    assert len(list((root / "versions").iterdir())) == 1  # what failed is gone
    assert publish(spark, str(root), {"a": df}, gates=gate).number == 2


def test_a_claimed_number_is_not_taken_twice(spark, tmp_path):
    root = tmp_path / "mart"
    df = spark.createDataFrame(rows(3), SCHEMA)
    publish(spark, str(root), {"a": df})
    (root / "manifests" / "00000002.claim").write_text("another publisher")
    assert publish(spark, str(root), {"a": df}).number == 3


def test_reconcile_pairs_rows_that_share_a_key(spark):
    from cairn.operators.quality import reconcile

    schema = "k int, g string, v double, t string"
    a = spark.createDataFrame([(1, "a", 1.0, "x"), (1, "a", 2.0, "y"), (2, "a", 5.0, "z"), (None, "a", 7.0, "n"), (3, None, 1.0, None)], schema)
    got = {r.column: r for r in reconcile(a, a, ["k", "g"], ["v", "t"]).collect()}
    assert all((r.rows_compared, r.mismatches, r.missing_left, r.missing_right) == (5, 0, 0, 0) for r in got.values())
    b = spark.createDataFrame([(1, "a", 2.0, "y"), (1, "a", 1.0 + 1e-12, "x"), (2, "a", 5.5, "z"), (None, "a", 7.0, "m"), (4, "b", 1.0, None)], schema)
    got = {r.column: r for r in reconcile(a, b, ["k", "g"], ["v", "t"]).collect()}
    assert (got["v"].rows_compared, got["v"].mismatches, got["v"].first_mismatch_key) == (4, 1, "2|a")
    assert (got["t"].mismatches, got["t"].first_mismatch_key, got["t"].missing_left, got["t"].missing_right) == (1, "|a", 1, 1)


def test_a_table_may_be_made_from_those_written_before(spark, tmp_path):
    df = spark.range(40).withColumn("x", F.col("id") * 2)
    mart = publish(spark, str(tmp_path / "m"), {"a": df, "b": lambda written: written["a"].where("id < 7")})
    assert mart.rows("a") == 40 and mart.table("b").count() == mart.rows("b") == 7
    assert all(f.endswith(".zstd.parquet") for f in mart.table("a").inputFiles())


def test_a_side_is_computed_once_for_equal_tables(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    left = spark.createDataFrame(rows(60), SCHEMA)
    got = compare_tables("t", left, left.mapInArrow(counted, left.schema), keys=["id"]).collect()[0]
    assert (got["status"], got["left_rows"], got["right_rows"], seen.value) == ("EQUAL", 60, 60, 60)


def test_the_session_reads_the_published_order_lines(spark, monkeypatch):
    from cairn.plans import q_publish
    from cairn.sources import adapter

    monkeypatch.setattr(adapter, "_CACHE", {})
    monkeypatch.setattr(q_publish, "_MARTS", {})
    made = []
    monkeypatch.setattr(q_publish, "PROCESSED", {"rfm_scores": q_publish.PROCESSED["rfm_scores"], "data_quality_report": q_publish.PROCESSED["data_quality_report"]})
    monkeypatch.setattr(adapter.MaterializedCanonical, "_get", lambda self, name, build, own=adapter.MaterializedCanonical._get: made.append(name) or own(self, name, build))
    mart = q_publish.mart(spark, "/root/testdata/sf0.001")
    lines = adapter.canonical(spark, "/root/testdata/sf0.001").order_lines()
    assert lines.inputFiles() == mart.table("order_lines").inputFiles() and lines.count() == mart.rows("order_lines") > 0
    assert "orders" in made
