"""The quality rules split a text once: no filter repeats the words of a text, and counting
under a condition gives the counts of the rows that pass."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

from cairn.llm import quality_llr as q

TEXTS = ["a b c d e " * 20, "one two three four " * 3, " ".join(f"w{i}" for i in range(80)), "", None]


def _filters(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [x for x in plan.split("\n") if "Filter" in x]  # up to the line feed among the characters that btrim takes off


def test_no_filter_splits_texts(spark, tmp_path):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, i % 2, 0) for i in range(5)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = corpus_pipeline.quality_rules(spark, docs, str(tmp_path))
    assert not any("btrim(" in x for x in _filters(kept))
    fit = q.with_base_rules(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"), (F.col("doc_id") % 2 == 0).alias("trusted")))
    scored = fit.select(q.score(F.col("_words"), [0.5] * 64).alias("llr"), "trusted", "base_failed")
    assert not any("btrim(" in x for x in _filters(q.threshold_counts(scored)))
    want = q.quality_verdicts(docs, spark.read.parquet(str(tmp_path / "labels.parquet"))).collect()
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in want if r.kept)


def test_steps_of_failed_rows_do_not_move_the_threshold(spark):
    rows = [(0.5, True, False), (0.3, True, False), (-0.5, False, False), (-0.3, False, False)]
    failed = [(x / 10, x % 2 == 0, True) for x in range(-9, 10)]
    frame = lambda r: spark.createDataFrame(r, "llr double, trusted boolean, base_failed boolean")
    assert q.fit_threshold(frame(rows)) == q.fit_threshold(frame(rows + failed))
