"""The corpus pipeline: documents -> packed training sequences.

Stages, each a function (spark, docs, sf_dir) whose result is written as Parquet and read
again as the next one's docs: quality rules, SimHash near-dedup, substring dedup,
benchmark decontamination, best-fit packing.  All but the last return the columns of
documents.

Defined cases: decisions on whole documents are kept by doc_id, so a row without doc_id
passes near-dedup and decontamination; rows that repeat a doc_id are one document, of
which near-dedup keeps one row; null and empty texts fail the quality rules; an empty
table gives no sequences.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cairn.llm.common import materialize, ship_package, table, work_path  # noqa: E402
from cairn.llm.compact_windows import without_repeats  # noqa: E402
from cairn.llm.packing import packed_documents  # noqa: E402
from cairn.llm.quality_llr import quality_verdicts  # noqa: E402
from cairn.llm.simhash_blocks import simhash_components  # noqa: E402
from cairn.llm.winnow import decontaminate  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the log-likelihood-ratio threshold."""
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    # a filter on a generated column stays above the verdicts (0.1 GB, one run each: 169 CPU
    # seconds, 229 with a plain filter)
    found = quality_verdicts(docs, labels).select(*docs.columns, F.explode(F.array("kept")).alias("_kept"))
    return found.where("_kept").select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of linked fingerprints."""
    ship_package(spark)
    found = materialize(simhash_components(docs))
    out = docs.join(found.where("doc_id <> component_id").select("doc_id").distinct(), "doc_id", "left_anti")
    rows = found.where("doc_id IS NOT NULL")
    if rows.groupBy("doc_id").count().where("count > 1").limit(1).count():
        known = out.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
        out = known.unionByName(out.where("doc_id IS NULL"))
    return out.select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that nearly repeat one of an earlier document; a text of
    which no word is left goes, and n_chars is counted anew."""
    ship_package(spark)
    cut = without_repeats(docs)
    cut = cut.where((F.col("n_repeated") == 0) | (F.length(F.btrim("text", F.lit(" \t\n\x0b\f\r"))) > 0))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(F.col("n_repeated") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    ship_package(spark)
    found = decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    bad = materialize(found.where("contaminated").select("doc_id").distinct())
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their places in sequences of 4096 tokens."""
    ship_package(spark)
    return packed_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: hashes, tokenizer ids and components have no SQL form: tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES:
        path = work_path(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
