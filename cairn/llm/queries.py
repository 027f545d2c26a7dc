"""Registered queries of the training-data operators: ``name -> fn(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship_package, table
from . import hard_negatives, lexical_search, line_dedup, warc_zip
from .compact_windows import passage_repeats
from .maxent_lm import lm_scores
from .packing import packed_documents
from .piece_counts import piece_counts
from .quality_llr import quality_verdicts
from .simhash_blocks import simhash_components
from .suffix_dedup import removed_repeats
from .token_ids import token_offsets
from .winnow import decontaminate

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


@register
def op1_quality_llr(spark, sf_dir):
    """Base rules and log-likelihood-ratio verdict of every document."""
    return quality_verdicts(table(spark, sf_dir, "documents", "doc_id", "text"),
                            table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


@register
def op2_winnowing(spark, sf_dir):
    """Words of every document that lie in a window of a benchmark item."""
    return decontaminate(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


@register
def op3_maxent_lm(spark, sf_dir):
    """Language-model scores of every document, learned outside the held-out fold."""
    return lm_scores(table(spark, sf_dir, "documents", "doc_id", "text"))


@register
def op4_warc_zip(spark, sf_dir):
    """WARC records of every page in ZIP packages, written and read back by ranges."""
    return warc_zip.archived_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"))


ORACLE["op4_warc_zip"] = warc_zip.ORACLE_SQL


@register
def op5_compact_windows(spark, sf_dir):
    """Passages of every document that nearly repeat one of an earlier document."""
    return passage_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))


@register
def op6_token_ids(spark, sf_dir):
    """Token-id files with Elias-Fano document boundaries, written and read back."""
    return token_offsets(table(spark, sf_dir, "documents", "doc_id", "text"), end_id=2)


@register
def op7_piece_counts(spark, sf_dir):
    """Greedy word-piece counts of every document."""
    return piece_counts(table(spark, sf_dir, "documents", "doc_id", "text"))


@register
def op8_simhash_blocks(spark, sf_dir):
    """SimHash fingerprints and components of every document."""
    return simhash_components(table(spark, sf_dir, "documents", "doc_id", "text"))


@register
def op9_packing(spark, sf_dir):
    """Best-fit packing of every document into sequences of 4096 tokens."""
    return packed_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


@register
def op10_suffix_dedup(spark, sf_dir):
    """Bytes of every document inside 50-byte strings that start in an earlier document."""
    return removed_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))


@register
def op11_ranked_search(spark, sf_dir):
    """The 50 best documents of every benchmark item by lexical score."""
    return lexical_search.ranked_search(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


ORACLE["op11_ranked_search"] = lexical_search.ORACLE_SQL


@register
def op12_hard_negatives(spark, sf_dir):
    """Negatives of other labels that score just below each anchor's positives."""
    rows = hard_negatives.with_shifted_labels(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


ORACLE["op12_hard_negatives"] = hard_negatives.ORACLE_SQL


@register
def op13_line_dedup(spark, sf_dir):
    """Lines of every document that an earlier document holds, dropped."""
    return line_dedup.line_digest(table(spark, sf_dir, "documents", "doc_id", "text"))


ORACLE["op13_line_dedup"] = line_dedup.ORACLE_SQL
