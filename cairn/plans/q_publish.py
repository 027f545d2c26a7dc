"""Publishing and comparing whole sets of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import compare
from ..session import ensure_checkpoint_dir
from ..sources import files, publish
from ..sources.adapter import canonical, lazy_canonical
from . import q_core, q_models, q_reports  # noqa: F401  (their SQL is read below)
from .catalog import ORACLE, QUERIES, register
from .q_decision import production
from .q_governance import BLOCKING_GATES

#: processed tables of the mart: the queries that make them, and the number of their date,
#: int, double and text columns
PROCESSED = {
    "customer_snapshot_features": (3, 16, 11, 4), "rfm_scores": (1, 6, 2, 2), "cohort_retention_long": (0, 3, 1, 1),
    "monthly_customer_metrics": (1, 5, 6, 0), "churn_scores": (1, 1, 2, 1), "clv_scores": (1, 1, 2, 1),
    "churn_calibration": (0, 2, 2, 0), "churn_lift_curve": (0, 0, 3, 0), "fairness_audit": (0, 1, 4, 2),
    "drift_monitoring": (0, 0, 3, 2), "campaign_targets": (0, 7, 13, 5), "campaign_summary": (0, 2, 6, 1),
    "customer_360": (1, 16, 16, 10), "segment_summary": (0, 2, 8, 1), "executive_kpis": (0, 0, 1, 2), "data_quality_report": (0, 1, 0, 2),
}
CANONICAL = {"customers": ("cust", 1, 2, 0, 4), "products": ("part", 0, 1, 2, 1), "orders": ("ford", 1, 4, 5, 2),
             "order_lines": ("oline", 1, 5, 6, 3), "interactions": ("inter", 1, 6, 1, 0)}

_MARTS: dict[tuple[str, str], publish.Mart] = {}


def mart(spark, sf_dir) -> publish.Mart:
    """The session's published mart: every canonical and processed table as one version."""
    key = (spark.sparkContext.applicationId, str(sf_dir).rstrip("/"))
    if key not in _MARTS:
        c = canonical(spark, sf_dir)

        def processed(name):
            def table(written):
                c.adopt("order_lines", written["order_lines"])  # by far the largest: one copy will do
                return QUERIES[name](spark, sf_dir)

            return table

        tables = {n: getattr(c, n)() for n in CANONICAL if n != "order_lines"}
        tables |= {"order_lines": lazy_canonical(spark, sf_dir).order_lines()} | {n: processed(n) for n in PROCESSED}
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/marts/{spark.sparkContext.applicationId}-{len(_MARTS)}"

        def gates(written):
            return written["data_quality_report"].where(F.col("check_name").isin(*BLOCKING_GATES))

        try:
            _MARTS[key] = publish.publish(spark, root, tables, gates)
        except BaseException:
            c.forget("order_lines")  # it may be gone with the version
            raise
    return _MARTS[key]


def _counted(name: str, source: str, kinds) -> str:
    return f"SELECT '{name}' AS \"table\", COUNT(*) AS rows, " + ", ".join(
        f"{k} AS {c}_columns" for k, c in zip(kinds, ("date", "int", "double", "text"))) + f" FROM {source}"


@register("published_mart", " " + " UNION ALL ".join(
    [_counted(n, source, kinds) for n, (source, *kinds) in CANONICAL.items()]
    + [_counted(n, f"({ORACLE[n]})", kinds) for n, kinds in PROCESSED.items()]))
def published_mart(spark, sf_dir):
    """Every canonical and processed table published as one
    version after the blocking gates; rows by SQL on the registered views, kinds of columns
    by the manifest's schema."""
    found = mart(spark, sf_dir)
    found.register("mart_")
    rows = []
    for name in found.tables:
        kinds = list(files.type_map(found.table(name)).values())
        rows.append((name, int(files.query_scalar(spark, f"SELECT COUNT(*) FROM mart_{name}")),
                     *[kinds.count(k) for k in ("date", "int", "double", "text")]))
    return spark.createDataFrame(rows, "table string, rows long, date_columns int, int_columns int, double_columns int, text_columns int")


#: tables that are compared with a second computation, and their business keys
COMPARED = {"customers": ["customer_id"], "products": ["product_id"], "orders": ["order_id"], "order_lines": None,
            "interactions": ["customer_id", "month"]}


@register("mart_comparison", " " + " UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", 'EQUAL' AS status, COUNT(*) AS left_rows, COUNT(*) AS right_rows, COUNT(*) AS equal_rows, "
    f"0 AS close_rows, 0 AS changed_rows, 0 AS missing_left, 0 AS missing_right FROM {CANONICAL[n][0]}" for n in COMPARED))
def mart_comparison(spark, sf_dir):
    """The published version of every canonical table against a second computation
    from the source tables, all columns, as multisets of rows."""
    found, again = mart(spark, sf_dir), lazy_canonical(spark, sf_dir)
    return _totals(compare.compare_marts({n: found.table(n) for n in COMPARED}, {n: getattr(again, n)() for n in COMPARED},
                                         {n: k for n, k in COMPARED.items() if k}))


def _totals(out: DataFrame) -> DataFrame:
    return out.select("table", "status", "left_rows", "right_rows", "equal_rows", "close_rows", "changed_rows", "missing_left", "missing_right")


_CHANGED = """
, base AS (SELECT order_id, customer_id, channel, CAST(net_revenue AS DOUBLE) AS net_revenue, CAST(returned_amount AS DOUBLE) AS returned_amount,
    order_id % 89 = 0 AS gone, order_id % 83 = 0 AND order_id % 89 <> 0 AS twice, order_id % 101 = 0 AS text, order_id % 97 = 0 AS number,
    order_id % 5 = 0 AND net_revenue <> 0 AS near FROM ford)
, marked AS (SELECT *, NOT gone AND (text OR number) AS changed, NOT gone AND NOT text AND NOT number AND near AS close,
    gone OR twice OR text OR number AS bad FROM base)
, firsts AS (SELECT MIN(CAST(order_id AS VARCHAR)) AS k FROM marked WHERE bad)
SELECT 'orders' AS "table", CASE WHEN SUM(CASE WHEN bad THEN 1 ELSE 0 END) > 0 THEN 'DIFFERENT' ELSE 'EQUAL' END AS status,
  COUNT(*) AS left_rows, SUM(CASE WHEN gone THEN 0 WHEN twice THEN 2 ELSE 1 END) AS right_rows,
  SUM(CASE WHEN NOT gone AND NOT changed AND NOT close THEN 1 ELSE 0 END) AS equal_rows,
  SUM(CASE WHEN close THEN 1 ELSE 0 END) AS close_rows, SUM(CASE WHEN changed THEN 1 ELSE 0 END) AS changed_rows,
  SUM(CASE WHEN twice THEN 1 ELSE 0 END) AS missing_left, SUM(CASE WHEN gone THEN 1 ELSE 0 END) AS missing_right,
  MAX((SELECT k FROM firsts)) AS first_key,
  MAX(CASE WHEN CAST(order_id AS VARCHAR) = (SELECT k FROM firsts) THEN CASE WHEN gone THEN NULL WHEN text THEN 'channel' WHEN number THEN 'returned_amount' END END) AS first_column
FROM marked
"""


@register("mart_comparison_changed", _CHANGED)
def mart_comparison_changed(spark, sf_dir):
    """Orders against a copy with rows left out and repeated, texts and numbers
    changed, and numbers changed within tolerance: each kind is counted."""
    o = production(spark, sf_dir).orders
    left = o.select("order_id", "customer_id", "channel", F.col("net_revenue").cast("double").alias("net_revenue"),
                    F.col("returned_amount").cast("double").alias("returned_amount"))
    k = F.col("order_id")
    right = left.where(k % 89 != 0).withColumns({
        "channel": F.when(k % 101 == 0, F.upper("channel")).otherwise(F.col("channel")),
        "net_revenue": F.when(k % 5 == 0, F.col("net_revenue") * (1 + 1e-12)).otherwise(F.col("net_revenue")),
        "returned_amount": F.when(k % 97 == 0, F.col("returned_amount") + 1).otherwise(F.col("returned_amount"))})
    right = right.unionByName(right.where(k % 83 == 0))
    out = compare.compare_tables("orders", left, right, ["order_id"])
    return out.select("table", "status", "left_rows", "right_rows", "equal_rows", "close_rows", "changed_rows", "missing_left", "missing_right",
                      "first_key", "first_column")
