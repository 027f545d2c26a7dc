"""Group fairness audit of a churn score over audit attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import FAIRNESS_MIN_GROUP
from ..functions.ranking import value_prefix
from .contracts import check_fairness_inputs


def fairness_audit(scored: DataFrame, threshold: float, attributes: Sequence[str] = ("region", "age_band"),
                   min_group: int = FAIRNESS_MIN_GROUP, validate: bool = True) -> DataFrame:
    """Per (attribute, group): customers, observed churn rate, mean risk,
    ROC-AUC (null when one class) and true-positive rate; groups under ``min_group``
    rows are dropped.  Input: customer_id, attributes..., churn_90d, probability.

    Rows are unpivoted by attribute (the attribute list is fixed), then every
    measure is a grouped aggregate; the AUC uses average ranks within the group.
    """
    if validate:
        threshold = check_fairness_inputs(scored, threshold, attributes)
    long = scored.select(
        "customer_id",
        F.col("churn_90d").cast("long").alias("y"),
        F.col("probability").cast("double").alias("p"),
        F.explode(F.array(*[
            F.struct(F.lit(a).alias("audit_attribute"), F.col(a).cast("string").alias("audit_group"))
            for a in attributes
        ])).alias("kv"),
    ).select("customer_id", "y", "p", "kv.audit_attribute", "kv.audit_group")
    keys = ["audit_attribute", "audit_group"]
    pred = F.col("p") >= F.lit(float(threshold))
    basic = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("y").alias("observed_churn_rate"),
        F.avg("p").alias("average_predicted_risk"),
        F.sum("y").alias("_pos"),
        F.count_if(pred & (F.col("y") == 1)).alias("_tp"),
    )
    ranks = value_prefix(long, "p", sums=["y"], partition_by=keys)
    auc = ranks.groupBy(*keys).agg(
        F.sum(F.col("_s_y") * (F.col("_before") + (F.col("_cnt") + 1) / 2.0)).alias("_rs"),
        F.first("_st_y").alias("_P"),
        F.first("_n").alias("_N"),
    ).select(
        *keys,
        F.when((F.col("_P") > 0) & (F.col("_N") - F.col("_P") > 0),
               (F.col("_rs") - F.col("_P") * (F.col("_P") + 1) / 2.0) / (F.col("_P") * (F.col("_N") - F.col("_P"))))
        .alias("roc_auc"),
    )
    out = basic.filter(F.col("customers") >= min_group).join(auc, keys, "left")
    return out.select(
        *keys, "customers", "observed_churn_rate", "average_predicted_risk", "roc_auc",
        (F.col("_tp") / F.greatest(F.lit(1), F.col("_pos"))).alias("true_positive_rate"),
    )
