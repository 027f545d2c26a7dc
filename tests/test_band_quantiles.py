"""Band quartiles and value-risk reference lines equal numpy on a frame
where one band holds a third of the customers."""

from __future__ import annotations

import numpy as np
import pandas as pd

from cairn.operators.reports import clv_band_quartiles, value_risk_reference_lines


def _c360(spark, n=2400, seed=3):
    rng = np.random.default_rng(seed)
    band = rng.choice(["Low", "Developing", "High", "Strategic"], n)
    band[: n // 3] = "Low"
    clv = np.round(rng.gamma(2.0, 900.0, n), 2)
    clv[n // 3: n // 3 + 40] = 1234.5  # a repeated value
    pdf = pd.DataFrame({"customer_id": np.arange(n), "clv_band": band, "predicted_clv_12m": clv,
                        "churn_probability": np.round(rng.uniform(0, 1, n), 3)})
    return pdf, spark.createDataFrame(pdf).repartition(5)


def test_clv_band_quartiles_match_numpy(spark):
    pdf, df = _c360(spark)
    got = clv_band_quartiles(df).toPandas().set_index("clv_band").sort_index()
    for band, g in pdf.groupby("clv_band"):
        q1, q2, q3 = np.quantile(g["predicted_clv_12m"], [0.25, 0.5, 0.75])
        row = got.loc[band]
        assert row["customers"] == len(g)
        assert abs(row["q1_predicted_clv_12m"] - round(q1, 6)) < 1e-6
        assert abs(row["median_predicted_clv_12m"] - round(q2, 6)) < 1e-6
        assert abs(row["q3_predicted_clv_12m"] - round(q3, 6)) < 1e-6


def test_value_risk_reference_lines_match_numpy(spark):
    pdf, df = _c360(spark)
    row = value_risk_reference_lines(df, 0.55, 0.8).first()
    t = np.quantile(pdf["predicted_clv_12m"], 0.8)
    hv = pdf["predicted_clv_12m"] > t
    hr = pdf["churn_probability"] >= 0.55
    assert abs(row["value_threshold"] - round(t, 6)) < 1e-6
    assert row["customers"] == len(pdf)
    assert row["high_value_customers"] == int(hv.sum())
    assert row["high_risk_customers"] == int(hr.sum())
    assert row["high_value_high_risk_customers"] == int((hv & hr).sum())
