"""Business names of the exports, stated plainly."""

from __future__ import annotations

import pytest

from cairn.plans.q_exports import CUSTOMER, business_name

# --- fixed values: business names ---------------------------------------------------------
NAMES = {
    "customer_id": "Customer ID", "frequency_12m": "Frequency 12M", "monetary_12m": "Revenue 12M", "avg_order_value_12m": "Average Order Value 12M",
    "rfm_segment": "RFM Segment", "predicted_clv_12m": "Predicted CLV 12M", "clv_band": "CLV Band", "selected_for_campaign": "Selected for Campaign",
    "gross_margin_pct": "Gross Margin Rate", "return_rate": "Return Rate", "average_expected_roi": "Average Expected ROI", "psi": "PSI",
    "mean_abs_shap": "Mean Abs SHAP", "expected_incremental_margin": "Expected Incremental Margin", "cohort_month": "Cohort Month",
}


@pytest.mark.parametrize("column", sorted(NAMES))
def test_business_names(column):
    assert business_name(column) == NAMES[column]


def test_the_customer_export_has_twenty_columns():
    assert len(CUSTOMER) == len({business_name(c) for c in CUSTOMER}) == 20
