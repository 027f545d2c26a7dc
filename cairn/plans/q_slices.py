"""Slicer queries: header, worksheet and month views answered from the cube alone."""

from __future__ import annotations

from ..constants import CAMPAIGN_BUDGET
from ..operators import slices
from ..session import materialize
from . import sql_parts as S
from .catalog import register
from .q_decision import production

CHAIN = S.c360_chain(CAMPAIGN_BUDGET)

#: what a user would pick
SEGMENTS, RISKS, MONTHS = ["Champions", "Loyal Customers", "At Risk", "Hibernating"], ["High", "Critical", "Medium"], ("1997-01", "1998-12")


def _sql(by: tuple[str, ...], segments=None, risks=None, months=None) -> str:
    among = lambda xs: ", ".join(f"'{x}'" for x in xs)
    tests = ([f"rfm_segment IN ({among(segments)})"] if segments else []) + ([f"risk_band IN ({among(risks)})"] if risks else [])
    tests += [f"strftime(month, '%Y-%m') BETWEEN '{months[0]}' AND '{months[1]}'"] if months else []
    keys = ", ".join(by)
    return CHAIN + f"""
, facts AS (
  SELECT c.rfm_segment, c.risk_band, CAST(date_trunc('month', o.order_date) AS DATE) AS month, o.customer_id,
    o.net_revenue, o.gross_margin
  FROM ford o JOIN c360 c ON c.customer_id = o.customer_id
)
SELECT {keys + "," if by else ""} COUNT(DISTINCT customer_id) AS customers, COUNT(*) AS orders,
  CAST(SUM(net_revenue) AS DECIMAL(18,2)) AS net_revenue, CAST(SUM(gross_margin) AS DECIMAL(18,2)) AS gross_margin,
  ROUND({S.sdiv("COUNT(*)", "COUNT(DISTINCT customer_id)")}, 6) AS orders_per_customer
FROM facts {"WHERE " + " AND ".join(tests) if tests else ""} {"GROUP BY " + keys if by else ""}
"""


def _cube(spark, sf_dir):
    p = production(spark, sf_dir)
    return materialize(slices.slice_cube(p.c360, p.orders))


@register("slicer_header", _sql((), SEGMENTS, RISKS, MONTHS))
def slicer_header(spark, sf_dir):
    """Header measures after a multi-select of segments, risk bands and months."""
    return slices.slice_measures(_cube(spark, sf_dir), SEGMENTS, RISKS, MONTHS)


@register("slicer_months", _sql(("month",), SEGMENTS, RISKS))
def slicer_months(spark, sf_dir):
    """The measures by month behind the segment and risk slicers."""
    return slices.slice_measures(_cube(spark, sf_dir), SEGMENTS, RISKS, by=("month",))


@register("slicer_worksheet", _sql(("rfm_segment", "risk_band"), months=MONTHS))
def slicer_worksheet(spark, sf_dir):
    """Sums and distinct customers by segment and risk band over a slice of months."""
    return slices.slice_measures(_cube(spark, sf_dir), months=MONTHS, by=("rfm_segment", "risk_band"))
