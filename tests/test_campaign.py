"""The campaign decision on generated customers: properties over budgets, ties, input
order and id types, and contracts by the counts they report."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cairn.constants import BASE_RESPONSE, CONTACT_COST
from cairn.functions.ranking import ordered_running
from cairn.operators.contracts import ContractError, check_budget
from cairn.operators.decision import campaign_summary, recommend_campaigns, uniform_from_key, weighted_contact_sample

SNAPSHOT = ("customer_id {id}, marketing_consent int, frequency_12m long, monetary_12m double, gross_margin_12m double, "
            "avg_order_value_12m double, category_diversity_12m long, recency_days int, sessions_90d long")
RFM = "customer_id {id}, rfm_segment string"
CLV = "customer_id {id}, clv_percentile double, predicted_clv_12m double, clv_band string"
CHURN = "customer_id {id}, churn_probability double, risk_percentile double, risk_band string"


def population(spark, n=60, seed=1, key=lambda i: i, kind="long", twins=1):
    """Random customers; every ``twins`` consecutive ones are equal but for their id."""
    rng = random.Random(seed)
    rows = [[], [], [], []]
    for i in range(n):
        if i % twins == 0:
            f, m = rng.randint(0, 9), round(rng.uniform(0, 9000), 2)
            own = [(rng.choice([0, 1, 1, 1]), f, m, round(m * rng.uniform(0.1, 0.7), 2), round(m / max(f, 1), 2),
                    rng.randint(0, 5), rng.randint(0, 500), rng.randint(0, 40)),
                   (rng.choice(["Champions", "At Risk", "Promising", "Lost", "Hibernating"]),),
                   (round(rng.random(), 3), round(rng.uniform(0, 9000), 2), "High"), (round(rng.random(), 3), round(rng.random(), 3), "Low")]
        for out, values in zip(rows, own):
            out.append((key(i), *values))
    return [spark.createDataFrame(r, s.format(id=kind)) for r, s in zip(rows, (SNAPSHOT, RFM, CLV, CHURN))]


def chosen(targets):
    return {r.customer_id for r in targets.filter("selected_for_campaign = 1").collect()}


def in_order(targets):
    """(id, cost) of the selected rows of an unbounded budget, in decision order."""
    rows = [r for r in targets if r.selected_for_campaign]
    return [(r.customer_id, r.contact_cost) for r in sorted(rows, key=lambda r: (-r.priority_score, -r.expected_roi, r.customer_id))]


def prefix(ordered, budget):
    """The choice by a plain loop."""
    spent, out = 0.0, set()
    for i, cost in ordered:
        spent += cost
        if spent <= budget:
            out.add(i)
    return out


@pytest.fixture(scope="module")
def decided(spark):
    """Customers in groups of four equal ones, and their decision without a budget."""
    frames = population(spark, twins=4)
    return frames, recommend_campaigns(*frames, budget=1e12).collect()


@pytest.mark.parametrize("share", [0.0, 0.37, 0.999])
def test_budgets_equal_a_plain_loop(decided, share):
    frames, rows = decided
    ordered = in_order(rows)
    budget = sum(c for _, c in ordered) * share
    # shuffled inputs: order and partitions must not matter
    shuffled = [f.orderBy(F.xxhash64("customer_id", F.lit(k))).repartition(k + 2) for k, f in enumerate(frames)]
    got = recommend_campaigns(*shuffled, budget=budget).collect()
    assert {r.customer_id for r in got if r.selected_for_campaign} == prefix(ordered, budget)
    assert len(got) == 60 and sum(r.allocated_budget for r in got) <= budget


@pytest.mark.parametrize("kind,key", [("string", lambda i: f"C{i:06d}"), ("long", lambda i: 10_000_000_000 + 7 * i)])
def test_text_and_large_ids(spark, decided, kind, key):
    ordered = in_order(decided[1])
    budget = sum(c for _, c in ordered) * 0.6
    other = population(spark, key=key, kind=kind, twins=4)
    assert chosen(recommend_campaigns(*other, budget=budget)) == {key(i) for i in prefix(ordered, budget)}


def test_decision_values(decided):
    for r in decided[1]:
        assert r.contact_cost == CONTACT_COST.get(r.recommended_action, 0.0)
        assert 0 <= r.expected_response_probability <= 0.55
        assert (r.selected_for_campaign == 1) <= (r.marketing_consent == 1 and r.recommended_action in BASE_RESPONSE)
        if r.selected_for_campaign:
            assert r.expected_roi == pytest.approx(r.expected_incremental_margin / r.contact_cost)
        else:
            assert (r.allocated_budget, r.expected_roi, r.expected_incremental_margin) == (0, 0, 0)


def test_summary_adds_up(spark, decided):
    frames, everyone = decided
    rows = recommend_campaigns(*frames, budget=sum(c for _, c in in_order(everyone)) / 2).collect()
    frame = spark.createDataFrame(rows, schema=recommend_campaigns(*frames, budget=0.0).schema)
    for s in campaign_summary(frame).collect():
        own = [r for r in rows if r.recommended_action == s.recommended_action]
        sel = [r for r in own if r.selected_for_campaign]
        assert (s.eligible_customers, s.selected_customers) == (len(own), len(sel))
        assert s.average_expected_roi == pytest.approx(sum(r.expected_roi for r in sel) / len(sel) if sel else 0)
        assert s.allocated_budget == pytest.approx(sum(r.contact_cost for r in sel))


@pytest.mark.parametrize("budget,name", [(-0.5, "negative"), (float("-inf"), "not_a_finite_number"), (None, "not_a_finite_number"),
                                         (False, "not_a_finite_number"), ([5], "not_a_finite_number")])
def test_budget_contract(budget, name):
    with pytest.raises(ContractError) as e:
        check_budget(budget)
    assert e.value.violations == {name: 1}


def test_input_contracts_count_every_violation(spark):
    snap, rfm, clv, churn = population(spark, n=20)
    cases = [
        ((snap, rfm.union(rfm.limit(3)), clv, churn), "rfm", {"customer_id_repeated": 3}),
        ((snap, rfm, clv.filter("customer_id >= 4"), churn), "clv_scores", {"customers_missing": 4}),
        ((snap.filter("customer_id <> 7"), rfm, clv, churn), "rfm", {"customers_unknown": 1}),
        ((snap, rfm.drop("customer_id"), clv, churn), "rfm", {"customer_id_absent": 1}),
        ((snap, rfm, clv, churn.withColumn("churn_probability", F.when(F.col("customer_id") < 2, F.lit(float("inf")))
                                           .otherwise(F.col("churn_probability"))).withColumn("risk_percentile", F.lit(-0.25))),
         "churn_scores", {"churn_probability_outside_0_1": 2, "risk_percentile_outside_0_1": 20}),
        ((snap.withColumn("marketing_consent", F.lit(2)), rfm, clv, churn), "production_snapshot", {"marketing_consent_not_0_or_1": 20}),
        ((snap, rfm, clv.withColumn("clv_percentile", F.lit("x")), churn), "clv_scores", {"clv_percentile_not_numeric": 1}),
    ]
    for frames, subject, violations in cases:
        with pytest.raises(ContractError) as e:
            recommend_campaigns(*frames, budget=10.0)
        assert (e.value.subject, e.value.violations) == (subject, violations)


def test_running_cost_counts_rows_over_the_budget(spark):
    rng = random.Random(8)
    rows = [(f"k{i:03d}", rng.choice([0.1, 0.2, 0.3]), float(rng.randint(1, 50))) for i in range(90)]
    out = ordered_running(spark.createDataFrame(rows, "id string, p double, c double").repartition(5), [("p", False)], "id", sums=["c"])
    run, want = 0.0, {}
    for n, (i, _, c) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0]))):
        run += c
        want[i] = (n + 1, run)
    assert {r.id: (r._rn, r._run_c) for r in out.collect()} == want


def test_sampling_keys(spark):
    ids = [0, 1, 5, 4_000_000_000, 10**12, 2**61 + 3]
    frame = spark.createDataFrame([(i,) for i in ids], "i long")
    a, b = ([r.u for r in frame.select(uniform_from_key(F.col("i"), F.lit(s), 7).alias("u")).collect()] for s in (1, 2))
    assert all(0 < u < 1 for u in a + b) and len(set(a + b)) == 2 * len(ids)
    targets = spark.createDataFrame(
        [(5_000_000_000 + i, 1, ("Win-Back", "Nurture")[i % 2], 0.1 + i / 100) for i in range(40)],
        "customer_id long, marketing_consent int, recommended_action string, priority_score double")
    dates = targets.select("customer_id", F.lit("2000-01-01").cast("date").alias("acquisition_date"))
    drawn = weighted_contact_sample(targets, dates, "2001-01-01", cap=4).collect()
    per = {}
    for r in drawn:
        per.setdefault(r.recommended_action, []).append(r.draw_order)
    assert per and all(sorted(v) == list(range(1, len(v) + 1)) and len(v) <= 4 for v in per.values())
