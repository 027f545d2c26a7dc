"""Point-in-time customer features for many cutoff dates in one pass.

A fact counts for a run of consecutive cutoffs: an order on day d for the 12-month measures
of the cutoffs from d on and before d + 365, for the lifetime measures of all from d on, for
the labels of horizon h of those from d - h on and before d.  So every fact becomes at most
four differences (added at the first cutoff of a run, taken off at the first one after it),
whatever the number of cutoffs; the differences are summed per (customer, cutoff) in one
hash aggregate of all facts, and running sums over a customer's cutoffs give the measures.
Which categories a customer bought in each window is a bit per cutoff, or-ed per category.
The facts are exchanged once, as narrow rows by customer; differences, sums and running sums
follow in the same tasks, with hash aggregates inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import FEATURE_COLUMNS, ONLINE_CHANNELS, TIER_SCORE
from ..functions.exprs import lookup, safe_divide
from ..session import shuffle_partitions
from .contracts import check_horizon

MONEY = "decimal(18,2)"


#: cutoffs of one pass: category bits are held in one long
MAX_CUTOFFS = 60
_WINDOW_DAYS, _SESSION_DAYS = 365, 90
_CUSTOMER, _ORDER, _INTERACTION = 0, 1, 2
_AMOUNTS = ("net_revenue", "gross_margin", "gross_revenue", "discount_amount")


def _first_at(dates: Sequence[Column], day: Column) -> Column:
    """Index of the first cutoff on or after ``day`` (their number, if there is none)."""
    def build(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(day <= dates[mid], build(lo, mid)).otherwise(build(mid + 1, hi))

    return build(0, len(dates))


def _run(first: Column, after: Column, flags: str) -> list[Column]:
    """The two differences of a run of cutoffs; ``flags`` names the measures it counts for."""
    return [F.struct(first.alias("k"), F.lit(flags).alias("of"), F.lit(1).alias("sign")),
            F.struct(after.alias("k"), F.lit(flags).alias("of"), F.lit(-1).alias("sign"))]


#: bits of a cutoff's index in ``_at``, and the places there
_BITS = 6
_START, _YEAR, _CHURN, _VALUE, _SESSIONS = 0, 1, 2, 3, 2


def _packed(*firsts: Column) -> Column:
    """Indices of cutoffs in one integer."""
    return reduce(lambda a, b: a + b, [F.call_function("shiftleft", f, F.lit(_BITS * i)) for i, f in enumerate(firsts)])


def _unpacked(place: int) -> Column:
    return F.shiftright("_at", _BITS * place).bitwiseAND((1 << _BITS) - 1)


def _stream(customers: DataFrame, orders: DataFrame, interactions: DataFrame, dates: Sequence[Column], churn_h: int | None,
            clv_h: int | None) -> DataFrame:
    """Customers, dated orders and dated interactions as one narrow table (``_of`` tells them apart).
    Amounts are cents: a long is summed in place and travels in 8 bytes.  ``_at`` holds the
    first cutoffs of a fact's runs: found here, they leave the method that makes and sums the
    differences below 8000 bytes of code, above which the JVM does not compile it."""
    cents = lambda c: (F.col(c).cast(MONEY) * 100).cast("long").alias(c)
    first = lambda c, days: _first_at(dates, F.date_add(F.col(c), days))
    bought = orders.where(F.col("order_date").isNotNull()).select(
        "customer_id", F.lit(_ORDER).alias("_of"), F.col("order_date").alias("_day"), *[cents(c) for c in _AMOUNTS],
        "returned_flag", F.when(F.col("channel").isin(*ONLINE_CHANNELS), 1).otherwise(0).alias("_online"),
        _packed(*[first("order_date", x) for x in (0, _WINDOW_DAYS, -(churn_h or 0), -(clv_h or 0))]).alias("_at"))
    seen = interactions.where(F.col("month").isNotNull()).select(
        "customer_id", F.lit(_INTERACTION).alias("_of"), F.col("month").alias("_day"), "email_sent", "email_opens", "support_tickets", "sessions",
        _packed(*[first("month", x) for x in (0, _WINDOW_DAYS, _SESSION_DAYS)]).alias("_at"))
    every = customers.select("customer_id", F.lit(_CUSTOMER).alias("_of"))
    return every.unionByName(bought, allowMissingColumns=True).unionByName(seen, allowMissingColumns=True)


def _differences(stream: DataFrame, dates: Sequence[Column], churn_h: int | None, clv_h: int | None) -> DataFrame:
    """customer_id, k and a difference of every measure: one row a customer and cutoff at least."""
    d, start, year = F.col("_day"), _unpacked(_START), _unpacked(_YEAR)
    ordered = [*_run(start, year, "year"), F.struct(start.alias("k"), F.lit("life").alias("of"), F.lit(1).alias("sign"))]
    for name, h, place in (("churn", churn_h, _CHURN), ("value", clv_h, _VALUE)):
        if h is not None:
            ordered += _run(_unpacked(place), start, name)
    seen = [*_run(start, year, "contact"), *_run(start, _unpacked(_SESSIONS), "sessions")]
    every = [F.struct(F.lit(k).alias("k"), F.lit("").alias("of"), F.lit(0).alias("sign")) for k in range(len(dates))]
    runs = F.when(F.col("_of") == _ORDER, F.array(*ordered)).when(F.col("_of") == _INTERACTION, F.array(*seen)).otherwise(F.array(*every))
    rows = stream.withColumn("_r", F.explode(runs)).where(F.col("_r.k") < len(dates))
    of, sign = F.col("_r.of"), F.col("_r.sign")

    def add(flag: str, value: Column | str) -> Column:
        return F.when(of == flag, (F.col(value) if isinstance(value, str) else value) * sign)

    out = [
        F.when(of == "life", d).alias("last_order_date"), add("life", F.lit(1)).alias("lifetime_orders"),
        add("life", "net_revenue").alias("lifetime_revenue"), add("life", "gross_margin").alias("lifetime_margin"),
        add("year", F.lit(1)).alias("frequency_12m"), add("year", "net_revenue").alias("monetary_12m"),
        add("year", "gross_margin").alias("gross_margin_12m"), add("year", "gross_revenue").alias("gross_revenue_12m"),
        add("year", "discount_amount").alias("discount_amount_12m"), add("year", "returned_flag").alias("returned_orders_12m"),
        add("year", "_online").alias("online_orders_12m"), add("contact", "email_sent").alias("email_sent_12m"),
        add("contact", "email_opens").alias("email_opens_12m"), add("contact", "support_tickets").alias("support_tickets_12m"),
        add("sessions", "sessions").alias("sessions_90d"),
        F.when((of == "sessions") & (sign == 1) & (F.col("sessions") > 0), d).alias("last_session_month"),
    ]
    if churn_h is not None:
        out.append(add("churn", F.lit(1)).alias("future_orders_churn"))
    if clv_h is not None:
        out += [add("value", "gross_margin").alias("future_gross_margin"), add("value", "net_revenue").alias("future_revenue"),
                add("value", F.lit(1)).alias("future_orders")]
    return rows.select("customer_id", F.col("_r.k").alias("k"), *out)


def _category_counts(orders: DataFrame, dates: Sequence[Column]) -> DataFrame:
    """customer_id and the number of categories bought in the window of each cutoff (array)."""
    d, one = F.col("order_date"), F.lit(1).cast("long")
    start, after = _first_at(dates, d), _first_at(dates, F.date_add(d, _WINDOW_DAYS))
    bits = F.call_function("shiftleft", one, after) - F.call_function("shiftleft", one, start)  # cutoffs start .. after - 1
    held = (orders.where(F.col("primary_category").isNotNull() & d.isNotNull())
            .groupBy("customer_id", "primary_category").agg(F.bit_or(bits).alias("_bits")))
    per = held.groupBy("customer_id").agg(*[F.sum(F.shiftright("_bits", k).bitwiseAND(1)).alias(f"_n{k}") for k in range(len(dates))])
    return per.select(F.col("customer_id"), F.array(*[F.col(f"_n{k}") for k in range(len(dates))]).alias("_categories"))


def build_snapshots(
    customers: DataFrame,
    orders: DataFrame,
    interactions: DataFrame,
    cutoffs: Sequence[str],
    churn_horizon: int | None = None,
    clv_horizon: int | None = None,
) -> DataFrame:
    """One row per (customer acquired on or before the cutoff, cutoff).

    ``churn_horizon`` adds ``churn_90d`` (no order in (cutoff, cutoff + h]);
    ``clv_horizon`` adds ``future_gross_margin``, ``future_revenue``, ``future_orders``.
    """
    if churn_horizon is not None:
        check_horizon(churn_horizon)
    if clv_horizon is not None:
        check_horizon(clv_horizon)
    cutoffs = sorted(set(map(str, cutoffs)))
    if len(cutoffs) > MAX_CUTOFFS:
        parts = [build_snapshots(customers, orders, interactions, cutoffs[i: i + MAX_CUTOFFS], churn_horizon, clv_horizon)
                 for i in range(0, len(cutoffs), MAX_CUTOFFS)]
        return reduce(DataFrame.unionByName, parts)
    dates = [F.lit(c).cast("date") for c in cutoffs]

    # ---- differences of all facts, one row per (customer, cutoff) at least -----------
    # the facts move once, as they are: their differences (six an order) and all that follows
    # are made where the customer is
    stream = _stream(customers, orders, interactions, dates, churn_horizon, clv_horizon).repartition(shuffle_partitions(customers.sparkSession), "customer_id")
    facts = _differences(stream, dates, churn_horizon, clv_horizon)
    latest = ("last_order_date", "last_session_month")
    measures = [c for c in facts.columns if c not in ("customer_id", "k")]
    summed = facts.groupBy("customer_id", "k").agg(*[(F.max(c) if c in latest else F.sum(c)).alias(c) for c in measures])
    upto = Window.partitionBy("customer_id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    running = summed.select("customer_id", "k", *[(F.max(c) if c in latest else F.sum(c)).over(upto).alias(c) for c in measures])

    # ---- customers x cutoffs (the output grain) ----------------------------------------
    attributes = customers.select("customer_id", "acquisition_date", "region", "age_band", "loyalty_tier", "preferred_channel", "marketing_consent")
    joined = (running.join(attributes, "customer_id").join(_category_counts(orders, dates), "customer_id", "left")
              .withColumn("snapshot_date", F.element_at(F.array(*dates), F.col("k") + 1))
              .where(F.col("acquisition_date") <= F.col("snapshot_date")))
    cut = F.col("snapshot_date")

    def cnt(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)

    def amt(c: str) -> Column:
        return (F.coalesce(F.col(c), F.lit(0)).cast("decimal(19,0)") * F.lit(Decimal("0.01"))).cast(MONEY).alias(c)

    snap = joined.select(
        "customer_id", "acquisition_date", "region", "age_band", "loyalty_tier", "preferred_channel",
        "marketing_consent", "snapshot_date",
        F.greatest(F.datediff(cut, F.col("acquisition_date")), F.lit(0)).alias("tenure_days"),
        "last_order_date", cnt("lifetime_orders"), amt("lifetime_revenue"), amt("lifetime_margin"),
        cnt("frequency_12m"), amt("monetary_12m"), amt("gross_margin_12m"), amt("gross_revenue_12m"),
        amt("discount_amount_12m"), cnt("returned_orders_12m"),
        F.coalesce(F.get("_categories", F.col("k")), F.lit(0)).cast("long").alias("category_diversity_12m"),
        cnt("online_orders_12m"), cnt("email_sent_12m"), cnt("email_opens_12m"), cnt("support_tickets_12m"),
        cnt("sessions_90d"), "last_session_month",
        *([F.col("future_orders_churn").alias("_fut_churn")] if churn_horizon is not None else []),
        *([amt("future_gross_margin"), amt("future_revenue"), cnt("future_orders")] if clv_horizon is not None else []),
    )
    tenure_floor = F.greatest(F.col("tenure_days"), F.lit(1))
    snap = snap.withColumns({
        "recency_days": F.coalesce(F.datediff(cut, F.col("last_order_date")), tenure_floor + 365),
        "avg_order_value_12m": safe_divide("monetary_12m", "frequency_12m"),
        "discount_rate_12m": safe_divide("discount_amount_12m", "gross_revenue_12m"),
        "return_rate_12m": safe_divide("returned_orders_12m", "frequency_12m"),
        "online_order_share_12m": safe_divide("online_orders_12m", "frequency_12m"),
        "email_open_rate_12m": safe_divide("email_opens_12m", "email_sent_12m"),
        "days_since_last_session": F.coalesce(F.datediff(cut, F.col("last_session_month")), tenure_floor + 90),
        "loyalty_tier_score": lookup("loyalty_tier", TIER_SCORE, 0),
        "consent_flag": F.col("marketing_consent").cast("int"),
    })
    if churn_horizon is not None:
        snap = snap.withColumn("churn_90d", F.when(F.coalesce(F.col("_fut_churn"), F.lit(0)) > 0, 0).otherwise(1)).drop(
            "_fut_churn"
        )
    return snap


def feature_vector_columns(df: DataFrame) -> DataFrame:
    """The 16 model features as doubles, nulls and bad values -> 0."""
    return df.withColumns({c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in FEATURE_COLUMNS})
