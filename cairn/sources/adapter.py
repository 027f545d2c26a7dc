"""Canonical customer-value tables derived from the driver's TPC-H-style tables.

The driver tables carry no loyalty, consent, acquisition or monthly-interaction
fields, so they are derived deterministically from keys and balances.  The DuckDB
oracle uses the same rules (``cairn.plans.oracle.ADAPTER_SQL``).

Canonical tables (money is exact DECIMAL(16,2)):

* ``customers``    customer_id, acquisition_date, region, age_band, loyalty_tier,
                   preferred_channel, marketing_consent
* ``order_lines``  order_line_id, order_id, customer_id, order_date, product_id,
                   category, quantity, discount_rate, gross_revenue, discount_amount,
                   returned_flag, returned_amount, net_revenue, gross_margin
* ``orders``       order_id, customer_id, order_date, channel, primary_category,
                   item_count, gross_revenue, discount_amount, returned_amount,
                   net_revenue, gross_margin, returned_flag
* ``interactions`` customer_id, month (month end), sessions, email_sent, email_opens,
                   email_clicks, support_tickets, nps_score
* ``products``     product_id, category, list_price, margin_pct
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# --- fixed values: derivation rules of the rebuild's adapter ------------------------
AGE_BANDS = ["18-24", "25-34", "35-44", "45-54", "55+"]
PREFERRED_CHANNELS = ["Mobile App", "Web", "Store", "Marketplace"]
ORDER_CHANNEL_BY_PRIORITY = {"1-URGENT": "Mobile App", "2-HIGH": "Web", "3-MEDIUM": "Marketplace"}
ORDER_CHANNEL_DEFAULT = "Store"
LOYALTY_EDGES = [(2000.0, "Bronze"), (5000.0, "Silver"), (8000.0, "Gold")]
LOYALTY_TOP = "Platinum"
REVENUE_SCALE = Decimal("0.02")      # driver prices are ~50x a retail basket
ACQUISITION_LAG_MOD = 45             # acquisition = first order - (id % 45) days
NO_ORDER_ACQUISITION = "1995-01-01"
INTERACTION_END = (2001, 7)          # interaction months end at 2001-07
INTERACTION_MONTHS = 36
MONEY = "decimal(16,2)"

# Region and nation are broadcast if they have at most so many rows; every other join
# is left to the optimizer's size statistics.
BROADCAST_ROW_LIMIT = 10_000


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows; else leave the join to
    the optimizer."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def _case(column, mapping: dict, default: str):
    expr = None
    for key, value in mapping.items():
        cond = column == F.lit(key)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(default))


def _label_by_mod(key, labels: list[str]):
    idx = F.pmod(key, F.lit(len(labels)))
    expr = None
    for i, label in enumerate(labels):
        expr = F.when(idx == i, F.lit(label)) if expr is None else expr.when(idx == i, F.lit(label))
    return expr


class Canonical:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    # ---- dimensions -------------------------------------------------------------
    def customers(self) -> DataFrame:
        cust = read_table(self.spark, self.sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal"])
        nation = read_table(self.spark, self.sf_dir, "nation", ["n_nationkey", "n_regionkey"])
        region = read_table(self.spark, self.sf_dir, "region", ["r_regionkey", "r_name"])
        geo = nation.join(bounded_broadcast(region), nation.n_regionkey == region.r_regionkey, "left").select(
            "n_nationkey", "r_name"
        )
        first = (
            read_table(self.spark, self.sf_dir, "orders", ["o_custkey", "o_orderdate"])
            .groupBy("o_custkey")
            .agg(F.min(F.to_date("o_orderdate")).alias("first_order_date"))
        )
        key = F.col("c_custkey")
        acquisition = F.coalesce(
            F.date_sub(F.col("first_order_date"), F.pmod(key, F.lit(ACQUISITION_LAG_MOD)).cast("int")),
            F.lit(NO_ORDER_ACQUISITION).cast("date"),
        )
        tier = None
        for edge, label in LOYALTY_EDGES:
            cond = F.col("c_acctbal") < F.lit(edge)
            tier = F.when(cond, F.lit(label)) if tier is None else tier.when(cond, F.lit(label))
        tier = tier.otherwise(F.lit(LOYALTY_TOP))
        return (
            cust.join(bounded_broadcast(geo), cust.c_nationkey == geo.n_nationkey, "left")
            .join(first, cust.c_custkey == first.o_custkey, "left")
            .select(
                key.alias("customer_id"),
                acquisition.alias("acquisition_date"),
                F.col("r_name").alias("region"),
                _label_by_mod(key, AGE_BANDS).alias("age_band"),
                tier.alias("loyalty_tier"),
                _label_by_mod(key, PREFERRED_CHANNELS).alias("preferred_channel"),
                F.when(F.pmod(key, F.lit(10)) == 0, F.lit(0)).otherwise(F.lit(1)).alias("marketing_consent"),
            )
        )

    def products(self) -> DataFrame:
        part = read_table(self.spark, self.sf_dir, "part", ["p_partkey", "p_type", "p_retailprice"])
        k = F.pmod(F.col("p_partkey"), F.lit(28))
        return part.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").cast("decimal(14,2)").alias("list_price"),
            ((F.lit(31) + k).cast("decimal(4,0)") * F.lit(Decimal("0.01"))).cast("decimal(10,4)").alias("margin_pct"),
        )

    # ---- facts ------------------------------------------------------------------
    def _source_lines(self) -> DataFrame:
        """Every line of lineitem with its category; a line without a part has none."""
        li = read_table(
            self.spark,
            self.sf_dir,
            "lineitem",
            ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_returnflag", "l_shipdate"],
        )
        part = read_table(self.spark, self.sf_dir, "part", ["p_partkey", "p_type"])
        return li.join(part, li.l_partkey == part.p_partkey, "left").drop("p_partkey").withColumnRenamed("l_orderkey", "order_id")

    def _rated(self, lines: DataFrame, *others: str) -> DataFrame:
        """Source lines with their gross revenue, discount and cost rate, and ``others``."""
        # precisions stay <= 18 so decimal arithmetic runs on longs, not BigDecimal
        gross = F.round(F.col("l_extendedprice").cast("decimal(12,2)") * F.lit(REVENUE_SCALE), 2).cast("decimal(12,2)")
        rate = F.col("l_discount").cast("decimal(5,4)")
        return lines.select(
            "order_id", *others, "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate",
            F.col("p_type").alias("category"),
            F.col("l_quantity").cast("int").alias("quantity"),
            rate.cast("decimal(10,4)").alias("discount_rate"),
            gross.cast(MONEY).alias("gross_revenue"),
            F.round(gross * rate, 2).cast(MONEY).alias("discount_amount"),
            F.when(F.col("l_returnflag") == F.lit("R"), 1).otherwise(0).alias("returned_flag"),
            (F.lit(69) - F.pmod(F.col("l_partkey"), F.lit(28))).alias("_cost_pct"),
        )

    def _priced(self, lines: DataFrame, *others: str) -> DataFrame:
        """Source lines with their economics, and ``others``."""
        out = self._rated(lines, *others)
        net_before = (F.col("gross_revenue") - F.col("discount_amount")).cast(MONEY)
        out = out.withColumn(
            "returned_amount", F.when(F.col("returned_flag") == 1, net_before).otherwise(F.lit(0).cast(MONEY))
        )
        out = out.withColumn("net_revenue", (net_before - F.col("returned_amount")).cast(MONEY))
        cost_rate = F.col("_cost_pct").cast("decimal(4,0)") * F.lit(Decimal("0.01"))
        cost = F.when(F.col("returned_flag") == 1, F.lit(0).cast(MONEY)).otherwise(
            F.round(F.col("gross_revenue").cast("decimal(12,2)") * cost_rate, 2).cast(MONEY)
        )
        return out.withColumn("gross_margin", (F.col("net_revenue") - cost).cast(MONEY)).drop("_cost_pct")

    def _lines_in_cents(self) -> DataFrame:
        """The economics of ``_priced`` as whole cents, the lines of an order in one task.
        They move as narrow rows; the sums of longs need no decimal of 28 digits a line."""
        cents = lambda c: (F.col(c) * 100).cast("long").alias(c)
        out = self._rated(self._source_lines()).select("order_id", "l_linenumber", "l_partkey", "category", "quantity", cents("gross_revenue"),
                                         cents("discount_amount"), "returned_flag", "_cost_pct").repartition("order_id")
        gross, back, none = F.col("gross_revenue"), F.col("returned_flag") == 1, F.lit(0).cast("long")
        net_before = gross - F.col("discount_amount")
        # half a cent is rounded away from zero, as in decimals
        cost = F.call_function("div", F.abs(gross) * F.col("_cost_pct") + 50, F.lit(100)) * F.when(gross < 0, -1).otherwise(1)
        out = out.withColumn("returned_amount", F.when(back, net_before).otherwise(none))
        out = out.withColumn("net_revenue", net_before - F.col("returned_amount"))
        return out.withColumn("gross_margin", F.col("net_revenue") - F.when(back, none).otherwise(cost)).drop("_cost_pct")

    def _headers(self) -> DataFrame:
        orders = read_table(self.spark, self.sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
        return orders.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.to_date("o_orderdate").alias("order_date"),
            _case(F.col("o_orderpriority"), ORDER_CHANNEL_BY_PRIORITY, ORDER_CHANNEL_DEFAULT).alias("channel"),
        )

    def order_lines(self) -> DataFrame:
        """Every line with its order's header; a line without an order keeps null there."""
        # No window over an order: a line is identified by its natural key (order,
        # line number, part, supplier, price, ship date), so a huge order never lands
        # whole in one task.  Orders grow with the data: a shuffle join at every scale; the
        # economics follow it, so that only the source columns move.
        joined = self._source_lines().join(self._headers().hint("merge"), "order_id", "left")
        lines = self._priced(joined, "customer_id", "order_date", "channel")
        line_id = F.concat_ws(
            "-", F.col("order_id").cast("string"), F.col("l_linenumber").cast("string"),
            F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
            F.round(F.col("l_extendedprice") * 100).cast("long").cast("string"),
            F.date_format("l_shipdate", "yyyyMMdd"))
        return lines.select(
            "order_id", line_id.alias("order_line_id"), "customer_id", "order_date", "channel",
            F.col("l_partkey").alias("product_id"), "category", "quantity", "discount_rate", "gross_revenue",
            "discount_amount", "returned_flag", "returned_amount", "net_revenue", "gross_margin",
        )

    def orders(self) -> DataFrame:
        """Every order header with its line rollup and the first-seen mode of the category;
        an order without lines has zero items and amounts and no category.

        Lines move once, as narrow rows by order, and both aggregates and the join with the
        headers follow in the same tasks.  Nearly every line is an (order, category) of its
        own, so a map-side aggregate would shrink nothing and spill; a huge order passes
        through one task, which holds its sums per category only.
        "First seen" is the smallest (line number, part): a part has one category, so two
        categories of an order never tie on it, and it packs into one long.
        """
        sums = ["gross_revenue", "discount_amount", "returned_amount", "net_revenue", "gross_margin"]
        seen = F.shiftleft(F.col("l_linenumber").cast("long"), 40) + F.col("l_partkey")
        per_cat = self._lines_in_cents().groupBy("order_id", "category").agg(
            F.count(F.lit(1)).alias("_lines"), F.min(seen).alias("_first"), F.sum("quantity").alias("_qty"),
            *[F.sum(s).alias(s) for s in sums],
        )
        rollup = per_cat.groupBy("order_id").agg(
            # most lines first, then the category seen first
            F.min_by("category", F.struct(-F.col("_lines"), F.col("_first"))).alias("primary_category"),
            F.sum("_qty").cast("int").alias("item_count"),
            *[(F.sum(s).cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(MONEY).alias(s) for s in sums],
        )
        joined = self._headers().join(rollup.hint("merge"), "order_id", "left")
        return joined.select(
            "order_id", "customer_id", "order_date", "channel", "primary_category",
            F.coalesce("item_count", F.lit(0)).alias("item_count"),
            *[F.coalesce(s, F.lit(0).cast(MONEY)).alias(s) for s in sums],
            F.when(F.col("returned_amount") > 0, 1).otherwise(0).alias("returned_flag"),
        )

    def interactions(self) -> DataFrame:
        ev = read_table(self.spark, self.sf_dir, "events", ["event_id", "user_id", "event_type"])
        end_index = INTERACTION_END[0] * 12 + (INTERACTION_END[1] - 1)
        idx = F.lit(end_index) - F.pmod(F.floor(F.col("event_id") / 10), F.lit(INTERACTION_MONTHS))
        month = F.last_day(F.make_date(F.floor(idx / 12).cast("int"), (F.pmod(idx, F.lit(12)) + 1).cast("int"), F.lit(1)))
        et = F.col("event_type")
        return (
            ev.select(
                (F.col("user_id") * 10 + F.pmod(F.col("event_id"), F.lit(10))).alias("customer_id"),
                month.alias("month"),
                et,
            )
            .groupBy("customer_id", "month")
            .agg(
                F.count_if(et.isin("view", "click")).cast("int").alias("sessions"),
                F.count_if(et.isin("signup", "purchase")).cast("int").alias("email_sent"),
                F.count_if(et == "purchase").cast("int").alias("email_opens"),
                F.count_if(et == "click").cast("int").alias("email_clicks"),
                F.count_if(et == "error").cast("int").alias("support_tickets"),
            )
            .withColumn("nps_score", F.lit(None).cast("decimal(4,1)"))
        )


class MaterializedCanonical(Canonical):
    """The canonical star schema, built once per session and kept in the shared
    checkpoint folder (a warehouse would persist these tables the same way); every
    query of the session reads the materialized tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        self._tables: dict[str, DataFrame] = {}

    def _get(self, name: str, build) -> DataFrame:
        if name not in self._tables:
            from ..session import materialize

            self._tables[name] = materialize(build())
        return self._tables[name]

    def adopt(self, name: str, table: DataFrame) -> None:
        """Read ``name`` from ``table``, which has its rows, instead of keeping a copy."""
        self._tables.setdefault(name, table)

    def forget(self, name: str) -> None:
        self._tables.pop(name, None)

    def customers(self) -> DataFrame:
        return self._get("customers", super().customers)

    def order_lines(self) -> DataFrame:
        return self._get("order_lines", super().order_lines)

    def orders(self) -> DataFrame:
        return self._get("orders", super().orders)

    def interactions(self) -> DataFrame:
        return self._get("interactions", super().interactions)


_CACHE: dict[tuple[str, str], MaterializedCanonical] = {}


def canonical(spark: SparkSession, sf_dir: str) -> Canonical:
    """Session-wide materialized canonical tables for ``sf_dir``."""
    key = (spark.sparkContext.applicationId, str(sf_dir).rstrip("/"))
    if key not in _CACHE:
        _CACHE[key] = MaterializedCanonical(spark, sf_dir)
    return _CACHE[key]


def lazy_canonical(spark: SparkSession, sf_dir: str) -> Canonical:
    """Un-materialized canonical tables (pure lazy plans)."""
    return Canonical(spark, sf_dir)
