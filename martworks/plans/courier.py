"""Monthly courier ledger with pay by rating tier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from martworks.operators.joins import valid_now
from martworks.operators.load import upsert
from martworks.operators.windows import with_stats

MONEY = "decimal(14,2)"

# Upper rating bound (exclusive), share of the order sum, least pay.
PAY_TIERS = [("4.00", "0.05", 100), ("4.50", "0.07", 150), ("4.90", "0.08", 175), (None, "0.10", 200)]
PROCESSING_SHARE = "0.25"
TIP_SHARE = "0.95"


def tier_pay(rating: Column, total: Column) -> Column:
    """Pay for a total at a rating: the tier's share, but at least the tier's floor."""
    def pay(share: str, least: int) -> Column:
        return F.greatest((total * F.lit(share).cast("decimal(3,2)")).cast("decimal(26,4)"),
                          F.lit(least).cast("decimal(26,4)"))

    chosen = None
    for bound, share, least in PAY_TIERS:
        if bound is None:
            return chosen.otherwise(pay(share, least))
        below = rating < F.lit(bound).cast("decimal(14,2)")
        chosen = F.when(below, pay(share, least)) if chosen is None else chosen.when(below, pay(share, least))


def courier_ledger(deliveries: DataFrame, couriers: DataFrame, now, floor: str = "month") -> DataFrame:
    """One row per courier and month.

    ``floor='month'`` applies the least pay to the monthly total, ``'order'`` to every single order.
    """
    active = valid_now(couriers, now).select("id", "courier_id", "courier_name")
    year, month = F.year("order_ts"), F.month("order_ts")
    facts = deliveries.join(active.drop("courier_name"), "courier_id").select(
        "id", year.alias("settlement_year"), month.alias("settlement_month"),
        "order_id", "rate", F.col("order_sum").cast(MONEY).alias("order_sum"),
        F.col("tip_sum").cast("decimal(16,4)").alias("tip_sum"),
    )
    keys = ["id", "settlement_year", "settlement_month"]
    rate_avg = F.avg("rate").cast("decimal(14,2)")
    by_order = []
    if floor == "order":
        facts = with_stats(facts, keys, _rating=rate_avg)
        facts = facts.withColumn("_pay", tier_pay(F.col("_rating"), F.col("order_sum")))
        by_order = [F.sum("_pay").cast("decimal(26,4)").alias("courier_order_sum")]
    # An order's deliveries by one courier lie side by side after a sort, which may spill; a distinct count would hold
    # every order of a task in a hash table, first where the deliveries are read, in tasks as large as a file's split.
    order = [*keys, "order_id"]
    lines = facts.repartition(*order).withColumn("_line", F.row_number().over(W.partitionBy(*order).orderBy(F.lit(0))))
    totals = lines.groupBy(*keys).agg(
        F.count_if((F.col("_line") == 1) & F.col("order_id").isNotNull()).alias("orders_count"),
        F.sum("order_sum").alias("orders_total_sum"),
        rate_avg.alias("rate_avg"),
        F.sum("tip_sum").alias("courier_tips_sum"),
        *by_order,
    )
    if floor != "order":
        totals = totals.withColumn("courier_order_sum", tier_pay(F.col("rate_avg"), F.col("orders_total_sum")))
    tips = F.col("courier_tips_sum") * F.lit(TIP_SHARE).cast("decimal(3,2)")
    # The name is looked up after grouping: one row per courier and month instead of one per delivery.
    named = totals.join(active.select("id", "courier_name"), "id")
    return named.select(
        "id", "courier_name", "settlement_year", "settlement_month", "orders_count", "orders_total_sum", "rate_avg",
        (F.col("orders_total_sum") * F.lit(PROCESSING_SHARE).cast("decimal(3,2)")).alias("order_processing_fee"),
        "courier_order_sum", "courier_tips_sum", (tips + F.col("courier_order_sum")).alias("courier_reward_sum"),
    )


def load_ledger(ledger: DataFrame, fresh: DataFrame) -> DataFrame:
    """Ledger after the upsert by courier and month."""
    return upsert(ledger, fresh, ["id", "settlement_year", "settlement_month"])
