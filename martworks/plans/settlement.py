"""Daily restaurant settlement."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.operators.load import update_matched, upsert

KEYS = ["restaurant_id", "settlement_date"]


def settlement(sales: DataFrame, orders: DataFrame, timestamps: DataFrame, restaurants: DataFrame,
               how: str = "inner") -> DataFrame:
    """Totals per restaurant and day.

    ``sales``: order_id, count, price, bonus_payment, bonus_grant (decimals); ``orders``: id,
    restaurant_id, timestamp_id; ``timestamps``: id, date; ``restaurants``: id, restaurant_name.
    """
    facts = (
        sales.join(orders.select(F.col("id").alias("order_id"), "restaurant_id", "timestamp_id"), "order_id", how)
        .join(timestamps.select(F.col("id").alias("timestamp_id"), F.col("date").alias("settlement_date")),
              "timestamp_id", how)
    )
    cost = F.col("price") * F.col("count")
    totals = facts.groupBy(*KEYS).agg(
        F.sum("count").alias("orders_count"),
        F.sum(cost).alias("orders_total_sum"),
        F.sum("bonus_payment").alias("orders_bonus_payment_sum"),
        F.sum("bonus_grant").alias("orders_bonus_granted_sum"),
    )
    # The name is looked up after grouping: one row per restaurant and day instead of one per sale.
    named = totals.join(restaurants.select(F.col("id").alias("restaurant_id"), "restaurant_name"),
                        "restaurant_id", how)
    quarter, rest = F.lit("0.25").cast("decimal(3,2)"), F.lit("0.75").cast("decimal(3,2)")
    return named.select(
        "restaurant_id", "restaurant_name", "settlement_date", "orders_count", "orders_total_sum",
        "orders_bonus_payment_sum", "orders_bonus_granted_sum",
        (F.col("orders_total_sum") * quarter).alias("order_processing_fee"),
        (F.col("orders_total_sum") * rest - F.col("orders_bonus_payment_sum")).alias("restaurant_reward_sum"),
    )


def load_settlement(report: DataFrame, fresh: DataFrame) -> DataFrame:
    """Report after the upsert by restaurant and day."""
    return upsert(report, fresh, KEYS)


def append_and_update(report: DataFrame, fresh: DataFrame) -> DataFrame:
    """The two-step form: append days after the report's last one, update the rows already there."""
    last = report.agg(F.coalesce(F.max("settlement_date"), F.lit("1900-01-01").cast("date")).alias("d")).scalar()
    measures = [c for c in report.columns if c not in KEYS and c != "restaurant_name"]
    later = fresh.where(F.col("settlement_date") > last).select(*report.columns)
    return update_matched(report, fresh, KEYS, measures).unionByName(later)
