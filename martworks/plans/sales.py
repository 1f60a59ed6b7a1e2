"""Signed sales fact and weekly customer retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from martworks.operators.load import add_column


def signed_sales(order_log: DataFrame, refunded: str = "refunded", default: str = "shipped") -> DataFrame:
    """Order log with refunds as negative quantity and amount; rows without a status are shipped."""
    rows = add_column(order_log, "status", default)
    sign = F.when(F.col("status") == refunded, F.lit(-1)).otherwise(F.lit(1))
    return rows.withColumns({
        "quantity": F.col("quantity") * sign,
        "payment_amount": F.col("payment_amount") * sign,
    })


def retention_weekly(order_log: DataFrame, refunded: str = "refunded", default: str = "shipped") -> DataFrame:
    """New, returning and refunding customers per ISO week and item, with their revenue.

    A customer is new with exactly one order of the item in the week and returning with several;
    refunded orders are counted apart.
    """
    rows = add_column(order_log, "status", default)
    kept = F.col("status") != refunded
    day = F.col("order_date")
    # A customer's rows of an item and week are brought together once and sorted, so neither orders nor customers, which
    # grow with the rows, are held in a task's memory. Orders are counted at their first row of either kind.
    customer = ["period_id", "item_id", "customer_id"]
    lines = rows.select(
        (F.extract(F.lit("YEAROFWEEK"), day) * 100 + F.weekofyear(day)).cast("int").alias("period_id"),
        "item_id", "customer_id", "order_id", kept.alias("_kept"), "payment_amount",
    ).repartition(*customer)
    of_order = W.partitionBy(*customer, "order_id", "_kept").orderBy(F.lit(0))
    of_customer = W.partitionBy(*customer)
    sorted_ = lines.sortWithinPartitions(*customer, "order_id", "_kept")
    first = sorted_.withColumn("_first", F.row_number().over(of_order) == 1)
    paid = F.when(F.col("_kept"), F.col("payment_amount"))
    counted = first.select(
        "period_id", "item_id", F.row_number().over(of_customer.orderBy("order_id", "_kept")).alias("_row"),
        F.sum((F.col("_first") & F.col("_kept")).cast("int")).over(of_customer).alias("_orders"),
        F.sum((F.col("_first") & ~F.col("_kept")).cast("int")).over(of_customer).alias("_refunds"),
        F.sum(paid).over(of_customer).alias("_revenue"),
    )
    by_customer = counted.where("_row = 1")
    new, returning = F.col("_orders") == 1, F.col("_orders") > 1
    zero = F.lit(0).cast("decimal(38,2)")
    return by_customer.groupBy("period_id", "item_id").agg(
        F.count_if(new).alias("new_customers_count"),
        F.count_if(returning).alias("returning_customers_count"),
        F.count_if(F.col("_refunds") > 0).alias("refunded_customer_count"),
        F.coalesce(F.sum(F.when(new, F.col("_revenue"))), zero).alias("new_customers_revenue"),
        F.coalesce(F.sum(F.when(returning, F.col("_revenue"))), zero).alias("returning_customers_revenue"),
        F.sum("_refunds").alias("customers_refunded"),
    ).withColumn("period_name", F.lit("weekly"))
