"""Global transaction metrics by day and currency."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def global_metrics(transactions: DataFrame, currencies: DataFrame, day: str | None = None,
                   currency_with: int | None = None, account_currency: int = 420) -> DataFrame:
    """Totals of finished incoming transfers.

    ``transactions``: operation_id, account_number_from, currency_code, status, transaction_type, amount,
    sent_dttm; ``currencies``: sent_dttm, currency_code, currency_code_with, currency_with_div.
    ``currency_with`` limits the rates to one target currency; without it every rate of the day counts.
    ``cnt_transactions`` is the sum of amounts, as the mart has it; ``transactions_count`` counts operations.
    """
    done = transactions.where(
        (F.col("account_number_from") > 0) & (F.col("status") == "done") & F.col("transaction_type").like("%comin%")
    ).withColumn("date_update", F.to_date("sent_dttm"))
    rates = currencies.withColumn("date_update", F.to_date("sent_dttm"))
    if day is not None:
        done, rates = (d.where(F.col("date_update") == F.lit(day).cast("date")) for d in (done, rates))
    if currency_with is not None:
        rates = rates.where(F.col("currency_code_with") == currency_with)
    own = F.when(F.col("currency_code") == account_currency, F.col("account_number_from"))
    # A day and currency has one sum of rates, so both sides are grouped first and only their few groups
    # are joined; several rates of a day still multiply the amounts, as a join of the rows would.
    sums = done.groupBy("date_update", "currency_code").agg(
        F.sum("amount").alias("_amount"),
        F.countDistinct("operation_id").alias("transactions_count"),
        F.countDistinct(own).alias("cnt_accounts_make_transactions"),
    )
    day_rates = rates.groupBy("date_update", "currency_code").agg(
        F.sum("currency_with_div").alias("_rate"), F.count(F.lit(1)).alias("_rates")
    )
    grouped = sums.join(day_rates, ["date_update", "currency_code"], "left").withColumns({
        "_total": F.col("_amount") * F.col("_rate"),
        "cnt_transactions": F.col("_amount") * F.coalesce("_rates", F.lit(1)),
    })
    return grouped.select(
        "date_update", F.col("currency_code").alias("currency_from"),
        F.col("_total").cast("decimal(20,2)").alias("amount_total"),
        "cnt_transactions",
        F.round(F.try_divide(F.col("_total"), F.col("transactions_count")), 0).cast("long")
        .alias("avg_transactions_per_account"),
        "cnt_accounts_make_transactions", "transactions_count",
    )
