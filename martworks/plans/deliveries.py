"""Delivery load: enveloped JSON to typed rows, through a rule gate, into the delivery table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martworks.operators.load import load_lookback
from martworks.operators.quality import require, split_valid
from martworks.sources.envelope import open_envelope

DELIVERY = (
    "order_id string, order_ts timestamp, delivery_id string, courier_id string, address string, "
    "delivery_ts timestamp, rate smallint, sum decimal(14,2), tip_sum decimal(14,2)"
)


def typed(envelope: DataFrame) -> DataFrame:
    return open_envelope(envelope, DELIVERY, keep=("update_ts",)).withColumnRenamed("sum", "order_sum")


def rules(first_day: str = "2022-01-01", last_day: str = "2029-12-31") -> dict[str, Column]:
    """The delivery rules; the window of order days is a parameter."""
    return {
        "date_check": F.col("delivery_ts") > F.col("order_ts"),
        "order_sum_check": F.col("order_sum") >= 0,
        "tip_sum_check": F.col("tip_sum") >= 0,
        "rate_check": F.col("rate").between(1, 5),
        "order_ts_check": F.col("order_ts").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date")),
    }


def load(target: DataFrame, envelope: DataFrame, checks: dict[str, Column], days: int = 7,
         stop_on_error: bool = True) -> DataFrame:
    """Target after an upsert of the last days by order, from enveloped documents."""
    return load_typed(target, typed(envelope), checks, days, stop_on_error)


def load_typed(target: DataFrame, rows: DataFrame, checks: dict[str, Column], days: int = 7,
               stop_on_error: bool = True) -> DataFrame:
    """The same from typed rows, such as a staging table in which the documents were parsed once.

    The gate comes first: it raises, or with ``stop_on_error=False`` only the valid rows are loaded.
    """
    rows = require(rows, checks) if stop_on_error else split_valid(rows, checks)[0]
    # Newest by update time; the other columns decide between equal times, so every run agrees.
    newest = ["update_ts", *[c for c in target.columns if c not in ("order_id", "update_ts")]]
    return load_lookback(target, rows.select(*target.columns), ["order_id"], "order_ts", days, newest=newest)
