"""Shipping log split into reference tables, and the shipping mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.functions import times
from martworks.functions.text import split_fields
from martworks.operators.windows import ranked

AGREEMENT = {"agreementid": "long", "agreement_number": "string", "agreement_rate": "decimal(14,3)",
             "agreement_commission": "decimal(14,3)"}
TRANSFER = {"transfer_type": "string", "transfer_model": "string"}


def _numbered(rows: DataFrame) -> DataFrame:
    """Serial ids for a reference table; the order is by hash, so it is the same on every run."""
    cols = rows.columns
    hashed = rows.withColumn("_h", F.xxhash64(*cols))
    return ranked(hashed, [], ["_h", *cols], "id", unique=True).select("id", *cols)


def country_rates(log: DataFrame) -> DataFrame:
    return _numbered(log.select("shipping_country", "shipping_country_base_rate").distinct())


def agreements(log: DataFrame) -> DataFrame:
    texts = log.select("vendor_agreement_description").distinct()
    return texts.select(*split_fields("vendor_agreement_description", AGREEMENT)).distinct()


def transfers(log: DataFrame) -> DataFrame:
    texts = log.select("shipping_transfer_description", "shipping_transfer_rate").distinct()
    return _numbered(
        texts.select(*split_fields("shipping_transfer_description", TRANSFER), "shipping_transfer_rate").distinct()
    )


def shipping_info(log: DataFrame, rates: DataFrame, transfer: DataFrame) -> DataFrame:
    """One row per shipping with the ids of its reference rows."""
    agreement_id, = split_fields("vendor_agreement_description", {"agreementid": "long"})
    parts = split_fields("shipping_transfer_description", TRANSFER)
    facts = log.select(
        "shippingid", "vendorid", "payment_amount", "shipping_plan_datetime", "shipping_country",
        "shipping_country_base_rate", agreement_id, *parts, "shipping_transfer_rate",
    )
    cols = [c for c in facts.columns if c != "shippingid"]
    one = facts.groupBy("shippingid").agg(F.min(F.struct(*cols)).alias("_r")).select("shippingid", "_r.*")
    return (
        one.join(rates.withColumnRenamed("id", "shipping_country_rate_id"),
                 ["shipping_country", "shipping_country_base_rate"], "left")
        .join(transfer.withColumnRenamed("id", "shipping_transfer_id"),
              ["transfer_type", "transfer_model", "shipping_transfer_rate"], "left")
        .select("shippingid", "vendorid", "payment_amount", "shipping_plan_datetime", "shipping_country_rate_id",
                "agreementid", "shipping_transfer_id")
    )


def shipping_status(log: DataFrame, start_state: str = "booked", end_state: str = "recieved") -> DataFrame:
    """Final status and state of every shipping, and when it began and ended.

    A single grouped pass: the final state is the latest by time; start and end are the earliest and the
    latest moment of the two named states.
    """
    moment = F.col("state_datetime")
    return log.groupBy("shippingid").agg(
        F.max_by(F.struct("status", "state"), F.struct("state_datetime", "state", "status")).alias("_last"),
        F.min(F.when(F.col("state") == start_state, moment)).alias("shipping_start_fact_datetime"),
        F.max(F.when(F.col("state") == end_state, moment)).alias("shipping_end_fact_datetime"),
    ).select("shippingid", "_last.*", "shipping_start_fact_datetime", "shipping_end_fact_datetime")


def shipping_mart(info: DataFrame, status: DataFrame, rates: DataFrame, agreement: DataFrame,
                  transfer: DataFrame) -> DataFrame:
    start, end, plan = (F.col(c) for c in (
        "shipping_start_fact_datetime", "shipping_end_fact_datetime", "shipping_plan_datetime"))
    joined = (
        info.join(status, "shippingid")
        .join(rates.select(F.col("id").alias("shipping_country_rate_id"), "shipping_country_base_rate"),
              "shipping_country_rate_id")
        .join(agreement, "agreementid")
        .join(transfer.withColumnRenamed("id", "shipping_transfer_id"), "shipping_transfer_id")
    )
    late = end > plan
    duty = F.col("shipping_country_base_rate") + F.col("agreement_rate") + F.col("shipping_transfer_rate")
    return joined.select(
        "shippingid", "vendorid", "transfer_type",
        times.days_between(end, start).alias("full_day_at_shipping"),
        F.when(late, 1).otherwise(0).alias("is_delay"),
        F.when(F.col("status") == "finished", 1).otherwise(0).alias("is_shipping_finish"),
        F.when(late, times.days_between(end, plan)).otherwise(F.lit(0)).alias("delay_day_at_shipping"),
        "payment_amount",
        (F.col("payment_amount") * duty).alias("vat"),
        (F.col("payment_amount") * F.col("agreement_commission")).alias("profit"),
    )
