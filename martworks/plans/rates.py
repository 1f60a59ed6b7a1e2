"""Exchange rates, replaced per rate date."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.functions import times
from martworks.operators.load import replace_rows


def load_rates(target: DataFrame, fresh: DataFrame, rate_date: str, now=None) -> DataFrame:
    """Rates table in which the day's rows give way to the fresh ones, stamped with the load time."""
    stamped = fresh.withColumn("ingest_datetime", times.now_or(now)).select(*target.columns)
    return replace_rows(target, stamped, F.col("rate_date") == F.lit(rate_date).cast("date"))
