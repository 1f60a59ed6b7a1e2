"""Duplicate and null removal."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.operators.windows import top1


def keep_latest(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """One row per key, the newest; the same on every run when ``by`` is unique within the key."""
    return top1(df, keys, by)


def unique_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Unordered pairs, each once: (1,2) and (2,1) are the same pair, shown smaller value first."""
    return ordered_pair(df, a, b).select(a, b).distinct()


def ordered_pair(df: DataFrame, a: str, b: str) -> DataFrame:
    """Put the smaller value of the two columns first."""
    return df.withColumns({a: F.least(a, b), b: F.greatest(a, b)})


def null_audit(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows, rows without any null in the columns, and rows with at least one."""
    columns = columns or df.columns
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("row_cnt"),
        F.count_if(complete).alias("complete_cnt"),
        F.count_if(~complete).alias("null_cnt"),
    )
