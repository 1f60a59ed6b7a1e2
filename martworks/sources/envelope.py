"""Raw-layer envelopes: ``(object_id, object_value, update_ts)`` with the document kept as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.functions import nested, times


def to_envelope(df: DataFrame, id_col: str, now=None) -> DataFrame:
    """Whole records as JSON, stamped with the load time."""
    return df.select(
        F.col(id_col).cast("string").alias("object_id"),
        nested.to_message("*").alias("object_value"),
        times.now_or(now).alias("update_ts"),
    )


def documents_after(df: DataFrame, id_col: str, ts_col: str, mark=None) -> DataFrame:
    """Documents changed at or after a mark; id and time are split off the document body."""
    changed = df if mark is None else df.where(F.col(ts_col) >= F.lit(mark).cast(df.schema[ts_col].dataType))
    body = [c for c in df.columns if c not in (id_col, ts_col)]
    return changed.select(
        F.col(id_col).cast("string").alias("object_id"),
        nested.to_message(*body).alias("object_value"),
        F.col(ts_col).alias("update_ts"),
    )


def open_envelope(df: DataFrame, schema, keep: tuple[str, ...] = ("object_id", "update_ts")) -> DataFrame:
    """Typed columns of the enveloped documents, next to the envelope columns asked for."""
    return nested.open_json(df, "object_value", schema, *keep)
