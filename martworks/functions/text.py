"""Text Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_fields(c: Column | str, fields: dict[str, str], sep: str = ":") -> list[Column]:
    """Columns cut out of delimited text, in order; ``fields`` maps name to type. Dirty parts give null."""
    parts = F.split(_col(c), "\\Q" + sep + "\\E")
    return [F.get(parts, F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(fields.items())]


def decimal_comma(c: Column | str) -> Column:
    """'-33,86' to -33.86; null when it is not a number."""
    return F.regexp_replace(_col(c).cast("string"), ",", ".").try_cast("double")


def words(c: Column | str) -> Column:
    """Lower-cased words of a text: every run of letters and digits, of the whole text."""
    parts = F.split(F.lower(_col(c)), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def as_text(binary: Column | str) -> Column:
    return _col(binary).cast("string")


def as_binary(text: Column | str) -> Column:
    return _col(text).cast("binary")
