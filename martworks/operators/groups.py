"""Grouping helpers that stay safe when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martworks.operators.skew import free, null_safe
from martworks.operators.windows import ranked
from martworks.session import stored


#: Items of one part of a list.
LIST_ROWS = 100_000


def collect_parts(df: DataFrame, keys: list[str], item: Column, name: str, row_id: str | Column,
                  list_rows: int = LIST_ROWS, part_rows: int | None = None) -> DataFrame:
    """Sorted list of items per key and part, with the ``part`` column.

    The rows of a key are numbered in the order of ``row_id``, any sortable column that tells them apart, and every
    ``list_rows`` of them are a part: all lists but a key's last have that length, whatever the ids are. Null ids come
    first. Keys are counted first, and only rows of keys with more than one list are numbered; the input is read twice.
    """
    at, id_ = free(df, "at", "id")

    def listed(rows: DataFrame, part: Column) -> DataFrame:
        return rows.groupBy(*keys, part.alias("part")).agg(F.array_sort(F.collect_list(item)).alias(name))

    def in_parts(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn(id_, F.col(row_id) if isinstance(row_id, str) else row_id)
        numbers = ranked(rows, keys, [id_], at, unique=True, part_rows=part_rows)
        return listed(numbers, F.floor((F.col(at) - 1) / list_rows).cast("int"))

    if part_rows is not None:
        return in_parts(df)
    names = free(df, *[f"k{i}" for i in range(len(keys))])
    counts = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.count(F.lit(1)).alias(at))
    # A key per ``list_rows`` rows at most.
    long = stored(counts.where(F.col(at) > list_rows).select(*names), "long_keys")
    if long.isEmpty():
        return listed(df, F.lit(0))
    same, others = null_safe(df, keys, long, names), F.broadcast(long)
    return listed(df.join(others, same, "left_anti"), F.lit(0)).unionByName(in_parts(df.join(others, same, "left_semi")))


def key_counts(df: DataFrame, keys: list[str], name: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def most_frequent(df: DataFrame, keys: list[str], k: int, name: str = "cnt") -> DataFrame:
    """The k keys with most rows; equal counts are ordered by the key."""
    return key_counts(df, keys, name).orderBy(F.desc(name), *keys).limit(k)
