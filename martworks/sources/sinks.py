"""File sinks: layouts, dated marts, nested documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from martworks.operators.groups import LIST_ROWS, collect_parts


def write_partitioned(df: DataFrame, path: str, by: list[str], sort: list[str] | None = None,
                      mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Write by partition columns, so that readers can skip whole directories.

    The rebalance hint gathers each directory's rows into few files, and splits a directory that holds
    a large share of the rows over several tasks.
    """
    laid_out = df.hint("rebalance", *by)
    if sort:
        laid_out = laid_out.sortWithinPartitions(*by, *sort)
    laid_out.write.partitionBy(*by).mode(mode).format(fmt).save(path)


def write_dated(df: DataFrame, base: str, date: str, depth: int) -> str:
    """One mart run in its own directory ``date=<date>_<depth>``; running again replaces it."""
    path = f"{base}/date={date}_{depth}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_any(df: DataFrame, path: str, fmt: str, mode: str = "append", **options: str) -> None:
    df.write.format(fmt).mode(mode).options(**options).save(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int, sort: str) -> None:
    """Catalog table stored by hash of ``key``: later joins and groupings on it need no shuffle."""
    (
        df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
        .bucketBy(buckets, key).sortBy(sort).saveAsTable(table)
    )


def nested_documents(df: DataFrame, keys: list[str], item: Column, name: str, row_id: str,
                     list_rows: int = LIST_ROWS) -> DataFrame:
    """One document per key and ``list_rows`` of its rows, with these as a list."""
    return collect_parts(df, keys, item, name, row_id, list_rows)


def write_documents(df: DataFrame, path: str, fmt: str = "json", mode: str = "append") -> None:
    df.write.format(fmt).mode(mode).save(path)
