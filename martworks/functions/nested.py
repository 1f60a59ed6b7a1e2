"""JSON and nested-value Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def parse_json(c: Column | str, schema: T.StructType | str) -> Column:
    """JSON text or bytes to a struct; a malformed document gives null fields and stays in the frame."""
    col = F.col(c) if isinstance(c, str) else c
    return F.from_json(col.cast("string"), schema, {"mode": "PERMISSIVE"})


def open_json(df: DataFrame, value: str, schema: T.StructType | str, *keep: str | Column) -> DataFrame:
    """The fields of JSON text or bytes as columns, next to the kept ones.

    The document is parsed once per row: the fields come out of a generator, which later filters on them
    do not pass. As a plain projection every such filter would be rewritten over its own copy of the parser.
    """
    return df.select(*keep, F.inline(F.array(parse_json(value, schema))))


def to_message(*cols: str | Column) -> Column:
    """The columns as one JSON document."""
    return F.to_json(F.struct(*cols))


def explode_records(df: DataFrame, array: Column | str, keep: list, fields: dict[str, str] | None = None) -> DataFrame:
    """One row per element of an array of structs: the kept parent columns plus the element's fields.

    All fields come out of a single generator, so they stay in step. ``fields`` maps element field to
    output name; by default every field keeps its name.
    """
    rows = df.select(*keep, F.explode(array).alias("_item"))
    parents = [c for c in rows.columns if c != "_item"]
    if fields is None:
        return rows.select(*parents, "_item.*")
    return rows.select(*parents, *[F.col(f"_item.{src}").alias(dst) for src, dst in fields.items()])
