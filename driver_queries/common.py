"""Shared by the driver queries: table loading, plain output types, SQL fragments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from martworks.session import stored  # noqa: F401


class Tables:
    """The driver tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        """The same table as a stream; the pattern matches a single file as well as a folder of part files."""
        reader = self.spark.readStream.schema(getattr(self, name).schema)
        return reader.parquet(f"{self.sf_dir}/{name}.parquet*")


def plain(df: DataFrame) -> DataFrame:
    """Output in types both engines show alike: decimals as double, times and dates as text, lists joined."""
    out = []
    for f in df.schema.fields:
        col, kind = F.col(f"`{f.name}`"), f.dataType
        if isinstance(kind, T.DecimalType):
            col = col.cast("double")
        elif isinstance(kind, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.BooleanType):
            col = col.cast("int")
        elif isinstance(kind, T.ArrayType):
            col = F.array_join(F.transform(col, lambda x: x.cast("string")), ",")
        out.append(col.alias(f.name))
    return df.select(*out)


def per_order(lines: DataFrame, item, name: str, *more) -> DataFrame:
    """The lines of each order as a sorted list, and other aggregates of them; an order has at most seven."""
    return lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias(name), *more)


def query(build):
    """A registered query out of a function of the tables."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(Tables(spark, sf_dir)))
    run.__name__, run.__doc__ = build.__name__, build.__doc__
    return run


def dec(col, precision: int = 14, scale: int = 2):
    """Money: cast a double factor before any arithmetic."""
    return (F.col(col) if isinstance(col, str) else col).cast(f"decimal({precision},{scale})")


def day(text: str):
    return F.lit(text).cast("timestamp_ntz")


# SQL fragments.
SQL_TS = "strftime({}, '%Y-%m-%d %H:%M:%S')"
SQL_DAY = "strftime({}, '%Y-%m-%d')"


def ts_sql(expr: str) -> str:
    return SQL_TS.format(expr)


def day_sql(expr: str) -> str:
    return SQL_DAY.format(expr)


def uuid5_sql(expr: str) -> str:
    h = f"sha1(unhex('6ba7b8149dad11d180b400c04fd430c8') || encode({expr}))"
    return (
        f"(substr({h},1,8) || '-' || substr({h},9,4) || '-5' || substr({h},14,3) || '-' || "
        f"translate(substr({h},17,1),'0123456789abcdef','89ab89ab89ab89ab') || substr({h},18,3) || '-' || "
        f"substr({h},21,12))"
    )
