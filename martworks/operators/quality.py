"""Data-quality rules and checks. Checks give one-row frames of 0/1, so they can be logged or raised on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


class GateError(ValueError):
    """A gate found rows that break its rules."""


def rule_flags(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Each rule as a 0/1 column; an undecided (null) rule counts as broken."""
    return df.withColumns({name: F.when(rule, 1).otherwise(0) for name, rule in rules.items()})


def gate(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row: 1 when every row keeps every rule, else 0."""
    flags = [F.when(rule, 1).otherwise(0) for rule in rules.values()]
    worst = F.least(*flags) if len(flags) > 1 else flags[0]
    return df.agg(F.coalesce(F.min(worst), F.lit(1)).alias("passed"))


def require(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The frame itself, or an error naming the broken rules; only the counts come to the driver."""
    broken = df.agg(*[F.count_if(~F.coalesce(rule, F.lit(False))).alias(n) for n, rule in rules.items()]).first()
    bad = {name: n for name, n in broken.asDict().items() if n}
    if bad:
        raise GateError(f"rows breaking a rule: {bad}")
    return df


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows keeping all rules, and the others with the names of the rules they break."""
    broken = F.filter(
        F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]),
        lambda x: x.isNotNull(),
    )
    judged = df.withColumn("broken_rules", broken)
    return (judged.where(F.size("broken_rules") == 0).drop("broken_rules"),
            judged.where(F.size("broken_rules") > 0))


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule with the number of rows that break it, from a single pass."""
    counts = df.agg(*[F.count_if(~F.coalesce(rule, F.lit(False))).alias(n) for n, rule in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations")


def no_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: how many nulls, and 1 when there is none."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "null_cnt").withColumn(
        "passed", (F.col("null_cnt") == 0).cast("int")
    )


def value_check(df: DataFrame, value: Column, expected: float, tolerance: float = 0.0) -> DataFrame:
    """One row: the scalar, and 1 when it is within ``tolerance`` (relative) of the expected value."""
    return df.agg(value.alias("value")).withColumn(
        "passed", (F.abs(F.col("value") - expected) <= tolerance * abs(expected)).cast("int")
    )


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent (a null key refers to nothing and is no orphan)."""
    return child.where(F.col(key).isNotNull()).join(
        parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti"
    )


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, as one frame."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_cnt")).select(F.lit(n).alias("table_name"), "row_cnt")
              for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


LOG_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()), T.StructField("check_name", T.StringType()),
    T.StructField("check_date", T.DateType()), T.StructField("check_result", T.IntegerType()),
])


def log_rows(check: DataFrame, table: str, name: str, date) -> DataFrame:
    """Results-log row of a check that has a ``passed`` column: 0 is fine, 1 is a failure."""
    return check.agg(F.min("passed").alias("_p")).select(
        F.lit(table).alias("table_name"), F.lit(name).alias("check_name"),
        F.lit(date).cast("date").alias("check_date"),
        (1 - F.coalesce("_p", F.lit(0))).cast("int").alias("check_result"),
    )


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def presence(expected: DataFrame, found: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Each expected file with 1 when it has arrived, else 0."""
    there = found.select(name_col).distinct().withColumn("_there", F.lit(1))
    return expected.join(there, name_col, "left").select(
        name_col, F.coalesce("_there", F.lit(0)).alias("passed")
    )
