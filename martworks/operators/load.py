"""Warehouse load operators.

The functions that take and return DataFrames give the new state (or the rows to add); the functions
that take a path write it. Plain Parquet has no MERGE, so a change to existing rows rewrites only the
partitions that hold them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martworks.operators.dedup import keep_latest
from martworks.operators.joins import absent
from martworks.operators.skew import null_safe
from martworks.operators.windows import ranked
from martworks.session import scratch


def insert_new(target: DataFrame, src: DataFrame, keys: list[str], pick: dict[str, Column] | None = None) -> DataFrame:
    """Rows to insert: one per source key that the target lacks, over all key columns (null equals null).

    A key whose first column is null is not inserted. ``pick`` gives an aggregate per remaining column (such as
    ``max(city_id)``); without it the keys alone.
    """
    fresh = without_keys(src.where(F.col(keys[0]).isNotNull()), target, keys)
    if pick is None:
        return fresh.select(*keys).distinct()
    return fresh.groupBy(*keys).agg(*[c.alias(name) for name, c in pick.items()])


def without_keys(df: DataFrame, known: DataFrame, keys: list[str], how: str = "left_anti") -> DataFrame:
    """Rows whose key does not occur in ``known`` (or, as a semi join, those whose key does), null equal to null."""
    names = [f"_known{i}" for i in range(len(keys))]
    other = known.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]).distinct()
    return df.join(other, null_safe(df, keys, other, names), how)


def insert_ignore(target: DataFrame | None, src: DataFrame, key: str) -> DataFrame:
    """Rows to insert so that every key exists once; keys already there are left as they are."""
    fresh = src if target is None else absent(src, target, [key])
    order = [c for c in src.columns if c != key]
    return fresh.groupBy(key).agg(F.min(F.struct(*order)).alias("_row")).select(
        *[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in src.columns]
    )


def upsert(target: DataFrame, src: DataFrame, keys: list[str], update_cols: list[str] | None = None,
           newest: list[str] | None = None) -> DataFrame:
    """Target after inserting new keys and updating known ones from the source.

    Several source rows of a key are first reduced to the newest, or without ``newest`` to the one of the largest
    values. With ``update_cols`` the other columns of a known key keep their old value. A null key equals a null key.
    """
    src = keep_latest(src.select(*target.columns, *[c for c in newest or [] if c not in target.columns]), keys,
                      newest or [c for c in target.columns if c not in keys])
    if update_cols is None:
        return without_keys(target, src, keys).unionByName(src.select(*target.columns))
    new = src.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.lit(True).alias("_new"),
                     *[F.col(c).alias(f"_n_{c}") for c in target.columns if c not in keys])
    on = null_safe(target, keys, new, [f"_k_{k}" for k in keys])
    known_new = F.col("_new").isNotNull()
    known_old = F.col("_old").isNotNull()
    both = target.withColumn("_old", F.lit(True)).join(new, on, "full")

    def value(c: str) -> Column:
        if c in keys:
            return F.coalesce(F.col(c), F.col(f"_k_{c}"))
        changed = F.col(f"_n_{c}")
        if c in update_cols:
            return F.when(known_new, changed).otherwise(F.col(c))
        return F.when(known_old, F.col(c)).otherwise(changed)

    return both.select(*[value(c).alias(c) for c in target.columns])


def update_matched(target: DataFrame, src: DataFrame, keys: list[str], cols: list[str],
                   newest: list[str] | None = None) -> DataFrame:
    """Target with ``cols`` replaced where the source has the key; nothing is inserted, and no row is doubled.

    Several source rows of a key are first reduced to the newest, or without ``newest`` to the one of the largest
    values.
    """
    src = keep_latest(src.select(*dict.fromkeys([*keys, *cols, *(newest or [])])), keys, newest or cols)
    new = src.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.lit(True).alias("_hit"),
                     *[F.col(c).alias(f"_n_{c}") for c in cols])
    on = null_safe(target, keys, new, [f"_k_{k}" for k in keys])
    joined = target.join(new, on, "left")
    return joined.select(*[
        F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
        for c in target.columns
    ])


def replace_rows(target: DataFrame, src: DataFrame, where: Column) -> DataFrame:
    """Delete-and-insert: target rows meeting ``where`` give way to the source rows meeting it."""
    keep = target.where(~F.coalesce(where, F.lit(False)))
    return keep.unionByName(src.where(where).select(*target.columns))


def replace_partition(src: DataFrame, path: str, by: list[str]) -> None:
    """Overwrite exactly the partitions that occur in the source; running again changes nothing."""
    (
        src.hint("rebalance", *by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    )


def reload(src: DataFrame, path: str) -> None:
    """Truncate and load."""
    src.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def merge_partitions(spark: SparkSession, path: str, src: DataFrame, keys: list[str], by: list[str],
                     newest: list[str] | None = None) -> None:
    """Upsert into a partitioned table on disk, reading and rewriting only the partitions the source touches.

    Rows of a key are expected to stay in their partition. The new state is staged in the shared folder
    first, because a path cannot be read and overwritten at the same time; if the last write is cut
    short, running the merge again completes it.
    """
    target = spark.read.parquet(path)
    src = target.limit(0).unionByName(src.select(*target.columns))
    # Only folders between the smallest and the largest value are listed; null has its own.
    bounds = src.agg(*[f(c).alias(f"_{n}_{c}") for c in by for n, f in (("lo", F.min), ("hi", F.max))])
    near = F.lit(True)
    for c in by:
        lo, hi = (bounds.select(f"_{n}_{c}").scalar() for n in ("lo", "hi"))
        near = near & (F.col(c).between(lo, hi) | F.col(c).isNull())
    touched = without_keys(target.where(near), src, by, "left_semi")
    staged = scratch(spark, "merge")
    upsert(touched, src, [*by, *keys], newest=newest).write.partitionBy(*by).parquet(staged)
    replace_partition(spark.read.parquet(staged).select(*target.columns), path, by)


def high_mark(marks: DataFrame, key: str, floor: str = "1900-01-01") -> Column:
    """Stored mark of a load, as a scalar; a floor date when there is none yet."""
    mine = marks.where(F.col("workflow_key") == key)
    latest = F.max(F.to_timestamp("workflow_settings"))
    return mine.agg(F.coalesce(latest, F.lit(floor).cast("timestamp")).alias("mark")).scalar()


def load_increment(src: DataFrame, marks: DataFrame, key: str, ts_col: str) -> tuple[DataFrame, DataFrame]:
    """Source rows after the stored mark, and the mark row to append (none if there is no such row).

    Moments are compared in full. The rows are written to the shared folder and the mark is taken from them, so rows
    that arrive meanwhile are left to the next run.
    """
    late = src.where(F.col(ts_col).cast("timestamp") > high_mark(marks, key))
    path = scratch(src.sparkSession, "increment")
    late.write.parquet(path)
    fresh = src.sparkSession.read.schema(late.schema).parquet(path)
    mark = fresh.agg(F.max(ts_col).alias("_m")).where("_m is not null").select(
        F.lit(key).alias("workflow_key"), F.col("_m").cast("string").alias("workflow_settings")
    )
    return fresh, mark


def load_lookback(target: DataFrame, src: DataFrame, keys: list[str], ts_col: str, days: int = 7,
                  newest: list[str] | None = None) -> DataFrame:
    """Upsert of the source rows from ``days`` days before the target's latest moment on."""
    kind = target.schema[ts_col].dataType
    floor = F.lit("1900-01-01").cast(kind)
    lower = target.agg(
        (F.coalesce(F.max(ts_col), floor) - F.expr(f"INTERVAL {days} DAYS")).alias("m")
    ).scalar()
    return upsert(target, src.where(F.col(ts_col) >= lower), keys, newest=newest)


def hash_diff(target: DataFrame, src: DataFrame) -> DataFrame:
    """Distinct source rows that the target does not hold yet, over all columns (null equals null)."""
    return src.subtract(target.select(*src.columns))


def add_column(df: DataFrame, name: str, default) -> DataFrame:
    """Column with a default for rows that lack it, whether or not the column exists already."""
    old = F.col(name) if name in df.columns else F.lit(None)
    return df.withColumn(name, F.coalesce(old, F.lit(default)))


def number_new(target: DataFrame, src: DataFrame, key: str, id_col: str = "id", order: str | None = None) -> DataFrame:
    """New keys with surrogate ids continuing after the target's largest one.

    Numbers follow ``order`` (default: the key itself), of any sortable type. The rows are numbered by range, in
    parallel.
    """
    fresh = absent(src, target, [key])
    rows = ranked(fresh, [], list(dict.fromkeys([order or key, key])), "_n", unique=True)
    last = target.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long").alias("m")).scalar()
    return rows.withColumn(id_col, last + F.col("_n")).drop("_n")


def versioned(src: DataFrame, start: Column, end: str = "2099-12-31") -> DataFrame:
    """Dimension rows with a validity window open to a far-future day."""
    return src.withColumn("active_from", start).withColumn("active_to", F.lit(end).cast("timestamp"))


def new_calendar(target: DataFrame, moments: DataFrame, ts_col: str) -> DataFrame:
    """Timestamp-dimension rows, to the second, for moments the dimension does not hold yet."""
    second = F.date_trunc("second", F.col(ts_col)).cast(target.schema["ts"].dataType)
    fresh = absent(moments.select(second.alias("ts")).where("ts is not null").distinct(), target, ["ts"])
    return fresh.select(
        "ts", F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"),
        F.date_format("ts", "HH:mm:ss").alias("time"), F.to_date("ts").alias("date"),
    )


def append_without(df: DataFrame, path: str, drop: list[str], unique: list[str] | None = None) -> None:
    """Append, leaving out source-side columns, after removing duplicates by the given key."""
    rows = df.dropDuplicates(unique) if unique else df
    rows.drop(*drop).write.mode("append").parquet(path)


def publish(df: DataFrame, name: str) -> DataFrame:
    """Make a mart readable in SQL under a name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
