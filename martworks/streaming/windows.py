"""Windowed counts, word counts and joins on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martworks.functions.nested import open_json
from martworks.functions.text import words


def window_counts(df: DataFrame, ts: str, by: list[str], size: str, slide: str | None = None,
                  delay: str = "5 minutes") -> DataFrame:
    """Rows per event-time window and key; without ``slide`` the windows do not overlap."""
    over = F.window(ts, size, slide) if slide else F.window(ts, size)
    return df.withWatermark(ts, delay).groupBy(over, *by).agg(F.count(F.lit(1)).alias("cnt")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "cnt"
    )


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """Occurrences of every word of a text stream."""
    return df.select(F.explode(words(text)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def missing_words(df: DataFrame, text: str, table: DataFrame, word: str) -> DataFrame:
    """Words of a text stream that a static table lacks; ``keyed.first_seen`` keeps each of them once."""
    known = table.select(F.col(word).alias("word")).distinct().withColumn("_known", F.lit(True))
    found = df.select(F.explode(words(text)).alias("word"))
    return found.join(known, "word", "left").where(F.col("_known").isNull()).select("word")


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, within: str,
                  delay: str = "1 hour", how: str = "inner") -> DataFrame:
    """Left rows with the right rows of the same key in the following ``within``, on two streams.

    Watermarks on both sides and the time condition let Spark drop state that can match no more. The rows meet, besides
    the key, on a time slot of that length, so a busy key is spread over its slots, in state and in tasks. One side is
    in its own slot, once, and the other visits the two slots it can match in; the side whose unmatched rows are kept
    is the one that is there once, so it is decided as in a join on the key. Full outer joins meet on the key alone.
    """
    after = F.col(right_ts) >= F.col(left_ts)
    until = F.col(right_ts) <= F.col(left_ts) + F.expr(f"INTERVAL {within}")
    near, far = left.withWatermark(left_ts, delay), right.withWatermark(right_ts, delay).withColumnRenamed(key, "_rkey")
    condition = (F.col(key) == F.col("_rkey")) & after & until
    kind = how.replace("_", "").lower()
    if kind not in ("full", "fullouter", "outer"):
        left_slot, right_slot = F.window(left_ts, within), F.window(right_ts, within)
        if kind in ("right", "rightouter"):
            near = near.withColumn("_slot", F.explode(F.array(left_slot["start"], left_slot["end"])))
            far = far.withColumn("_rslot", right_slot["start"])
        else:
            near = near.withColumn("_slot", left_slot["start"])
            far = far.withColumn("_rslot", F.explode(F.array(right_slot["start"], right_slot["start"] - F.expr(f"INTERVAL {within}"))))
        condition = condition & (F.col("_slot") == F.col("_rslot"))
    return near.join(far, condition, how).drop("_slot", "_rslot", "_rkey")


def parse_value(df: DataFrame, schema: str, *keep: str | Column) -> DataFrame:
    """JSON in ``value`` as typed columns."""
    return open_json(df, "value", schema, *keep)
