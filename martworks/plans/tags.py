"""Tag candidates and keyword counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martworks.operators.joins import absent


def tag_candidates(messages: DataFrame, verified: DataFrame, user: str, tags: Column, least: int = 100) -> DataFrame:
    """Tags used by at least ``least`` different users that are not verified yet."""
    used = messages.select(F.col(user).alias("_user"), F.explode(tags).alias("tag")).distinct()
    return absent(
        used.groupBy("tag").agg(F.count(F.lit(1)).alias("suggested_count")).where(F.col("suggested_count") >= least),
        verified, ["tag"],
    )


def keyword_counts(users: DataFrame, messages: DataFrame, user: str, keyword: Column, name: str = "count") -> DataFrame:
    """Messages with the keyword per user; every user row is kept, null for users without messages.

    Messages are counted per user before they meet the users, so a busy user is one row in the join.
    """
    counts = messages.groupBy(user).agg(F.count(F.when(keyword, F.lit(1))).alias(name))
    return counts.join(users, user, "right_outer")
