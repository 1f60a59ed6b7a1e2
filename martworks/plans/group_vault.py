"""Group activity: link and satellite from the join log, and conversion of the oldest groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martworks.functions import times
from martworks.operators.joins import absent, present


def hub(rows: DataFrame, natural: str, key: str, make_key, **attributes: Column) -> DataFrame:
    """Hub rows of a natural key: one per value, with aggregated attributes."""
    found = rows.where(F.col(natural).isNotNull()).groupBy(natural).agg(
        *([c.alias(n) for n, c in attributes.items()] or [F.lit(1).alias("_one")])
    )
    return found.withColumn(key, make_key(F.col(natural))).drop("_one")


def link_rows(log: DataFrame, h_users: DataFrame, h_groups: DataFrame, link: DataFrame | None, make_key,
              now=None, source: str = "s3") -> DataFrame:
    """New user-group links of the log; ``make_key`` hashes (user key, group key).

    The log is reduced to its distinct pairs before anything is looked up.
    """
    pairs = log.select("user_id", "group_id").distinct()
    keyed = pairs.join(h_users.select("user_id", "hk_user_id"), "user_id").join(
        h_groups.select("group_id", "hk_group_id"), "group_id"
    )
    rows = keyed.select(
        make_key(F.col("hk_user_id"), F.col("hk_group_id")).alias("hk_l_user_group_activity"),
        "hk_user_id", "hk_group_id",
    )
    if link is not None:
        rows = absent(rows, link, ["hk_l_user_group_activity"])
    return rows.withColumns({"load_dt": times.now_or(now), "load_src": F.lit(source)})


def satellite_rows(log: DataFrame, h_users: DataFrame, h_groups: DataFrame, link: DataFrame,
                   satellite: DataFrame | None, now=None, source: str = "s3") -> DataFrame:
    """History rows of the log that the satellite lacks, by link, event and event time."""
    keyed = (
        log.join(h_groups.select("group_id", "hk_group_id"), "group_id")
        .join(h_users.select("user_id", "hk_user_id"), "user_id")
        .join(link.select("hk_user_id", "hk_group_id", "hk_l_user_group_activity"), ["hk_user_id", "hk_group_id"])
    )
    rows = keyed.select("hk_l_user_group_activity", "user_id_from", "event", F.col("dt").alias("event_dt"))
    if satellite is not None:
        rows = absent(rows, satellite, ["hk_l_user_group_activity", "event", "event_dt"])
    return rows.withColumns({"load_dt": times.now_or(now), "load_src": F.lit(source)})


def conversion(h_groups: DataFrame, link: DataFrame, satellite: DataFrame, groups_dialogs: DataFrame,
               user_message: DataFrame, oldest: int = 10) -> DataFrame:
    """Users added to each of the oldest groups, those of them who wrote, and the ratio."""
    # At most ``oldest`` rows: safe to broadcast to all the following joins.
    groups = F.broadcast(h_groups.orderBy("registration_dt", "hk_group_id").limit(oldest).select("hk_group_id"))
    joined = satellite.where(F.col("event") == "add")
    added = (
        present(link.join(groups, "hk_group_id", "left_semi"), joined, ["hk_l_user_group_activity"])
        .groupBy("hk_group_id").agg(F.countDistinct("hk_user_id").alias("cnt_added_users"))
    )
    wrote = (
        groups_dialogs.join(groups, "hk_group_id", "left_semi").join(user_message, "hk_message_id", "left")
        .groupBy("hk_group_id").agg(F.countDistinct("hk_user_id").alias("cnt_users_in_group_with_messages"))
    )
    ratio = F.try_divide(F.col("cnt_users_in_group_with_messages"), F.col("cnt_added_users"))
    return added.join(wrote, "hk_group_id", "left").withColumn(
        "group_conversion", F.round(ratio, 2).cast("decimal(14,2)")
    )
