"""Geo marts over the event lake: located events, user travel, zone activity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from martworks.functions import times
from martworks.operators.groups import collect_parts
from martworks.operators.reference import nearest
from martworks.operators.windows import runs, top1, with_stats


def lake_events(lake: DataFrame) -> DataFrame:
    """Flat events of the three types out of the nested lake; only the fields used are read."""
    kind = F.col("event_type")
    return lake.select(
        kind,
        F.when(kind == "message", F.col("event.message_from")).when(kind == "reaction", F.col("event.reaction_from"))
        .otherwise(F.col("event.user")).alias("user_id"),
        F.col("event.message_id").alias("event_id"),
        F.col("event.message_to").alias("message_to"),
        F.col("event.subscription_channel").alias("channel"),
        times.parse_ts("event.datetime", "event.message_ts").alias("ts"),
        "lat", "lon",
    )


def locate(events: DataFrame, cities: DataFrame, units: str = "degrees") -> DataFrame:
    """Events with the nearest city (id, city, tz, distance); events without coordinates have no place."""
    placed = events.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return nearest(placed, cities, units=units)


def user_geo(located: DataFrame, min_days: int = 27, travel: str = "days") -> DataFrame:
    """One row per user: current city, home city, travel count and list, local time of the last event.

    Home is the city of the latest unbroken stay of at least ``min_days`` days, null without one.
    ``travel='days'`` counts distinct (day, city) visits. ``'moves'`` counts changes of city, of which a user may have
    any number: their list comes in parts (a row for each ``part`` of the list).
    """
    last = F.struct("ts", "event_id")
    visit = F.struct(F.to_date("ts").alias("dt"), F.col("id"), F.col("city"))
    users = located.groupBy("user_id").agg(
        F.max_by(F.struct("city", "ts", "tz"), last).alias("_last"),
        # Distinct (day, city) pairs only: bounded by days times cities, however many events there are.
        F.collect_set(visit).alias("_visits"),
    )
    stays = runs(located, "user_id", "city", "ts", "event_id")
    home = top1(stays.where(F.col("days") >= min_days).select("user_id", "run_end", "run_no", "city"),
                ["user_id"], ["run_end", "run_no"]).select("user_id", F.col("city").alias("home_city"))
    out = users.join(home, "user_id", "left").select(
        "user_id", F.col("_last.city").alias("act_city"), "home_city",
        F.size("_visits").cast("long").alias("travel_count"),
        F.array_sort(F.transform("_visits", lambda v: v["city"])).alias("travel_array"),
        times.local_time(F.col("_last.ts"), F.col("_last.tz")).alias("local_time"),
    )
    if travel == "moves":
        counts = stays.groupBy("user_id").agg(F.count(F.lit(1)).alias("travel_count"))
        lists = collect_parts(stays, ["user_id"], F.struct("run_no", "city"), "_runs", "run_no").select(
            "user_id", "part", F.transform("_runs", lambda r: r["city"]).alias("travel_array"))
        moves = out.drop("travel_count", "travel_array").join(counts, "user_id", "left").join(lists, "user_id", "left")
        out = moves.select(*out.columns, "part")
    return out


def zone_activity(located: DataFrame, first_over: str = "message") -> DataFrame:
    """Messages, reactions, subscriptions and new users per city, by week and by month.

    One conditional aggregate per week; the months are sums over its few rows. A user is new at the first
    message (``first_over='all'``: at the first event of any type). Figures without any event are null, as
    after left joins to a key spine.
    """
    kind = F.col("event_type")
    counted = kind == "message" if first_over == "message" else F.lit(True)
    rows = with_stats(located, ["user_id"], _first=F.min(F.when(counted, F.col("ts")))).select(
        times.month_start("ts").alias("month"), times.week_start("ts").alias("week"),
        F.col("id").alias("zone_id"), "event_type",
        F.when(counted, (F.col("_first") == F.col("ts")).cast("int")).alias("_new"),
    )
    figures = {name: F.sum(F.when(kind == name, 1)) for name in ("message", "reaction", "subscription")}
    figures["user"] = F.sum("_new")
    weekly = rows.groupBy("month", "week", "zone_id").agg(*[c.alias(f"week_{n}") for n, c in figures.items()])
    # At most six weeks fall into a month, so this window is over six rows.
    of_month = W.partitionBy("month", "zone_id")
    return weekly.withColumns({f"month_{n}": F.sum(f"week_{n}").over(of_month) for n in figures})
