"""Activity counts on every event, and contacts seen nearby."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.functions import times
from martworks.functions.geo import cosine_distance
from martworks.operators.joins import as_of
from martworks.operators.windows import top_n, with_stats
from martworks.session import stored


def activity_windows(events: DataFrame, user: str = "user_id", ts: str = "ts", event_id: str = "event_id") -> DataFrame:
    """Every event with its week's and month's messages, reactions, subscriptions and new users.

    The figures are grouped per week and per month and joined back. A user counts as new where its first event lies,
    so the events themselves are never moved: the figures have a row per week or month of the calendar, which is what
    bounds their broadcast.
    """
    rows = events.withColumns({"month": times.month_start(ts), "week": times.week_start(ts)})
    first = events.groupBy(user).agg(F.min(F.struct(ts, event_id)).alias("_first")).select(F.col(f"_first.{ts}").alias(ts))
    for grain, start in (("week", times.week_start(ts)), ("month", times.month_start(ts))):
        kinds = rows.groupBy(F.col(grain).alias("_grain")).agg(*[
            F.count_if(F.col("event_type") == kind).alias(f"{grain}_{kind}") for kind in ("message", "reaction", "subscription")])
        new = first.groupBy(start.alias("_from")).agg(F.count(F.lit(1)).alias("_users"))
        figures = kinds.join(new, kinds["_grain"].eqNullSafe(new["_from"]), "left").drop("_from").withColumn(
            f"{grain}_user", F.coalesce("_users", F.lit(0))).drop("_users")
        rows = rows.join(F.broadcast(figures), rows[grain].eqNullSafe(figures["_grain"]), "left").drop("_grain")
    return rows


def nearby_contacts(messages: DataFrame, max_km: float = 1.0, last: int = 5, positions: str = "sent",
                    units: str = "degrees") -> DataFrame:
    """A user's last messages whose receiver was then at most ``max_km`` away, with the list of such receivers.

    ``messages``: event_id, user_id, message_to, ts, lat, lon and the sender's city and tz. The receiver's
    place is the last one known at that moment: of messages he sent (``positions='sent'``), or also of
    those he got (``'both'``).
    """
    rows = with_stats(
        messages.withColumn("week", times.week_start("ts")), ["user_id", "week", "message_to"],
        cnt=F.count(F.lit(1)),
    )
    recent = top_n(rows, ["user_id"], [F.desc("ts"), F.desc("event_id")], last)
    seen = messages.select(F.col("user_id").alias("message_to"), "ts", "event_id", "lat", "lon")
    if positions == "both":
        seen = seen.unionByName(messages.select("message_to", "ts", "event_id", "lat", "lon"))
    seen = seen.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    # Both sides are read several times.
    recent, seen = stored(recent, "recent"), stored(seen, "seen")
    placed = as_of(recent, seen, "message_to", "ts", ["lat", "lon"], tiebreak="event_id")
    distance = cosine_distance("lat", "lon", "last_lat", "last_lon", units=units)
    close = placed.withColumn("distance", distance).where(F.col("distance") <= max_km)
    # At most ``last`` messages per user are left, so the list is short.
    friends = close.groupBy("user_id").agg(F.array_sort(F.collect_list("message_to")).alias("friends"))
    return close.join(friends, "user_id").select(
        "event_id", "user_id", "message_to", "friends", "cnt", "distance", "week", "city",
        F.col("ts").alias("time_utc"), times.local_time("ts", "tz").alias("local_time"),
    )
