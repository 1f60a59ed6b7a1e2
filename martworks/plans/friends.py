"""Friend recommendation: people of one channel, in one place, who never wrote to each other."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from martworks.functions import times
from martworks.operators.joins import within_distance, without_pairs
from martworks.operators.windows import top1
from martworks.session import stored

#: Most channels of a user that are compared as a list, and most channels that are numbered.
MOST_CHANNELS = 1000
MOST_BITS = 512


def _paired_by_place(members: DataFrame) -> bool:
    """Whether fewer rows meet when people are paired by zone than by zone and channel, and all lists of channels are short."""
    squares = lambda df, *by: df.groupBy(*by).agg(F.count(F.lit(1)).cast("double").alias("n")).agg(
        F.sum(F.col("n") * F.col("n")).alias("pairs"), F.max("n").alias("most")).first()
    channels, places = squares(members, "zone_id", "channel"), squares(members.select("user_id", "zone_id").distinct(), "zone_id")
    return bool(channels.pairs) and channels.pairs > places.pairs and squares(members, "user_id").most <= MOST_CHANNELS


def _channel_sets(members: DataFrame) -> tuple[DataFrame, Column]:
    """Each user's channels, and whether they meet those of another user, whose columns begin with ``_left``.

    Few channels are numbered and are bits of long values, which are compared much faster than lists.
    """
    channels = members.select("channel").distinct()
    count = channels.count()
    if count > MOST_BITS:
        return members.groupBy("user_id").agg(F.collect_list("channel").alias("_channels")), F.arrays_overlap("_channels", "_left_channels")
    numbers = channels.withColumn("_no", F.row_number().over(W.orderBy("channel")) - 1)  # a row per channel, few of them
    bit = F.expr("shiftleft(1L, _no % 64)")
    bits = [F.bit_or(F.when(F.floor(F.col("_no") / 64) == i, bit).otherwise(F.lit(0).cast("long"))).alias(f"_bits{i}") for i in range(-(-count // 64))]
    sets = members.join(F.broadcast(numbers), "channel").groupBy("user_id").agg(*bits)
    return sets, reduce(or_, [F.col(c).bitwiseAND(F.col(f"_left{c}")) != 0 for c in sets.columns[1:]])


def friend_recommendations(located: DataFrame, now=None, max_km: float = 1.0) -> DataFrame:
    """Recommended pairs with the moment, their zone and its local time.

    Both users are subscribed to a common channel, are last seen in the same zone and at most ``max_km``
    apart, and never exchanged a message in either direction. ``located`` has event_type, user_id,
    message_to, channel, ts, event_id, lat, lon, id (zone) and tz. Zone and grid cell are part of the
    join key, so only people near each other are paired; so is the channel, unless that would pair the same people
    again and again.
    """
    spots = top1(located.select("user_id", "ts", "event_id", "id", "tz", "lat", "lon"), ["user_id"],
                 ["ts", "event_id"]).select("user_id", F.col("id").alias("zone_id"), "tz", "lat", "lon")
    subscribed = located.where(F.col("event_type") == "subscription").select("user_id", "channel").where(
        F.col("channel").isNotNull()).distinct()
    members = stored(subscribed.join(spots, "user_id"), "members")
    at = (("_lat", "_lon"), ("lat", "lon"))
    if _paired_by_place(members):
        # Most neighbours share channels, many of them: each pair meets once, and their channels are compared.
        sets, common = _channel_sets(members)
        people = sets.join(spots, "user_id")
        left = people.select("zone_id", F.col("user_id").alias("user_left"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon"),
                             *[F.col(c).alias(f"_left{c}") for c in sets.columns[1:]])
        right = people.select("zone_id", F.col("user_id").alias("user_right"), "lat", "lon", *sets.columns[1:])
        met = within_distance(left, right, max_km, *at, also=["zone_id"]).where(F.col("user_left") < F.col("user_right"))
        pairs = met.where(common).select("user_left", "user_right")
    else:
        left = members.select("channel", "zone_id", F.col("user_id").alias("user_left"), F.col("lat").alias("_lat"),
                              F.col("lon").alias("_lon"))
        right = members.select("channel", "zone_id", F.col("user_id").alias("user_right"), "lat", "lon")
        met = within_distance(left, right, max_km, *at, also=["channel", "zone_id"])
        pairs = met.where(F.col("user_left") < F.col("user_right")).select("user_left", "user_right").distinct()
    messages = located.where(F.col("event_type") == "message").where(F.col("message_to").isNotNull())
    strangers = without_pairs(pairs, messages, "user_left", "user_right", "user_id", "message_to")
    place = spots.select(F.col("user_id").alias("user_left"), "zone_id", "tz")
    moment = times.now_or(now)
    return strangers.join(place, "user_left").select(
        "user_left", "user_right", moment.alias("processed_dttm"), "zone_id",
        times.local_time(moment, "tz").alias("local_time"),
    )
