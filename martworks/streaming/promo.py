"""Campaign notifications: active campaigns of a topic, pushed to the subscribers of the restaurant."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martworks.functions import times
from martworks.session import stored
from martworks.streaming import core
from martworks.streaming.windows import parse_value

MESSAGE = (
    "restaurant_id string, restaraunt_id string, adv_campaign_id string, adv_campaign_content string, "
    "adv_campaign_owner string, adv_campaign_owner_contact string, adv_campaign_datetime_start double, "
    "adv_campaign_datetime_end double, datetime_created double"
)
FIELDS = [
    "restaurant_id", "adv_campaign_id", "adv_campaign_content", "adv_campaign_owner", "adv_campaign_owner_contact",
    "adv_campaign_datetime_start", "adv_campaign_datetime_end", "datetime_created",
]


#: Clients of a slice of a restaurant's subscribers.
SLICE = 4096


def campaigns(topic: DataFrame) -> DataFrame:
    """Typed campaign messages; the misspelt restaurant field is accepted as well."""
    return parse_value(topic, MESSAGE).withColumn(
        "restaurant_id", F.coalesce("restaurant_id", "restaraunt_id")
    ).select(*FIELDS, times.from_epoch("datetime_created").alias("datetime_created_ts"))


def active(rows: DataFrame, now=None) -> DataFrame:
    """Campaigns running at ``now`` (start inclusive, end exclusive); on a stream, now is the batch's time."""
    moment = F.unix_timestamp() if now is None else F.lit(now)
    return rows.where(
        (F.col("adv_campaign_datetime_start") <= moment) & (F.col("adv_campaign_datetime_end") > moment)
    )


def sliced(subscribers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored: the distinct pairs of restaurant and client with their slice, and the restaurants with their number of
    slices. A slice has about ``SLICE`` clients, so notifications of a large restaurant are made in many tasks."""
    pairs = stored(subscribers.select("restaurant_id", "client_id").where("restaurant_id IS NOT NULL").distinct(), "subscribers")
    sizes = pairs.groupBy("restaurant_id").agg(F.ceil(F.count(F.lit(1)) / SLICE).cast("int").alias("_slices"))
    restaurants = stored(sizes, "restaurants")
    own = F.pmod(F.xxhash64("client_id"), F.col("_slices")).cast("int")
    return stored(pairs.join(restaurants, "restaurant_id").select("restaurant_id", own.alias("_slice"), "client_id"), "slices"), restaurants


def notifications(rows: DataFrame, clients: DataFrame, now=None) -> DataFrame:
    """One row per campaign and subscribed client, stamped with the trigger time. ``rows`` know the number of slices of
    their restaurant; each meets every slice of the clients once."""
    moment = F.unix_timestamp() if now is None else F.lit(now)
    dealt = rows.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))
    return dealt.join(clients, ["restaurant_id", "_slice"]).select(
        *FIELDS, "client_id", moment.cast("long").alias("trigger_datetime_created")
    )


def promo_stream(topic: DataFrame, subscribers: DataFrame, now=None, delay: str = "5 minutes") -> DataFrame:
    """Notifications of the campaigns that are new; the subscribers are read when the stream is made.

    Campaigns of restaurants without subscribers notify nobody: they count for the watermark, but are not kept in state.
    """
    clients, restaurants = sliced(subscribers)
    timed = active(campaigns(topic), now).withWatermark("datetime_created_ts", delay)
    fresh = timed.join(restaurants, "restaurant_id").dropDuplicatesWithinWatermark(FIELDS)
    return notifications(fresh, clients, now)


def feedback(batch: DataFrame) -> DataFrame:
    """Rows of the feedback table: the notification with an empty feedback."""
    return batch.withColumn("feedback", F.lit(None).cast("string"))


def run(spark: SparkSession, topic: DataFrame, subscribers: DataFrame, out: str, checkpoint: str, now=None,
        every: str | None = None):
    """Write both targets of every batch below ``out``; on a cluster give JDBC and topic sinks instead.

    The subscribers are reduced to distinct pairs and stored once, when the stream starts.
    """
    sink = core.fan_out(
        core.batch_folder(f"{out}/feedback", feedback),
        core.batch_folder(f"{out}/push", core.as_messages),
    )
    return core.start(promo_stream(topic, subscribers, now), sink, checkpoint, every=every)
