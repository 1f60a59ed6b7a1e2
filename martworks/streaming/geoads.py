"""Client positions and the campaign points near them, with the distance to each."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.functions import times
from martworks.functions.geo import EARTH_KM, EARTH_M
from martworks.operators.joins import within_distance
from martworks.streaming import core
from martworks.streaming.windows import parse_value

POSITION = "client_id string, timestamp timestamp, lat double, lon double"


def positions(topic: DataFrame, delay: str = "5 minutes") -> DataFrame:
    rows = parse_value(topic.select("value", "offset"), POSITION, "offset")
    return core.distinct_within(rows, ["client_id", "timestamp", "lat", "lon", "offset"], "timestamp", delay)


def with_campaigns(rows: DataFrame, campaigns: DataFrame, now=None, within_km: float = 500.0) -> DataFrame:
    """Each position with the campaigns at most ``within_km`` away and the distance in metres.

    ``campaigns``: id, name, description, start_time, end_time, point_lat, point_lon. Positions and campaigns meet in
    the cells of a grid: the campaigns visit the cells around them, the stream is an ordinary equi-join.
    """
    named = campaigns.select(
        F.col("id").alias("adv_campaign_id"), F.col("name").alias("adv_campaign_name"),
        F.col("description").alias("adv_campaign_description"), F.col("start_time").alias("adv_campaign_start_time"),
        F.col("end_time").alias("adv_campaign_end_time"), F.col("point_lat").alias("adv_campaign_point_lat"),
        F.col("point_lon").alias("adv_campaign_point_lon"),
    )
    point = ("adv_campaign_point_lat", "adv_campaign_point_lon")
    met = within_distance(named, rows.select("client_id", "lat", "lon", "offset"), within_km, point, ("lat", "lon"))
    return met.withColumns({"created_at": times.now_or(now), "distance": F.col("distance") * (EARTH_M / EARTH_KM)})


def run(topic: DataFrame, campaigns: DataFrame, out: str, checkpoint: str, every: str | None = None,
        within_km: float = 500.0):
    return core.start_files(with_campaigns(positions(topic), campaigns, within_km=within_km), out, checkpoint, every=every)
