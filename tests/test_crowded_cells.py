"""Rows of crowded cells are sent a bounded number of times."""

from __future__ import annotations

from pyspark.sql import functions as F

from martworks.operators import joins


def test_rows_of_a_crowded_cell_are_sent_a_bounded_number_of_times(spark):
    at = spark.range(300).select("id", F.lit(10.0).alias("lat"), (F.lit(20.0) + F.col("id") / 1e7).alias("lon"))
    other = at.select(F.col("id").alias("other"), F.col("lat").alias("ref_lat"), F.col("lon").alias("ref_lon"))
    crowded = joins._crowded(joins.near_cells(at, "lat", "lon", 0.02), joins.in_cells(other, "ref_lat", "ref_lon", 0.02), ["_band", "_cell"], 5)
    assert max(max(r["_lefts"], r["_rights"]) for r in crowded.collect()) == joins.MOST_BLOCKS
    assert joins.within_distance(at, other, 0.02, block_rows=5).select("id", "other").distinct().count() == 300 * 300
