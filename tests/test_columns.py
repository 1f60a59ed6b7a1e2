"""Key, geo, time, text and JSON expressions."""

from __future__ import annotations

import math
import random

import pytest
import uuid

from pyspark.sql import functions as F

from martworks.functions import geo, nested, text, times
from martworks.functions.keys import link_uuid5, uuid5
from martworks.operators import joins, reference
from martworks.sources.files import zone_of

GOLDEN = {
    "Салаты": "1cdc77a4-66dd-5b81-9625-19efbd6667df",
    "Основные блюда": "c71ba4a6-b4e3-5142-b2f5-d3e75dbdabfe",
    "Супы": "a6634f95-e0ef-55cd-a685-88eb672ab221",
    "626a81ce9a8cd1920641e266": "6d9ced61-24f4-5cc9-be9e-3938ad94cbe4",
}


def test_uuid5_golden_and_random(spark):
    names = [*GOLDEN, *[str(random.Random(i).random()) + "é" for i in range(200)], ""]
    got = {r.n: r.u for r in spark.createDataFrame([(n,) for n in names], "n string").select("n", uuid5("n").alias("u")).collect()}
    assert all(got[n] == u for n, u in GOLDEN.items())
    assert all(got[n] == str(uuid.uuid5(uuid.NAMESPACE_X500, n)) for n in names)


def test_uuid5_null_and_link(spark):
    a, b = str(uuid.uuid4()), str(uuid.uuid4())
    row = spark.createDataFrame([(a, b, None)], "a string, b string, n string").select(
        uuid5("n").alias("n"), link_uuid5("a", "b").alias("l")).first()
    assert row.n is None and row.l == str(uuid.uuid5(uuid.NAMESPACE_X500, a + b))


def _km(a, b):
    la, lo, ma, mo = map(math.radians, (*a, *b))
    h = math.sin((ma - la) / 2) ** 2 + math.cos(la) * math.cos(ma) * math.sin((mo - lo) / 2) ** 2
    return 2 * 6371 * math.asin(min(1, math.sqrt(h)))


def test_distances(spark):
    row = spark.createDataFrame([(-33.87, 151.21, -37.81, 144.96, None)], "a double, b double, c double, d double, n double").select(
        geo.haversine("a", "b", "c", "d").alias("h"), geo.cosine_distance("a", "b", "c", "d").alias("c"),
        geo.haversine("a", "b", "a", "b").alias("zero"), geo.haversine("a", "n", "c", "d").alias("none"),
        geo.cosine_distance("a", "n", "c", "d").alias("none2"), geo.haversine("a", "b", "c", "d", geo.EARTH_M).alias("m"),
        geo.haversine(F.lit(0.1), F.lit(0.2), F.lit(0.3), F.lit(0.4), units="radians").alias("rad")).first()
    assert abs(row.h - _km((-33.87, 151.21), (-37.81, 144.96))) < 1e-6 and abs(row.h - row.c) < 1e-6
    assert row.zero == 0 and row.none is None and row.none2 is None and abs(row.m - 1000 * row.h) < 1e-3
    assert abs(row.rad - _km((math.degrees(0.1), math.degrees(0.2)), (math.degrees(0.3), math.degrees(0.4)))) < 1e-6


def test_nearest_tie_and_missing_point(spark):
    cities = spark.createDataFrame([(2, "b", 0.0, 1.0), (1, "a", 0.0, -1.0), (3, "c", 50.0, 50.0)],
                                   "id int, city string, lat_city double, lng_city double")
    events = spark.createDataFrame([(1, 0.0, 0.0), (2, 49.0, 49.0), (3, None, 1.0)], "e int, lat double, lon double")
    got = {r.e: (r.id, r.city) for r in reference.nearest(events, cities).collect()}
    assert got == {1: (1, "a"), 2: (3, "c"), 3: (None, None)}
    assert {r.id for r in reference.nearest(events, cities.limit(0)).collect()} == {None}


@pytest.mark.parametrize("length", [4, 64, 1000])
def test_nearest_against_brute_force(spark, monkeypatch, length):
    """Cubes are halved to different sizes, by the length of a list that is short enough."""
    monkeypatch.setattr(reference, "LIST", length)
    rng = random.Random(6)
    cities = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(60)] + [(100 + i, 50 + rng.random(), 10 + rng.random()) for i in range(200)]
    spots = [(i // 2, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(80)] + [(None, 50 + rng.random(), 10 + rng.random()) for _ in range(80)]
    spots += [(500, 90.0, 0.0), (501, -90.0, 7.0), (502, 0.0, 180.0), (503, 0.0, -180.0), (503, 0.0, -180.0)]
    df = spark.createDataFrame(spots, "e int, lat double, lon double")
    got = reference.nearest(df, spark.createDataFrame(cities, "id int, lat_city double, lng_city double")).collect()
    want = [(e, a, o, round(min(_km((a, o), c[1:]) for c in cities), 6)) for e, a, o in spots]
    assert sorted(((r.e, r.lat, r.lon, round(r.distance, 6)) for r in got), key=repr) == sorted(want, key=repr)


def test_within_distance_against_brute_force(spark):
    rng = random.Random(3)
    spots = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(150)]
    spots += [(200 + i, rng.uniform(-89.9, -88), rng.uniform(-180, 180)) for i in range(40)]
    spots += [(300 + i, rng.uniform(-1, 1), rng.choice([-179.9, 179.9]) + rng.uniform(-0.1, 0.1)) for i in range(40)]
    spots += [(400, 90.0, 0.0), (401, 90.0, 120.0), (402, -90.0, 10.0)]
    df = spark.createDataFrame(spots, "id int, lat double, lon double")
    other = df.toDF("rid", "ref_lat", "ref_lon")
    for km in (5, 100, 900, 6000):
        got = {(r.id, r.rid) for r in joins.within_distance(df, other, km).select("id", "rid").collect()}
        want = {(a[0], b[0]) for a in spots for b in spots if _km(a[1:], b[1:]) <= km - 1e-6}
        near = {(a[0], b[0]) for a in spots for b in spots if _km(a[1:], b[1:]) <= km + 1e-6}
        assert want <= got <= near


def test_zone_and_local_time(spark):
    df = spark.createDataFrame([("Sydney",), ("Cairns",), ("Broken_Hill",), ("Paris",)], "city string")
    got = df.select("city", zone_of(F.col("city")).alias("tz")).withColumn(
        "lt", times.local_time(F.lit("2022-05-31 00:00:00"), "tz").cast("string")).collect()
    assert [(r.tz, r.lt) for r in got] == [
        ("Australia/Sydney", "2022-05-31 10:00:00"), ("Australia/Brisbane", "2022-05-31 10:00:00"),
        ("Australia/Broken_Hill", "2022-05-31 09:30:00"), (None, None)]


def test_times(spark):
    row = spark.createDataFrame([(None, "2022-01-02 03:04:05", "junk")], "a string, b string, c string").select(
        times.parse_ts("a", "b").cast("string").alias("first"), times.parse_ts("c").alias("bad"),
        times.days_between(F.lit("2022-01-03 02:00:00"), F.lit("2022-01-01 03:00:00")).alias("full"),
        times.week_start(F.lit("2022-01-02").cast("date")).cast("string").alias("monday")).first()
    assert (row["first"], row.bad, row.full, row.monday) == ("2022-01-02 03:04:05", None, 1, "2021-12-27")


def test_text(spark):
    row = spark.createDataFrame([("7:vsp-1:0.02:x", "-33,86", "Émile's  2 cats!")], "d string, n string, t string").select(
        *text.split_fields("d", {"id": "long", "num": "string", "rate": "decimal(5,2)", "com": "decimal(5,2)"}),
        text.decimal_comma("n").alias("n"), text.words("t").alias("w")).first()
    assert (row.id, row.num, float(row.rate), row.com, row.n) == (7, "vsp-1", 0.02, None, -33.86)
    assert row.w == ["émile", "s", "2", "cats"]


def test_open_json_keeps_bad_documents(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": "x"}'), (2, "{broken"), (3, None)], "id int, v string")
    got = nested.open_json(df, "v", "a int, b string", "id").orderBy("id").collect()
    assert [(r.id, r.a, r.b) for r in got] == [(1, 1, "x"), (2, None, None), (3, None, None)]


def test_explode_records_in_step(spark, rows):
    df = spark.createDataFrame([(1, [("a", 1), ("b", 2)]), (2, [("c", 3)])], "id int, items array<struct<n: string, q: int>>")
    assert rows(nested.explode_records(df, "items", ["id"])) == [(1, "a", 1), (1, "b", 2), (2, "c", 3)]
