"""File readers and file streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from martworks.functions.text import decimal_comma

# The cities that have a time zone of their own, and the zone city used for the others.
ZONE_CITIES = [
    "Darwin", "Perth", "Eucla", "Brisbane", "Lindeman", "Canberra", "Queensland",
    "Adelaide", "Hobart", "Melbourne", "Sydney", "Broken_Hill", "Lord_Howe",
]
ZONE_OF_OTHER_CITIES = {
    "Brisbane": ["Gold Coast", "Townsville", "Ipswich", "Cairns", "Toowoomba", "Mackay", "Rockhampton"],
    "Sydney": ["Newcastle", "Wollongong", "Geelong", "Ballarat", "Bendigo", "Maitland", "Cranbourne"],
    "Perth": ["Bunbury"],
    "Hobart": ["Launceston"],
}


def read_events(spark: SparkSession, base: str, date: str | None = None, depth: int | None = None,
                types: tuple[str, ...] = ("message", "reaction", "subscription")) -> DataFrame:
    """Event lake partitioned by ``event_type`` and ``date``: ``depth`` days back from ``date``.

    Both conditions are on partition columns, so only the matching directories are listed and read.
    """
    events = spark.read.parquet(base).where(F.col("event_type").isin(*types))
    if date is None:
        return events
    last = dt.date.fromisoformat(date)
    if depth is None:
        return events.where(F.col("date") <= F.lit(last))
    first = last - dt.timedelta(days=depth - 1)
    return events.where(F.col("date").between(F.lit(first), F.lit(last)))


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines; without a schema Spark reads the data once more to infer it."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ",",
             header: bool = True, infer: bool = False) -> DataFrame:
    reader = spark.read.option("sep", sep).option("header", header)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", infer)
    return reader.csv(path)


def read_clean(spark: SparkSession, path: str, schema: T.StructType | str, required: list[str],
               sep: str = ",") -> DataFrame:
    """CSV with a fixed schema (so integers stay nullable integers), without rows lacking a key."""
    return read_csv(spark, path, schema, sep).na.drop(subset=required)


def zone_of(city):
    """Time zone of an Australian city name; null when the city is unknown."""
    zone = F.when(city.isin(ZONE_CITIES), city)
    for main_city, others in ZONE_OF_OTHER_CITIES.items():
        zone = zone.when(city.isin(others), F.lit(main_city))
    return F.concat(F.lit("Australia/"), zone)


def load_cities(spark: SparkSession, path: str) -> DataFrame:
    """City reference: ``;`` separated text with decimal commas, plus the zone of each city."""
    raw = read_csv(spark, path, "id string, city string, lat string, lng string", sep=";")
    return raw.select(
        F.col("id").try_cast("long").alias("id"),
        "city",
        decimal_comma("lat").alias("lat_city"),
        decimal_comma("lng").alias("lng_city"),
        zone_of(F.col("city")).alias("tz"),
    )


def stream_files(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "json",
                 max_files: int | None = None) -> DataFrame:
    """Stream over a growing folder of text, JSON, CSV or Parquet files."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Names of the files below a folder. The file contents are a pruned column and are not read."""
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern).load(path)
    )
    return listing.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length")
