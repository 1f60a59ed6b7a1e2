"""Message topics. The reader differs from a file stream only by format; it needs the Kafka package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martworks.functions.nested import to_message

# Columns of a topic frame, as the Kafka source gives them.
TOPIC_SCHEMA = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"


def read_topic(spark: SparkSession, servers: str, topic: str, options: dict[str, str] | None = None) -> DataFrame:
    """All messages now in a topic, with their metadata columns."""
    return (
        spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", "earliest").options(**(options or {})).load()
    )


def stream_topic(spark: SparkSession, servers: str, topic: str, options: dict[str, str] | None = None,
                 max_per_batch: int | None = None) -> DataFrame:
    """Unbounded topic, from its earliest message, in batches of at most ``max_per_batch``."""
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", "earliest").options(**(options or {}))
    )
    if max_per_batch is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_batch)
    return reader.load()


def as_topic(df: DataFrame, topic: str, key, offset, timestamp, *payload) -> DataFrame:
    """Any frame shaped like a topic: the payload columns become one JSON document in ``value``."""
    return df.select(
        key.cast("string").cast("binary").alias("key"),
        to_message(*payload).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        offset.cast("long").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
    )


def messages(df: DataFrame) -> DataFrame:
    """Decode the bytes of a topic frame, keeping the metadata."""
    return df.withColumn("key", F.col("key").cast("string")).withColumn("value", F.col("value").cast("string"))


def write_topic(df: DataFrame, servers: str, topic: str, options: dict[str, str] | None = None) -> None:
    """Send every row as a JSON message; for use on batches, also inside ``foreachBatch``."""
    (
        df.select(to_message("*").alias("value")).write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic).options(**(options or {})).save()
    )


def stream_to_topic(df: DataFrame, servers: str, topic: str, checkpoint: str, options: dict[str, str] | None = None):
    """Start a query that sends every new row of a stream as a JSON message."""
    return (
        df.select(to_message("*").alias("value")).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic)
        .option("checkpointLocation", checkpoint).options(**(options or {})).start()
    )
