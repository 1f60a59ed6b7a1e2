"""Readers and sinks: the driver tables written in the formats of the projects and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.common import Tables, day_sql, dec, query, ts_sql
from martworks.operators import load
from martworks.session import scratch
from martworks.sources import envelope, files, kafka, sinks


def _lake(t: Tables, path: str):
    """Events as a nested lake: type and date as partition columns, the rest inside a struct."""
    kind, eid = F.col("event_type"), F.col("event_id")
    message = kind.isin("click", "error")
    rows = t.events.select(
        F.when(message, "message").when(kind == "view", "reaction").otherwise("subscription").alias("event_type"),
        F.to_date("ts").alias("date"),
        F.struct(
            F.when(~message, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("datetime"),
            eid.alias("message_id"), F.when(message, F.col("user_id")).alias("message_from"),
            F.when(message, F.col("user_id") + 1).alias("message_to"),
            F.when(message, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("message_ts"),
            F.when(kind == "view", F.col("user_id")).alias("reaction_from"),
            F.get_json_object("props", "$.k").cast("bigint").alias("subscription_channel"),
            F.when(kind.isin("signup", "purchase"), F.col("user_id")).alias("user"),
        ).alias("event"),
        F.lit(-33.9).alias("lat"), F.lit(151.2).alias("lon"),
    )
    sinks.write_partitioned(rows, path, ["event_type", "date"])


def partition_rewrite(t: Tables):
    """Rows per directory of the rewritten lake."""
    path = scratch(t.spark, "lake")
    _lake(t, path)
    return t.spark.read.parquet(path).groupBy("event_type", "date").agg(F.count(F.lit(1)).alias("n"))


REWRITE_SQL = f"""
SELECT CASE WHEN event_type IN ('click', 'error') THEN 'message' WHEN event_type = 'view' THEN 'reaction'
            ELSE 'subscription' END AS event_type, {day_sql('ts')} AS date, count(*) AS n FROM events GROUP BY 1, 2"""


def prune_scan(t: Tables):
    """Messages and reactions of the ten days up to 20 January, flattened out of the lake."""
    from martworks.plans.geo import lake_events
    path = scratch(t.spark, "lake")
    _lake(t, path)
    events = files.read_events(t.spark, path, "2024-01-20", 10, ("message", "reaction"))
    return lake_events(events).select("event_type", "user_id", "event_id", "message_to", "ts")


PRUNE_SQL = f"""
SELECT CASE WHEN event_type = 'view' THEN 'reaction' ELSE 'message' END AS event_type, user_id, event_id,
       CASE WHEN event_type <> 'view' THEN user_id + 1 END AS message_to, {ts_sql('ts')} AS ts
FROM events WHERE event_type IN ('click', 'error', 'view') AND ts >= DATE '2024-01-11' AND ts < DATE '2024-01-21'"""


def dated_mart(t: Tables):
    """A mart run written twice into its dated directory: the second run replaces the first."""
    base = scratch(t.spark, "mart")
    mart = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    sinks.write_dated(mart.withColumn("n", F.lit(0).cast("bigint")), base, "2024-01-30", 30)
    return t.spark.read.parquet(sinks.write_dated(mart, base, "2024-01-30", 30))


def layout_write(t: Tables):
    """Orders partitioned by status and sorted by customer; read back as totals."""
    path = scratch(t.spark, "layout")
    sinks.write_partitioned(t.orders, path, ["o_orderstatus"], sort=["o_custkey"])
    return t.spark.read.parquet(path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(dec("o_totalprice")).alias("total"))


LAYOUT_SQL = """
SELECT o_orderstatus, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total
FROM orders GROUP BY 1"""


def bucketed_join(t: Tables):
    """Orders and customers stored in buckets of the customer key, joined without a shuffle."""
    sinks.write_bucketed(t.orders, "mw_orders", scratch(t.spark, "b_orders"), "o_custkey", 8, "o_custkey")
    sinks.write_bucketed(t.customer, "mw_customer", scratch(t.spark, "b_customer"), "c_custkey", 8, "c_custkey")
    orders, customers = t.spark.table("mw_orders"), t.spark.table("mw_customer")
    return orders.hint("merge").join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_custkey").agg(
        F.count(F.lit(1)).alias("orders"))


def nested_documents(t: Tables):
    """One JSON document per customer with the list of orders; read back and counted."""
    path = scratch(t.spark, "documents")
    item = F.struct("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    documents = sinks.nested_documents(t.orders, ["o_custkey"], item, "orders", "o_orderkey")
    sinks.write_documents(documents, path)
    schema = "o_custkey bigint, part int, orders array<struct<o_orderkey: bigint, day: string>>"
    return files.read_json(t.spark, path, schema).select(
        "o_custkey", "part", F.transform("orders", lambda o: o["o_orderkey"]).alias("keys"))


DOCUMENTS_SQL = """
SELECT o_custkey, 0 AS part, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS keys
FROM orders GROUP BY 1"""


def save_modes(t: Tables):
    """Append twice, then overwrite: the rows of the last write remain."""
    path = scratch(t.spark, "modes")
    rows = t.supplier.select("s_suppkey", "s_name")
    sinks.write_any(rows, path, "orc")
    sinks.write_any(rows, path, "orc")
    twice = t.spark.read.orc(path).groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("copies"))
    sinks.write_any(twice, f"{path}_out", "json", "overwrite")
    return t.spark.read.schema("s_suppkey bigint, copies bigint").json(f"{path}_out")


def read_cities(t: Tables):
    """Customers written as a ';' city file with decimal commas, read as a city reference."""
    path, key = scratch(t.spark, "cities"), F.col("c_custkey")
    name = F.element_at(F.array(*[F.lit(c) for c in ("Darwin", "Ipswich", "Bendigo", "Bunbury", "Nowhere")]),
                        (key % 5 + 1).cast("int"))
    comma = F.regexp_replace(F.col("c_acctbal").cast("string"), "\\.", ",")
    rows = t.customer.select(key.alias("id"), name.alias("city"), comma.alias("lat"), comma.alias("lng"))
    rows.write.option("sep", ";").option("header", True).csv(path)
    return files.load_cities(t.spark, path).drop("lng_city")


CITIES_SQL = """
SELECT c_custkey AS id, ['Darwin', 'Ipswich', 'Bendigo', 'Bunbury', 'Nowhere'][c_custkey % 5 + 1] AS city,
       c_acctbal AS lat_city,
       ['Australia/Darwin', 'Australia/Brisbane', 'Australia/Sydney', 'Australia/Perth', NULL][c_custkey % 5 + 1] AS tz
FROM customer"""


def read_clean(t: Tables):
    """Group log as CSV with missing keys, read with nullable integers and without those rows."""
    path = scratch(t.spark, "group_log")
    kind = F.col("event_type")
    rows = t.events.select(
        F.when(kind != "error", F.get_json_object("props", "$.k")).alias("group_id"), "user_id",
        F.when(kind == "click", F.col("user_id") + 1).alias("user_id_from"), kind.alias("event"), "event_id")
    rows.write.option("header", True).csv(path)
    schema = "group_id int, user_id int, user_id_from int, event string, event_id bigint"
    clean = files.read_clean(t.spark, path, schema, ["group_id", "user_id"])
    out = scratch(t.spark, "group_log_loaded")
    load.append_without(clean, out, ["event_id"], unique=["event_id"])
    return t.spark.read.parquet(out)


CLEAN_SQL = """
SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS group_id, CAST(user_id AS INTEGER) AS user_id,
       CAST(CASE WHEN event_type = 'click' THEN user_id + 1 END AS INTEGER) AS user_id_from, event_type AS event
FROM events WHERE event_type <> 'error'"""


def read_json_envelope(t: Tables):
    """Events landed as JSON, wrapped into envelopes after a mark and opened again."""
    path = scratch(t.spark, "pages")
    t.events.select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("update_ts")).write.json(path)
    schema = "event_id bigint, user_id bigint, event_type string, update_ts timestamp"
    landed = files.read_json(t.spark, path, schema)
    documents = envelope.documents_after(landed, "event_id", "update_ts", "2024-01-20 00:00:00")
    return envelope.open_envelope(documents, "user_id bigint, event_type string")


ENVELOPE_SQL = f"""
SELECT CAST(event_id AS VARCHAR) AS object_id, {ts_sql('ts')} AS update_ts, user_id, event_type
FROM events WHERE ts >= TIMESTAMP '2024-01-20'"""


def add_default_column(t: Tables):
    """A status column added to a table that has none, and filled where it exists."""
    old = t.orders.where("o_orderstatus = 'O'").select("o_orderkey")
    new = t.orders.where("o_orderstatus != 'O'").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "refunded").alias("status"))
    return load.add_column(old, "status", "shipped").unionByName(load.add_column(new, "status", "shipped"))


ADD_COLUMN_SQL = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'refunded' ELSE 'shipped' END AS status FROM orders"""


def topic_shape(t: Tables):
    """Events in the shape of a topic, decoded with their metadata."""
    topic = kafka.as_topic(t.events, "events", F.col("event_id"), F.col("event_id"), F.col("ts"),
                           "event_id", "user_id", "event_type")
    rows = kafka.messages(topic)
    return rows.select("key", "topic", "partition", "offset", "timestamp",
                       F.get_json_object("value", "$.event_type").alias("event_type"))


TOPIC_SQL = f"""
SELECT CAST(event_id AS VARCHAR) AS key, 'events' AS topic, 0 AS partition, event_id AS "offset",
       {ts_sql('ts')} AS timestamp, event_type FROM events"""


QUERIES = {
    "partition_rewrite": (partition_rewrite, REWRITE_SQL),
    "prune_scan": (prune_scan, PRUNE_SQL),
    "dated_mart": (dated_mart, "SELECT user_id, count(*) AS n FROM events GROUP BY 1"),
    "layout_write": (layout_write, LAYOUT_SQL),
    "bucketed_join": (bucketed_join, "SELECT o_custkey AS c_custkey, count(*) AS orders FROM orders GROUP BY 1"),
    "nested_documents": (nested_documents, DOCUMENTS_SQL),
    "save_modes": (save_modes, "SELECT s_suppkey, CAST(2 AS BIGINT) AS copies FROM supplier"),
    "read_cities": (read_cities, CITIES_SQL),
    "read_clean": (read_clean, CLEAN_SQL),
    "read_json_envelope": (read_json_envelope, ENVELOPE_SQL),
    "add_default_column": (add_default_column, ADD_COLUMN_SQL),
    "topic_shape": (topic_shape, TOPIC_SQL),
}
QUERIES = {name: (query(fn), sql) for name, (fn, sql) in QUERIES.items()}
