"""The chained order streams: enrichment, vault and counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martworks.operators import keyed
from martworks.operators.dedup import keep_latest
from martworks.operators.joins import array_lookup, array_lookup_lines
from martworks.plans import counters, vault
from martworks.session import Copies
from martworks.streaming import core
from martworks.streaming.windows import parse_value

RAW = (
    "object_id bigint, object_type string, sent_dttm timestamp, payload struct<restaurant: struct<id: string>, "
    "date: timestamp, user: struct<id: string>, order_items: array<struct<id: string, name: string, "
    "price: decimal(14,2), quantity: int>>, bonus_payment: decimal(14,2), cost: decimal(14,2), "
    "payment: decimal(14,2), bonus_grant: decimal(14,2), "
    "statuses: array<struct<status: string, dttm: timestamp>>, final_status: string, update_ts: timestamp>"
)


def raw_events(topic: DataFrame) -> DataFrame:
    """Raw-layer rows: the envelope with its payload as JSON text, the newest one per order."""
    rows = topic.select(F.col("value").cast("string").alias("_v")).select(
        F.get_json_object("_v", "$.object_id").cast("bigint").alias("object_id"),
        F.get_json_object("_v", "$.object_type").alias("object_type"),
        F.to_timestamp(F.get_json_object("_v", "$.sent_dttm")).alias("sent_dttm"),
        F.get_json_object("_v", "$.payload").alias("payload"),
    )
    return keep_latest(rows, ["object_id"], ["sent_dttm", "payload"])


def _flat(orders: DataFrame) -> DataFrame:
    flat = orders.select("object_id", "payload.*").drop("update_ts", "statuses")
    # The line's own name gives way to the menu's.
    kept = [f.name for f in flat.schema["order_items"].dataType.elementType.fields if f.name != "name"]
    return flat.withColumn("order_items", F.transform("order_items", lambda i: F.struct(*[i[k].alias(k) for k in kept])))


def enriched_lines(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Product lines of the orders as the counters take them (``id``, ``user`` and product), straight from the opened
    lists: no list is closed to be opened again. The keys are the short natural ones; :func:`vault.keyed` turns what is
    counted into UUIDs."""
    flat = _flat(orders).withColumn("_user", F.col("user.id")).withColumnRenamed("object_id", "_order")
    lines = array_lookup_lines(flat, ["_order", "_user"], F.col("restaurant.id"), "order_items", restaurants, "id", "menu")
    return vault.natural_lines(lines)


def enriched(orders: DataFrame, users: DataFrame, restaurants: DataFrame, copies: Copies | None = None) -> DataFrame:
    """Order messages completed with user and restaurant names and menu data.

    ``users``: id, name, login; ``restaurants``: id, name, menu, a long menu possibly in several rows.
    Orders of unknown users or restaurants keep null names. With ``copies`` the lines are stored there on the way.
    """
    flat = _flat(orders)
    named = (
        flat.drop("order_items").withColumns({"_uid": F.col("user.id"), "_rid": F.col("restaurant.id")})
        .join(users.select(F.col("id").alias("_uid"), F.col("name").alias("_uname"), F.col("login").alias("_login")),
              "_uid", "left")
        .join(restaurants.select(F.col("id").alias("_rid"), F.col("name").alias("_rname")).distinct(), "_rid", "left")
    )
    looked = array_lookup(flat, "object_id", F.col("restaurant.id"), "order_items", restaurants, "id", "menu", onto=named,
                          copies=copies)
    return looked.select("object_id", F.lit("order").alias("object_type"), F.struct(
        F.col("object_id").alias("id"), "date",
        F.col("cost").cast("decimal(19,5)").alias("cost"), F.col("payment").cast("decimal(19,5)").alias("payment"),
        F.col("final_status").alias("status"),
        F.struct(F.col("_rid").alias("id"), F.col("_rname").alias("name")).alias("restaurant"),
        F.struct(F.col("_uid").alias("id"), F.col("_uname").alias("name"), F.col("_login").alias("login")).alias("user"),
        "products",
    ).alias("payload"))


def run_enrich(topic: DataFrame, users: DataFrame, restaurants: DataFrame, out: str, checkpoint: str,
               every: str | None = None):
    """Raw rows, the newest of each order over all batches, and enriched messages of every batch."""
    def messages(batch: DataFrame, batch_id: int) -> None:
        copies = Copies(batch.sparkSession)
        try:
            rows = enriched(parse_value(batch, RAW), users, restaurants, copies)
            core.batch_folder(f"{out}/messages", core.as_messages)(rows, batch_id)
        finally:
            copies.drop()

    sink = core.fan_out(
        keyed.upsert_folder(f"{out}/order_events", ["object_id"], ["sent_dttm", "payload"], raw_events),
        messages, on_disk=True,
    )
    return core.start(topic.select("value"), sink, checkpoint, every=every)


def vault_sink(spark: SparkSession, out: str, load_dt):
    """Sink that adds a batch's new keys to the 14 tables and writes the compact messages. Of what is stored only the
    buckets that the batch's keys lie in are read."""
    def write(batch: DataFrame, batch_id: int) -> None:
        # Parsed once for all fifteen outputs, and kept in columns on disk.
        copies = Copies(batch.sparkSession)
        try:
            messages = copies.add(parse_value(batch, vault.ORDER_MESSAGE), "vault_batch")
            lines = copies.add(vault.product_level(vault.order_level(messages)), "vault_lines")
            rows = vault.vault_rows(messages, load_dt, lines=lines)
            most = max(messages.count(), lines.count())
            keyed.add_unseen({t: (r, f"{out}/{t}", [vault.TABLES[t]]) for t, r in rows.items()}, batch_id, dict.fromkeys(rows, most))
            core.batch_folder(f"{out}/messages", core.as_messages)(vault.compact_messages(messages), batch_id)
        finally:
            copies.drop()
    return write


def run_vault(spark: SparkSession, topic: DataFrame, out: str, checkpoint: str, load_dt, every: str | None = None):
    return core.start(topic.select("value"), vault_sink(spark, out, load_dt), checkpoint, every=every)


def counter_sink(by: list[str], out: str) -> core.Sink:
    """Sink for running numbers of distinct orders per key. An order counts in the batch that brings it first: the pairs
    seen are kept by bucket, and each batch adds the counts of its new ones."""
    def lines(batch: DataFrame) -> DataFrame:
        return counters.order_lines(parse_value(batch, counters.COMPACT)).select("id", *by)

    pairs = keyed.first_seen(f"{out}/pairs", ["id", *by], lines, few_repeats=True)

    def write(batch: DataFrame, batch_id: int) -> None:
        pairs(batch, batch_id)
        new = batch.sparkSession.read.schema(lines(batch).schema).parquet(f"{out}/pairs/batch_id={batch_id}")
        core.batch_folder(f"{out}/counts", lambda rows: rows.groupBy(*by).agg(F.count(F.lit(1)).alias("order_cnt")))(new, batch_id)
    return write


def run_counters(topic: DataFrame, by: list[str], out: str, checkpoint: str, every: str | None = None):
    """What every batch adds to the counters; :func:`current_counters` gives their state."""
    return core.start(topic.select("value"), counter_sink(by, out), checkpoint, every=every)


def current_counters(spark: SparkSession, out: str, by: list[str]) -> DataFrame:
    return core.batches(spark, f"{out}/counts").groupBy(*by).agg(F.sum("order_cnt").alias("order_cnt"))
