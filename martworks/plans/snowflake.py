"""Loading dimensions and the product-sales fact from enveloped documents.

Every function gives the new rows of its table; the caller appends them and stores the mark
(``load.load_increment``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.functions.nested import explode_records, open_json
from martworks.operators.dedup import keep_latest
from martworks.operators.joins import absent
from martworks.operators.load import new_calendar, number_new, versioned
from martworks.sources.envelope import open_envelope

USER = "name string, login string"
RESTAURANT = "name string, menu array<struct<_id: string, name: string, price: decimal(14,2)>>"
ORDER = "user struct<id: string>, restaurant struct<id: string>, date timestamp, final_status string"
PAYMENTS = (
    "order_id string, product_payments array<struct<product_id: string, price: decimal(14,2), quantity: int, "
    "product_cost: decimal(14,2), bonus_payment: decimal(14,2), bonus_grant: decimal(14,2)>>"
)


def _newest(envelope: DataFrame) -> DataFrame:
    return keep_latest(envelope.select("object_id", "update_ts", "object_value"), ["object_id"],
                       ["update_ts", "object_value"])


def users(target: DataFrame, envelope: DataFrame) -> DataFrame:
    """New users with surrogate ids; numeric ids in their order, then others in that of their text."""
    rows = open_envelope(_newest(envelope), USER).select(
        F.col("object_id").alias("user_id"), F.col("name").alias("user_name"), F.col("login").alias("user_login"),
        F.col("object_id").try_cast("long").alias("_order"),
    )
    return number_new(target, rows, "user_id", order="_order").drop("_order")


def restaurants(target: DataFrame, envelope: DataFrame) -> DataFrame:
    rows = open_envelope(_newest(envelope), RESTAURANT).select(
        F.col("object_id").alias("restaurant_id"), F.col("name").alias("restaurant_name"), "update_ts",
        F.col("object_id").try_cast("long").alias("_order"),
    )
    dated = versioned(rows, F.date_trunc("second", "update_ts")).drop("update_ts")
    return number_new(target, dated, "restaurant_id", order="_order").drop("_order")


def products(target: DataFrame, envelope: DataFrame, dm_restaurants: DataFrame) -> DataFrame:
    """Menu entries of all restaurant documents; the newest version of each product of a restaurant."""
    entries = explode_records(
        open_envelope(envelope, RESTAURANT), "menu", ["object_id", "update_ts"],
        {"_id": "product_id", "name": "product_name", "price": "product_price"},
    )
    newest = keep_latest(entries, ["object_id", "product_id"], ["update_ts", "product_name", "product_price"])
    owned = newest.join(
        dm_restaurants.select(F.col("restaurant_id").alias("object_id"), F.col("id").alias("restaurant_id")),
        "object_id", "left",
    ).withColumn("_order", F.col("product_id").try_cast("long"))
    dated = versioned(owned, F.date_trunc("second", "update_ts")).drop("object_id", "update_ts")
    return number_new(target, dated, "product_id", order="_order").drop("_order")


def order_documents(envelope: DataFrame) -> DataFrame:
    """Newest version of every order document, typed."""
    return open_envelope(_newest(envelope), ORDER).select(
        F.col("object_id").alias("order_key"), F.col("user.id").alias("user_key"),
        F.col("restaurant.id").alias("restaurant_key"), F.date_trunc("second", "date").alias("ts"),
        F.col("final_status").alias("order_status"),
    )


def timestamps(target: DataFrame, orders: DataFrame) -> DataFrame:
    """New timestamp-dimension rows, numbered in time order."""
    return number_new(target, new_calendar(target, orders, "ts"), "ts")


def orders(target: DataFrame, documents: DataFrame, dm_users: DataFrame, dm_restaurants: DataFrame,
           dm_timestamps: DataFrame) -> DataFrame:
    """New orders with the surrogate ids of user, restaurant and moment."""
    rows = (
        absent(documents, target, ["order_key"])
        .join(dm_restaurants.select(F.col("restaurant_id").alias("restaurant_key"),
                                    F.col("id").alias("restaurant_id")), "restaurant_key", "left")
        .join(dm_timestamps.select("ts", F.col("id").alias("timestamp_id")), "ts", "left")
        .join(dm_users.select(F.col("user_id").alias("user_key"), F.col("id").alias("user_id")), "user_key", "left")
        .withColumn("_order", F.col("order_key").try_cast("long"))
    )
    return number_new(target, rows, "order_key", order="_order").select(
        "id", "user_id", "restaurant_id", "timestamp_id", "order_key", "order_status"
    )


def product_sales(events: DataFrame, dm_orders: DataFrame, dm_products: DataFrame,
                  event_type: str = "bonus_transaction") -> DataFrame:
    """Fact rows of the bonus events; products by their current version, so versions never multiply rows."""
    paid = open_json(events.where(F.col("event_type") == event_type), "event_value", PAYMENTS)
    lines = explode_records(paid, "product_payments", [F.col("order_id").alias("order_key")], {
        "product_id": "product_key", "quantity": "count", "price": "price", "product_cost": "total_sum",
        "bonus_payment": "bonus_payment", "bonus_grant": "bonus_grant",
    })
    current = keep_latest(
        dm_products.select(F.col("product_id").alias("product_key"), "active_from", F.col("id").alias("product_id")),
        ["product_key"], ["active_from", "product_id"],
    ).select("product_key", "product_id")
    return (
        lines.join(dm_orders.select("order_key", F.col("id").alias("order_id")), "order_key")
        .join(current, "product_key")
        .select("product_id", "order_id", "count", "price", "total_sum", "bonus_payment", "bonus_grant")
    )
