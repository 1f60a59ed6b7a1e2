"""Order vault: five hubs, four links and five satellites out of enriched order messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martworks.functions.keys import link_uuid5, uuid5, uuid5_digest, uuid5_of_digest
from martworks.operators.joins import absent
from martworks.operators.windows import top1

ORDER_MESSAGE = (
    "object_id bigint, object_type string, payload struct<id: bigint, date: timestamp, cost: decimal(19,5), "
    "payment: decimal(19,5), status: string, restaurant: struct<id: string, name: string>, "
    "user: struct<id: string, name: string, login: string>, products: array<struct<id: string, "
    "price: decimal(14,2), quantity: int, name: string, category: string>>>"
)

# Natural key of every hub; a hub's key column is its name with ``_pk``.
HUBS = {"h_user": "user_id", "h_product": "product_id", "h_category": "category_name",
        "h_restaurant": "restaurant_id", "h_order": "order_id"}
LINKS = {"l_order_product": ("h_order", "h_product"), "l_product_restaurant": ("h_product", "h_restaurant"),
         "l_product_category": ("h_product", "h_category"), "l_order_user": ("h_order", "h_user")}
SATELLITES = {"s_user_names": ("h_user", {"username": "username", "userlogin": "userlogin"}),
              "s_product_names": ("h_product", {"product_name": "name"}),
              "s_restaurant_names": ("h_restaurant", {"restaurant_name": "name"}),
              "s_order_cost": ("h_order", {"cost": "cost", "payment": "payment"}),
              "s_order_status": ("h_order", {"status": "status"})}
# Every table with its key column.
TABLES = {**{h: f"{h}_pk" for h in HUBS}, **{t: f"hk_{t[2:]}_pk" for t in (*LINKS, *SATELLITES)}}


def order_level(messages: DataFrame) -> DataFrame:
    """Orders of the messages with natural keys only."""
    return messages.select("payload.*").select(
        F.col("id").alias("order_id"), F.col("date").alias("order_dt"), "cost", "payment", "status", "products",
        F.col("restaurant.id").alias("restaurant_id"), F.col("restaurant.name").alias("restaurant_name"),
        F.col("user.id").alias("user_id"), F.col("user.name").alias("username"),
        F.col("user.login").alias("userlogin"),
    )


def product_level(orders: DataFrame) -> DataFrame:
    """Product lines of the orders with natural keys only."""
    return orders.select("order_id", "restaurant_id", F.explode("products").alias("_p")).select(
        "order_id", "restaurant_id", F.col("_p.id").alias("product_id"), F.col("_p.name").alias("product_name"),
        F.col("_p.category").alias("category_name"),
    )


def _one_per_key(rows: DataFrame, keys: list[str], attributes: list[str]) -> DataFrame:
    """One row per natural key; the smallest attributes where messages differ."""
    if not attributes:
        return rows.select(*keys).distinct()
    return top1(rows.select(*keys, *attributes), keys, attributes, largest=False)


def vault_rows(messages: DataFrame, load_dt, source: str = "stg-service-orders",
               existing: dict[str, DataFrame] | None = None, history: bool = False,
               lines: DataFrame | None = None) -> dict[str, DataFrame]:
    """New rows of all 14 tables; keys already present in ``existing`` are left alone.

    Rows are first reduced by their short natural keys, and UUIDs made for what is left; the keys are
    functions of the natural ones, so nothing is looked up. With ``history`` the satellites also get a row
    when attributes of a known key have changed. Callers that write several tables should persist or
    store ``messages`` first, and may give the stored ``product_level`` rows as ``lines``.
    """
    orders = order_level(messages)
    lines = product_level(orders) if lines is None else lines
    stamp = {"load_dt": F.lit(load_dt).cast("timestamp"), "load_src": F.lit(source)}

    def level(*hubs: str) -> DataFrame:
        return lines if {"h_product", "h_category"} & set(hubs) else orders

    def fresh(table: str, rows: DataFrame, on: list[str]) -> DataFrame:
        before = (existing or {}).get(table)
        return (rows if before is None else absent(rows, before, on)).withColumns(stamp)

    result = {}
    for hub, natural in HUBS.items():
        attributes = ["order_dt"] if hub == "h_order" else []
        rows = _one_per_key(level(hub), [natural], attributes)
        result[hub] = fresh(hub, rows.select(uuid5(natural).alias(f"{hub}_pk"), natural, *attributes), [f"{hub}_pk"])
    for link, (a, b) in LINKS.items():
        pairs = _one_per_key(level(a, b), [HUBS[a], HUBS[b]], [])
        keyed = pairs.select(uuid5(HUBS[a]).alias(f"{a}_pk"), uuid5(HUBS[b]).alias(f"{b}_pk"))
        rows = keyed.select(link_uuid5(f"{a}_pk", f"{b}_pk").alias(TABLES[link]), f"{a}_pk", f"{b}_pk")
        result[link] = fresh(link, rows, [TABLES[link]])
    for satellite, (hub, attributes) in SATELLITES.items():
        natural, columns = HUBS[hub], list(attributes)
        source_rows = level(hub)
        one = source_rows.select(natural, *columns).distinct() if history else _one_per_key(source_rows, [natural], columns)
        keyed = one.select(uuid5(natural).alias(f"{hub}_pk"), *[F.col(c).alias(n) for c, n in attributes.items()])
        rows = keyed.select(uuid5(f"{hub}_pk").alias(TABLES[satellite]), "*")
        result[satellite] = fresh(satellite, rows, rows.columns if history else [TABLES[satellite]])
    return result


def natural_lines(lines: DataFrame) -> DataFrame:
    """Lines shaped as those of the compact messages from plain ones (``_order``, ``_user``, product id, name and
    category), with natural keys where :func:`keyed` puts UUIDs."""
    return lines.select(
        F.col("_order").alias("id"), F.col("_user").alias("user"), F.col("id").alias("product_uuid"),
        F.col("name").alias("product_name"), F.col("category").alias("category_uuid"), F.col("category").alias("category_name"))


def keyed(rows: DataFrame) -> DataFrame:
    """UUIDs for the natural keys of user, product and category: equal for equal ones, null for null."""
    return rows.withColumns({c: uuid5(c) for c in ("user", "product_uuid", "category_uuid") if c in rows.columns})


def compact_messages(messages: DataFrame) -> DataFrame:
    """Outgoing message per order: id, user key and the keyed product list."""
    digests = F.transform("payload.products", lambda p: F.struct(
        uuid5_digest(p["id"]).alias("id"), p["name"].alias("name"),
        uuid5_digest(p["category"]).alias("kind"), p["category"].alias("category"),
    ))
    return messages.select(
        F.col("object_id").alias("id"), uuid5("payload.user.id").alias("user"),
        F.transform(digests, lambda d: F.struct(
            uuid5_of_digest(d["id"]).alias("product_uuid"), d["name"].alias("product_name"),
            uuid5_of_digest(d["kind"]).alias("category_uuid"), d["category"].alias("category_name"),
        )).alias("products"),
    )
