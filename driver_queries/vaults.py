"""Order vault and counters on the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from driver_queries.common import Tables, dec, per_order, query, ts_sql, uuid5_sql
from martworks.operators.groups import collect_parts
from martworks.plans import counters, vault
from martworks.session import Copies
from martworks.sources import kafka
from martworks.streaming import orders as order_streams
from martworks.streaming.windows import parse_value

LOADED = "2024-01-01 00:00:00"
#: Row groups of stored menus: a task holds the lists of one of them.
MENU_BYTES = 1 << 20


def raw_topic(t: Tables):
    """Orders with their lines as raw messages of a topic. The restaurant of an order is the supplier with the smallest
    key among its lines."""
    item = F.struct(
        F.col("l_partkey").cast("string").alias("id"), F.col("p_name").alias("name"),
        "price", "quantity")
    # Lines of unknown parts are not in the list, but count for the restaurant: both out of one grouping.
    sold = t.lineitem.where(F.col("l_orderkey").isNotNull()).select(
        "l_orderkey", "l_partkey", "l_suppkey", dec("l_extendedprice").alias("price"), F.col("l_quantity").cast("int").alias("quantity"))
    lines = sold.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left")
    items = per_order(lines.repartition("l_orderkey"), F.when(F.col("p_partkey").isNotNull(), item), "order_items", F.min("l_suppkey").alias("shop"))
    rows = (
        t.orders.join(items.where(F.size("order_items") > 0), F.col("o_orderkey") == F.col("l_orderkey"))
        .select(
            F.col("o_orderkey").alias("object_id"), F.lit("order").alias("object_type"),
            F.col("o_orderdate").alias("sent_dttm"),
            F.struct(
                F.struct(F.col("shop").cast("string").alias("id")).alias("restaurant"),
                F.col("o_orderdate").alias("date"),
                F.struct(F.col("o_custkey").cast("string").alias("id")).alias("user"), "order_items",
                dec("o_totalprice").alias("cost"), dec("o_totalprice").alias("payment"),
                F.col("o_orderstatus").alias("final_status"),
            ).alias("payload"))
    )
    return kafka.as_topic(rows, "orders", F.col("object_id"), F.col("object_id"), F.col("sent_dttm"),
                          "object_id", "object_type", "sent_dttm", "payload")


def user_lookup(t: Tables):
    return t.customer.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
                             F.lower("c_mktsegment").alias("login"))


def shop_lookup(t: Tables, copies: Copies | None = None):
    """Restaurants with the menu of all parts in orders of theirs, stored."""
    early, copies = Copies(t.spark), copies or Copies(t.spark)
    by_order = t.lineitem.where(F.col("l_orderkey").isNotNull()).groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("shop"), F.collect_set("l_partkey").alias("parts"))
    sold = early.add(by_order.select("shop", F.explode("parts").alias("p_partkey")).distinct()
                  .join(t.part.select("p_partkey", "p_name", "p_type"), "p_partkey"), "sold")
    item = F.struct(F.col("p_partkey").cast("string").alias("_id"), F.col("p_name").alias("name"),
                    F.col("p_type").alias("category"))
    menus = collect_parts(sold, ["shop"], item, "menu", "p_partkey")
    named = menus.join(t.supplier, F.col("shop") == F.col("s_suppkey")).select(
        F.col("shop").cast("string").alias("id"), F.col("s_name").alias("name"), "menu")
    shops = copies.add(named, "shops", row_group=MENU_BYTES)
    early.drop()
    return shops


def enriched(t: Tables, copies: Copies | None = None):
    """Enriched order messages, typed; they read the ``copies``."""
    copies = copies or Copies(t.spark)
    # Read twice: for the orders and for their lines.
    raw = parse_value(copies.add(raw_topic(t).select("value"), "raw_orders"), order_streams.RAW)
    return order_streams.enriched(raw, user_lookup(t), shop_lookup(t, copies), copies)


def enriched_orders(t: Tables):
    """Enriched messages as flat rows."""
    p = F.col("payload")
    return enriched(t).select(
        "object_id", p["date"].alias("date"), p["cost"].alias("cost"), p["status"].alias("status"),
        p["restaurant"]["name"].alias("restaurant"), p["user"]["name"].alias("user"), p["user"]["login"].alias("login"),
        F.array_sort(F.transform(p["products"], lambda i: F.concat_ws(
            ":", i["id"], i["quantity"].cast("string"), i["price"].cast("string"), i["name"], i["category"])))
        .alias("products"))


ENRICHED_SQL = f"""
WITH s AS (SELECT l_orderkey, min(l_suppkey) AS shop FROM lineitem GROUP BY 1),
i AS (
  SELECT l_orderkey, concat_ws(':', l_partkey, CAST(l_quantity AS INTEGER), CAST(l_extendedprice AS DECIMAL(14,2)),
         p_name, p_type) AS item FROM lineitem JOIN part ON l_partkey = p_partkey),
x AS (SELECT l_orderkey, string_agg(item, ',' ORDER BY item) AS products FROM i GROUP BY 1)
SELECT o_orderkey AS object_id, {ts_sql('o_orderdate')} AS date, o_totalprice AS cost, o_orderstatus AS status,
       s_name AS restaurant, c_name AS "user", lower(c_mktsegment) AS login, products
FROM orders JOIN s ON s.l_orderkey = o_orderkey JOIN x ON x.l_orderkey = o_orderkey
JOIN supplier ON s_suppkey = shop JOIN customer ON c_custkey = o_custkey"""


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _vault(t: Tables):
    early, copies = Copies(t.spark), Copies(t.spark)
    messages = copies.add(enriched(t, early), "enriched")
    early.drop()
    lines = copies.add(vault.product_level(vault.order_level(messages)), "enriched_lines")
    return vault.vault_rows(messages, LOADED, lines=lines)


def stacked_hubs(tables):
    natural = {"h_user": "user_id", "h_product": "product_id", "h_category": "category_name",
               "h_restaurant": "restaurant_id", "h_order": "order_id"}
    return _union([
        tables[h].select(F.lit(h).alias("hub"), F.col(vault.TABLES[h]).alias("pk"),
                         F.col(key).cast("string").alias("business_key"), "load_dt", "load_src")
        for h, key in natural.items()])


def stacked_links(tables):
    members = {"l_order_product": ("h_order_pk", "h_product_pk"), "l_order_user": ("h_order_pk", "h_user_pk"),
               "l_product_restaurant": ("h_product_pk", "h_restaurant_pk"),
               "l_product_category": ("h_product_pk", "h_category_pk")}
    return _union([
        tables[n].select(F.lit(n).alias("link"), F.col(vault.TABLES[n]).alias("pk"),
                         F.col(a).alias("left_pk"), F.col(b).alias("right_pk"))
        for n, (a, b) in members.items()])


def stacked_sats(tables):
    attributes = {"s_user_names": ("h_user_pk", ["username", "userlogin"]), "s_product_names": ("h_product_pk", ["name"]),
                  "s_restaurant_names": ("h_restaurant_pk", ["name"]), "s_order_status": ("h_order_pk", ["status"]),
                  "s_order_cost": ("h_order_pk", ["cost", "payment"])}
    return _union([
        tables[n].select(F.lit(n).alias("sat"), F.col(vault.TABLES[n]).alias("pk"), F.col(parent).alias("hub_pk"),
                         F.concat_ws("|", *[F.col(c).cast("decimal(19,2)").cast("string") if n == "s_order_cost"
                                            else F.col(c) for c in columns]).alias("attributes"))
        for n, (parent, columns) in attributes.items()])


def vault_hubs(t: Tables):
    return stacked_hubs(_vault(t))


def vault_links(t: Tables):
    return stacked_links(_vault(t))


def vault_sats(t: Tables):
    return stacked_sats(_vault(t))


_O, _P, _U, _C = (uuid5_sql(e) for e in (
    "CAST(l_orderkey AS VARCHAR)", "CAST(l_partkey AS VARCHAR)", "CAST(o_custkey AS VARCHAR)", "p_type"))
_R = uuid5_sql("CAST(shop AS VARCHAR)")
VAULT_CTE = f"""
WITH s AS (SELECT l_orderkey AS ok, min(l_suppkey) AS shop FROM lineitem GROUP BY 1),
b AS (SELECT DISTINCT l_orderkey, l_partkey, o_custkey, shop, p_type, p_name, o_orderstatus, o_totalprice
      FROM lineitem JOIN s ON ok = l_orderkey JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey),
k AS (SELECT *, {_O} AS o, {_P} AS p, {_U} AS u, {_C} AS c, {_R} AS r FROM b)"""

HUBS_SQL = VAULT_CTE + """
SELECT DISTINCT hub, pk, business_key, '2024-01-01 00:00:00' AS load_dt, 'stg-service-orders' AS load_src FROM (
  SELECT 'h_user' AS hub, u AS pk, CAST(o_custkey AS VARCHAR) AS business_key FROM k
  UNION ALL SELECT 'h_product', p, CAST(l_partkey AS VARCHAR) FROM k UNION ALL SELECT 'h_category', c, p_type FROM k
  UNION ALL SELECT 'h_restaurant', r, CAST(shop AS VARCHAR) FROM k
  UNION ALL SELECT 'h_order', o, CAST(l_orderkey AS VARCHAR) FROM k)"""

LINKS_SQL = VAULT_CTE + f"""
SELECT link, {uuid5_sql('left_pk || right_pk')} AS pk, left_pk, right_pk FROM (
  SELECT 'l_order_product' AS link, o AS left_pk, p AS right_pk FROM k UNION SELECT 'l_order_user', o, u FROM k
  UNION SELECT 'l_product_restaurant', p, r FROM k UNION SELECT 'l_product_category', p, c FROM k)"""

SATS_SQL = VAULT_CTE + f"""
SELECT sat, {uuid5_sql('hub_pk')} AS pk, hub_pk, attributes FROM (
  SELECT 's_user_names' AS sat, u AS hub_pk, c_name || '|' || lower(c_mktsegment) AS attributes
  FROM k JOIN customer ON c_custkey = o_custkey
  UNION SELECT 's_product_names', p, p_name FROM k
  UNION SELECT 's_restaurant_names', r, s_name FROM k JOIN supplier ON s_suppkey = shop
  UNION SELECT 's_order_status', o, o_orderstatus FROM k
  UNION SELECT 's_order_cost', o, CAST(o_totalprice AS DECIMAL(19,2)) || '|' || CAST(o_totalprice AS DECIMAL(19,2))
  FROM k)"""


def _lines(t: Tables):
    """Lines as the counters take them, stored."""
    early = Copies(t.spark)
    raw = parse_value(early.add(raw_topic(t).select("value"), "raw_orders"), order_streams.RAW)
    lines = Copies(t.spark).add(order_streams.enriched_lines(raw, shop_lookup(t, early)), "counted_lines")
    early.drop()
    return lines


def order_counters(t: Tables):
    return vault.keyed(counters.order_counters(_lines(t), counters.PRODUCT))


def category_counters(t: Tables):
    return vault.keyed(counters.order_counters(_lines(t), counters.CATEGORY))


PRODUCT_COUNTERS_SQL = VAULT_CTE + """
SELECT u AS "user", p AS product_uuid, p_name AS product_name, count(DISTINCT l_orderkey) AS order_cnt
FROM k GROUP BY ALL"""

CATEGORY_COUNTERS_SQL = VAULT_CTE + """
SELECT u AS "user", c AS category_uuid, p_type AS category_name, count(DISTINCT l_orderkey) AS order_cnt
FROM k GROUP BY ALL"""


QUERIES = {
    "enriched_orders": (enriched_orders, ENRICHED_SQL),
    "vault_hubs": (vault_hubs, HUBS_SQL),
    "vault_links": (vault_links, LINKS_SQL),
    "vault_sats": (vault_sats, SATS_SQL),
    "order_counters": (order_counters, PRODUCT_COUNTERS_SQL),
    "category_counters": (category_counters, CATEGORY_COUNTERS_SQL),
}
QUERIES = {name: (query(fn), sql) for name, (fn, sql) in QUERIES.items()}
