"""Marts and load operators of the warehouse projects, on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.common import Tables, day, day_sql, dec, per_order, query, stored, ts_sql
from martworks.functions import nested
from martworks.functions.keys import text_key
from martworks.operators import load
from martworks.operators.groups import collect_parts
from martworks.operators.joins import valid_at, valid_now
from martworks.operators.quality import split_valid
from martworks.operators.windows import ranked, top1
from martworks.plans import courier, deliveries, group_vault, metrics, rates, sales, settlement, shipping, snowflake
from martworks.session import scratch
from martworks.sources.envelope import to_envelope

NOW = "2024-01-01"


# --- courier ledger -----------------------------------------------------------------------------------

def _deliveries(t: Tables):
    price = dec("l_extendedprice")
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_ts"),
        F.col("l_suppkey").alias("courier_id"), (1 + F.col("l_linenumber") % 5).alias("rate"),
        price.alias("order_sum"), (price * dec("l_discount", 4, 2)).alias("tip_sum"),
    )


def _couriers(t: Tables):
    """Suppliers; one with a negative balance is no longer active."""
    return t.supplier.select(
        F.col("s_suppkey").alias("id"), F.col("s_suppkey").alias("courier_id"), F.col("s_name").alias("courier_name"),
        F.when(F.col("s_acctbal") < 0, F.lit("2000-01-01")).otherwise(F.lit("2099-01-01"))
        .cast("timestamp").alias("active_to"),
    )


def courier_ledger(t: Tables):
    return courier.courier_ledger(_deliveries(t), _couriers(t), NOW)


def courier_ledger_order_floor(t: Tables):
    return courier.courier_ledger(_deliveries(t), _couriers(t), NOW, floor="order")


LEDGER_BASE = """
WITH d AS (
  SELECT s_suppkey AS id, s_name AS courier_name, year(o_orderdate) AS settlement_year,
         month(o_orderdate) AS settlement_month, l_orderkey, 1 + l_linenumber % 5 AS rate,
         CAST(l_extendedprice AS DECIMAL(14,2)) AS s,
         CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_discount AS DECIMAL(4,2)) AS tip
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
  WHERE NOT s_acctbal < 0),
g AS (
  SELECT id, courier_name, settlement_year, settlement_month, count(DISTINCT l_orderkey) AS orders_count,
         CAST(sum(s) AS DECIMAL(20,2)) AS total, CAST(avg(rate) AS DECIMAL(14,2)) AS rate_avg,
         CAST(sum(tip) AS DECIMAL(22,4)) AS tips
  FROM d GROUP BY ALL)"""

LEDGER_SQL = LEDGER_BASE + """,
p AS (
  SELECT *, CASE WHEN rate_avg < 4 THEN greatest(total * CAST('0.05' AS DECIMAL(3,2)), 100)
                 WHEN rate_avg < 4.5 THEN greatest(total * CAST('0.07' AS DECIMAL(3,2)), 150)
                 WHEN rate_avg < 4.9 THEN greatest(total * CAST('0.08' AS DECIMAL(3,2)), 175)
                 ELSE greatest(total * CAST('0.10' AS DECIMAL(3,2)), 200) END AS pay
  FROM g)
SELECT id, courier_name, settlement_year, settlement_month, orders_count, CAST(total AS DOUBLE) AS orders_total_sum,
       CAST(rate_avg AS DOUBLE) AS rate_avg,
       CAST(total * CAST('0.25' AS DECIMAL(3,2)) AS DOUBLE) AS order_processing_fee,
       CAST(pay AS DOUBLE) AS courier_order_sum, CAST(tips AS DOUBLE) AS courier_tips_sum,
       CAST(tips * CAST('0.95' AS DECIMAL(3,2)) + pay AS DOUBLE) AS courier_reward_sum
FROM p"""

LEDGER_ORDER_SQL = LEDGER_BASE + """,
o AS (
  SELECT id, settlement_year, settlement_month, sum(CASE
      WHEN rate_avg < 4 THEN greatest(s * CAST('0.05' AS DECIMAL(3,2)), 100)
      WHEN rate_avg < 4.5 THEN greatest(s * CAST('0.07' AS DECIMAL(3,2)), 150)
      WHEN rate_avg < 4.9 THEN greatest(s * CAST('0.08' AS DECIMAL(3,2)), 175)
      ELSE greatest(s * CAST('0.10' AS DECIMAL(3,2)), 200) END) AS pay
  FROM d JOIN g USING (id, courier_name, settlement_year, settlement_month) GROUP BY ALL)
SELECT id, courier_name, settlement_year, settlement_month, orders_count, CAST(total AS DOUBLE) AS orders_total_sum,
       CAST(rate_avg AS DOUBLE) AS rate_avg,
       CAST(total * CAST('0.25' AS DECIMAL(3,2)) AS DOUBLE) AS order_processing_fee,
       CAST(pay AS DOUBLE) AS courier_order_sum, CAST(tips AS DOUBLE) AS courier_tips_sum,
       CAST(tips * CAST('0.95' AS DECIMAL(3,2)) + pay AS DOUBLE) AS courier_reward_sum
FROM g JOIN o USING (id, settlement_year, settlement_month)"""


# --- settlement ---------------------------------------------------------------------------------------

def _settlement(t: Tables):
    """Restaurant = customer, as every order has one."""
    price = dec("l_extendedprice")
    day_id = F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date"))
    facts = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), dec("l_quantity", 6, 0).alias("count"), price.alias("price"),
        (price * dec("l_discount", 4, 2)).alias("bonus_payment"), (price * dec("l_tax", 4, 2)).alias("bonus_grant"),
    )
    orders = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("restaurant_id"),
                             day_id.alias("timestamp_id"))
    stamps = t.orders.select(day_id.alias("id"), F.to_date("o_orderdate").alias("date")).distinct()
    names = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("restaurant_name"))
    return settlement.settlement(facts, orders, stamps, names)


def settlement_daily(t: Tables):
    return _settlement(t).withColumn("orders_count", F.col("orders_count").cast("bigint"))


def settlement_update(t: Tables):
    """Two-step form: the report holds the days before 1999 with empty sums; they are updated, later days added."""
    fresh = _settlement(t)
    zero = F.lit(0).cast(fresh.schema["orders_total_sum"].dataType)
    old = fresh.where(F.col("settlement_date") < F.lit("1999-01-01").cast("date")).withColumn("orders_total_sum", zero)
    return settlement.append_and_update(old, fresh).withColumn("orders_count", F.col("orders_count").cast("bigint"))


SETTLEMENT_SQL = f"""
WITH d AS (
  SELECT o_custkey AS restaurant_id, o_orderdate AS d, CAST(l_quantity AS DECIMAL(6,0)) AS q,
         CAST(l_extendedprice AS DECIMAL(14,2)) AS price, CAST(l_discount AS DECIMAL(4,2)) AS disc,
         CAST(l_tax AS DECIMAL(4,2)) AS tax
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
g AS (
  SELECT restaurant_id, d, CAST(sum(q) AS BIGINT) AS orders_count, CAST(sum(price * q) AS DECIMAL(24,2)) AS total,
         CAST(sum(price * disc) AS DECIMAL(24,4)) AS paid, CAST(sum(price * tax) AS DECIMAL(24,4)) AS granted
  FROM d GROUP BY ALL)
SELECT restaurant_id, c_name AS restaurant_name, {day_sql('d')} AS settlement_date, orders_count,
       CAST(total AS DOUBLE) AS orders_total_sum, CAST(paid AS DOUBLE) AS orders_bonus_payment_sum,
       CAST(granted AS DOUBLE) AS orders_bonus_granted_sum,
       CAST(total * CAST('0.25' AS DECIMAL(3,2)) AS DOUBLE) AS order_processing_fee,
       CAST(total * CAST('0.75' AS DECIMAL(3,2)) - paid AS DOUBLE) AS restaurant_reward_sum
FROM g JOIN customer ON c_custkey = restaurant_id"""


# --- sales and retention ------------------------------------------------------------------------------

def _order_log(t: Tables):
    """Lines with returnflag R are refunds; N has no status yet, as rows older than the column."""
    flag = F.col("l_returnflag")
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
            F.col("l_partkey").alias("part_id"), F.col("o_custkey").alias("customer_id"),
            F.col("p_type").alias("item_id"), F.col("o_orderdate").alias("order_date"),
            F.col("l_quantity").cast("int").alias("quantity"), dec("l_extendedprice").alias("payment_amount"),
            F.when(flag == "R", "refunded").when(flag == "A", "shipped").alias("status"),
        )
    )


def sales_signed(t: Tables):
    return sales.signed_sales(_order_log(t)).select(
        "order_id", "line", "part_id", "customer_id", "item_id", "order_date", "status", "quantity", "payment_amount"
    )


SALES_SQL = f"""
SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part_id, o_custkey AS customer_id,
       p_type AS item_id, {ts_sql('o_orderdate')} AS order_date,
       CASE WHEN l_returnflag = 'R' THEN 'refunded' ELSE 'shipped' END AS status,
       CAST(l_quantity AS INTEGER) * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS quantity,
       CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS DOUBLE)
         AS payment_amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""


def retention_weekly(t: Tables):
    return sales.retention_weekly(_order_log(t))


RETENTION_SQL = """
WITH c AS (
  SELECT CAST(isoyear(o_orderdate) * 100 + week(o_orderdate) AS INTEGER) AS period_id, p_type AS item_id, o_custkey,
         count(DISTINCT CASE WHEN l_returnflag <> 'R' THEN l_orderkey END) AS n,
         sum(CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(14,2)) END) AS revenue,
         count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS refunds
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT period_id, item_id, count(*) FILTER (n = 1) AS new_customers_count,
       count(*) FILTER (n > 1) AS returning_customers_count,
       count(*) FILTER (refunds > 0) AS refunded_customer_count,
       CAST(coalesce(sum(revenue) FILTER (n = 1), 0) AS DOUBLE) AS new_customers_revenue,
       CAST(coalesce(sum(revenue) FILTER (n > 1), 0) AS DOUBLE) AS returning_customers_revenue,
       CAST(sum(refunds) AS BIGINT) AS customers_refunded, 'weekly' AS period_name
FROM c GROUP BY ALL"""


# --- shipping -----------------------------------------------------------------------------------------

def _shipping_log(t: Tables):
    """Shipping = order; its lines are the state changes."""
    key, priority = F.col("c_nationkey"), F.col("o_orderpriority")
    rate = (key / 1000).cast("decimal(14,3)")
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("shippingid"), F.col("o_custkey").alias("vendorid"),
            dec("o_totalprice").alias("payment_amount"),
            (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("shipping_plan_datetime"),
            F.when(F.col("l_returnflag") == "N", "in_progress").otherwise("finished").alias("status"),
            F.when(F.col("l_linestatus") == "O", "booked").otherwise("recieved").alias("state"),
            F.col("l_shipdate").alias("state_datetime"),
            F.col("n_name").alias("shipping_country"), rate.alias("shipping_country_base_rate"),
            F.concat_ws(":", key.cast("string"), F.concat(F.lit("vsp-"), key.cast("string")), rate.cast("string"),
                        F.lit("0.020")).alias("vendor_agreement_description"),
            F.concat_ws(":", F.substring(priority, 1, 1), F.substring(priority, 3, 20))
            .alias("shipping_transfer_description"),
            (F.substring(priority, 1, 1).cast("int") / 100).cast("decimal(14,3)").alias("shipping_transfer_rate"),
        )
    )


def shipping_split(t: Tables):
    """The three reference tables and the split descriptions, met again through shipping_info."""
    log = stored(_shipping_log(t), "shipping")
    rates_, transfer = shipping.country_rates(log), shipping.transfers(log)
    info = shipping.shipping_info(log, rates_, transfer)
    return (
        info.join(rates_, info.shipping_country_rate_id == rates_.id).drop("id")
        .join(shipping.agreements(log), "agreementid")
        .join(transfer, info.shipping_transfer_id == transfer.id).drop("id")
        .select("shippingid", "vendorid", "payment_amount", "shipping_country", "shipping_country_base_rate",
                "agreementid", "agreement_number", "agreement_rate", "agreement_commission", "transfer_type",
                "transfer_model", "shipping_transfer_rate")
    )


SHIPPING_BASE = """
WITH l AS (
  SELECT o_orderkey AS shippingid, o_custkey AS vendorid, CAST(o_totalprice AS DECIMAL(14,2)) AS pay,
         o_orderdate + INTERVAL 30 DAY AS plan, n_name, c_nationkey AS k, o_orderpriority AS pr,
         CASE WHEN l_returnflag = 'N' THEN 'in_progress' ELSE 'finished' END AS status,
         CASE WHEN l_linestatus = 'O' THEN 'booked' ELSE 'recieved' END AS state, l_shipdate AS moved
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey)"""

SHIPPING_SPLIT_SQL = SHIPPING_BASE + """
SELECT DISTINCT shippingid, vendorid, CAST(pay AS DOUBLE) AS payment_amount, n_name AS shipping_country,
       CAST(CAST(k / 1000.0 AS DECIMAL(14,3)) AS DOUBLE) AS shipping_country_base_rate,
       CAST(k AS BIGINT) AS agreementid, 'vsp-' || k AS agreement_number,
       CAST(CAST(k / 1000.0 AS DECIMAL(14,3)) AS DOUBLE) AS agreement_rate,
       0.02::DOUBLE AS agreement_commission, substr(pr, 1, 1) AS transfer_type, substr(pr, 3) AS transfer_model,
       CAST(CAST(substr(pr, 1, 1) AS INTEGER) / 100.0 AS DOUBLE) AS shipping_transfer_rate
FROM l"""


def shipping_mart(t: Tables):
    log = stored(_shipping_log(t), "shipping")
    rates_, transfer = shipping.country_rates(log), shipping.transfers(log)
    info = shipping.shipping_info(log, rates_, transfer)
    return shipping.shipping_mart(info, shipping.shipping_status(log), rates_, shipping.agreements(log), transfer)


SHIPPING_MART_SQL = SHIPPING_BASE + """,
s AS (
  SELECT shippingid, vendorid, pay, plan, k, pr, arg_max(status, (moved, state, status)) AS status,
         min(moved) FILTER (state = 'booked') AS b, max(moved) FILTER (state = 'recieved') AS e
  FROM l GROUP BY ALL)
SELECT shippingid, vendorid, substr(pr, 1, 1) AS transfer_type,
       date_diff('day', b, e) AS full_day_at_shipping,
       CASE WHEN e > plan THEN 1 ELSE 0 END AS is_delay,
       CASE WHEN status = 'finished' THEN 1 ELSE 0 END AS is_shipping_finish,
       CASE WHEN e > plan THEN date_diff('day', plan, e) ELSE 0 END AS delay_day_at_shipping,
       CAST(pay AS DOUBLE) AS payment_amount,
       CAST(pay * (CAST(k / 1000.0 AS DECIMAL(14,3)) + CAST(k / 1000.0 AS DECIMAL(14,3))
            + CAST(CAST(substr(pr, 1, 1) AS INTEGER) / 100.0 AS DECIMAL(14,3))) AS DOUBLE) AS vat,
       CAST(pay * CAST('0.020' AS DECIMAL(14,3)) AS DOUBLE) AS profit
FROM s"""


# --- load operators -----------------------------------------------------------------------------------

def dim_insert_new(t: Tables):
    """Customers of the whole order log that the dimension (customers ordering before 1996) lacks."""
    log = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.col("c_nationkey").alias("city_id"), "o_orderdate",
    )
    known = log.where(F.col("o_orderdate") < day("1996-01-01"))
    return load.insert_new(known, log, ["customer_id", "customer_name"], {"city_id": F.max("city_id")})


DIM_INSERT_SQL = """
SELECT c_custkey AS customer_id, c_name AS customer_name, max(c_nationkey) AS city_id
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate < DATE '1996-01-01')
GROUP BY ALL"""


def insert_ignore(t: Tables):
    """Pairs of user and property with a type of theirs, once per pair; those of 1 January are loaded already."""
    pair = F.concat_ws("/", F.col("user_id").cast("string"), "props").alias("pair")
    rows = t.events.select(pair, "event_type", "ts")
    known = rows.where(F.col("ts") < day("2024-01-02")).select("pair")
    return load.insert_ignore(known, rows.drop("ts"), "pair")


INSERT_IGNORE_SQL = """
SELECT user_id || '/' || props AS pair, min(event_type) AS event_type FROM events
GROUP BY 1 HAVING min(ts) >= TIMESTAMP '2024-01-02'"""


def _order_state(t: Tables):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", dec("o_totalprice").alias("total"), "o_orderdate")


def _changed(orders):
    """A later delivery of the orders: closed, five percent dearer."""
    return orders.withColumn("o_orderstatus", F.lit("C")).withColumn(
        "total", (F.col("total") * F.lit("1.05").cast("decimal(3,2)")).cast("decimal(16,2)")
    )


def upsert_orders(t: Tables):
    """Target: orders before 1999. Source: orders from 1998 on, changed, each also in its old form."""
    orders = _order_state(t).withColumn("total", F.col("total").cast("decimal(16,2)"))
    target = orders.where(F.col("o_orderdate") < day("1999-01-01")).withColumn("version", F.lit(1))
    later = orders.where(F.col("o_orderdate") >= day("1998-01-01"))
    src = _changed(later).withColumn("version", F.lit(2)).unionByName(later.withColumn("version", F.lit(1)))
    return load.upsert(target, src, ["o_orderkey"], newest=["version"])


UPSERT_SQL = f"""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= DATE '1998-01-01' THEN 'C' ELSE o_orderstatus END
         AS o_orderstatus,
       CAST(CASE WHEN o_orderdate >= DATE '1998-01-01'
            THEN CAST(CAST(o_totalprice AS DECIMAL(14,2)) * CAST('1.05' AS DECIMAL(3,2)) AS DECIMAL(16,2))
            ELSE CAST(o_totalprice AS DECIMAL(16,2)) END AS DOUBLE) AS total,
       {ts_sql('o_orderdate')} AS o_orderdate, CASE WHEN o_orderdate >= DATE '1998-01-01' THEN 2 ELSE 1 END AS version
FROM orders"""


def upsert_columns(t: Tables):
    """Upsert that updates the status only; the total of known orders stays."""
    orders = _order_state(t).withColumn("total", F.col("total").cast("decimal(16,2)"))
    target = orders.where(F.col("o_orderdate") < day("1999-01-01"))
    src = _changed(orders.where(F.col("o_orderdate") >= day("1998-01-01")))
    return load.upsert(target, src, ["o_orderkey"], update_cols=["o_orderstatus"])


UPSERT_COLUMNS_SQL = f"""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= DATE '1998-01-01' THEN 'C' ELSE o_orderstatus END
         AS o_orderstatus,
       CAST(CASE WHEN o_orderdate >= DATE '1999-01-01'
            THEN CAST(CAST(o_totalprice AS DECIMAL(14,2)) * CAST('1.05' AS DECIMAL(3,2)) AS DECIMAL(16,2))
            ELSE CAST(o_totalprice AS DECIMAL(16,2)) END AS DOUBLE) AS total,
       {ts_sql('o_orderdate')} AS o_orderdate
FROM orders"""


def update_matched(t: Tables):
    """Customers' balances set to their order totals, where they have orders."""
    totals = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum(dec("o_totalprice")).alias("balance"))
    customers = t.customer.select("c_custkey", "c_name", dec("c_acctbal", 24, 2).alias("balance"))
    return load.update_matched(customers, totals, ["c_custkey"], ["balance"])


UPDATE_MATCHED_SQL = """
SELECT c_custkey, c_name, CAST(coalesce(s, CAST(c_acctbal AS DECIMAL(24,2))) AS DOUBLE) AS balance
FROM customer LEFT JOIN (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(14,2))) AS s FROM orders GROUP BY 1)
  ON o_custkey = c_custkey"""


def replace_date(t: Tables):
    orders = _order_state(t).withColumn("total", F.col("total").cast("decimal(16,2)"))
    return load.replace_rows(orders, _changed(orders), F.col("o_orderdate") == day("1998-10-03"))


REPLACE_DATE_SQL = f"""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate = DATE '1998-10-03' THEN 'C' ELSE o_orderstatus END
         AS o_orderstatus,
       CAST(CASE WHEN o_orderdate = DATE '1998-10-03'
            THEN CAST(CAST(o_totalprice AS DECIMAL(14,2)) * CAST('1.05' AS DECIMAL(3,2)) AS DECIMAL(16,2))
            ELSE CAST(o_totalprice AS DECIMAL(16,2)) END AS DOUBLE) AS total,
       {ts_sql('o_orderdate')} AS o_orderdate
FROM orders"""


def partition_replace(t: Tables):
    """The same on disk: orders stored by year, the partitions of 1998 and 1999 overwritten, read back."""
    path = scratch(t.spark, "orders_by_year")
    orders = _order_state(t).withColumn("total", F.col("total").cast("decimal(16,2)")).withColumn(
        "year", F.year("o_orderdate"))
    load.replace_partition(orders, path, ["year"])
    load.replace_partition(_changed(orders.where(F.col("year").between(1998, 1999))), path, ["year"])
    return t.spark.read.parquet(path)


PARTITION_REPLACE_SQL = f"""
SELECT o_orderkey, o_custkey, CASE WHEN year(o_orderdate) IN (1998, 1999) THEN 'C' ELSE o_orderstatus END
         AS o_orderstatus,
       CAST(CASE WHEN year(o_orderdate) IN (1998, 1999)
            THEN CAST(CAST(o_totalprice AS DECIMAL(14,2)) * CAST('1.05' AS DECIMAL(3,2)) AS DECIMAL(16,2))
            ELSE CAST(o_totalprice AS DECIMAL(16,2)) END AS DOUBLE) AS total,
       {ts_sql('o_orderdate')} AS o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders"""


def merge_partitions(t: Tables):
    """Upsert into a table on disk: orders before 1999 stored by year, changed orders from 1998 on merged in."""
    path = scratch(t.spark, "orders_merge")
    orders = _order_state(t).withColumn("total", F.col("total").cast("decimal(16,2)")).withColumn(
        "year", F.year("o_orderdate"))
    load.replace_partition(orders.where(F.col("o_orderdate") < day("1999-01-01")), path, ["year"])
    src = _changed(orders.where(F.col("o_orderdate") >= day("1998-01-01")))
    load.merge_partitions(t.spark, path, src, ["o_orderkey"], ["year"])
    return t.spark.read.parquet(path)


MERGE_SQL = f"""
SELECT o_orderkey, o_custkey, CASE WHEN year(o_orderdate) >= 1998 THEN 'C' ELSE o_orderstatus END
         AS o_orderstatus,
       CAST(CASE WHEN year(o_orderdate) >= 1998
            THEN CAST(CAST(o_totalprice AS DECIMAL(14,2)) * CAST('1.05' AS DECIMAL(3,2)) AS DECIMAL(16,2))
            ELSE CAST(o_totalprice AS DECIMAL(16,2)) END AS DOUBLE) AS total,
       {ts_sql('o_orderdate')} AS o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders"""


def _marks(t: Tables):
    loaded = t.orders.where(F.col("o_orderdate") < day("1998-01-01"))
    return loaded.agg(F.max("o_orderdate").alias("m")).select(
        F.lit("orders").alias("workflow_key"), F.col("m").cast("string").alias("workflow_settings"))


def increment_mark(t: Tables):
    """Orders after the stored mark, which is the last day before 1998."""
    fresh, _ = load.load_increment(t.orders, _marks(t), "orders", "o_orderdate")
    return fresh.select("o_orderkey", "o_orderdate")


INCREMENT_SQL = f"""
SELECT o_orderkey, {ts_sql('o_orderdate')} AS o_orderdate FROM orders
WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < DATE '1998-01-01')"""


def increment_next_mark(t: Tables):
    """The marks table after the load: old row and new one."""
    marks = _marks(t)
    _, mark = load.load_increment(t.orders, marks, "orders", "o_orderdate")
    return marks.unionByName(mark)


NEXT_MARK_SQL = f"""
SELECT 'orders' AS workflow_key, {ts_sql('max(o_orderdate)')} AS workflow_settings FROM orders
WHERE o_orderdate < DATE '1998-01-01'
UNION ALL SELECT 'orders', {ts_sql('max(o_orderdate)')} FROM orders"""


def increment_lookback(t: Tables):
    orders = _order_state(t).withColumn("total", F.col("total").cast("decimal(16,2)"))
    target = orders.where(F.col("o_orderdate") < day("1998-01-01"))
    return load.load_lookback(target, _changed(orders), ["o_orderkey"], "o_orderdate", 7)


LOOKBACK_SQL = f"""
WITH m AS (SELECT max(o_orderdate) - INTERVAL 7 DAY AS lo FROM orders WHERE o_orderdate < DATE '1998-01-01')
SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= lo THEN 'C' ELSE o_orderstatus END AS o_orderstatus,
       CAST(CASE WHEN o_orderdate >= lo
            THEN CAST(CAST(o_totalprice AS DECIMAL(14,2)) * CAST('1.05' AS DECIMAL(3,2)) AS DECIMAL(16,2))
            ELSE CAST(o_totalprice AS DECIMAL(16,2)) END AS DOUBLE) AS total,
       {ts_sql('o_orderdate')} AS o_orderdate
FROM orders, m"""


def hash_diff_append(t: Tables):
    """Events delivered twice; those before 15 January are loaded already."""
    loaded = t.events.where(F.col("ts") < day("2024-01-15"))
    return load.hash_diff(loaded, t.events.unionByName(t.events))


HASH_DIFF_SQL = f"""
SELECT event_id, {ts_sql('ts')} AS ts, user_id, event_type, value, props FROM events
WHERE ts >= TIMESTAMP '2024-01-15'"""


def surrogate_keys(t: Tables):
    """Customers in credit are numbered already; the others get the next numbers, in key order."""
    keys = t.customer.select("c_custkey", "c_name", "c_acctbal")
    known = ranked(keys.where("c_acctbal >= 0"), [], ["c_custkey"], "id", unique=True).drop("c_acctbal")
    return known.unionByName(load.number_new(known, keys.drop("c_acctbal"), "c_custkey").select(*known.columns))


SURROGATE_SQL = """
SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_acctbal < 0, c_custkey) AS id FROM customer"""


def valid_now_dim(t: Tables):
    """Each supplier has two versions; lines per supplier and the version valid on the ship date."""
    first = load.versioned(t.supplier.select("s_suppkey", "s_name"), day("1990-01-01"), "1998-01-01")
    second = load.versioned(t.supplier.select("s_suppkey", F.upper("s_name").alias("s_name")), day("1998-01-01"))
    facts = t.lineitem.select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_shipdate").cast("timestamp").alias("ts"))
    met = valid_at(facts, first.unionByName(second), "s_suppkey", "ts")
    lines = met.groupBy("s_suppkey", "s_name").agg(F.count(F.lit(1)).alias("lines"))
    current = valid_now(first.unionByName(second), NOW).select("s_suppkey", F.col("s_name").alias("name_now"))
    return lines.join(current, "s_suppkey")


VALID_NOW_SQL = """
SELECT s_suppkey, CASE WHEN l_shipdate < DATE '1998-01-01' THEN s_name ELSE upper(s_name) END AS s_name,
       count(*) AS lines, upper(s_name) AS name_now
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_suppkey, 2, s_name"""


def mart_view(t: Tables):
    load.publish(_settlement(t), "settlement_view")
    return t.spark.sql(
        "SELECT restaurant_id, CAST(sum(orders_total_sum) AS decimal(26,2)) AS total, count(*) AS days "
        "FROM settlement_view GROUP BY restaurant_id"
    )


MART_VIEW_SQL = """
SELECT o_custkey AS restaurant_id,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_quantity AS DECIMAL(6,0))) AS DOUBLE) AS total,
       count(DISTINCT o_orderdate) AS days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY 1"""


def fx_replace(t: Tables):
    """Rates by day and base out of the events; those of 15 January are replaced."""
    keys = [F.to_date("ts").alias("rate_date"), F.col("event_type").alias("rate_base")]

    def frame(value):
        return t.events.groupBy(*keys).agg(value.alias("value_")).select(
            F.lit("2024-02-01 00:00:00").cast("timestamp").alias("ingest_datetime"), "rate_date", "rate_base",
            F.lit("USD").alias("rate_target"), dec("value_", 14, 4).alias("value_"))

    fresh = frame(F.min("value")).where(F.col("rate_date") == F.lit("2024-01-15").cast("date"))
    return rates.load_rates(frame(F.max("value")), fresh, "2024-01-15", now="2024-02-02 00:00:00")


FX_SQL = f"""
SELECT CASE WHEN date_trunc('day', ts) = DATE '2024-01-15' THEN '2024-02-02 00:00:00' ELSE '2024-02-01 00:00:00' END
         AS ingest_datetime, {day_sql('ts')} AS rate_date, event_type AS rate_base, 'USD' AS rate_target,
       CAST(CAST(CASE WHEN date_trunc('day', ts) = DATE '2024-01-15' THEN min(value) ELSE max(value) END
            AS DECIMAL(14,4)) AS DOUBLE) AS value_
FROM events GROUP BY date_trunc('day', ts), 1, 2, 3"""


# --- snowflake load -----------------------------------------------------------------------------------

def _envelope(df, id_col, ts, *body):
    return df.select(F.col(id_col).cast("string").alias("object_id"), nested.to_message(*body).alias("object_value"),
                     ts.cast("timestamp").alias("update_ts"))


def _owners(t: Tables):
    """Restaurant of an order, and of a part: its supplier with the smallest key."""
    by_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_suppkey").alias("rest"))
    by_part = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min("l_suppkey").alias("rest"))
    return by_order, by_part


def snowflake_fact(t: Tables):
    """Dimensions and fact loaded from JSON documents into empty tables."""
    spark, stamp = t.spark, F.lit("2022-01-01 00:00:00")
    by_order, by_part = _owners(t)
    users_doc = _envelope(t.customer.withColumns({"name": F.col("c_name"), "login": F.lower("c_mktsegment")}),
                          "c_custkey", stamp, "name", "login")
    menu_item = F.struct(F.col("p_partkey").cast("string").alias("_id"), F.col("p_name").alias("name"),
                         dec("p_retailprice").alias("price"))
    owned = stored(t.part.join(by_part, "p_partkey").select("rest", "p_partkey", "p_name", "p_retailprice"), "owned_parts")
    menus = collect_parts(owned, ["rest"], menu_item, "menu", "p_partkey")
    rest_doc = _envelope(
        menus.join(t.supplier, F.col("rest") == F.col("s_suppkey")).withColumn("name", F.col("s_name")),
        "s_suppkey", stamp, "name", "menu")
    order_doc = _envelope(
        t.orders.join(by_order, "o_orderkey").select(
            "o_orderkey", F.struct(F.col("o_custkey").cast("string").alias("id")).alias("user"),
            F.struct(F.col("rest").cast("string").alias("id")).alias("restaurant"),
            F.col("o_orderdate").alias("date"), F.col("o_orderstatus").alias("final_status")),
        "o_orderkey", stamp, "user", "restaurant", "date", "final_status")
    price = dec("l_extendedprice")
    payment = F.struct(
        F.col("l_partkey").cast("string").alias("product_id"), price.alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"), (price * F.col("l_quantity").cast("int")).alias("product_cost"),
        (price * dec("l_discount", 4, 2)).cast("decimal(14,2)").alias("bonus_payment"),
        (price * dec("l_tax", 4, 2)).cast("decimal(14,2)").alias("bonus_grant"))
    events = per_order(t.lineitem, payment, "product_payments").select(
        F.lit("bonus_transaction").alias("event_type"),
        nested.to_message(F.col("l_orderkey").cast("string").alias("order_id"), "product_payments").alias("event_value"))

    empty = {name: spark.createDataFrame([], ddl) for name, ddl in {
        "users": "id bigint, user_id string", "restaurants": "id bigint, restaurant_id string",
        "products": "id bigint, product_id string", "stamps": "id bigint, ts timestamp",
        "orders": "id bigint, order_key string"}.items()}
    # What several tables need is written and read back, as the load does; numbering has written the others already.
    rest_doc = stored(rest_doc, "stg_restaurants")
    users = snowflake.users(empty["users"], users_doc)
    restaurants = stored(snowflake.restaurants(empty["restaurants"], rest_doc), "dm_restaurants")
    products = snowflake.products(empty["products"], rest_doc, restaurants)
    documents = stored(snowflake.order_documents(order_doc), "stg_orders")
    stamps = snowflake.timestamps(empty["stamps"], documents)
    orders = stored(snowflake.orders(empty["orders"], documents, users, restaurants, stamps), "dm_orders")
    fact = snowflake.product_sales(events, orders, products)
    return fact.join(orders.withColumnRenamed("id", "order_id"), "order_id").select(
        "order_id", "order_key", "user_id", "restaurant_id", "timestamp_id", "order_status", "product_id",
        "count", "price", "total_sum", "bonus_payment", "bonus_grant")


SNOWFLAKE_SQL = """
WITH u AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS user_id FROM customer),
bo AS (SELECT l_orderkey, min(l_suppkey) AS rest FROM lineitem GROUP BY 1),
bp AS (SELECT l_partkey, min(l_suppkey) AS rest FROM lineitem GROUP BY 1),
r AS (SELECT rest, row_number() OVER (ORDER BY rest) AS restaurant_id FROM (SELECT DISTINCT rest FROM bp)),
p AS (SELECT l_partkey, row_number() OVER (ORDER BY l_partkey) AS product_id FROM bp),
o AS (SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus, rest FROM orders JOIN bo ON o_orderkey = l_orderkey),
s AS (SELECT o_orderdate, row_number() OVER (ORDER BY o_orderdate) AS timestamp_id
      FROM (SELECT DISTINCT o_orderdate FROM o)),
n AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS order_id FROM o)
SELECT order_id, CAST(o_orderkey AS VARCHAR) AS order_key, user_id, restaurant_id, timestamp_id,
       o_orderstatus AS order_status, product_id, CAST(l_quantity AS INTEGER) AS count,
       CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS DOUBLE) AS price,
       CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_quantity AS INTEGER) AS DOUBLE) AS total_sum,
       CAST(CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(14,2)) AS DOUBLE)
         AS bonus_payment,
       CAST(CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(14,2)) AS DOUBLE)
         AS bonus_grant
FROM lineitem l JOIN n ON n.o_orderkey = l.l_orderkey JOIN u ON u.c_custkey = n.o_custkey
LEFT JOIN r ON r.rest = n.rest JOIN s ON s.o_orderdate = n.o_orderdate JOIN p ON p.l_partkey = l.l_partkey"""


# --- delivery load ------------------------------------------------------------------------------------

def _delivery_envelope(t: Tables):
    price = dec("l_extendedprice")
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").cast("string").alias("order_id"), F.col("o_orderdate").alias("order_ts"),
        F.concat(F.lit("d"), F.col("l_partkey")).alias("delivery_id"),
        F.col("l_suppkey").cast("string").alias("courier_id"),
        F.concat(F.lit("street "), F.col("l_partkey")).alias("address"), F.col("l_shipdate").alias("delivery_ts"),
        (1 + F.col("l_linenumber") % 6).alias("rate"), price.alias("sum"),
        (price * dec("l_discount", 4, 2)).cast("decimal(14,2)").alias("tip_sum"))
    return to_envelope(rows, "order_id", "2022-01-01 00:00:00")


def delivery_load(t: Tables):
    """Rows breaking a rule (rating 6, delivered before ordered) are kept out; older orders are loaded already."""
    rows = stored(deliveries.typed(_delivery_envelope(t)), "stg_deliveries")
    checks = deliveries.rules("1995-01-01", "2001-12-31")
    before = rows.where(F.col("order_ts") < F.lit("1998-01-01").cast("timestamp"))
    valid, _ = split_valid(before, checks)
    others = [c for c in before.columns if c not in ("order_id", "update_ts")]
    target = stored(top1(valid, ["order_id"], ["update_ts", *others]), "dds_deliveries")
    return deliveries.load_typed(target, rows, checks, stop_on_error=False).drop("update_ts")


DELIVERY_SQL = f"""
WITH d AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, o_orderdate AS order_ts, 'd' || l_partkey AS delivery_id,
         CAST(l_suppkey AS VARCHAR) AS courier_id, 'street ' || l_partkey AS address, l_shipdate AS delivery_ts,
         1 + l_linenumber % 6 AS rate, CAST(l_extendedprice AS DECIMAL(14,2)) AS order_sum,
         CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(14,2)) AS tip_sum
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
v AS (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_ts DESC, delivery_id DESC, courier_id DESC,
           address DESC, delivery_ts DESC, rate DESC, order_sum DESC, tip_sum DESC) AS rn
  FROM d WHERE delivery_ts > order_ts AND order_sum >= 0 AND tip_sum >= 0 AND rate BETWEEN 1 AND 5
    AND order_ts BETWEEN DATE '1995-01-01' AND DATE '2001-12-31')
SELECT order_id, {ts_sql('order_ts')} AS order_ts, delivery_id, courier_id, address,
       {ts_sql('delivery_ts')} AS delivery_ts, CAST(rate AS INTEGER) AS rate, CAST(order_sum AS DOUBLE) AS order_sum,
       CAST(tip_sum AS DOUBLE) AS tip_sum
FROM v WHERE rn = 1"""


# --- group vault --------------------------------------------------------------------------------------

def _group_log(t: Tables):
    kind = F.col("event_type")
    return t.events.select(
        F.get_json_object("props", "$.k").cast("int").alias("group_id"), "user_id",
        F.lit(None).cast("bigint").alias("user_id_from"),
        F.when(kind == "signup", "add").when(kind == "purchase", "leave").when(kind == "view", "create")
        .otherwise(kind).alias("event"),
        F.col("ts").alias("dt"), "event_id",
    )


def _hubs(log):
    h_users = group_vault.hub(log, "user_id", "hk_user_id", lambda c: text_key(F.lit("u"), c))
    h_groups = group_vault.hub(log, "group_id", "hk_group_id", lambda c: text_key(F.lit("g"), c),
                               registration_dt=F.min("dt"))
    return h_users, h_groups


def group_links(t: Tables):
    """Links not loaded before 8 January."""
    log = _group_log(t)
    h_users, h_groups = _hubs(log)
    before = group_vault.link_rows(log.where(F.col("dt") < day("2024-01-08")), h_users, h_groups, None, text_key, NOW)
    return group_vault.link_rows(log, h_users, h_groups, before, text_key, NOW)


GROUP_CTE = """
WITH g AS (
  SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS group_id, user_id, ts, event_id, event_type,
         sha1('u|' || user_id) AS hu, sha1('g|' || CAST(json_extract_string(props, '$.k') AS INTEGER)) AS hg
  FROM events)"""

GROUP_LINKS_SQL = GROUP_CTE + """
SELECT sha1(hu || '|' || hg) AS hk_l_user_group_activity, hu AS hk_user_id, hg AS hk_group_id,
       '2024-01-01 00:00:00' AS load_dt, 's3' AS load_src
FROM g GROUP BY hu, hg HAVING min(ts) >= TIMESTAMP '2024-01-08'"""


def group_link_sat(t: Tables):
    """History rows not loaded before 8 January, of all links."""
    log = _group_log(t)
    h_users, h_groups = _hubs(log)
    link = group_vault.link_rows(log, h_users, h_groups, None, text_key, NOW)
    old = group_vault.satellite_rows(log.where(F.col("dt") < day("2024-01-08")), h_users, h_groups, link, None, NOW)
    return group_vault.satellite_rows(log, h_users, h_groups, link, old, NOW)


GROUP_SAT_SQL = GROUP_CTE + f"""
SELECT sha1(hu || '|' || hg) AS hk_l_user_group_activity, CAST(NULL AS BIGINT) AS user_id_from,
       CASE event_type WHEN 'signup' THEN 'add' WHEN 'purchase' THEN 'leave' WHEN 'view' THEN 'create'
            ELSE event_type END AS event,
       {ts_sql('ts')} AS event_dt, '2024-01-01 00:00:00' AS load_dt, 's3' AS load_src
FROM g WHERE ts >= TIMESTAMP '2024-01-08'"""


def group_conversion(t: Tables):
    log = _group_log(t)
    h_users, h_groups = _hubs(log)
    link = group_vault.link_rows(log, h_users, h_groups, None, text_key, NOW)
    satellite = group_vault.satellite_rows(log, h_users, h_groups, link, None, NOW)
    wrote = log.where(F.col("event") == "click")
    dialogs = wrote.join(h_groups, "group_id").select("hk_group_id", F.col("event_id").alias("hk_message_id"))
    authors = wrote.join(h_users, "user_id").select(F.col("event_id").alias("hk_message_id"), "hk_user_id")
    return group_vault.conversion(h_groups, link, satellite, dialogs, authors)


GROUP_CONVERSION_SQL = GROUP_CTE + """,
o AS (SELECT hg FROM g GROUP BY hg ORDER BY min(ts), hg LIMIT 10),
a AS (SELECT hg, count(DISTINCT hu) AS n FROM g WHERE event_type = 'signup' AND hg IN (FROM o) GROUP BY 1),
w AS (SELECT hg, count(DISTINCT hu) AS n FROM g WHERE event_type = 'click' AND hg IN (FROM o) GROUP BY 1)
SELECT a.hg AS hk_group_id, a.n AS cnt_added_users, w.n AS cnt_users_in_group_with_messages,
       round(w.n / a.n, 2) AS group_conversion
FROM a LEFT JOIN w ON a.hg = w.hg"""


# --- global metrics -----------------------------------------------------------------------------------

def _currency(col):
    return F.lit(420) + F.lit(10) * (F.get_json_object(col, "$.k").cast("int") % 7)


def global_metrics(t: Tables):
    kind = F.col("event_type")
    transactions = t.events.select(
        F.col("event_id").alias("operation_id"), F.col("user_id").alias("account_number_from"),
        _currency("props").alias("currency_code"), F.when(kind == "error", "queued").otherwise("done").alias("status"),
        F.when(kind == "purchase", "sbp_incoming").when(kind == "click", "c2b_partner_incoming")
        .when(kind == "view", "authorization").otherwise("store_incoming").alias("transaction_type"),
        (dec("value", 14, 2) * 100).cast("bigint").alias("amount"), F.col("ts").alias("sent_dttm"))
    currencies = t.events.groupBy(F.to_date("ts").alias("sent_dttm"), _currency("props").alias("currency_code")).agg(
        (F.lit(1) + F.count(F.lit(1)) / 1000).cast("decimal(10,3)").alias("currency_with_div")
    ).withColumn("currency_code_with", F.lit(430))
    return metrics.global_metrics(transactions, currencies, currency_with=430)


METRICS_SQL = f"""
WITH e AS (
  SELECT *, date_trunc('day', ts) AS d, 420 + 10 * (CAST(json_extract_string(props, '$.k') AS INTEGER) % 7) AS cur
  FROM events),
r AS (SELECT d, cur, CAST(1 + count(*) / 1000 AS DECIMAL(10,3)) AS div FROM e GROUP BY ALL),
x AS (
  SELECT e.d, e.cur, event_id, user_id, CAST(CAST(value AS DECIMAL(14,2)) * 100 AS BIGINT) AS amount, div
  FROM e LEFT JOIN r ON r.d = e.d AND r.cur = e.cur
  WHERE user_id > 0 AND event_type IN ('purchase', 'click', 'signup'))
SELECT {day_sql('d')} AS date_update, cur AS currency_from, CAST(CAST(sum(amount * div) AS DECIMAL(20,2)) AS DOUBLE) AS amount_total,
       CAST(sum(amount) AS BIGINT) AS cnt_transactions,
       CAST(round(CAST(sum(amount * div) AS DOUBLE) / count(DISTINCT event_id)) AS BIGINT)
         AS avg_transactions_per_account,
       count(DISTINCT CASE WHEN cur = 420 THEN user_id END) AS cnt_accounts_make_transactions,
       count(DISTINCT event_id) AS transactions_count
FROM x GROUP BY d, cur"""


QUERIES = {
    "courier_ledger": (courier_ledger, LEDGER_SQL),
    "courier_ledger_order_floor": (courier_ledger_order_floor, LEDGER_ORDER_SQL),
    "settlement_daily": (settlement_daily, SETTLEMENT_SQL),
    "settlement_update": (settlement_update, SETTLEMENT_SQL),
    "sales_signed": (sales_signed, SALES_SQL),
    "retention_weekly": (retention_weekly, RETENTION_SQL),
    "shipping_split": (shipping_split, SHIPPING_SPLIT_SQL),
    "shipping_mart": (shipping_mart, SHIPPING_MART_SQL),
    "dim_insert_new": (dim_insert_new, DIM_INSERT_SQL),
    "insert_ignore": (insert_ignore, INSERT_IGNORE_SQL),
    "upsert_orders": (upsert_orders, UPSERT_SQL),
    "upsert_columns": (upsert_columns, UPSERT_COLUMNS_SQL),
    "update_matched": (update_matched, UPDATE_MATCHED_SQL),
    "replace_date": (replace_date, REPLACE_DATE_SQL),
    "partition_replace": (partition_replace, PARTITION_REPLACE_SQL),
    "merge_partitions": (merge_partitions, MERGE_SQL),
    "increment_mark": (increment_mark, INCREMENT_SQL),
    "increment_next_mark": (increment_next_mark, NEXT_MARK_SQL),
    "increment_lookback": (increment_lookback, LOOKBACK_SQL),
    "hash_diff_append": (hash_diff_append, HASH_DIFF_SQL),
    "surrogate_keys": (surrogate_keys, SURROGATE_SQL),
    "valid_now_dim": (valid_now_dim, VALID_NOW_SQL),
    "mart_view": (mart_view, MART_VIEW_SQL),
    "fx_replace": (fx_replace, FX_SQL),
    "snowflake_fact": (snowflake_fact, SNOWFLAKE_SQL),
    "delivery_load": (delivery_load, DELIVERY_SQL),
    "group_links": (group_links, GROUP_LINKS_SQL),
    "group_link_sat": (group_link_sat, GROUP_SAT_SQL),
    "group_conversion": (group_conversion, GROUP_CONVERSION_SQL),
    "global_metrics": (global_metrics, METRICS_SQL),
}
QUERIES = {name: (query(fn), sql) for name, (fn, sql) in QUERIES.items()}
