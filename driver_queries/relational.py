"""Relational, window and scalar operators on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.common import Tables, day, day_sql, dec, query, stored, ts_sql
from martworks.functions import nested, text, times
from martworks.functions.keys import text_key, uuid5
from martworks.operators import joins
from martworks.operators.dedup import null_audit as audit
from martworks.operators.dedup import keep_latest, unique_pairs
from martworks.operators.groups import collect_parts, most_frequent
from martworks.operators.windows import carry_forward, first_flag, ranked, running_sum, shifted, top_n, with_stats
from martworks.session import cut_lineage


def nations_of(df, col):
    return df.select(F.col(col).alias("key"))


# --- windows ------------------------------------------------------------------------------------------

def rank_in_day(t: Tables):
    """Rank of each order in its day by total price, dearest first."""
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    return ranked(rows, ["o_orderdate"], ["o_totalprice"], "rnk", descending=True)


RANK_SQL = f"""
SELECT o_orderkey, {ts_sql('o_orderdate')} AS o_orderdate, o_totalprice,
       rank() OVER (PARTITION BY o_orderdate ORDER BY o_totalprice DESC) AS rnk FROM orders"""


def lag_spend(t: Tables):
    """Each event's value next to the user's previous and following ones."""
    rows = t.events.select("event_id", "user_id", "ts", "value")
    return shifted(rows, ["user_id"], ["ts", "event_id"],
                   {"prev": ("value", -1), "prev2": ("value", -2), "next": ("value", 1)})


LAG_SQL = f"""
SELECT event_id, user_id, {ts_sql('ts')} AS ts, value, lag(value) OVER w AS prev, lag(value, 2) OVER w AS prev2,
       lead(value) OVER w AS next
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""


def running_total(t: Tables):
    """Customer's order total so far; orders of one day count together."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", dec("o_totalprice").alias("price"))
    return running_sum(rows, ["o_custkey"], ["o_orderdate"], "price", "total_so_far")


RUNNING_SQL = f"""
SELECT o_orderkey, o_custkey, {ts_sql('o_orderdate')} AS o_orderdate, o_totalprice AS price,
       CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS DOUBLE)
         AS total_so_far
FROM orders"""


def last_known(t: Tables):
    """Each event with the value of the user's latest click so far, itself included."""
    rows = t.events.select("event_id", "user_id", "ts", F.when(F.col("event_type") == "click", F.col("value"))
                           .alias("click_value"))
    return carry_forward(rows, ["user_id"], ["ts", "event_id"], {"last_click": "click_value"})


LAST_SQL = f"""
SELECT event_id, user_id, {ts_sql('ts')} AS ts, CASE WHEN event_type = 'click' THEN value END AS click_value,
       last_value(CASE WHEN event_type = 'click' THEN value END IGNORE NULLS)
         OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_click
FROM events"""


def partition_stats(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", dec("o_totalprice").alias("price"))
    stats = with_stats(rows, ["o_custkey"], total=F.sum("price"), orders=F.count(F.lit(1)), lowest=F.min("price"),
                       highest=F.max("price"))
    return stats.withColumn("average", F.col("total").cast("double") / F.col("orders"))


STATS_SQL = """
SELECT o_orderkey, o_custkey, o_totalprice AS price,
       CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) OVER w AS DOUBLE) AS total, count(*) OVER w AS orders,
       min(o_totalprice) OVER w AS lowest, max(o_totalprice) OVER w AS highest,
       CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) OVER w AS DOUBLE) / count(*) OVER w AS average
FROM orders WINDOW w AS (PARTITION BY o_custkey)"""


def last_five(t: Tables):
    rows = t.events.select("event_id", "user_id", "ts")
    return top_n(rows, ["user_id"], [F.desc("ts"), F.desc("event_id")], 5, "rn")


LAST_FIVE_SQL = f"""
SELECT event_id, user_id, {ts_sql('ts')} AS ts, rn FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS INTEGER) AS rn FROM events)
WHERE rn <= 5"""


def new_user_flag(t: Tables):
    return first_flag(t.events.select("event_id", "user_id", "ts"), ["user_id"], "ts", "new_user")


NEW_USER_SQL = f"""
SELECT event_id, user_id, {ts_sql('ts')} AS ts,
       CASE WHEN ts = min(ts) OVER (PARTITION BY user_id) THEN 1 ELSE 0 END AS new_user FROM events"""


# --- aggregates ---------------------------------------------------------------------------------------

def max_of_counts(t: Tables):
    """Events of a type on its busiest day."""
    daily = t.events.groupBy("event_type", F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return daily.groupBy("event_type").agg(F.max("n").alias("busiest"), F.sum("n").cast("bigint").alias("total"))


MAX_COUNTS_SQL = """
SELECT event_type, max(n) AS busiest, CAST(sum(n) AS BIGINT) AS total FROM (
  SELECT event_type, date_trunc('day', ts) AS d, count(*) AS n FROM events GROUP BY ALL) GROUP BY 1"""


def top_days(t: Tables):
    """The ten days with most events."""
    return most_frequent(t.events.select(F.to_date("ts").alias("d")), ["d"], 10, "n")


TOP_DAYS_SQL = f"SELECT {day_sql('ts')} AS d, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, d LIMIT 10"


def having_busy(t: Tables):
    """Conditional counts and sums per customer with more than ten orders."""
    status = F.col("o_orderstatus")
    return t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(status == "F").alias("finished"),
        F.sum(F.when(status == "O", dec("o_totalprice"))).alias("open_sum"),
        F.countDistinct(F.when(status == "P", F.col("o_orderpriority"))).alias("pending_priorities"),
        F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("last_order"),
    ).where("orders > 10")


HAVING_SQL = """
SELECT o_custkey, count(*) AS orders, count(*) FILTER (o_orderstatus = 'F') AS finished,
       CAST(sum(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(14,2)) END) AS DOUBLE) AS open_sum,
       count(DISTINCT CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END) AS pending_priorities,
       arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order
FROM orders GROUP BY 1 HAVING count(*) > 10"""


def collected(t: Tables):
    """Distinct, then collected: the order priorities of each customer, sorted."""
    return t.orders.select("o_custkey", "o_orderpriority").distinct().groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("o_orderpriority")).alias("priorities"))


COLLECTED_SQL = """
SELECT o_custkey, count(*) AS n, string_agg(o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities
FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders) GROUP BY 1"""


# --- set operations -----------------------------------------------------------------------------------

def set_union(t: Tables):
    return nations_of(t.customer, "c_nationkey").union(nations_of(t.supplier, "s_nationkey"))


def set_union_by_name(t: Tables):
    left = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    right = t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"), F.lit("s").alias("kind"))
    return left.unionByName(right, allowMissingColumns=True)


def set_union_distinct(t: Tables):
    return set_union(t).distinct()


def set_except(t: Tables):
    """Days with orders on which nothing was shipped."""
    return t.orders.select(F.col("o_orderdate").alias("d")).subtract(t.lineitem.select(F.col("l_shipdate").alias("d")))


# --- duplicates and nulls -----------------------------------------------------------------------------

def null_audit(t: Tables):
    rows = t.events.select(F.when(F.col("event_type") != "error", F.col("value")).alias("value"), "user_id")
    return audit(rows)


NULL_AUDIT_SQL = """
SELECT count(*) AS row_cnt, count(*) FILTER (event_type <> 'error') AS complete_cnt,
       count(*) FILTER (event_type = 'error') AS null_cnt FROM events"""


def dedup_rows(t: Tables):
    return t.events.union(t.events).dropDuplicates().select("event_id", "user_id", "event_type", "value")


def dedup_keys(t: Tables):
    """The latest event per user and type."""
    return keep_latest(t.events.union(t.events), ["user_id", "event_type"], ["ts", "event_id"]).select(
        "user_id", "event_type", "event_id", "ts")


DEDUP_KEYS_SQL = f"""
SELECT user_id, event_type, event_id, {ts_sql('ts')} AS ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""


def array_pairs(t: Tables):
    """Unordered pairs of a customer's and a supplier's nation that meet in an order line."""
    met = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
           .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
           .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")))
    return unique_pairs(met.select(F.col("c_nationkey").alias("a"), F.col("s_nationkey").alias("b")), "a", "b")


ARRAY_PAIRS_SQL = """
SELECT DISTINCT least(c_nationkey, s_nationkey) AS a, greatest(c_nationkey, s_nationkey) AS b
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey"""


# --- joins --------------------------------------------------------------------------------------------

def semi_in(t: Tables):
    finished = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.present(t.customer, finished, ["c_custkey"]).select("c_custkey", "c_name")


def anti_not_in(t: Tables):
    """Customers whose key no pending order names (NOT IN, without nulls on the right)."""
    pending = t.orders.where("o_orderstatus = 'P'")
    return joins.not_in(t.customer, "c_custkey", pending, "o_custkey").select("c_custkey", "c_name")


def anti_not_in_null(t: Tables):
    """The same with a null among the keys: nothing qualifies, so the count is 0."""
    keys = t.orders.select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"))
    return joins.not_in(t.customer, "c_custkey", keys, "k").agg(F.count(F.lit(1)).alias("n"))


def anti_not_exists(t: Tables):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.absent(t.customer, urgent, ["c_custkey"]).select("c_custkey", "c_name")


def anti_composite(t: Tables):
    """Events whose (user, props) did not occur before 15 January."""
    before = t.events.where(F.col("ts") < day("2024-01-15")).select("user_id", "props")
    return joins.absent(t.events, before, ["user_id", "props"]).select("event_id", "user_id", "props")


ANTI_COMPOSITE_SQL = """
SELECT event_id, user_id, props FROM events e WHERE NOT EXISTS (
  SELECT 1 FROM events b WHERE b.user_id = e.user_id AND b.props = e.props AND b.ts < TIMESTAMP '2024-01-15')"""


def anti_keys(t: Tables):
    """Parts never ordered in a line with a discount above 9 percent."""
    cut = t.lineitem.where("l_discount > 0.09").select(F.col("l_partkey").alias("p_partkey"))
    return joins.absent(t.part, cut, ["p_partkey"]).select("p_partkey", "p_name")


def cross_ref(t: Tables):
    """Every customer with the region its nation belongs to."""
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("r_regionkey"))
    found = joins.lookup(t.customer, nations, ["c_nationkey"], "inner")
    return joins.lookup(found, t.region, ["r_regionkey"], "inner").select("c_custkey", "r_regionkey", "r_name")


def right_keep(t: Tables):
    """Orders per customer; customers without orders stay."""
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders"))
    return counts.join(t.customer.select("c_custkey", "c_name"), "c_custkey", "right_outer")


def left_composite(t: Tables):
    """Left join on two keys: daily click counts beside daily purchase counts of the user."""
    daily = t.events.groupBy("user_id", F.to_date("ts").alias("d"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    clicks = daily.where("event_type = 'click'").select("user_id", "d", F.col("n").alias("clicks"))
    bought = daily.where("event_type = 'purchase'").select("user_id", "d", F.col("n").alias("purchases"))
    return clicks.join(bought, ["user_id", "d"], "left")


LEFT_COMPOSITE_SQL = f"""
SELECT user_id, {day_sql('ts')} AS d, count(*) FILTER (event_type = 'click') AS clicks,
       CASE WHEN count(*) FILTER (event_type = 'purchase') > 0 THEN count(*) FILTER (event_type = 'purchase') END
         AS purchases
FROM events GROUP BY 1, 2 HAVING clicks > 0"""


def spine_join(t: Tables):
    """Nations of customers and suppliers as the spine, with both counts."""
    keys = nations_of(t.customer, "c_nationkey").union(nations_of(t.supplier, "s_nationkey"))
    customers = t.customer.groupBy(F.col("c_nationkey").alias("key")).agg(F.count(F.lit(1)).alias("customers"))
    rich = t.supplier.where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("key")).agg(
        F.count(F.lit(1)).alias("rich_suppliers"))
    return joins.spine(keys, ["key"], customers, rich)


SPINE_SQL = """
SELECT key, customers, rich_suppliers
FROM (SELECT c_nationkey AS key FROM customer UNION SELECT s_nationkey FROM supplier)
LEFT JOIN (SELECT c_nationkey AS key, count(*) AS customers FROM customer GROUP BY 1) USING (key)
LEFT JOIN (SELECT s_nationkey AS key, count(*) AS rich_suppliers FROM supplier WHERE s_acctbal > 5000 GROUP BY 1)
  USING (key)"""


def time_part_join(t: Tables):
    """Events matched to the timestamp dimension by their second."""
    dim = t.events.select(times.second("ts").alias("sec")).distinct().select(
        "sec", *[c.alias(n) for n, c in times.date_parts("sec").items()])
    return t.events.withColumn("sec", times.second("ts")).join(dim, "sec").select(
        "event_id", "year", "month", "day", "hour", "minute", "second")


TIME_PART_SQL = """
SELECT event_id, year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, day(ts)::INTEGER AS day,
       hour(ts)::INTEGER AS hour, minute(ts)::INTEGER AS minute, second(ts)::INTEGER AS second FROM events"""


def hint_broadcast(t: Tables):
    facts = t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return joins.lookup(facts, t.nation, ["n_nationkey"], "inner").select("c_custkey", "n_name")


CUSTOMER_NATION_SQL = "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey"


def cached_reuse(t: Tables):
    """One persisted frame used by two aggregates, and released when the result is written."""
    kept = t.events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n")).persist()
    try:
        users = kept.groupBy("user_id").agg(F.sum("n").alias("total"))
        return stored(kept.join(users, "user_id").select("user_id", "event_type", "n", "total"), "cached_reuse")
    finally:
        kept.unpersist()


CACHED_SQL = """
SELECT user_id, event_type, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY user_id) AS BIGINT) AS total
FROM events GROUP BY 1, 2"""


def lineage_cut(t: Tables):
    return cut_lineage(hint_broadcast(t)).groupBy("n_name").agg(F.count(F.lit(1)).alias("customers"))


LINEAGE_SQL = "SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"


# --- scalars ------------------------------------------------------------------------------------------

def json_roundtrip(t: Tables):
    """Events to JSON messages and back."""
    packed = t.events.select(nested.to_message("event_id", "event_type", F.struct("value", "props").alias("body"))
                             .alias("m"))
    schema = "event_id bigint, event_type string, body struct<value: double, props: string>"
    opened = nested.open_json(packed, "m", schema).select("event_id", "event_type", "body.*")
    return opened.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


JSON_SQL = """
SELECT event_id, event_type, value, props, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"""


def date_parts(t: Tables):
    d = F.col("o_orderdate")
    parts = times.date_parts("o_orderdate")
    return t.orders.select(
        "o_orderkey", parts["year"].alias("y"), parts["month"].alias("m"), parts["day"].alias("d"),
        parts["week"].alias("w"), times.week_start(d).alias("week_start"), times.month_start(d).alias("month_start"),
        F.datediff(F.lit("2002-01-01").cast("date"), F.to_date(d)).alias("age"),
        F.date_sub(F.to_date(d), 7).alias("week_ago"), times.time_of_day(d).alias("tod"))


DATE_PARTS_SQL = f"""
SELECT o_orderkey, year(o_orderdate)::INTEGER AS y, month(o_orderdate)::INTEGER AS m, day(o_orderdate)::INTEGER AS d,
       week(o_orderdate)::INTEGER AS w, {day_sql("date_trunc('week', o_orderdate)")} AS week_start,
       {day_sql("date_trunc('month', o_orderdate)")} AS month_start,
       CAST(date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') AS INTEGER) AS age,
       {day_sql("o_orderdate - INTERVAL 7 DAY")} AS week_ago, strftime(o_orderdate, '%H:%M:%S') AS tod FROM orders"""


def epoch_time(t: Tables):
    seconds = times.to_epoch("ts")
    return t.events.select("event_id", seconds.alias("seconds"), times.from_epoch(seconds).alias("back"),
                           times.parse_ts(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("x")).alias("parsed"),
                           times.parse_ts(F.col("event_type")).isNull().cast("int").alias("dirty"))


EPOCH_SQL = f"""
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, {ts_sql("date_trunc('second', ts)")} AS back,
       {ts_sql("date_trunc('second', ts)")} AS parsed, 1 AS dirty FROM events"""


def active_filter(t: Tables):
    """Orders 'active' at a moment: placed before it, and less than 90 days old; with typed literals."""
    start = F.col("o_orderdate")
    moment = day("1998-06-01")
    running = t.orders.where((start <= moment) & (start + F.expr("INTERVAL 90 DAYS") > moment))
    return running.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.col("o_totalprice").between(1e4, 3e5)
                         & ~F.col("o_orderpriority").like("%LOW%")).select(
        "o_orderkey", F.lit(None).cast("string").alias("feedback"),
        F.coalesce(F.when(F.col("o_orderstatus") == "F", "closed"), F.lit("running")).alias("state"))


ACTIVE_SQL = """
SELECT o_orderkey, CAST(NULL AS VARCHAR) AS feedback,
       CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'running' END AS state
FROM orders WHERE o_orderdate <= DATE '1998-06-01' AND o_orderdate + INTERVAL 90 DAY > DATE '1998-06-01'
  AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice BETWEEN 1e4 AND 3e5"""


def nested_select(t: Tables):
    """Struct fields projected and expanded, with a cast in an SQL expression."""
    packed = t.events.select(F.struct("event_id", "user_id", F.struct("value", "event_type").alias("inner")).alias("event"))
    return packed.selectExpr("event.event_id", "cast(event.user_id as string) user_id", "event.inner.*")


NESTED_SQL = "SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, value, event_type FROM events"


def text_clean(t: Tables):
    described = F.concat_ws(":", F.col("p_partkey").cast("string"), "p_brand", F.col("p_size").cast("string"), F.lit("x"))
    return t.part.select(
        "p_partkey", *text.split_fields(described, {"id": "long", "brand": "string", "size": "int", "bad": "int"}),
        F.regexp_replace("p_name", " ", "_").alias("slug"), F.substring("p_brand", 1, 5).alias("head"),
        F.element_at(F.split("p_name", " "), 1).alias("first_word"),
        text.decimal_comma(F.regexp_replace(F.col("p_retailprice").cast("string"), "\\.", ",")).alias("price"))


TEXT_SQL = """
SELECT p_partkey, p_partkey AS id, p_brand AS brand, p_size AS size, CAST(NULL AS INTEGER) AS bad,
       replace(p_name, ' ', '_') AS slug, substr(p_brand, 1, 5) AS head, split_part(p_name, ' ', 1) AS first_word,
       p_retailprice AS price FROM part"""


def binary_cast(t: Tables):
    return t.part.select("p_partkey", text.as_text(text.as_binary("p_name")).alias("name"),
                         F.length(text.as_binary("p_name")).alias("bytes"))


BINARY_SQL = "SELECT p_partkey, p_name AS name, strlen(p_name)::INTEGER AS bytes FROM part"


def key_functions(t: Tables):
    return t.customer.select("c_custkey", uuid5("c_name").alias("uid"), text_key("c_custkey", "c_name").alias("sha"))


def key_sql() -> str:
    from driver_queries.common import uuid5_sql
    return f"SELECT c_custkey, {uuid5_sql('c_name')} AS uid, sha1(c_custkey || '|' || c_name) AS sha FROM customer"


def array_lookup(t: Tables):
    """Order lines as arrays, completed from the menus of shops with fifty parts each."""
    shop = F.floor(F.col("p_partkey") / 50).cast("bigint").alias("shop")
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", shop, F.col("l_partkey").alias("id"), F.col("l_quantity").cast("int").alias("quantity"))
    orders = collect_parts(lines, ["l_orderkey", "shop"], F.struct("id", "quantity"), "items", "id")
    orders = orders.withColumn("doc", F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "shop", "part")]))
    menus = t.part.groupBy(shop).agg(F.array_sort(F.collect_list(F.struct(
        F.col("p_partkey").alias("_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("category")))).alias("menu"))
    found = joins.array_lookup(orders, "doc", F.col("shop"), "items", menus, "shop", "menu")
    return found.select("doc", F.transform("products", lambda p: F.concat_ws(
        ":", p["id"].cast("string"), p["quantity"].cast("string"), p["name"], p["category"])).alias("products"))


ARRAY_LOOKUP_SQL = """
SELECT l_orderkey || '-' || (l_partkey // 50) || '-0' AS doc,
       string_agg(concat_ws(':', l_partkey, CAST(l_quantity AS INTEGER), p_name, p_brand), ','
                  ORDER BY l_partkey, CAST(l_quantity AS INTEGER)) AS products
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey, l_partkey // 50"""


def row_ids(t: Tables):
    """Row ids without a global sort: all distinct, so as many as rows."""
    numbered = t.orders.select(F.monotonically_increasing_id().alias("rid"))
    return numbered.agg(F.countDistinct("rid").alias("ids"), F.count(F.lit(1)).alias("row_cnt"))


def sorted_limit(t: Tables):
    """The twenty dearest orders, ties by key."""
    return t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey", "o_totalprice")


QUERIES = {
    "rank_in_day": (rank_in_day, RANK_SQL),
    "lag_spend": (lag_spend, LAG_SQL),
    "running_total": (running_total, RUNNING_SQL),
    "last_known": (last_known, LAST_SQL),
    "partition_stats": (partition_stats, STATS_SQL),
    "last_five": (last_five, LAST_FIVE_SQL),
    "new_user_flag": (new_user_flag, NEW_USER_SQL),
    "max_of_counts": (max_of_counts, MAX_COUNTS_SQL),
    "top_days": (top_days, TOP_DAYS_SQL),
    "having_busy": (having_busy, HAVING_SQL),
    "collected": (collected, COLLECTED_SQL),
    "set_union": (set_union, "SELECT c_nationkey AS key FROM customer UNION ALL SELECT s_nationkey FROM supplier"),
    "set_union_by_name": (set_union_by_name, """
SELECT c_custkey AS id, c_name AS name, CAST(NULL AS VARCHAR) AS kind FROM customer
UNION ALL SELECT s_suppkey, s_name, 's' FROM supplier"""),
    "set_union_distinct": (set_union_distinct,
                           "SELECT c_nationkey AS key FROM customer UNION SELECT s_nationkey FROM supplier"),
    "set_except": (set_except, f"""
SELECT {ts_sql('o_orderdate')} AS d FROM (SELECT o_orderdate FROM orders EXCEPT SELECT l_shipdate FROM lineitem)"""),
    "null_audit": (null_audit, NULL_AUDIT_SQL),
    "dedup_rows": (dedup_rows, "SELECT event_id, user_id, event_type, value FROM events"),
    "dedup_keys": (dedup_keys, DEDUP_KEYS_SQL),
    "array_pairs": (array_pairs, ARRAY_PAIRS_SQL),
    "semi_in": (semi_in, """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')"""),
    "anti_not_in": (anti_not_in, """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')"""),
    "anti_not_in_null": (anti_not_in_null, """
SELECT count(*) AS n FROM customer
WHERE c_custkey NOT IN (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END FROM orders)"""),
    "anti_not_exists": (anti_not_exists, """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c.c_custkey AND o_orderpriority = '1-URGENT')"""),
    "anti_composite": (anti_composite, ANTI_COMPOSITE_SQL),
    "anti_keys": (anti_keys, """
SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_discount > 0.09)"""),
    "cross_ref": (cross_ref, "SELECT c_custkey, r_regionkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey "
                  "JOIN region ON n_regionkey = r_regionkey"),
    "right_keep": (right_keep, """
SELECT c_custkey, orders, c_name FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1) ON o_custkey = c_custkey"""),
    "left_composite": (left_composite, LEFT_COMPOSITE_SQL),
    "spine_join": (spine_join, SPINE_SQL),
    "time_part_join": (time_part_join, TIME_PART_SQL),
    "hint_broadcast": (hint_broadcast, CUSTOMER_NATION_SQL),
    "cached_reuse": (cached_reuse, CACHED_SQL),
    "lineage_cut": (lineage_cut, LINEAGE_SQL),
    "json_roundtrip": (json_roundtrip, JSON_SQL),
    "date_parts": (date_parts, DATE_PARTS_SQL),
    "epoch_time": (epoch_time, EPOCH_SQL),
    "active_filter": (active_filter, ACTIVE_SQL),
    "nested_select": (nested_select, NESTED_SQL),
    "text_clean": (text_clean, TEXT_SQL),
    "binary_cast": (binary_cast, BINARY_SQL),
    "key_functions": (key_functions, key_sql()),
    "array_lookup": (array_lookup, ARRAY_LOOKUP_SQL),
    "row_ids": (row_ids, "SELECT count(*) AS ids, count(*) AS row_cnt FROM orders"),
    "sorted_limit": (sorted_limit, """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"""),
}
QUERIES = {name: (query(fn), sql) for name, (fn, sql) in QUERIES.items()}
