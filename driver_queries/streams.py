"""Streaming jobs on the driver tables: each runs over a table as a file stream until all rows are read."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries import vaults
from driver_queries.common import Tables, day_sql, query, ts_sql, uuid5_sql
from martworks.functions.nested import open_json
from martworks.functions.text import words
from martworks.operators import keyed
from martworks.plans import counters, vault
from martworks.session import Copies, scratch, tidy_shuffles
from martworks.sources import kafka
from martworks.streaming import core, geoads, history, ingest, orders, promo, windows

NOW = 1706745600  # 2024-02-01


def events(t: Tables):
    return t.stream("events").withColumn("ts", F.col("ts").cast("timestamp"))


def _paths(t: Tables, name: str) -> tuple[str, str]:
    path = scratch(t.spark, name)
    return f"{path}/out", f"{path}/checkpoint"


def stream_words(t: Tables):
    """Word counts over all documents, complete mode."""
    out, checkpoint = _paths(t, "words")
    core.run_for(core.start(windows.word_counts(t.stream("documents"), "text"), core.snapshot(out), checkpoint, "complete"))
    return core.latest(t.spark, out)


WORDS_SQL = r"""
SELECT word, count(*) AS cnt FROM (
  SELECT unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS word FROM documents) WHERE word <> '' GROUP BY 1"""


def stream_slide(t: Tables):
    """Events per type in one-hour windows that slide by half an hour."""
    out, checkpoint = _paths(t, "slide")
    counted = windows.window_counts(events(t), "ts", ["event_type"], "1 hour", "30 minutes")
    core.run_for(core.start(counted, core.snapshot(out), checkpoint, "complete"))
    return core.latest(t.spark, out)


SLIDE_SQL = f"""
WITH w AS (
  SELECT event_type, unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts)
         - INTERVAL 30 MINUTE]) AS s FROM events)
SELECT {ts_sql('s')} AS window_start, {ts_sql('s + INTERVAL 1 HOUR')} AS window_end, event_type, count(*) AS cnt
FROM w GROUP BY s, event_type"""


def stream_dedup(t: Tables):
    """Every event sent twice; the second copy is dropped."""
    out, checkpoint = _paths(t, "dedup")
    twice = events(t).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    fresh = core.distinct_within(twice, ["event_id"], "ts", "1 hour")
    core.run_for(core.start_files(fresh.select("event_id", "user_id", "value"), out, checkpoint))
    return t.spark.read.parquet(out)


def stream_file_sink(t: Tables):
    """Rows passed through to files; a second run from the same checkpoint adds nothing."""
    out, checkpoint = _paths(t, "files")
    rows = events(t).select("event_id", "event_type", "value")
    core.run_for(core.start_files(rows, out, checkpoint))
    core.run_for(core.start_files(rows, out, checkpoint))
    return t.spark.read.parquet(out)


def stream_kafka_shape(t: Tables):
    """A stream in the shape of a topic, decoded."""
    out, checkpoint = _paths(t, "topic")
    topic = kafka.as_topic(events(t), "events", F.col("event_id"), F.col("event_id"), F.col("ts"),
                           "event_id", "user_id", "event_type")
    rows = windows.parse_value(topic, "event_id bigint, user_id bigint, event_type string", "topic", "offset")
    core.run_for(core.start_files(rows, out, checkpoint))
    return t.spark.read.parquet(out)


def _campaign_topic(t: Tables):
    """Events as campaigns: they run for 45 days from their moment; purchases have ended long ago.

    Each one is sent twice, and clicks use the misspelt restaurant field.
    """
    start = F.unix_seconds("ts").cast("double")
    click = F.col("event_type") == "click"
    length = F.when(F.col("event_type") == "purchase", 3600.0).otherwise(45 * 86400.0)
    shop = F.concat(F.lit("r"), F.col("user_id").cast("string"))
    fields = [
        F.when(~click, shop).alias("restaurant_id"), F.when(click, shop).alias("restaraunt_id"),
        F.col("event_id").cast("string").alias("adv_campaign_id"), F.col("props").alias("adv_campaign_content"),
        F.lit("owner").alias("adv_campaign_owner"), F.lit("contact").alias("adv_campaign_owner_contact"),
        start.alias("adv_campaign_datetime_start"), (start + length).alias("adv_campaign_datetime_end"),
        start.alias("datetime_created"),
    ]
    twice = events(t).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return kafka.as_topic(twice, "campaigns", F.col("event_id"), F.col("event_id"), F.col("ts"), *fields)


def stream_promo(t: Tables):
    """Notifications of active campaigns to subscribers (customers of the restaurant's nation key)."""
    out, checkpoint = _paths(t, "promo")
    subscribers = t.customer.select(
        F.col("c_custkey").cast("string").alias("client_id"),
        F.concat(F.lit("r"), F.col("c_nationkey").cast("string")).alias("restaurant_id"))
    core.run_for(promo.run(t.spark, _campaign_topic(t), subscribers, out, checkpoint, now=NOW))
    feedback = core.batches(t.spark, f"{out}/feedback")
    opened = open_json(core.batches(t.spark, f"{out}/push"), "value", "adv_campaign_id string, client_id string")
    pushed = opened.select("adv_campaign_id", "client_id", F.lit(1).alias("pushed"))
    return feedback.join(pushed, ["adv_campaign_id", "client_id"], "left").select(
        "restaurant_id", "adv_campaign_id", "client_id", "adv_campaign_datetime_end", "trigger_datetime_created",
        "feedback", "pushed")


PROMO_SQL = f"""
SELECT 'r' || user_id AS restaurant_id, CAST(event_id AS VARCHAR) AS adv_campaign_id,
       CAST(c_custkey AS VARCHAR) AS client_id,
       floor(epoch(ts)) + CASE WHEN event_type = 'purchase' THEN 3600 ELSE 45 * 86400 END AS adv_campaign_datetime_end,
       CAST({NOW} AS BIGINT) AS trigger_datetime_created, CAST(NULL AS VARCHAR) AS feedback, 1 AS pushed
FROM events JOIN customer ON c_nationkey = user_id
WHERE floor(epoch(ts)) <= {NOW}
  AND floor(epoch(ts)) + CASE WHEN event_type = 'purchase' THEN 3600 ELSE 45 * 86400 END > {NOW}"""


def _mixed_topic(t: Tables):
    """Purchases and clicks as transactions, views as currency rates, other events as a type nobody reads."""
    kind = F.col("event_type")
    object_type = F.when(kind.isin("purchase", "click"), "TRANSACTION").when(kind == "view", "CURRENCY").otherwise("OTHER")
    k = F.get_json_object("props", "$.k").cast("int")
    payload = F.struct(
        F.col("event_id").cast("string").alias("operation_id"), F.col("user_id").cast("int").alias("account_number_from"),
        k.alias("account_number_to"), (420 + k).alias("currency_code"), F.lit("land").alias("country"),
        F.lit("done").alias("status"), F.lit("sbp_incoming").alias("transaction_type"),
        F.round(F.col("value") * 100).cast("int").alias("amount"), F.col("ts").alias("transaction_dt"),
        F.col("ts").alias("date_update"), F.lit(430).alias("currency_code_with"), F.col("value").alias("currency_with_div"))
    return kafka.as_topic(events(t), "mixed", F.col("event_id"), F.col("event_id"), F.col("ts"),
                          F.col("event_id").cast("string").alias("object_id"), object_type.alias("object_type"),
                          F.col("ts").alias("sent_dttm"), payload.alias("payload"))


def stream_ingest(t: Tables):
    """The two typed tables of the topic, stacked."""
    out, checkpoint = _paths(t, "ingest")
    core.run_for(ingest.run(_mixed_topic(t), out, checkpoint))
    transactions = core.batches(t.spark, f"{out}/transaction")
    currencies = core.batches(t.spark, f"{out}/currency")
    common = ["object_id", "object_type", "sent_dttm", "currency_code"]
    return transactions.select(*common, "account_number_from", "amount").unionByName(
        currencies.select(*common, "currency_code_with", "currency_with_div"), allowMissingColumns=True)


INGEST_SQL = f"""
WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT CAST(event_id AS VARCHAR) AS object_id,
       CASE WHEN event_type = 'view' THEN 'CURRENCY' ELSE 'TRANSACTION' END AS object_type,
       {ts_sql('ts')} AS sent_dttm, 420 + k AS currency_code,
       CAST(CASE WHEN event_type <> 'view' THEN user_id END AS INTEGER) AS account_number_from,
       CASE WHEN event_type <> 'view' THEN CAST(round(value * 100) AS INTEGER) END AS amount,
       CASE WHEN event_type = 'view' THEN 430 END AS currency_code_with,
       CASE WHEN event_type = 'view' THEN value END AS currency_with_div
FROM e WHERE event_type IN ('purchase', 'click', 'view')"""


def _deliver(t: Tables, name: str, start, *deliveries) -> None:
    """Deliveries of a topic, one after the other: each is written in parallel, and the stream, started by ``start`` and
    going on from its checkpoint, has read it before the next one comes. A delivery may be a function of those before."""
    path = scratch(t.spark, name)
    for rows in deliveries:
        rows = rows(t.spark.read.parquet(path)) if callable(rows) else rows
        with tidy_shuffles(t.spark):
            rows.write.mode("append").option("compression", "zstd").parquet(path)
        core.run_for(start(t.spark.readStream.schema(rows.schema).parquet(path)))


def stream_enrich(t: Tables):
    """Raw orders to enriched messages; raw rows stored beside them. Every fourth order is sent again a batch later,
    with another status."""
    out, checkpoint = _paths(t, "enrich")
    first, shops = vaults.raw_topic(t).select("value"), vaults.shop_lookup(t)
    text = F.col("value").cast("string")
    again = lambda sent: sent.where(
        F.get_json_object(text, "$.object_id").cast("bigint") % 4 == 0).select(F.regexp_replace(
        F.regexp_replace(text, '"final_status":"[A-Z]"', '"final_status":"Z"'), '"sent_dttm":"[^"]*"', '"sent_dttm":"2031-01-01T00:00:00"').cast("binary").alias("value"))
    _deliver(t, "raw_topic", lambda raw: orders.run_enrich(raw, vaults.user_lookup(t), shops, out, checkpoint), first, again)
    messages = windows.parse_value(core.batches(t.spark, f"{out}/messages"), vault.ORDER_MESSAGE)
    kept = core.batches(t.spark, f"{out}/order_events").select(
        "object_id", F.col("object_type").alias("raw_type"), F.get_json_object("payload", "$.final_status").alias("raw_status"))
    p = F.col("payload")
    return messages.join(kept, "object_id").select(
        "object_id", "raw_type", "raw_status", p["status"].alias("status"), p["restaurant"]["name"].alias("restaurant"),
        p["user"]["login"].alias("login"), F.size(p["products"]).cast("bigint").alias("products"))


STREAM_ENRICH_SQL = """
WITH s AS (SELECT l_orderkey, min(l_suppkey) AS shop, count(*) AS products FROM lineitem GROUP BY 1)
SELECT o_orderkey AS object_id, 'order' AS raw_type, CASE WHEN o_orderkey % 4 = 0 THEN 'Z' ELSE o_orderstatus END AS raw_status,
       CASE WHEN sent = 1 THEN 'Z' ELSE o_orderstatus END AS status, s_name AS restaurant,
       lower(c_mktsegment) AS login, products
FROM orders JOIN s ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = shop JOIN customer ON c_custkey = o_custkey
JOIN (VALUES (0), (1)) v(sent) ON sent = 0 OR o_orderkey % 4 = 0"""


def _enriched_topic(t: Tables, copies: Copies):
    rows = vaults.enriched(t, copies)
    return rows.select(F.to_json(F.struct("object_id", "object_type", "payload")).cast("binary").alias("value"))


def _vault_run(t: Tables):
    out, checkpoint = _paths(t, "vault")
    # Three batches: odd orders, the others, and some of both once more.
    early, topic = Copies(t.spark), Copies(t.spark)
    rows = topic.add(_enriched_topic(t, early), "enriched_orders")
    early.drop()
    key = F.get_json_object(F.col("value").cast("string"), "$.object_id").cast("bigint")

    def again(sent):
        topic.drop()
        return sent.where(key % 5 == 0)
    _deliver(t, "enriched_topic", lambda topic: orders.run_vault(t.spark, topic, out, checkpoint, vaults.LOADED),
             rows.where(key % 2 == 1), rows.where(key % 2 == 0), again)
    return {table: core.batches(t.spark, f"{out}/{table}") for table in vault.TABLES}


def stream_vault(t: Tables):
    """All 14 tables of the vault stream: hubs, links and satellites stacked to (table, key)."""
    tables = _vault_run(t)
    frames = [rows.select(F.lit(n).alias("vault_table"), F.col(vault.TABLES[n]).alias("pk"))
              for n, rows in tables.items()]
    return vaults._union(frames)


STREAM_VAULT_SQL = vaults.VAULT_CTE + f""",
l AS (SELECT DISTINCT 'l_order_product' AS t, o || p AS name FROM k UNION SELECT 'l_order_user', o || u FROM k
      UNION SELECT 'l_product_restaurant', p || r FROM k UNION SELECT 'l_product_category', p || c FROM k
      UNION SELECT 's_user_names', u FROM k UNION SELECT 's_product_names', p FROM k
      UNION SELECT 's_restaurant_names', r FROM k UNION SELECT 's_order_cost', o FROM k
      UNION SELECT 's_order_status', o FROM k)
SELECT t AS vault_table, {uuid5_sql('name')} AS pk FROM l
UNION ALL SELECT DISTINCT 'h_user', u FROM k UNION ALL SELECT DISTINCT 'h_product', p FROM k
UNION ALL SELECT DISTINCT 'h_category', c FROM k UNION ALL SELECT DISTINCT 'h_restaurant', r FROM k
UNION ALL SELECT DISTINCT 'h_order', o FROM k"""


def stream_counters(t: Tables):
    """Running order counters per user and product of the compact messages, each message sent in both batches."""
    out, checkpoint = _paths(t, "counters")
    early = Copies(t.spark)
    compact = vault.compact_messages(vaults.enriched(t, early)).select(
        F.to_json(F.struct("id", "user", "products")).cast("binary").alias("value"))

    def start(topic):
        early.drop()
        return orders.run_counters(topic, counters.PRODUCT, out, checkpoint)
    _deliver(t, "compact_topic", start, compact, lambda sent: sent)
    return orders.current_counters(t.spark, out, counters.PRODUCT)


def stream_history(t: Tables):
    """Purchases of each customer and country as a list."""
    out, checkpoint = _paths(t, "history")
    fields = [
        F.col("event_id").cast("string").alias("InvoiceNo"), F.lit("s").alias("StockCode"),
        F.col("props").alias("Description"), F.round("value").cast("int").cast("string").alias("Quantity"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("InvoiceDate"), F.lit("1").alias("UnitPrice"),
        F.col("user_id").cast("string").alias("CustomerID"), F.col("event_type").alias("Country")]
    topic = kafka.as_topic(events(t), "retail", F.col("event_id"), F.col("event_id"), F.col("ts"), *fields)
    core.run_for(history.run_purchases(topic, out, checkpoint))
    rows = core.batches(t.spark, out)
    return rows.select("CustomerID", "Country", "part", F.array_sort(F.transform(
        "PurchaseDescription", lambda p: F.concat_ws("/", p["InvoiceDate"], p["Quantity"].cast("string"))))
        .alias("purchases"))


HISTORY_SQL = f"""
SELECT CAST(user_id AS VARCHAR) AS "CustomerID", event_type AS "Country", 0 AS part,
       string_agg({ts_sql('ts')} || '/' || CAST(round(value) AS INTEGER), ',' ORDER BY
                  {ts_sql('ts')} || '/' || CAST(round(value) AS INTEGER)) AS purchases
FROM events GROUP BY 1, 2"""


def stream_customers(t: Tables):
    """Customer messages passed through as documents."""
    out, checkpoint = _paths(t, "customers")
    rows = t.stream("customer")
    fields = [F.col("c_custkey").cast("string").alias("CustomerID"), F.col("c_mktsegment").alias("Address"),
              F.col("c_name").alias("Name")]
    topic = kafka.as_topic(rows, "customers", F.col("c_custkey"), F.col("c_custkey"), F.lit(None), *fields)
    core.run_for(history.run_customers(topic, out, checkpoint))
    return t.spark.read.parquet(out).select("CustomerID", "Address", "Name", "Email")


def stream_geoads(t: Tables):
    """Client positions within 900 km of five campaign points, one per region."""
    out, checkpoint = _paths(t, "geoads")
    eid = F.col("event_id")
    topic = kafka.as_topic(
        events(t), "positions", eid, eid, F.col("ts"), F.col("user_id").cast("string").alias("client_id"),
        F.col("ts").alias("timestamp"), (F.lit(-43) + ((37 * eid) % 330) / F.lit(10.0)).alias("lat"),
        (F.lit(114) + ((53 * eid) % 400) / F.lit(10.0)).alias("lon"))
    key = F.col("r_regionkey")
    campaigns = t.region.select(
        key.alias("id"), F.col("r_name").alias("name"), F.lit("d").alias("description"), F.lit("a").alias("start_time"),
        F.lit("b").alias("end_time"), (F.lit(-40.0) + 5 * key).alias("point_lat"), (F.lit(115.0) + 7 * key).alias("point_lon"))
    core.run_for(geoads.run(topic, campaigns, out, checkpoint, within_km=900))
    return t.spark.read.parquet(out).select(
        "client_id", "offset", "adv_campaign_id", "adv_campaign_name", F.round("distance", 0).cast("bigint").alias("metres"))


GEOADS_SQL = """
WITH p AS (
  SELECT user_id, event_id, radians(-43 + ((37 * event_id) % 330) / CAST(10 AS DOUBLE)) AS la,
         radians(114 + ((53 * event_id) % 400) / CAST(10 AS DOUBLE)) AS lo FROM events),
c AS (SELECT *, radians(CAST(-40 AS DOUBLE) + 5 * r_regionkey) AS cla,
             radians(CAST(115 AS DOUBLE) + 7 * r_regionkey) AS clo FROM region),
m AS (
SELECT CAST(user_id AS VARCHAR) AS client_id, event_id AS "offset", r_regionkey AS adv_campaign_id,
       r_name AS adv_campaign_name, CAST(round(2 * 6371000 * asin(sqrt(least(1.0, pow(sin((cla - la) / 2), 2)
         + cos(cla) * cos(la) * pow(sin((clo - lo) / 2), 2))))) AS BIGINT) AS metres
FROM p, c)
SELECT * FROM m WHERE metres <= 900000"""


def stream_missing_words(t: Tables):
    """Words of the documents that no benchmark item has."""
    out, checkpoint = _paths(t, "missing")
    known = t.benchmark.select(F.explode(words("text")).alias("words"))
    sink = keyed.first_seen(out, ["word"], lambda batch: windows.missing_words(batch, "text", known, "words"), split_rows=5_000)
    _deliver(t, "texts", lambda found: core.start(found, sink, checkpoint),
             *[t.documents.where(F.col("doc_id") % 2 == k).select("text") for k in (0, 1)])
    return core.batches(t.spark, out)


MISSING_SQL = r"""
SELECT DISTINCT word FROM (
  SELECT unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS word FROM documents)
WHERE word <> '' AND word NOT IN (SELECT unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) FROM benchmark)"""


def stream_late(t: Tables):
    """Events per type and day. A tenth of the first days of January is delivered last: it comes too late to count."""
    out, checkpoint = _paths(t, "late")
    rows = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp")
    late = (F.col("ts") < F.lit("2024-01-14").cast("timestamp")) & (F.col("event_id") % 10 == 0)
    _deliver(t, "late_events", lambda topic: core.start_files(
        windows.window_counts(topic, "ts", ["event_type"], "1 day", delay="1 hour"), out, checkpoint),
        rows.where(early & ~late), rows.where(~early), rows.where(late))
    return t.spark.read.parquet(out).select(F.to_date("window_start").alias("day"), "event_type", "cnt")


LATE_SQL = f"""
SELECT {day_sql("date_trunc('day', ts)")} AS day, event_type, count(*) AS cnt FROM events
WHERE ts >= TIMESTAMP '2024-01-14' OR event_id % 10 <> 0
GROUP BY date_trunc('day', ts), event_type
HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"""


def stream_join(t: Tables):
    """Clicks with the user's purchases in the following hour, as a join of two streams."""
    out, checkpoint = _paths(t, "join")
    clicks = events(t).where("event_type = 'click'").select("user_id", F.col("event_id").alias("click"),
                                                            F.col("ts").alias("click_ts"))
    bought = events(t).where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase"),
                                                               F.col("ts").alias("purchase_ts"))
    met = windows.interval_join(clicks, bought, "user_id", "click_ts", "purchase_ts", "1 hour")
    core.run_for(core.start_files(met, out, checkpoint))
    return t.spark.read.parquet(out).select("user_id", "click", "purchase")


def stream_outer_join(t: Tables):
    """The same join with the clicks that no purchase followed, as far as the watermark has decided them."""
    out, checkpoint = _paths(t, "outer_join")
    clicks = events(t).where("event_type = 'click'").select("user_id", F.col("event_id").alias("click"), F.col("ts").alias("click_ts"))
    bought = events(t).where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase"), F.col("ts").alias("purchase_ts"))
    met = windows.interval_join(clicks, bought, "user_id", "click_ts", "purchase_ts", "1 hour", how="left_outer")
    core.run_for(core.start_files(met, out, checkpoint))
    return t.spark.read.parquet(out).select("user_id", "click", "purchase")


OUTER_JOIN_SQL = """
WITH c AS (SELECT * FROM events WHERE event_type = 'click'), p AS (SELECT * FROM events WHERE event_type = 'purchase'),
w AS (SELECT least((SELECT max(ts) FROM c), (SELECT max(ts) FROM p)) - INTERVAL 1 HOUR AS mark),
j AS (SELECT c.user_id, c.event_id AS click, p.event_id AS purchase, c.ts
      FROM c LEFT JOIN p ON c.user_id = p.user_id AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 1 HOUR)
SELECT user_id, click, purchase FROM j, w WHERE purchase IS NOT NULL OR ts + INTERVAL 1 HOUR < mark"""


def stream_hot_join(t: Tables):
    """The outer join with four fifths of the events on one user and a narrower span."""
    out, checkpoint = _paths(t, "hot_join")
    who = F.when(F.col("event_id") % 5 != 0, 0).otherwise(F.col("user_id")).cast("bigint").alias("who")
    clicks = events(t).where("event_type = 'click'").select(who, F.col("event_id").alias("click"), F.col("ts").alias("click_ts"))
    bought = events(t).where("event_type = 'purchase'").select(who, F.col("event_id").alias("purchase"), F.col("ts").alias("purchase_ts"))
    met = windows.interval_join(clicks, bought, "who", "click_ts", "purchase_ts", "10 minutes", how="left_outer")
    core.run_for(core.start_files(met, out, checkpoint))
    return t.spark.read.parquet(out).select("who", "click", "purchase")


HOT_JOIN_SQL = """
WITH h AS (SELECT *, CASE WHEN event_id % 5 <> 0 THEN 0 ELSE user_id END AS who FROM events),
c AS (SELECT * FROM h WHERE event_type = 'click'), p AS (SELECT * FROM h WHERE event_type = 'purchase'),
w AS (SELECT least((SELECT max(ts) FROM c), (SELECT max(ts) FROM p)) - INTERVAL 1 HOUR AS mark),
j AS (SELECT c.who, c.event_id AS click, p.event_id AS purchase, c.ts
      FROM c LEFT JOIN p ON c.who = p.who AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 10 MINUTE)
SELECT who, click, purchase FROM j, w WHERE purchase IS NOT NULL OR ts + INTERVAL 10 MINUTE < mark"""


def stream_progress(t: Tables):
    """Rows read according to the progress reports of a stream that is shown on the console."""
    out, checkpoint = _paths(t, "console")
    reports = core.run_for(core.start_console(events(t).select("event_type").where(F.length("event_type") < 0), checkpoint))
    return t.spark.createDataFrame([(sum(r["numInputRows"] for r in reports),)], "rows_read long")


STREAM_JOIN_SQL = """
SELECT c.user_id, c.event_id AS click, p.event_id AS purchase
FROM events c JOIN events p ON c.user_id = p.user_id AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 1 HOUR
WHERE c.event_type = 'click' AND p.event_type = 'purchase'"""


QUERIES = {
    "stream_words": (stream_words, WORDS_SQL),
    "stream_slide": (stream_slide, SLIDE_SQL),
    "stream_dedup": (stream_dedup, "SELECT event_id, user_id, value FROM events"),
    "stream_file_sink": (stream_file_sink, "SELECT event_id, event_type, value FROM events"),
    "stream_kafka_shape": (stream_kafka_shape, """
SELECT 'events' AS topic, event_id AS "offset", event_id, user_id, event_type FROM events"""),
    "stream_promo": (stream_promo, PROMO_SQL),
    "stream_ingest": (stream_ingest, INGEST_SQL),
    "stream_enrich": (stream_enrich, STREAM_ENRICH_SQL),
    "stream_vault": (stream_vault, STREAM_VAULT_SQL),
    "stream_counters": (stream_counters, vaults.PRODUCT_COUNTERS_SQL),
    "stream_history": (stream_history, HISTORY_SQL),
    "stream_customers": (stream_customers, """
SELECT CAST(c_custkey AS VARCHAR) AS "CustomerID", c_mktsegment AS "Address", c_name AS "Name",
       CAST(NULL AS VARCHAR) AS "Email" FROM customer"""),
    "stream_geoads": (stream_geoads, GEOADS_SQL),
    "stream_missing_words": (stream_missing_words, MISSING_SQL),
    "stream_late": (stream_late, LATE_SQL),
    "stream_outer_join": (stream_outer_join, OUTER_JOIN_SQL),
    "stream_hot_join": (stream_hot_join, HOT_JOIN_SQL),
    "stream_progress": (stream_progress, "SELECT count(*) AS rows_read FROM events"),
    "stream_join": (stream_join, STREAM_JOIN_SQL),
}
QUERIES = {name: (query(fn), sql) for name, (fn, sql) in QUERIES.items()}
