"""Data-quality checks on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.common import Tables, day, query
from martworks.operators import quality
from martworks.operators.groups import most_frequent
from martworks.session import scratch


def _lines(t: Tables):
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


def _rules():
    return {
        "shipped_after_order": F.col("l_shipdate") > F.col("o_orderdate"),
        "price_positive": F.col("l_extendedprice") >= 0,
        "discount_small": F.col("l_discount").between(0, 0.08),
        "quantity_known": F.col("l_quantity") >= 1,
        "order_window": F.col("o_orderdate").between(day("1995-01-01"), day("2000-12-31")),
    }


RULES_SQL = """
WITH r AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
         CASE WHEN l_shipdate > o_orderdate THEN 1 ELSE 0 END AS shipped_after_order,
         CASE WHEN l_extendedprice >= 0 THEN 1 ELSE 0 END AS price_positive,
         CASE WHEN l_discount BETWEEN 0 AND CAST(0.08 AS DOUBLE) THEN 1 ELSE 0 END AS discount_small,
         CASE WHEN l_quantity >= 1 THEN 1 ELSE 0 END AS quantity_known,
         CASE WHEN o_orderdate BETWEEN DATE '1995-01-01' AND DATE '2000-12-31' THEN 1 ELSE 0 END AS order_window
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def dq_gate(t: Tables):
    """All rules, and the two that every row keeps, as 0/1 gates."""
    rules = _rules()
    kept = {k: rules[k] for k in ("price_positive", "quantity_known")}
    return quality.gate(_lines(t), rules).withColumn("gate", F.lit("all")).unionByName(
        quality.gate(_lines(t), kept).withColumn("gate", F.lit("kept")))


GATE_SQL = RULES_SQL + """
SELECT 'all' AS gate, min(least(shipped_after_order, price_positive, discount_small, quantity_known, order_window))
         AS passed FROM r
UNION ALL SELECT 'kept', min(least(price_positive, quantity_known)) FROM r"""


def dq_constraints(t: Tables):
    return quality.rule_counts(_lines(t), _rules())


CONSTRAINTS_SQL = RULES_SQL + " UNION ALL ".join(
    f"\nSELECT '{n}' AS rule, count(*) FILTER ({n} = 0) AS violations FROM r" for n in (
        "shipped_after_order", "price_positive", "discount_small", "quantity_known", "order_window"))


def dq_quarantine(t: Tables):
    """Rows breaking rules, with the names of the broken ones."""
    _, bad = quality.split_valid(_lines(t), _rules())
    return bad.select("l_orderkey", "l_linenumber", "l_partkey", "broken_rules")


QUARANTINE_SQL = RULES_SQL + """
SELECT l_orderkey, l_linenumber, l_partkey, concat_ws(',',
         CASE WHEN shipped_after_order = 0 THEN 'shipped_after_order' END,
         CASE WHEN price_positive = 0 THEN 'price_positive' END, CASE WHEN discount_small = 0 THEN 'discount_small' END,
         CASE WHEN quantity_known = 0 THEN 'quantity_known' END, CASE WHEN order_window = 0 THEN 'order_window' END)
         AS broken_rules
FROM r WHERE least(shipped_after_order, price_positive, discount_small, quantity_known, order_window) = 0"""


def dq_scalar(t: Tables):
    """Distinct customers with orders against the expectation of 1,000, one percent and fifty percent tolerance."""
    value = F.countDistinct("o_custkey")
    return quality.value_check(t.orders, value, 1000, 0.01).withColumn("tolerance", F.lit("1%")).unionByName(
        quality.value_check(t.orders, value, 1000, 0.5).withColumn("tolerance", F.lit("50%")))


SCALAR_SQL = """
SELECT '1%' AS tolerance, count(DISTINCT o_custkey) AS value,
       CASE WHEN abs(count(DISTINCT o_custkey) - 1000) <= 10 THEN 1 ELSE 0 END AS passed FROM orders
UNION ALL SELECT '50%', count(DISTINCT o_custkey),
       CASE WHEN abs(count(DISTINCT o_custkey) - 1000) <= 500 THEN 1 ELSE 0 END FROM orders"""


def dq_null(t: Tables):
    rows = t.events.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    return quality.no_nulls(rows, ["event_id", "user_id", "value"])


NULL_SQL = """
SELECT 'event_id' AS column_name, count(*) FILTER (event_id IS NULL) AS null_cnt,
       CASE WHEN count(*) FILTER (event_id IS NULL) = 0 THEN 1 ELSE 0 END AS passed FROM events
UNION ALL SELECT 'user_id', count(*) FILTER (user_id IS NULL),
       CASE WHEN count(*) FILTER (user_id IS NULL) = 0 THEN 1 ELSE 0 END FROM events
UNION ALL SELECT 'value', count(*) FILTER (event_type = 'error'),
       CASE WHEN count(*) FILTER (event_type = 'error') = 0 THEN 1 ELSE 0 END FROM events"""


def dq_unique(t: Tables):
    """Repeated (order, line number) pairs."""
    return quality.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


def dq_fk(t: Tables):
    """Orders whose customer is missing from the customers in credit."""
    in_credit = t.customer.where("c_acctbal >= 0")
    return quality.orphans(t.orders, "o_custkey", in_credit, "c_custkey").select("o_orderkey", "o_custkey")


def dq_key_audit(t: Tables):
    return most_frequent(t.lineitem, ["l_orderkey", "l_linenumber"], 5)


def dq_layer_counts(t: Tables):
    names = ["customer", "orders", "lineitem", "events", "documents"]
    return quality.layer_counts({n: getattr(t, n) for n in names})


LAYER_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_cnt FROM {n}"
    for n in ("customer", "orders", "lineitem", "events", "documents"))


def dq_log(t: Tables):
    """Check results appended to a log on disk and read back."""
    path = scratch(t.spark, "dq_log")
    nulls = quality.no_nulls(t.events, ["event_id", "user_id"])
    value = quality.value_check(t.events, F.countDistinct("event_type"), 3, 0.01)
    quality.append_log(quality.log_rows(nulls, "events", "is_null", "2024-02-01"), path)
    quality.append_log(quality.log_rows(value, "events", "type_count", "2024-02-01"), path)
    return t.spark.read.parquet(path)


LOG_SQL = """
SELECT 'events' AS table_name, 'is_null' AS check_name, '2024-02-01' AS check_date,
       CASE WHEN count(*) FILTER (event_id IS NULL OR user_id IS NULL) = 0 THEN 0 ELSE 1 END AS check_result FROM events
UNION ALL SELECT 'events', 'type_count', '2024-02-01',
       CASE WHEN abs(count(DISTINCT event_type) - 3) <= 0.03 THEN 0 ELSE 1 END FROM events"""


def dq_presence(t: Tables):
    """One file expected per day and type; the files of errors never arrive."""
    from martworks.sources.files import list_files
    path = scratch(t.spark, "dq_presence")
    rows = t.events.withColumn("d", F.to_date("ts"))
    (rows.where("event_type != 'error'").repartition("event_type", "d").write.partitionBy("event_type", "d").parquet(path))
    expected = rows.select(F.concat_ws("/", F.concat(F.lit("event_type="), "event_type"),
                                       F.concat(F.lit("d="), F.col("d").cast("string"))).alias("file_name")).distinct()
    found = list_files(t.spark, path, "*.parquet").select(
        F.regexp_extract("path", r"(event_type=[^/]+/d=[^/]+)/[^/]+$", 1).alias("file_name"))
    return quality.presence(expected, found)


PRESENCE_SQL = """
SELECT DISTINCT 'event_type=' || event_type || '/d=' || strftime(ts, '%Y-%m-%d') AS file_name,
       CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS passed FROM events"""


QUERIES = {
    "dq_gate": (dq_gate, GATE_SQL),
    "dq_constraints": (dq_constraints, CONSTRAINTS_SQL),
    "dq_quarantine": (dq_quarantine, QUARANTINE_SQL),
    "dq_scalar": (dq_scalar, SCALAR_SQL),
    "dq_null": (dq_null, NULL_SQL),
    "dq_unique": (dq_unique, """
SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem GROUP BY ALL HAVING count(*) > 1"""),
    "dq_fk": (dq_fk, """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"""),
    "dq_key_audit": (dq_key_audit, """
SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem GROUP BY ALL
ORDER BY cnt DESC, l_orderkey, l_linenumber LIMIT 5"""),
    "dq_layer_counts": (dq_layer_counts, LAYER_SQL),
    "dq_log": (dq_log, LOG_SQL),
    "dq_presence": (dq_presence, PRESENCE_SQL),
}
QUERIES = {name: (query(fn), sql) for name, (fn, sql) in QUERIES.items()}
