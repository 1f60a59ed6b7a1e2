"""Marts whose groups are about as many as their rows sort them instead of holding them in hash tables."""

from __future__ import annotations

import datetime as dt
import random
import re
from decimal import Decimal

from pyspark.sql import functions as F

from martworks.plans import courier, sales


def _grouped(df):
    """The grouping columns of all aggregates of the plan."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return [set(re.findall(r"(\w+)#\d+", keys)) for keys in re.findall(r"HashAggregate\(keys=\[(.*?)\]", plan)]


def test_ledger_counts_orders_without_holding_them(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(12)]), dt.datetime(2024, rng.randint(1, 3), 5), rng.randint(1, 4), rng.randint(1, 5),
             Decimal(rng.randint(1, 900)), Decimal(1)) for _ in range(300)]
    facts = spark.createDataFrame(rows, "order_id long, order_ts timestamp, courier_id int, rate int, order_sum decimal(14,2), tip_sum decimal(14,2)")
    people = spark.createDataFrame([(i, i, f"c{i}", dt.datetime(2099, 1, 1)) for i in range(1, 5)],
                                   "id int, courier_id int, courier_name string, active_to timestamp")
    for floor in ("month", "order"):
        ledger = courier.courier_ledger(facts, people, "2024-06-01", floor)
        assert not any("order_id" in keys for keys in _grouped(ledger))
        want = facts.groupBy("courier_id", F.month("order_ts").alias("m")).agg(F.countDistinct("order_id").alias("n"), F.sum("order_sum").alias("s"))
        assert sorted((r.id, r.settlement_month, r.orders_count, r.orders_total_sum) for r in ledger.collect()) == sorted(tuple(r) for r in want.collect())


def test_retention_counts_orders_without_holding_them(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, *range(15)]), rng.choice([None, 1, 2, 3]), rng.choice(["a", "b"]), dt.date(2024, 1, rng.randint(1, 20)),
             Decimal(rng.randint(1, 90)), rng.choice([None, "shipped", "refunded"])) for _ in range(250)]
    log = spark.createDataFrame(rows, "order_id int, customer_id int, item_id string, order_date date, payment_amount decimal(14,2), status string")
    found = sales.retention_weekly(log)
    assert not any({"order_id", "customer_id"} & keys for keys in _grouped(found))
    want = {}
    for order, customer, item, day, paid, status in rows:
        kept, refunds, sums = want.setdefault((day.isocalendar()[0] * 100 + day.isocalendar()[1], item, customer), (set(), set(), []))
        (refunds if status == "refunded" else kept).add(order)
        if status != "refunded":
            sums.append(paid)
    total = {}
    for (week, item, _), (kept, refunds, sums) in want.items():
        t = total.setdefault((week, item), [0, 0, 0, 0, 0, 0])
        for i, v in enumerate((len(kept) == 1, len(kept) > 1, bool(refunds), sum(sums) * (len(kept) == 1), sum(sums) * (len(kept) > 1), len(refunds))):
            t[i] += v
    got = {(r.period_id, r.item_id): [r.new_customers_count, r.returning_customers_count, r.refunded_customer_count,
                                      r.new_customers_revenue, r.returning_customers_revenue, r.customers_refunded] for r in found.collect()}
    assert got == total
    assert dict(found.dtypes)["new_customers_revenue"] == "decimal(38,2)"
