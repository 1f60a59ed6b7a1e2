"""Golden cases of the marts."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martworks.operators.quality import GateError
from martworks.operators.joins import within_distance
from martworks.plans import activity, courier, deliveries, friends, geo, group_vault, metrics, paths, sales, settlement, tags, vault
from martworks.functions.keys import text_key


@pytest.mark.parametrize("rating,total,pay", [("3.99", 1000, 100), ("4.00", 1000, 150), ("4.50", 10000, 800), ("4.90", 1000, 200),
                                              ("4.89", 1000, 175), ("3.00", 10000, 500)])
def test_pay_tiers(spark, rating, total, pay):
    got = spark.range(1).select(courier.tier_pay(F.lit(rating).cast("decimal(14,2)"), F.lit(total).cast("decimal(14,2)")).alias("p"))
    assert got.first().p == pay


def _deliveries(spark):
    rows = [("o1", "2022-05-01 10:00:00", "c1", 4, "1000.00", "10.00"), ("o2", "2022-05-02 10:00:00", "c1", 5, "3000.00", "0.00"),
            ("o3", "2022-06-02 10:00:00", "c1", 3, "100.00", "1.00"), ("o4", "2022-05-02 10:00:00", "old", 5, "100.00", "0.00")]
    return spark.createDataFrame(rows, "order_id string, order_ts string, courier_id string, rate int, order_sum string, tip_sum string").withColumn(
        "order_ts", F.to_timestamp("order_ts"))


def _couriers(spark):
    return spark.createDataFrame([(1, "c1", "Ann", "2099-01-01"), (2, "old", "Bob", "2020-01-01")],
                                 "id int, courier_id string, courier_name string, active_to string").withColumn(
        "active_to", F.to_timestamp("active_to"))


def test_ledger(spark):
    got = {r.settlement_month: r for r in courier.courier_ledger(_deliveries(spark), _couriers(spark), "2023-01-01").collect()}
    may = got[5]
    assert len(got) == 2 and (may.orders_count, may.rate_avg, may.orders_total_sum) == (2, Decimal("4.50"), Decimal("4000.00"))
    assert may.courier_order_sum == 320 and may.order_processing_fee == 1000 and may.courier_reward_sum == Decimal("329.5")
    assert got[6].courier_order_sum == 100
    by_order = {r.settlement_month: r for r in courier.courier_ledger(_deliveries(spark), _couriers(spark), "2023-01-01", "order").collect()}
    assert by_order[5].courier_order_sum == 175 + 240


def test_ledger_load_twice(spark, rows):
    fresh = courier.courier_ledger(_deliveries(spark), _couriers(spark), "2023-01-01")
    once = courier.load_ledger(fresh.limit(0), fresh)
    assert rows(courier.load_ledger(once, fresh)) == rows(once)


TRANSACTIONS = [  # operation, from, currency, status, type, amount
    ("a", 914810, 430, "queued", "sbp_incoming", 230900), ("b", 914810, 430, "done", "sbp_incoming", 62000),
    ("a", 914810, 430, "done", "sbp_incoming", 230900), ("c", 914810, 470, "done", "sbp_incoming", 30000),
    ("d", 914810, 450, "done", "authorization", -5100), ("e", -1, 430, "done", "sbp_incoming", 10),
    ("f", 914810, 460, "in_progress", "sbp_incoming", 110000),
]


def test_global_metrics(spark):
    t = spark.createDataFrame(TRANSACTIONS, "operation_id string, account_number_from int, currency_code int, status string, "
                              "transaction_type string, amount int").withColumn("sent_dttm", F.to_timestamp(F.lit("2022-10-01 00:00:26")))
    c = spark.createDataFrame([(430, 420, 1.1), (430, 470, 2.0)], "currency_code int, currency_code_with int, currency_with_div double").withColumn(
        "sent_dttm", F.to_timestamp(F.lit("2022-10-01 09:00:00")))
    got = {r.currency_from: r for r in metrics.global_metrics(t, c, "2022-10-01", currency_with=420).collect()}
    assert set(got) == {430, 470}
    assert got[430].amount_total == Decimal("322190.00") and got[430].cnt_transactions == 292900
    assert (got[430].transactions_count, got[430].avg_transactions_per_account, got[470].amount_total) == (2, 161095, None)
    every = {r.currency_from: r for r in metrics.global_metrics(t, c).collect()}
    assert every[430].cnt_transactions == 2 * 292900 and every[430].amount_total == Decimal("907990.00")
    assert metrics.global_metrics(t, c, "2022-10-02").count() == 0


def _located(spark):
    day = dt.datetime(2022, 5, 1)
    rows = []

    def add(kind, user, days, city, to=None, channel=None, hour=0):
        rows.append((kind, user, len(rows), to, channel, day + dt.timedelta(days=days, hours=hour), -33.0, 151.0, ord(city), city,
                     None if city == "X" else "Australia/Brisbane"))

    for d, city in enumerate("AABA"):
        add("message", 1, d, city, to=9)
    add("subscription", 1, 5, "A", channel=7)
    add("subscription", 2, 5, "A", channel=7)
    add("subscription", 3, 5, "A", channel=7)
    add("message", 3, 4, "A", to=1)
    add("subscription", 4, 5, "X", channel=7)
    return spark.createDataFrame(rows, "event_type string, user_id int, event_id int, message_to int, channel int, ts timestamp, "
                                 "lat double, lon double, id int, city string, tz string")


def test_user_geo(spark):
    got = {r.user_id: r for r in geo.user_geo(_located(spark), min_days=1).collect()}
    one = got[1]
    assert (one.act_city, one.home_city, one.travel_count, one.travel_array) == ("A", "A", 5, ["A", "A", "A", "A", "B"])
    assert str(one.local_time) == "2022-05-06 10:00:00"
    assert got[2].home_city is None and got[4].local_time is None
    moves = {r.user_id: r for r in geo.user_geo(_located(spark), 1, "moves").collect()}
    assert (moves[1].travel_count, moves[1].travel_array) == (3, ["A", "B", "A"])


def test_zone_activity(spark):
    got = {(str(r.week), r.zone_id): r for r in geo.zone_activity(_located(spark)).collect()}
    week = got[("2022-05-02", ord("A"))]
    assert (week.week_message, week.week_subscription, week.week_reaction, week.week_user) == (3, 3, None, 1)
    assert week.month_message == 4 and week.month_user == 2


def test_friends(spark, rows):
    """3 wrote to 1, so only 1-2 and 2-3 remain; 4 is in another zone."""
    got = friends.friend_recommendations(_located(spark), "2022-06-01 00:00:00", 1.0)
    assert rows(got, "user_left", "user_right", "zone_id") == [(1, 2, 65), (2, 3, 65)]


@pytest.mark.parametrize("most,bits", [(1000, 512), (1000, 3), (0, 512)])
def test_friends_with_many_channels_meet_once(spark, rows, monkeypatch, most, bits):
    """Forty people of one place share some of ninety channels: they are paired by place, or by channel if lists are too long."""
    monkeypatch.setattr(friends, "MOST_BITS", bits)
    monkeypatch.setattr(friends, "MOST_CHANNELS", most)
    joined = []
    monkeypatch.setattr(friends, "within_distance", lambda *a, also, **k: joined.append(also) or within_distance(*a, also=also, **k))
    found = [("subscription", u, None, c if c % 4 else None) for u in range(40) for c in range(90) if (u * 7 + c * c) % 5 < 1]
    said = [("message", u, (u * 3) % 40, None) for u in range(0, 40, 2)]
    log = spark.createDataFrame([(k, u, to, c, i, i, -37.8, 144.9, 1 + u % 2, "Australia/Perth") for i, (k, u, to, c) in enumerate(found + said)],
                                "event_type string, user_id int, message_to int, channel int, ts int, event_id int, lat double, lon double, id int, tz string")
    got = friends.friend_recommendations(log, "2022-06-01 00:00:00", 1.0)
    channels = {u: {c for _, v, _, c in found if v == u and c} for u in range(40)}
    known = {frozenset((u, to)) for _, u, to, _ in said}
    want = [(a, b) for a in range(40) for b in range(a + 1, 40)
            if a % 2 == b % 2 and channels[a] & channels[b] and frozenset((a, b)) not in known]
    assert rows(got, "user_left", "user_right") == sorted(want, key=repr)
    assert joined == [["zone_id"] if most else ["channel", "zone_id"]]


def test_activity_and_contacts(spark):
    first = activity.activity_windows(_located(spark)).where("event_id = 0").first()
    assert (first.week_message, first.week_user, first.month_message, first.month_user) == (1, 1, 5, 4)
    messages = _located(spark).where("event_type = 'message'")
    got = activity.nearby_contacts(messages).collect()
    assert [(r.user_id, r.message_to, r.friends) for r in got] == [(3, 1, [1])]
    assert activity.nearby_contacts(messages, positions="both").count() == 5


def test_paths_only_new(spark, rows):
    steps = ["/product/1", "/cart", "/payment", "/confirmation"] * 2
    df = spark.createDataFrame([(1, i, p) for i, p in enumerate(steps)], "user_custom_id int, event_timestamp int, page_url_path string")
    found = paths.purchase_paths(df)
    assert rows(found, "event_timestamp") == [(0,), (4,)]
    assert paths.purchase_paths(df, found).count() == 0


def test_tags(spark, rows):
    df = spark.createDataFrame([("u1", ["a", "b"]), ("u2", ["a", "b"]), ("u2", ["a", "c"])], "u string, tags array<string>")
    verified = spark.createDataFrame([("b",)], "tag string")
    assert rows(tags.tag_candidates(df, verified, "u", F.col("tags"), 2)) == [("a", 2)]


def test_sales_and_retention(spark):
    log = spark.createDataFrame([
        (1, 10, "i", "2022-01-03", 1, "5.00", None), (2, 10, "i", "2022-01-04", 1, "6.00", "shipped"),
        (3, 11, "i", "2022-01-04", 2, "7.00", "shipped"), (4, 11, "i", "2022-01-05", 1, "1.00", "refunded")],
        "order_id int, customer_id int, item_id string, order_date string, quantity int, amount string, status string",
    ).withColumn("order_date", F.to_date("order_date")).withColumn("payment_amount", F.col("amount").cast("decimal(14,2)")).drop("amount")
    assert sales.signed_sales(log).agg(F.sum("payment_amount")).first()[0] == 17
    row = sales.retention_weekly(log).first()
    assert (row.period_id, row.new_customers_count, row.returning_customers_count, row.refunded_customer_count) == (202201, 1, 1, 1)
    assert (row.new_customers_revenue, row.returning_customers_revenue, row.customers_refunded) == (7, 11, 1)


def test_settlement_two_forms(spark, rows):
    s = spark.createDataFrame([(1, 2, "10.00", "1.00", "0.50")], "order_id int, count int, price string, a string, b string").select(
        "order_id", F.col("count").cast("decimal(6,0)").alias("count"), F.col("price").cast("decimal(14,2)").alias("price"),
        F.col("a").cast("decimal(14,2)").alias("bonus_payment"), F.col("b").cast("decimal(14,2)").alias("bonus_grant"))
    o = spark.createDataFrame([(1, 5, 3)], "id int, restaurant_id int, timestamp_id int")
    ts = spark.createDataFrame([(3, "2022-01-01")], "id int, date string").withColumn("date", F.to_date("date"))
    r = spark.createDataFrame([(5, "R")], "id int, restaurant_name string")
    fresh = settlement.settlement(s, o, ts, r)
    row = fresh.first()
    assert (row.orders_total_sum, row.order_processing_fee, row.restaurant_reward_sum) == (20, 5, 14)
    into_empty = settlement.append_and_update(fresh.limit(0), fresh)
    assert rows(into_empty) == rows(fresh) == rows(settlement.append_and_update(into_empty, fresh))
    assert rows(settlement.load_settlement(fresh, fresh)) == rows(fresh)


def test_group_vault_reload(spark):
    log = spark.createDataFrame([(1, 2, "add", "2022-01-01"), (1, 2, "leave", "2022-01-02"), (1, 3, "add", "2022-01-01")],
                                "group_id int, user_id int, event string, dt string").withColumn("user_id_from", F.lit(None).cast("int"))
    users = group_vault.hub(log, "user_id", "hk_user_id", lambda c: text_key(c))
    groups = group_vault.hub(log, "group_id", "hk_group_id", lambda c: text_key(c), registration_dt=F.min("dt"))
    link = group_vault.link_rows(log, users, groups, None, text_key)
    sat = group_vault.satellite_rows(log, users, groups, link, None)
    assert link.count() == 2 and sat.count() == 3
    assert group_vault.link_rows(log, users, groups, link, text_key).count() == 0
    assert group_vault.satellite_rows(log, users, groups, link, sat).count() == 0


def _order_messages(spark, name="Ann", status="NEW"):
    return spark.createDataFrame(
        [(1, "order", (1, dt.datetime(2022, 1, 1), Decimal(10), Decimal(9), status, ("r", "Rest"), ("u", name, "ann"),
                       [("p1", Decimal(5), 1, "Soup", "Soups"), ("p2", Decimal(5), 1, "Stew", "Soups")]))], vault.ORDER_MESSAGE)


def test_vault_rows(spark):
    tables = vault.vault_rows(_order_messages(spark), "2022-02-01 00:00:00")
    counts = {t: df.count() for t, df in tables.items()}
    assert len(counts) == 14 and counts["h_product"] == 2 and counts["h_category"] == 1 and counts["l_order_product"] == 2
    assert sum(counts.values()) == 19
    again = vault.vault_rows(_order_messages(spark), "2022-02-02 00:00:00", existing=tables)
    assert sum(df.count() for df in again.values()) == 0
    changed = vault.vault_rows(_order_messages(spark, "Eve", "DONE"), "2022-02-02 00:00:00", existing=tables, history=True)
    assert {t: n for t, n in ((t, df.count()) for t, df in changed.items()) if n} == {"s_user_names": 1, "s_order_status": 1}


def test_delivery_gate(spark):
    good = ('{"order_id":"o1","order_ts":"2022-05-01 10:00:00","delivery_id":"d","courier_id":"c","address":"a",'
            '"delivery_ts":"2022-05-01 11:00:00","rate":5,"sum":10.5,"tip_sum":1}')
    bad = good.replace('"rate":5', '"rate":7').replace("o1", "o2")

    def envelope(*docs):
        return spark.createDataFrame([(str(i), d) for i, d in enumerate(docs)], "object_id string, object_value string").withColumn(
            "update_ts", F.to_timestamp(F.lit("2022-06-01")))

    empty = deliveries.typed(envelope(good)).limit(0)
    loaded = deliveries.load(empty, envelope(good), deliveries.rules())
    assert loaded.count() == 1 and loaded.first().order_sum == Decimal("10.50")
    assert deliveries.load(loaded, envelope(good), deliveries.rules()).count() == 1
    with pytest.raises(GateError, match="rate_check"):
        deliveries.load(empty, envelope(good, bad), deliveries.rules())
    assert deliveries.load(empty, envelope(good, bad), deliveries.rules(), stop_on_error=False).count() == 1
