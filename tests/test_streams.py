"""Streams: golden promo cases, restarts from the checkpoint, batch against stream."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from martworks.operators import keyed
from martworks.plans import counters, vault
from martworks.session import scratch
from martworks.sources import files
from martworks.streaming import core, ingest, orders, promo, windows


def _campaign(shop, campaign, start, end, field="restaurant_id"):
    return {field: shop, "adv_campaign_id": campaign, "adv_campaign_content": "first campaign", "adv_campaign_owner": "Owner",
            "adv_campaign_owner_contact": "owner@shop.example", "adv_campaign_datetime_start": start,
            "adv_campaign_datetime_end": end, "datetime_created": 1668255290}


MESSAGES = [_campaign("s0", "c3", 1668211200, 1672444800), _campaign("s0", "c3", 1668211200, 1672444800),
            _campaign("s1", "c9", 1668297600, 1703980800), _campaign("s1", "c9", 1670803200, 1703980800, "restaraunt_id")]


def _land(spark, documents, path):
    """Messages as one more file of a topic folder."""
    rows = spark.createDataFrame([(json.dumps(d),) for d in documents], "value string").coalesce(1)
    rows.select(F.col("value").cast("binary").alias("value")).write.mode("append").parquet(path)
    return spark.readStream.schema("value binary").parquet(path)


@pytest.mark.parametrize("now,count", [(1668211199, 0), (1668300000, 2), (1670803200, 3), (1672444800, 2)])
def test_active_campaigns(spark, now, count):
    topic = spark.createDataFrame([(json.dumps(m),) for m in MESSAGES], "value string")
    assert promo.active(promo.campaigns(topic), now).distinct().count() == count


def test_promo_restart(spark):
    path, out, checkpoint = (scratch(spark, n) for n in ("topic", "out", "checkpoint"))
    subscribers = spark.createDataFrame([(1, "x", "s0"), (2, "x", "s0"), (3, "y", "s1")], "id int, client_id string, restaurant_id string")
    topic = _land(spark, MESSAGES, path)
    for _ in range(2):
        core.run_for(promo.run(spark, topic, subscribers, out, checkpoint, now=1670803200))
        assert core.batches(spark, f"{out}/feedback").count() == 3
        assert core.batches(spark, f"{out}/push").count() == 3
    pushed = json.loads(core.batches(spark, f"{out}/push").first().value)
    assert "feedback" not in pushed and pushed["trigger_datetime_created"] == 1670803200
    _land(spark, [_campaign("s1", "c10", 1668297600, 1703980800)], path)
    core.run_for(promo.run(spark, topic, subscribers, out, checkpoint, now=1670803200))
    assert core.batches(spark, f"{out}/feedback").count() == 4


def test_promo_of_many_clients_is_cut_and_restaurants_without_any_are_not_kept(spark, rows, monkeypatch):
    monkeypatch.setattr(promo, "SLICE", 2)
    path, out, checkpoint = (scratch(spark, n) for n in ("topic", "out", "checkpoint"))
    wanted = [(f"x{i}", "s0") for i in range(9)] + [(None, "s0"), ("x0", "s0"), ("y", "s1"), ("z", None)]
    subscribers = spark.createDataFrame(wanted, "client_id string, restaurant_id string")
    others = [_campaign(r, "c1", 1668211200, 1672444800) for r in ("nobody", None)]
    progress = core.run_for(promo.run(spark, _land(spark, MESSAGES + others, path), subscribers, out, checkpoint, now=1670803200))
    assert max(o["numRowsTotal"] for p in progress for o in p["stateOperators"]) == 3
    got = rows(core.batches(spark, f"{out}/feedback"), "adv_campaign_id", "adv_campaign_datetime_start", "client_id")
    assert len(got) == 10 + 2 and len(set(got)) == 12
    assert promo.sliced(subscribers)[0].groupBy("restaurant_id", "_slice").count().agg(F.max("count")).first()[0] < 10


def test_repeated_batch_adds_nothing(spark):
    out = scratch(spark, "out")
    sink = core.batch_folder(out)
    for _ in range(2):
        sink(spark.range(5), 0)
    sink(spark.range(2), 1)
    assert core.batches(spark, out).count() == 7


def test_upsert_folder_keeps_the_newest(spark, rows):
    out = scratch(spark, "out")
    sink = keyed.upsert_folder(out, ["k"], ["v"], split_rows=2, many_folders=1)
    for batch_id, data in enumerate([[(1, 5), (2, 5), (None, 1)], [(1, 4), (2, 9), (3, 1), (3, 2), (None, 3)], []]):
        for _ in range(2):
            sink(spark.createDataFrame(data, "k int, v int"), batch_id)
    assert rows(core.batches(spark, out)) == [(1, 5), (2, 9), (3, 2), (None, 3)]


def test_first_seen_over_batches(spark, rows):
    out = scratch(spark, "out")
    sink = keyed.first_seen(out, ["w"], lambda b: b)
    for batch_id, data in enumerate([["a", "b", "a", None], [], ["b", "c", None]]):
        for _ in range(2):
            sink(spark.createDataFrame([(w,) for w in data], "w string"), batch_id)
    assert rows(core.batches(spark, out)) == [("a",), ("b",), ("c",), (None,)]


def test_history_is_cut_as_it_grows(spark):
    """Buckets stay small, repeated batches change nothing, and few keys read a falling share of the files."""
    out, shares = scratch(spark, "out"), []
    schema = "k long, v long"
    for batch_id in range(6):
        rows = spark.range(batch_id * 300, batch_id * 600 + 300).selectExpr("id as k", f"{batch_id} as v")
        for _ in range(2 if batch_id in (2, 4) else 1):
            keyed.first_seen(out, ["k"], lambda b: b, split_rows=100, many_folders=3)(rows, batch_id)
        folder = keyed.KeyedFolder(spark, out, ["k"], rows.schema)
        leaves = folder.leaves()
        assert max(x["rows"] for x in leaves.values()) <= 100
        few = spark.createDataFrame([(i, 0) for i in range(3)], schema)
        near = keyed.touched({"few": (few, folder, leaves)})["few"]
        shares.append(len(folder.rows(leaves, near).inputFiles()) / len(folder.rows(leaves).inputFiles()))
    found = core.batches(spark, out).collect()
    assert sorted(r.k for r in found) == list(range(3300))
    first = {}
    for batch_id in range(6):
        for k in range(batch_id * 300, batch_id * 600 + 300):
            first.setdefault(k, batch_id)
    assert {r.k: r.v for r in found} == first
    assert shares[-1] < shares[0] / 3


def test_snapshot_versions(spark, rows):
    out = scratch(spark, "out")
    for batch_id in range(5):
        core.snapshot(out)(spark.range(batch_id + 1), batch_id)
    assert core.latest(spark, out).count() == 5 and core._versions(spark, out) == [3, 4]


def test_ingest_splits_types(spark):
    path, out, checkpoint = (scratch(spark, n) for n in ("topic", "out", "checkpoint"))
    documents = [
        {"object_id": "1", "object_type": "TRANSACTION", "sent_dttm": "2022-10-01T00:00:26", "payload": {"operation_id": "a", "amount": 62000, "status": "done"}},
        {"object_id": "2", "object_type": "CURRENCY", "sent_dttm": "2022-10-01T00:00:00", "payload": {"currency_code": 430, "currency_with_div": 1.1}},
        {"object_id": "3", "object_type": "OTHER", "payload": {}}]
    core.run_for(ingest.run(_land(spark, documents, path), out, checkpoint))
    transaction, currency = core.batches(spark, f"{out}/transaction").collect(), core.batches(spark, f"{out}/currency").collect()
    assert [(r.object_id, r.amount) for r in transaction] == [("1", 62000)]
    assert [(r.object_id, r.currency_with_div) for r in currency] == [("2", 1.1)]


RAW = {"object_id": 7, "object_type": "order", "sent_dttm": "2022-01-01 00:00:00", "payload": {
    "restaurant": {"id": "r"}, "date": "2022-01-01 10:00:00", "user": {"id": "u"}, "cost": 12.5, "payment": 10, "final_status": "CLOSED",
    "order_items": [{"id": "b", "name": "old", "price": 2.5, "quantity": 1}, {"id": "a", "name": "x", "price": 10, "quantity": 1}]}}


def test_order_chain(spark):
    """Raw message to enriched message to vault and counters, in two batches with a repeated order."""
    users = spark.createDataFrame([("u", "Ann", "ann")], "id string, name string, login string")
    shops = spark.createDataFrame([("r", "Rest", [("a", "Stew", "Main"), ("b", "Soup", "Soups")])],
                                  "id string, name string, menu array<struct<_id: string, name: string, category: string>>")
    raw_path, enrich_out, vault_out, count_out = (scratch(spark, n) for n in ("raw", "enrich", "vault", "count"))
    for round_, document in enumerate([RAW, {**RAW, "object_id": 8}]):
        topic = _land(spark, [document], raw_path)
        core.run_for(orders.run_enrich(topic, users, shops, enrich_out, f"{enrich_out}_cp"))
        messages = core.batches(spark, f"{enrich_out}/messages")
        assert messages.count() == round_ + 1
        stream = spark.readStream.schema("value string, batch_id int").option("recursiveFileLookup", "true").parquet(f"{enrich_out}/messages")
        core.run_for(orders.run_vault(spark, stream, vault_out, f"{vault_out}_cp", "2022-02-01 00:00:00"))
        compact = spark.readStream.schema("value string").option("recursiveFileLookup", "true").parquet(f"{vault_out}/messages")
        core.run_for(orders.run_counters(compact, counters.PRODUCT, count_out, f"{count_out}_cp"))
    document = json.loads(messages.orderBy("value").first().value)["payload"]
    assert [(p["id"], p["name"], p["category"]) for p in document["products"]] == [("b", "Soup", "Soups"), ("a", "Stew", "Main")]
    assert document["user"] == {"id": "u", "name": "Ann", "login": "ann"} and document["restaurant"]["name"] == "Rest"
    counts = {t: core.batches(spark, f"{vault_out}/{t}").count() for t in vault.TABLES}
    assert (counts["h_order"], counts["h_user"], counts["h_product"], counts["l_order_product"], counts["s_order_cost"]) == (2, 1, 2, 4, 2)
    current = orders.current_counters(spark, count_out, counters.PRODUCT).collect()
    assert sorted(r.order_cnt for r in current) == [2, 2]


def test_late_rows_are_dropped(spark):
    """A window that the watermark has closed takes no more rows."""
    path, out = scratch(spark, "in"), scratch(spark, "out")
    schema = "ts timestamp, sym string"

    def land(*moments):
        spark.createDataFrame([(m, "A") for m in moments], "m string, sym string").select(
            F.to_timestamp("m").alias("ts"), "sym").coalesce(1).write.mode("append").json(path)
        stream = spark.readStream.schema(schema).json(path)
        counted = windows.window_counts(stream, "ts", ["sym"], "10 minutes", delay="5 minutes")
        core.run_for(core.start_files(counted, out, f"{out}_cp"))

    land("2024-01-01 00:01:00", "2024-01-01 00:02:00")
    land("2024-01-01 01:00:00")
    land("2024-01-01 00:03:00", "2024-01-01 02:00:00")
    got = {str(r.window_start): r.cnt for r in spark.read.parquet(out).collect()}
    assert got["2024-01-01 00:00:00"] == 2


def test_interval_join_on_slot_borders(spark, rows):
    left = spark.createDataFrame([(1, "2024-01-01 00:59:59", "a")], "k int, t string, l string").withColumn("lt", F.to_timestamp("t")).drop("t")
    right = spark.createDataFrame([(1, "2024-01-01 01:59:59", "in"), (1, "2024-01-01 02:00:00", "late"), (1, "2024-01-01 00:59:58", "before"),
                                   (2, "2024-01-01 01:00:00", "other")], "k int, t string, r string").withColumn("rt", F.to_timestamp("t")).drop("t")
    assert rows(windows.interval_join(left, right, "k", "lt", "rt", "1 hour"), "l", "r") == [("a", "in")]


def test_interval_join_keeps_unmatched_rows(spark, rows):
    left = spark.createDataFrame([(1, "2024-01-01 00:00:00", "a"), (2, "2024-01-01 00:00:00", "b")], "k int, t string, l string").withColumn(
        "lt", F.to_timestamp("t")).drop("t")
    right = spark.createDataFrame([(1, "2024-01-01 00:30:00", "x")], "k int, t string, r string").withColumn("rt", F.to_timestamp("t")).drop("t")
    got = windows.interval_join(left, right, "k", "lt", "rt", "1 hour", how="left_outer")
    assert rows(got, "l", "r") == [("a", "x"), ("b", None)]


@pytest.mark.parametrize("how", ["inner", "left_outer", "left_semi", "right_outer", "full_outer"])
def test_interval_join_kinds(spark, rows, how):
    moments = [0, 1, 1799, 3599, 3600, 3601, 5400, 7199, 7200, 10800, 14401]
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("s"))
    left = spark.createDataFrame([(k, s) for k in (1, 2) for s in moments], "k int, s int").select("k", F.col("s").alias("l"), at.alias("lt"))
    right = spark.createDataFrame([(1, s) for s in (3599, 3600, 7200, 18000)] + [(3, 0)], "k int, s int").select("k", F.col("s").alias("r"), at.alias("rt"))
    got = windows.interval_join(left, right, "k", "lt", "rt", "1 hour", how=how)
    other = right.withColumnRenamed("k", "j")
    want = left.join(other, (left.k == other.j) & (other.rt >= left.lt) & (other.rt <= left.lt + F.expr("INTERVAL 1 HOUR")), how)
    cols = ["k", "l"] if how == "left_semi" else ["l", "r"]
    assert rows(got, *cols) == rows(want, *cols)


def test_text_stream_words(spark, rows):
    """Text files one per batch, counted in complete mode; the run is bounded and reports its progress."""
    path, out = scratch(spark, "text"), scratch(spark, "counts")
    for line in ("one two", "two three"):
        spark.createDataFrame([(line,)], "text string").coalesce(1).write.mode("append").text(path)
    stream = files.stream_files(spark, path, "text string", "text", max_files=1)
    progress = core.run_for(core.start(windows.word_counts(stream, "text"), core.snapshot(out), f"{out}_cp", "complete"), 120)
    assert rows(core.latest(spark, out)) == [("one", 1), ("three", 1), ("two", 2)]
    assert sum(p["numInputRows"] for p in progress) == 2
    core.run_for(core.start_console(stream, f"{out}_console"))


def test_progress_and_trigger():
    assert core.trigger_options("15 seconds") == {"processingTime": "15 seconds"}
    assert core.trigger_options() == {"availableNow": True}
