"""What is on disk while a query runs: shuffle files that go, one shuffle where one is enough, tables written once."""

from __future__ import annotations

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_vault_build import _tables

from driver_queries import vaults
from martworks.operators import joins, keyed
from martworks.session import AS_THEY_LIE, Copies, scratch, tidy_shuffles
from martworks.streaming import core, orders


def _shuffled(spark):
    """Bytes of shuffle files by name."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    found = iter(lambda: files.next() if files.hasNext() else None, None)
    return {f.getName(): f.length() for f in found if f.getName().startswith("shuffle_") and f.getName().endswith(".data")}


def _left(spark, before):
    return sum(n for name, n in _shuffled(spark).items() if name not in before)


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_copies_leave_no_shuffle_files_and_go(spark):
    before, copies = _shuffled(spark), Copies(spark)
    kept = copies.add(spark.range(100).repartition(3, "id"), "copy")
    assert _left(spark, before) == 0 and kept.count() == 100
    path, = copies.paths
    assert keyed.exists(spark, path)
    copies.drop()
    assert not keyed.exists(spark, path)


def test_batches_of_keys_leave_no_shuffle_files(spark, tmp_path):
    before = _shuffled(spark)
    for batch in (0, 1):
        keyed.add_unseen({"t": (spark.range(batch * 5000, batch * 5000 + 10000).toDF("k").distinct(), str(tmp_path / "t"), ["k"])}, batch, split_rows=4000)
    # Only the lists of buckets and their counts, not the rows.
    assert _left(spark, before) < 10_000
    assert keyed.read(spark, str(tmp_path / "t")).count() == 15000


def test_settings_come_back(spark):
    name, = AS_THEY_LIE
    before = spark.conf.get(name, None)
    with pytest.raises(ZeroDivisionError), tidy_shuffles(spark, **AS_THEY_LIE):
        assert spark.conf.get(name) == "false"
        1 / 0
    assert spark.conf.get(name, None) == before


@pytest.mark.parametrize("unique", [True, False])
def test_rows_meet_known_keys_where_they_are_placed(spark, tmp_path, unique):
    rows = spark.createDataFrame([(None if i == 7 else i % 60, f"v{i % 60}") for i in range(80)], "k int, v string")
    known = spark.createDataFrame([(i if i else None, "old") for i in range(30)], "k int, v string")
    folder = keyed.KeyedFolder(spark, str(tmp_path / "t"), ["k"], rows.schema)
    leaves = {64 + i: {"rows": 0, "folders": []} for i in range(64)}
    with tidy_shuffles(spark, **AS_THEY_LIE, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        found = folder.placed(rows, leaves, known, unique)
        assert _exchanges(found) == 2
        got = sorted(r.k for r in found.collect())
    # Null is known; 0 is not, and neither are 30 to 59.
    assert (got if not unique else sorted(set(got))) == [0, *range(30, 60)]


def test_an_empty_table_begins_with_the_buckets_it_needs(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sink = keyed.first_seen(path, ["k"], lambda b: b, few_repeats=True, split_rows=20)
    for batch, first in enumerate((0, 0, 50)):
        sink(spark.range(first, first + 100).select(F.explode(F.array("id", "id")).alias("k")), batch)
    folder = keyed.KeyedFolder(spark, path, ["k"], spark.range(1).toDF("k").schema)
    assert all(i >= 0 for x in folder.leaves(before=1).values() for i in x["folders"])
    assert rows(keyed.read(spark, path)) == [(i,) for i in sorted(range(150), key=lambda i: repr((i,)))]
    assert [len(folder.ready(n)) for n in (0, 1_000_000, 1_000_001, 4_000_000, 4_000_001)] == [1, 1, 4, 8, 16]


def test_passes_over_the_buckets_write_all_rows_once(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "PASS_ROWS", 10)
    modes, plain = [], keyed.KeyedFolder.placed

    def placed(*args):
        modes.append(args[-1])
        return plain(*args)
    monkeypatch.setattr(keyed.KeyedFolder, "placed", placed)
    path = str(tmp_path / "t")
    sink = keyed.first_seen(path, ["k"], lambda b: b, few_repeats=True, split_rows=20)
    for batch, first in enumerate((0, 50, 50, 120)):
        for _ in range(1 + (batch == 1)):  # a batch that is run again changes nothing
            some = spark.range(first, first + 100).select(F.when(F.col("id") != 60, F.col("id")).alias("k"))
            sink(some.unionByName(some), batch)
    assert (7, 8) in modes
    assert rows(keyed.read(spark, path)) == sorted([(i if i != 60 else None,) for i in range(220)], key=repr)


def test_names_are_looked_up_before_lists_are_sent(spark):
    raw = spark.createDataFrame([(1, ("r",), ("u",), [("1", 2), ("9", 1)]), (2, ("q",), ("x",), [("1", 1)])],
                                "object_id long, restaurant struct<id: string>, user struct<id: string>, order_items array<struct<id: string, quantity: int>>")
    raw = raw.select("object_id", F.struct("restaurant", "user", "order_items", *[F.lit(None).cast("string").alias(c) for c in ("date", "cost", "payment", "final_status")],
                                           F.lit(None).cast("string").alias("update_ts"), F.lit(None).cast("string").alias("statuses")).alias("payload"))
    users = spark.createDataFrame([("u", "name", "login")], "id string, name string, login string")
    shops = spark.createDataFrame([("r", "shop", [("1", "a", "c"), ("1", "b", "d")])], "id string, name string, menu array<struct<_id: string, name: string, category: string>>")
    with tidy_shuffles(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        found = orders.enriched(raw, users, shops)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert not any("Exchange" in line and "_list" in line for line in plan.splitlines())
        sent = [line for line in plan.splitlines() if "hashpartitioning(_uid" in line or "hashpartitioning(_rid" in line]
        assert sent and not any("_list" in x or "order_items" in x for x in sent)
        # The join to the names comes before the one to the lists, which is the outermost.
        joined = [line for line in plan.splitlines() if "SortMergeJoin" in line]
        assert "object_id" in joined[0] and any("_uid" in x for x in joined[1:])
        got = {r.object_id: (r.payload.restaurant.name, r.payload.user.login, r.payload.products) for r in found.collect()}
    assert got[1][:2] == ("shop", "login") and [(p.id, p.quantity, p.name, p.category) for p in got[1][2]] == [("1", 2, "a", "c")]
    assert got[2] == (None, None, None)


def test_stored_menus_are_read_in_small_groups(spark, tmp_path, monkeypatch):
    t = _tables(spark, tmp_path)
    monkeypatch.setattr(vaults, "MENU_BYTES", 1 << 10)
    n = 400
    t.lineitem = spark.range(n).select("id", *[F.col("id").alias(c) for c in ("l_orderkey", "l_partkey", "l_suppkey")], F.lit(1.0).alias("l_quantity"), F.lit(1.0).alias("l_extendedprice"))
    t.part = spark.range(n).select(F.col("id").alias("p_partkey"), F.concat(F.lit("p"), "id").alias("p_name"), F.concat(F.lit("t"), "id").alias("p_type"))
    t.supplier = spark.range(n).select(F.col("id").alias("s_suppkey"), F.concat(F.lit("s"), "id").alias("s_name")).coalesce(1)
    shops = vaults.shop_lookup(t)
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in shops.inputFiles()]
    assert max(m.row_group(i).num_rows for m in groups for i in range(m.num_row_groups)) < 200
    assert {(r.id, r.menu[0].name) for r in shops.collect()} == {(str(i), f"p{i}") for i in range(n)}


def test_a_batch_kept_on_disk_is_not_in_memory(spark):
    seen = []
    out = scratch(spark, "fan_out")
    write = core.batch_folder(out)
    core.fan_out(write, lambda b, i: seen.append((b.storageLevel.useMemory, b.count())), on_disk=True)(spark.range(5).toDF("k"), 0)
    assert seen == [(False, 5)] and core.batches(spark, out).count() == 5


def test_repeated_menu_entries_keep_the_first(spark):
    df = spark.createDataFrame([(1, "o", [("1", 5)])], "k int, o string, items array<struct<id: string, n: int>>")
    menus = spark.createDataFrame([("o", [("1", "first"), ("1", "again")])], "id string, menu array<struct<_id: string, name: string>>")
    got = joins.array_lookup(df, "k", F.col("o"), "items", menus, "id", "menu", take=("name",)).first()
    assert [(p.id, p.n, p.name) for p in got.products] == [("1", 5, "first")]


def test_counters_count_stored_lines(spark, tmp_path):
    plan = vaults._lines(_tables(spark, tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "FileScan parquet [l_" not in plan


def test_lines_are_stored_between_their_lookup_and_their_lists(spark):
    df = spark.createDataFrame([(1, "o", [("1", 5), ("2", 6)]), (2, "p", None)], "k int, o string, items array<struct<id: string, n: int>>")
    menus = spark.createDataFrame([("o", [("1", "a"), ("2", "b")])], "id string, menu array<struct<_id: string, name: string>>")
    copies = Copies(spark)
    found = joins.array_lookup(df, "k", F.col("o"), "items", menus, "id", "menu", take=("name",), copies=copies)
    assert len(copies.paths) == 1 and "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r.k: r.products and [tuple(p) for p in r.products] for r in found.collect()} == {1: [("1", 5, "a"), ("2", 6, "b")], 2: None}
    copies.drop()
