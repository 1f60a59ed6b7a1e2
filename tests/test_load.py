"""Load, dedup, grouping, join and quality operators on small cases; loads run twice give the same target."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martworks.operators import dedup, groups, joins, keyed, load, quality
from martworks.session import cut_lineage, scratch, shared_dir
from martworks.sources import files, jdbc, sinks


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, s string, v int")


def test_insert_new(spark, target, rows):
    src = spark.createDataFrame([(2, "b", 5), (3, "c", 6), (3, "c", 9), (None, "n", 1)], "k int, s string, v int")
    got = load.insert_new(target, src, ["k", "s"], {"v": F.max("v")})
    assert rows(got) == [(3, "c", 9)]
    assert load.insert_new(target.unionByName(got), src, ["k", "s"], {"v": F.max("v")}).count() == 0


def test_insert_ignore(spark, target, rows):
    src = spark.createDataFrame([(2, "x", 5), (3, "c", 6), (3, "a", 9)], "k int, s string, v int")
    fresh = load.insert_ignore(target, src, "k")
    assert rows(fresh) == [(3, "a", 9)]
    assert load.insert_ignore(target.unionByName(fresh), src, "k").count() == 0


def test_upsert(spark, target, rows):
    src = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 3)], "k int, s string, v int")
    once = load.upsert(target, src, ["k"], newest=["v"])
    assert rows(once) == [(1, "a", 10), (2, "y", 2), (3, "z", 3)]
    assert rows(load.upsert(once, src, ["k"], newest=["v"])) == rows(once)


def test_upsert_some_columns(spark, target, rows):
    src = spark.createDataFrame([(2, None, 2), (3, "z", 3)], "k int, s string, v int")
    assert rows(load.upsert(target, src, ["k"], update_cols=["s"])) == [(1, "a", 10), (2, None, 20), (3, "z", 3)]


def test_update_matched_writes_nulls(spark, target, rows):
    src = spark.createDataFrame([(2, None), (9, 9)], "k int, v int")
    assert rows(load.update_matched(target, src, ["k"], ["v"])) == [(1, "a", 10), (2, "b", None)]


def test_replace_partition_twice(spark, rows):
    path = scratch(spark, "t")
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "v int, p string")
    load.replace_partition(df, path, ["p"])
    new = spark.createDataFrame([(9, "a")], "v int, p string")
    for _ in range(2):
        load.replace_partition(new, path, ["p"])
        assert rows(spark.read.parquet(path), "v", "p") == [(3, "b"), (9, "a")]


def test_merge_partitions_twice(spark, rows):
    path = scratch(spark, "m")
    load.replace_partition(spark.createDataFrame([(1, 1, "a"), (2, 1, "a"), (3, 1, "b")], "k int, v int, p string"), path, ["p"])
    src = spark.createDataFrame([(2, 5, "a"), (4, 6, "a"), (5, 7, "c")], "k int, v int, p string")
    for _ in range(2):
        load.merge_partitions(spark, path, src, ["k"], ["p"])
        assert rows(spark.read.parquet(path), "k", "v", "p") == [(1, 1, "a"), (2, 5, "a"), (3, 1, "b"), (4, 6, "a"), (5, 7, "c")]


def test_increment(spark, rows):
    marks = spark.createDataFrame([], "workflow_key string, workflow_settings string")
    src = spark.createDataFrame([(1, "2022-01-01 00:00:00"), (2, "2022-01-02 00:00:01")], "k int, t string").withColumn("t", F.to_timestamp("t"))
    fresh, mark = load.load_increment(src, marks, "w", "t")
    assert fresh.count() == 2
    marks = marks.unionByName(mark)
    assert load.load_increment(src, marks, "w", "t")[0].count() == 0
    later = src.unionByName(spark.createDataFrame([(3,)], "k int").withColumn("t", F.to_timestamp(F.lit("2022-02-01 00:00:00"))))
    assert rows(load.load_increment(later, marks, "w", "t")[0], "k") == [(3,)]


def test_lookback_into_empty_target(spark):
    src = spark.createDataFrame([(1, "2022-01-01")], "k int, d string").withColumn("d", F.to_timestamp("d"))
    assert load.load_lookback(src.limit(0), src, ["k"], "d").count() == 1


def test_hash_diff(spark, target, rows):
    src = spark.createDataFrame([(1, "a", 10), (1, "a", None), (1, "a", None), (2, "b", 21)], "k int, s string, v int")
    fresh = load.hash_diff(target, src)
    assert rows(fresh) == [(1, "a", None), (2, "b", 21)]
    assert load.hash_diff(target.unionByName(fresh), src).count() == 0


def test_number_new(spark, rows):
    known = spark.createDataFrame([(5, 1), (6, 7)], "k int, id bigint")
    new = spark.createDataFrame([(i,) for i in (9, 5, 8, 7)], "k int")
    assert rows(load.number_new(known, new, "k"), "k", "id") == [(7, 8), (8, 9), (9, 10)]
    assert rows(load.number_new(known.limit(0), new, "k"), "k", "id") == [(5, 1), (7, 2), (8, 3), (9, 4)]


def test_calendar_and_column(spark):
    empty = spark.createDataFrame([], "ts timestamp")
    moments = spark.createDataFrame([("2022-01-01 10:00:00.5",), ("2022-01-01 10:00:00.7",)], "m string").withColumn("m", F.to_timestamp("m"))
    fresh = load.new_calendar(empty, moments, "m")
    row = fresh.first()
    assert fresh.count() == 1 and (row.year, row.month, row.day, row.time) == (2022, 1, 1, "10:00:00")
    assert load.new_calendar(fresh.select("ts"), moments, "m").count() == 0
    df = spark.createDataFrame([(1, None), (2, "refunded")], "k int, status string")
    assert [r.status for r in load.add_column(df, "status", "shipped").orderBy("k").collect()] == ["shipped", "refunded"]


def test_not_in_follows_sql(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    some, none = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([], "x int")
    assert rows(joins.not_in(df, "k", some, "x")) == [(2,)]
    assert joins.not_in(df, "k", spark.createDataFrame([(1,), (None,)], "x int"), "x").count() == 0
    assert joins.not_in(df, "k", none, "x").count() == 3


def test_pairs(spark, rows):
    df = spark.createDataFrame([(1, 2), (2, 1), (3, 1)], "a int, b int")
    assert rows(dedup.unique_pairs(df, "a", "b")) == [(1, 2), (1, 3)]
    known = spark.createDataFrame([(3, 1)], "f int, t int")
    assert rows(joins.without_pairs(dedup.unique_pairs(df, "a", "b"), known, "a", "b", "f", "t")) == [(1, 2)]


@pytest.mark.parametrize("part_rows", [None, 10])
def test_lists_of_equal_length_whatever_the_ids(spark, part_rows):
    df = spark.range(500).select(F.when(F.col("id") % 5 > 0, 1).alias("k"), F.xxhash64("id").alias("h"), "id")
    got = groups.collect_parts(df, ["k"], F.struct("h", "id"), "items", "h", 30, part_rows).orderBy("k", "part").collect()
    assert [(r.k, r.part, len(r["items"])) for r in got] == [(None, i, 30) for i in range(3)] + [(None, 3, 10)] + \
        [(1, i, 30) for i in range(13)] + [(1, 13, 10)]
    hashes = [x.h for r in got if r.k == 1 for x in r["items"]]
    assert hashes == sorted(hashes)


@pytest.mark.parametrize("ids", [9, 1000])
def test_collect_parts_keeps_everything(spark, ids):
    df = spark.createDataFrame([(1 if i % 3 else 2, i) for i in range(60)], "k int, v int")
    got = groups.collect_parts(df, ["k"], F.col("v"), "vs", "v", ids).collect()
    assert sorted(v for r in got for v in r.vs) == list(range(60))
    assert len(got) == (2 if ids == 1000 else 8)
    assert all(r.vs == sorted(r.vs) and len(r.vs) <= ids for r in got)


def test_array_lookup_order_and_missing(spark):
    orders = spark.createDataFrame([(1, "r", [("b", 1), ("a", 2), ("zz", 3)]), (2, "r", [])],
                                   "o int, rest string, items array<struct<id: string, q: int>>")
    menus = spark.createDataFrame([("r", [("a", "Apple", "fruit"), ("b", "Beet", "veg"), ("b", "Second", "veg")])],
                                  "id string, menu array<struct<_id: string, name: string, category: string>>")
    got = {r.o: r.products for r in joins.array_lookup(orders, "o", F.col("rest"), "items", menus, "id", "menu").collect()}
    assert [(p.id, p.q, p.name) for p in got[1]] == [("b", 1, "Beet"), ("a", 2, "Apple")] and not got[2]


def test_gate_and_quarantine(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, None)], "k int, v int")
    rules = {"positive": F.col("v") > 0, "known": F.col("k") > 0}
    assert quality.gate(df, rules).first().passed == 0
    assert quality.gate(df.where("k = 1"), rules).first().passed == 1
    good, bad = quality.split_valid(df, rules)
    assert rows(good, "k") == [(1,)] and rows(bad, "k", "broken_rules") == [(2, ["positive"]), (3, ["positive"])]
    assert rows(quality.rule_counts(df, rules)) == [("known", 0), ("positive", 2)]
    with pytest.raises(quality.GateError, match="positive"):
        quality.require(df, rules)
    assert quality.require(df.where("k = 1"), rules).count() == 1


def test_checks_and_log(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (3,)], "c int")
    value = quality.value_check(df, F.countDistinct("c"), 3, 0.01)
    assert (value.first().value, value.first().passed) == (3, 1)
    assert quality.log_rows(value, "t", "n", "2024-01-01").first().check_result == 0
    failed = quality.no_nulls(spark.createDataFrame([(None,)], "c int"), ["c"])
    assert quality.log_rows(failed, "t", "n", "2024-01-01").first().check_result == 1
    assert quality.duplicates(df, ["c"]).first().c == 3
    parent = spark.createDataFrame([(1,)], "p int")
    child = spark.createDataFrame([(1,), (2,), (None,)], "c int")
    assert [r.c for r in quality.orphans(child, "c", parent, "p").collect()] == [2]


def test_presence_of_files(spark, rows):
    path = scratch(spark, "files")
    spark.range(1).write.csv(f"{path}/user_order_log")
    names = files.list_files(spark, path, "*.csv").select(F.element_at(F.split("path", "/"), -2).alias("file_name"))
    expected = spark.createDataFrame([("user_order_log",), ("price_log",)], "file_name string")
    assert rows(quality.presence(expected, names)) == [("price_log", 0), ("user_order_log", 1)]


def test_event_pruning(spark):
    path = scratch(spark, "lake")
    df = spark.createDataFrame([(k, f"2022-05-{d:02d}") for k in ("message", "reaction", "other") for d in range(20, 31)],
                               "event_type string, date string").withColumn("date", F.to_date("date")).withColumn("x", F.lit(1))
    sinks.write_partitioned(df, path, ["event_type", "date"])
    got = files.read_events(spark, path, "2022-05-30", 5, ("message", "reaction"))
    assert got.count() == 10 and files.read_events(spark, path).count() == 22
    plan = got._jdf.queryExecution().toString()
    assert "DataFilters: []" in plan and "PartitionFilters: []" not in plan


def test_checkpoint_lives_in_the_shared_folder(spark):
    assert scratch(spark, "x").startswith(shared_dir(spark))
    assert cut_lineage(spark.range(5)).count() == 5


def test_jdbc_partition_options(spark):
    with pytest.raises(Exception, match="(?i)driver|suitable"):
        jdbc.read_jdbc(spark, "jdbc:none://x", "t", {}, ("id", 0, 10, 2))


def test_update_matched_with_repeated_keys(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    src = spark.createDataFrame([(1, "x", 2), (1, "y", 1), (3, "z", 1)], "k int, v string, n int")
    assert rows(load.update_matched(target, src, ["k"], ["v"], newest=["n"])) == [(1, "x"), (2, "b")]
    assert rows(load.update_matched(target, src, ["k"], ["v"])) == [(1, "y"), (2, "b")]


def test_lookup_hints_by_size(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "dim"))
    dim, facts = spark.read.parquet(str(tmp_path / "dim")), spark.range(10)
    plans = {n: joins.lookup(facts, dim, ["id"], max_bytes=n)._jdf.queryExecution().optimizedPlan().toString() for n in (0, 1 << 20)}
    assert "broadcast" not in plans[0] and "strategy=broadcast" in plans[1 << 20]


@pytest.mark.parametrize("overlapping", [False, True])
@pytest.mark.parametrize("joined", [0, 100])
def test_valid_at(spark, rows, overlapping, joined):
    spans = [(1, i * 10, i * 10 + (13 if overlapping else 7), f"v{i}") for i in range(40)] + [(2, 5, 5, "empty"), (2, 9, 3, "turned"), (None, 0, 99, "n")]
    dim = spark.createDataFrame(spans, "k int, active_from int, active_to int, name string")
    facts = [(1, t, t) for t in range(0, 420, 3)] + [(2, 5, -1), (None, 5, -2), (1, None, -3), (3, 5, -4)]
    got = joins.valid_at(spark.createDataFrame(facts, "k int, t int, id int"), dim, "k", "t", joined_versions=joined, part_rows=11)
    want = [(f[2], s[3]) for f in facts for s in spans if None not in (f[0], f[1], s[0]) and f[0] == s[0] and s[1] <= f[1] < s[2]]
    assert rows(got, "id", "name") == sorted(want, key=repr)
    assert got.columns == ["k", "t", "id", "active_from", "active_to", "name"]


def test_keyed_merges_read_few_files(spark, rows):
    path = scratch(spark, "keyed")
    table = {(None if k % 50 == 7 else k): k for k in range(1000)}
    keyed.merge(spark.createDataFrame([(k, v) for k, v in table.items()], "k int, v int"), path, ["k"], split_rows=60)
    for step, insert in enumerate([True, False, True, False, True]):
        src = [(k, -step * 100 - i) for i, k in enumerate([3, 500, None, 999, 2000 + step])] + [(3, -9000 - step)]
        keyed.merge(spark.createDataFrame(src, "k int, v int"), path, ["k"], ["v"], insert, split_rows=60, many_folders=3)
        for k, v in src[:0:-1][::-1] + [src[0]]:
            if insert or k in table:
                table[k] = v
        assert rows(keyed.read(spark, path)) == sorted(table.items(), key=repr)
    folder = keyed.KeyedFolder(spark, path, ["k"], spark.createDataFrame([], "k int, v int, _merge int").schema)
    leaves = folder.leaves()
    near = keyed.touched({"few": (spark.createDataFrame([(3, 0, 0)], "k int, v int, _merge int"), folder, leaves)})["few"]
    assert len(folder.rows(leaves, near).inputFiles()) * 5 < len(folder.rows(leaves).inputFiles())
