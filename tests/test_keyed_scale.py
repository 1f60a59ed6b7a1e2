"""Tables by key: files written, and joins left out."""

from __future__ import annotations

from pyspark.sql import functions as F

from martworks.operators import keyed


def test_a_folder_has_about_as_many_files_as_buckets(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 8).toDF("k")
    folder = keyed.KeyedFolder(spark, str(tmp_path / "t"), ["k"], rows.schema)
    leaves = {64 + i: {"rows": 0, "folders": []} for i in range(64)}
    folder.write(rows, 0, leaves)
    assert len(list((tmp_path / "t").rglob("*.parquet"))) <= 64
    assert {r["_bucket"]: r["n"] for r in folder._written(0).collect()} == {
        r["b"]: r["n"] for r in rows.groupBy(folder.bucket(leaves).alias("b")).agg(F.count("*").alias("n")).collect()}


def test_a_few_large_buckets_are_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 1).toDF("k")
    folder = keyed.KeyedFolder(spark, str(tmp_path / "t"), ["k"], rows.schema)
    folder.write(rows, 0, {2: {"rows": 0, "folders": []}, 3: {"rows": 0, "folders": []}})
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4000


def test_buckets_of_different_depth(spark):
    rows = spark.range(2000).toDF("k")
    leaves = {b: {} for b in (2, 6, 14, *range(60, 64))}
    found = {r["b"]: r["n"] for r in rows.groupBy(keyed.bucket_of(["k"], leaves).alias("b")).agg(F.count("*").alias("n")).collect()}
    assert set(found) == set(leaves) and sum(found.values()) == 2000
    top = F.shiftrightunsigned(F.xxhash64("k"), 58)
    assert found[2] == rows.where(top < 32).count() and found[61] == rows.where(F.shiftright(top, 1) == 29).count()


def test_an_empty_table_is_not_joined_to(spark, tmp_path, monkeypatch):
    def joined(*_):
        raise AssertionError("joined")
    monkeypatch.setattr(keyed, "with_keys", joined)
    keyed.add_unseen({"t": (spark.range(10).toDF("k"), str(tmp_path / "t"), ["k"])}, 0)
    assert keyed.read(spark, str(tmp_path / "t")).count() == 10


def test_new_keys_of_a_table_of_several_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch, first in enumerate((0, 50, 50)):
        rows = spark.range(first, first + 100).select(F.when(F.col("id") != 60, F.col("id")).alias("k"))
        keyed.add_unseen({"t": (rows, path, ["k"])}, batch, split_rows=20)
    assert sorted(-1 if r.k is None else r.k for r in keyed.read(spark, path).collect()) == [-1, *range(60), *range(61, 150)]
