"""Window operators against plain windows, with keys in one part and in many."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window as W, functions as F

from martworks.operators import windows
from martworks.operators.joins import as_of
from martworks.operators.skew import cut, numbered


@pytest.fixture(scope="module")
def log(spark):
    """One user holds a third of the rows; moments repeat."""
    rng = random.Random(7)
    start = dt.datetime(2024, 1, 1)
    data = []
    for i in range(900):
        user = 1 if i % 3 == 0 else rng.randint(2, 60)
        data.append((user, start + dt.timedelta(minutes=rng.randint(0, 3000)), i, rng.choice("ABC"),
                     rng.choice([None, rng.randint(1, 9)])))
    return spark.createDataFrame(data, "user int, ts timestamp, id int, city string, v int").cache()


SPANS = [25, None]  # rows of a part: some thirty parts, and one


@pytest.mark.parametrize("order", [["ts", "id"], ["id"], ["city", "v", "id"], ["share"], ["text"], ["hashed"], ["day", "id"], ["odd", "id"]])
@pytest.mark.parametrize("down", [False, True])
def test_parts_are_even_and_follow_the_order(log, order, down):
    """Whatever the values are: shares of one, texts of one beginning, 64-bit hashes, NaN and null."""
    rows = log.withColumns({
        "share": F.col("id") / 1e6, "text": F.format_string("https://a.example/%05d", "id"), "hashed": F.xxhash64("id"),
        "day": F.to_date("ts"), "odd": F.when(F.col("id") % 3 > 0, F.when(F.col("id") % 3 > 1, float("nan")).otherwise(1.0))})
    made = cut(rows, ["user"], order, (order[0],) if down else (), 50)
    sort = [F.desc(order[0]) if down else F.asc(order[0]), *[F.asc(c) for c in order[1:]]]
    parts = [r[0] for r in made.rows.orderBy("user", *sort).select(made.part).collect()]
    assert parts == sorted(parts)
    sizes = [parts.count(p) for p in set(parts)]
    assert len(sizes) > 12 and max(sizes) < 3 * 50


def test_many_parts_need_few_tasks(spark, log):
    """The sample's ranges are tasks, and the driver gets rows of each of them: there are far fewer than parts."""
    context = spark.sparkContext
    context.setJobGroup("many parts", "")
    made = cut(log, ["user"], ["ts", "id"], part_rows=3)
    context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("many parts") for s in tracker.getJobInfo(j).stageIds]
    assert max(i.numTasks for i in map(tracker.getStageInfo, stages) if i) < 50
    sizes = [r["count"] for r in made.rows.groupBy(made.part).count().collect()]
    assert len(sizes) > 200 and max(sizes) <= 6 and sum(sizes) == 900


def test_numbered(spark, rows):
    df = spark.createDataFrame([(f"k{i * 7 % 100:03d}", i) for i in range(100)] + [(None, 100)], "k string, v int").repartition(5)
    got = {r.k: r.n for r in numbered(df, ["k", "v"], "n").collect()}
    assert got == {None: 1, **{f"k{i:03d}": i + 2 for i in range(100)}}


@pytest.mark.parametrize("span", SPANS)
def test_shifted(log, rows, span):
    w = W.partitionBy("user").orderBy("ts", "id")
    want = log.withColumns({"p": F.lag("city", 1).over(w), "p3": F.lag("v", 3).over(w), "n": F.lead("city", 1).over(w),
                            "n2": F.lead("v", 2).over(w)})
    got = windows.shifted(log, ["user"], ["ts", "id"], {"p": ("city", -1), "p3": ("v", -3), "n": ("city", 1), "n2": ("v", 2)}, span)
    cols = ["id", "p", "p3", "n", "n2"]
    assert rows(got, *cols) == rows(want, *cols)


@pytest.mark.parametrize("span", SPANS)
def test_running_sum(log, rows, span):
    w = W.partitionBy("user").orderBy("ts").rangeBetween(W.unboundedPreceding, 0)
    want = log.withColumn("s", F.sum("id").over(w))
    assert rows(windows.running_sum(log, ["user"], ["ts"], "id", "s", span), "id", "s") == rows(want, "id", "s")


@pytest.mark.parametrize("span", SPANS)
def test_carry_forward(log, rows, span):
    w = W.partitionBy("user").orderBy("ts", "id").rowsBetween(W.unboundedPreceding, 0)
    want = log.withColumn("last", F.last("v", ignorenulls=True).over(w))
    got = windows.carry_forward(log, ["user"], ["ts", "id"], {"last": "v"}, span)
    assert rows(got, "id", "last") == rows(want, "id", "last")


@pytest.mark.parametrize("span", SPANS)
@pytest.mark.parametrize("down", [False, True])
def test_ranked(log, rows, span, down):
    w = W.partitionBy("user").orderBy(F.desc("ts") if down else F.asc("ts"))
    want = log.withColumn("r", F.rank().over(w))
    assert rows(windows.ranked(log, ["user"], ["ts"], "r", down, part_rows=span), "id", "r") == rows(want, "id", "r")


def test_ranked_whole_frame(log, rows):
    got = windows.ranked(log, [], ["id"], "n", unique=True)
    assert rows(got, "id", "n") == sorted([(i, i + 1) for i in range(900)], key=repr)


def test_null_order_values(spark, rows):
    df = spark.createDataFrame([(1, None, i) for i in range(10)] + [(1, i, 100 + i) for i in range(30)], "k int, o int, id int")
    w = W.partitionBy("k").orderBy("o", "id")
    want = df.withColumn("p", F.lag("id").over(w))
    assert rows(windows.shifted(df, ["k"], ["o", "id"], {"p": ("id", -1)}, 4), "id", "p") == rows(want, "id", "p")


@pytest.mark.parametrize("span", [1, None])
@pytest.mark.parametrize("tie", ["id", "none"])
def test_runs(spark, rows, span, tie):
    cities = ["A", "A", "B", "A"]
    df = spark.createDataFrame([(7, c, dt.datetime(2024, 1, 1 + i), i) for i, c in enumerate(cities)],
                               "user int, city string, ts timestamp, id int").withColumn("none", F.lit(None).cast("int"))
    got = windows.runs(df, "user", "city", "ts", tie, part_rows=span)
    assert rows(got, "run_no", "city", "events", "days") == [(1, "A", 2, 1), (2, "B", 1, 0), (3, "A", 1, 0)]
    assert windows.runs(df, "user", "city", "ts", "id", min_days=1).count() == 1


def test_runs_agree_between_spans(log, rows):
    cols = ["user", "run_no", "city", "run_start", "run_end", "events", "days"]
    assert rows(windows.runs(log, "user", "city", "ts", "id", part_rows=40), *cols) == \
        rows(windows.runs(log, "user", "city", "ts", "id"), *cols)


@pytest.mark.parametrize("span", [3, None])
def test_funnel(spark, rows, span):
    pages = ["/product/1", "/cart", "/payment", "/confirmation", "/product/2", "/cart", "/home", "/product/3", "/cart", "/payment"]
    df = spark.createDataFrame([(1, i, p) for i, p in enumerate(pages)], "u int, ts int, page string")
    got = windows.funnel(df, "u", ["ts"], "page", F.col("page").startswith("/product"),
                         ["/cart", "/payment", "/confirmation"], span)
    assert rows(got, "ts", "page") == [(0, "/product/1")]


@pytest.mark.parametrize("span", [2, None])
def test_running_sum_with_nulls_and_fractions(spark, rows, span):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([None, 5.1, None, None, 6.2, None, 0.1])], "k int, o int, v double")
    got = windows.running_sum(df, ["k"], ["o"], "v", "s", span)
    assert [r.s for r in got.orderBy("o").collect()] == [None, 5.1, 5.1, 5.1, 11.3, 11.3, 11.4]


def test_top1_and_top_n(log, rows):
    w = W.partitionBy("user").orderBy(F.desc("ts"), F.desc("id"))
    want = log.withColumn("rn", F.row_number().over(w))
    assert rows(windows.top1(log, ["user"], ["ts", "id"]), "user", "id") == rows(want.where("rn = 1"), "user", "id")
    got = windows.top_n(log, ["user"], [F.desc("ts"), F.desc("id")], 5)
    assert rows(got, "id") == rows(want.where("rn <= 5"), "id")


def test_with_stats_null_key(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 5)], "k int, v int")
    assert rows(windows.with_stats(df, ["k"], s=F.sum("v")), "k", "v", "s") == [(1, 5, 5), (None, 1, 3), (None, 2, 3)]


@pytest.mark.parametrize("span", SPANS)
def test_as_of(spark, log, span):
    left = log.where("city = 'A'").select("user", "ts", "id")
    right = log.where("city = 'B'")
    got = {r.id: r.last_v for r in as_of(left, right, "user", "ts", ["v"], tiebreak="id", part_rows=span).collect()}
    known = [(r.user, r.ts, r.id, r.v) for r in right.collect()]
    for r in left.collect():
        before = [k for k in known if k[0] == r.user and k[1] <= r.ts]
        assert got[r.id] == (max(before, key=lambda k: (k[1], k[2]))[3] if before else None)
