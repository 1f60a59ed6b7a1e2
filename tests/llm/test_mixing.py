from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus
from martworks.llm import mixing as M


def targets(sizes: dict, most: float = 3.0) -> dict:
    """Shares by weight, the excess over the cap reshared until none is above."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: float(k % 3 + 1) for k, s in enumerate(order)}
    out, full, left = {}, set(), float(sum(sizes.values()))
    while True:
        free = [s for s in order if s not in full]
        total = sum(weight[s] for s in free)
        share = {s: left * weight[s] / total for s in free}
        above = [s for s in free if share[s] >= most * sizes[s]]
        if not above:
            return out | share
        for s in above:
            out[s] = most * sizes[s]
            left -= out[s]
            full.add(s)


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 5, "c": 1000, None: 10}, {"a": 0, "b": 10}, {"z": 7}, {None: 4, "é": 9, "e": 1},
    {f"s{i}": i * i for i in range(20)}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in M.source_targets(rows).collect()}
    want = targets(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


def many(n=3000):
    rng = corpus.random.Random(5)
    return [(i, corpus.sentence(rng, rng.randint(1, 60)), "en", rng.choice(["a", "b", "c", "d", None, "a", "a"]), 1) for i in range(n)]


def test_taken_words_come_near_the_targets_and_reruns_agree(spark):
    docs = corpus.documents(spark, many())
    got = M.mix(docs).collect()
    sums, want, size = defaultdict(int), {}, {}
    for r in got:
        sums[r.source] += r.taken
        want[r.source], size[r.source] = r.target, r.source_size
        assert r.taken == r.copies * r.size <= 3 * r.size
        assert r.copies in (int(r.target / r.source_size), int(r.target / r.source_size) + 1)
    assert all(abs(sums[s] - want[s]) <= 30 for s in want)
    again = M.mix(docs.repartition(7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_order_is_that_of_the_odds(spark):
    rows = M.mix(corpus.documents(spark, many(500)), preference=F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)).collect()
    part = [r for r in rows if r.source == "a" and 0 < r.target / r.source_size % 1 < 1]
    extra = [r.copies - min(x.copies for x in part) for r in part]
    even, odd = ([e for r, e in zip(part, extra) if r.doc_id % 2 == k] for k in (0, 1))
    assert sum(even) / len(even) > sum(odd) / len(odd)


def test_mixed_rows_are_the_copies(spark):
    docs = corpus.documents(spark, many(800)).withColumns({"size": F.lit("x"), "copies": F.lit(9), "place": F.lit(0)})
    plan = {r.doc_id: r.copies for r in M.mix(docs).collect()}
    out = M.mixed(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in plan.items() if v}


def test_awkward_rows(spark):
    docs = corpus.documents(spark)
    rows = M.mix(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.taken == 0 for r in rows if r.size == 0)
    twins = corpus.documents(spark, [(None, "a b c", "en", "s", 1)] * 50 + [(1, "x y", "en", "t", 1)] * 10)
    taken = defaultdict(int)
    for r in M.mix(twins).collect():
        taken[r.source] += r.copies
    copies = {r.source: r["count"] for r in M.mixed(twins).groupBy("source").count().collect()}
    assert copies == {s: n for s, n in taken.items() if n}
    assert M.mix(docs.limit(0)).count() == 0 and M.mixed(docs.limit(0)).count() == 0


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    docs = corpus.documents(spark, many())
    want = sorted(map(repr, M.mix(docs).collect()))
    monkeypatch.setattr(M, "RUNS", 8)
    monkeypatch.setattr(M, "ROWS_PER_BUCKET", 10)
    assert sorted(map(repr, M.mix(docs).collect())) == want
