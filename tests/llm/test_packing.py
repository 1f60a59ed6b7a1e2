from __future__ import annotations

import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus
from martworks.llm import packing as P


def plain_best_fit(sizes, capacity):
    rooms, out = [], []
    for size in sizes:
        fits = [(room, b) for b, room in enumerate(rooms) if room >= size]
        if fits:
            b = min(fits)[1]
        else:
            b = len(rooms)
            rooms.append(max(capacity, size))
        rooms[b] -= size
        out.append(b)
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(1, 120))
def test_the_tree_finds_the_tightest_bin(sizes, capacity):
    sizes = sorted(sizes, reverse=True)
    assert P.best_fit(sizes, capacity) == plain_best_fit(sizes, capacity)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=1, max_size=60), st.integers(1, 16))
def test_least_capacity_fits(sizes, shards):
    sizes = sorted(sizes, reverse=True)
    assert max(P.best_fit(sizes, P.least_capacity(sizes, shards))) < shards


def test_slots(spark):
    rng = corpus.random.Random(9)
    rows = corpus.awkward() + [(1000 + i, corpus.sentence(rng, rng.randint(1, 80)), "en", "s", 1) for i in range(2000)]
    docs = corpus.documents(spark, rows)
    got = P.slots(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted(
        (r[0] is None, r[0] or 0, len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert set(by) == set(range(16))
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    shards = defaultdict(set)
    for r in got:
        shards[(r.size, r.text_crc32)].add(r.shard)
    assert all(len(x) == 1 for x in shards.values())
    # The one very long text has a shard of its own; the others are nearly equal.
    sums = sorted(sum(r.size for r in part) for part in by.values())[:-1]
    assert sums[-1] - sums[0] < 0.02 * sums[-1]


def test_a_group_with_most_rows_stays_together(spark):
    docs = corpus.documents(spark, [(i, "same text", "en", "s", 1) for i in range(500)] + [(900 + i, f"text {i}", "en", "s", 1) for i in range(100)])
    got = P.slots(docs).collect()
    assert len({r.shard for r in got if r.doc_id < 500}) == 1
    assert len({(r.shard, r.slot) for r in got}) == 600


def test_fixed_capacity_and_own_columns(spark):
    docs = corpus.documents(spark).withColumns({"shard": F.lit("old"), "unit": F.lit(1), "slot": F.lit(2)})
    out = P.sharded(docs, capacity=20_000, cells=64)
    assert out.columns == [c for c in docs.columns if c != "shard"] + ["shard"]
    assert out.count() == docs.count()
    sizes = {r.shard: r.b for r in out.groupBy("shard").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("b")).collect()}
    assert sum(b > 20_000 for b in sizes.values()) <= 1  # the text that is longer itself
    assert P.sharded(docs.limit(0)).count() == 0 and P.slots(docs.limit(0)).count() == 0


@pytest.mark.parametrize("capacity, per_region", [(300, 50_000), (300, 100), (5000, 200), (10, 50)])
def test_no_shard_exceeds_the_capacity(spark, capacity, per_region):
    rng = corpus.random.Random(3)
    rows = [(i, f"{i} " + "x" * rng.randint(0, 60), "en", "s", 1) for i in range(1500)]
    rows += [(5000 + i, rng.choice(["", None, "same"]), "en", "s", 1) for i in range(700)] + [(9000, "y" * 7000, "en", "s", 1)]
    docs = corpus.documents(spark, rows)
    got = P.sharded(docs, capacity=capacity, cells=64, per_region=per_region).collect()
    assert sorted((r.doc_id, r.text or "") for r in got) == sorted((r[0], r[1] or "") for r in rows)
    sizes, groups, of = defaultdict(int), defaultdict(set), defaultdict(set)
    for r in got:
        sizes[r.shard] += len(r.text or "") + 1
        groups[r.shard].add(r.text or "")
        of[r.text or ""].add(r.shard)
    assert all(len(s) == 1 for s in of.values()) and set(sizes) == set(range(len(sizes)))
    assert all(len(groups[s]) == 1 for s, size in sizes.items() if size > capacity)
    # Two bins are more than half full in each region, but for one; all regions' rests together as well.
    assert sum(2 * size <= capacity for size in sizes.values()) <= 1
    fit = sum(s for s in sizes.values() if s <= capacity)
    assert capacity < 300 or sum(s <= capacity for s in sizes.values()) <= 1.3 * fit / capacity + 3
