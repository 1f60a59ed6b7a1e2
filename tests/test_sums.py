"""Exact sums against fractions."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from martworks.functions.sums import exact_sums
from martworks.operators.windows import running_sum

WIDE = [1e30, -1e30, 1e-10, 5e-324, -5e-324, 1.7e308, 1.7e308, -1.7e308, 2.2e-308, 1.0, -1.0, 0.1, 2.0 ** 53, 1e16, -1e16,
        2.0 ** 40, 2.0 ** 20, 2.0 ** -20, 1 - 2.0 ** -53, 0.0, -0.0]


def values(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for key in range(60):
        for _ in range(rng.randint(1, 25)):
            kind = rng.random()
            out.append((key, rng.choice(WIDE) if kind < 0.5 else rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300) if kind < 0.7
                        else rng.uniform(-5, 5)))
    return out


def rounded(values: list[float]) -> float:
    whole = sum(map(Fraction, values), Fraction(0))
    try:
        return float(whole)
    except OverflowError:
        return math.inf if whole > 0 else -math.inf


def test_equals_fractions(spark):
    rows = values(3)
    got = {r.k: r.s for r in exact_sums(spark.createDataFrame(rows, "k int, v double"), ["k"], "v", "s").collect()}
    for key, found in got.items():
        want = rounded([v for k, v in rows if k == key])
        assert found == want or abs(found - want) <= math.ulp(want)


def test_special_values(spark):
    rows = [(0, math.nan), (0, 1.0), (1, math.inf), (1, 1.0), (2, math.inf), (2, -math.inf), (3, None), (4, -math.inf), (5, None), (5, 2.0), (6, 0.0)]
    got = {r.k: r.s for r in exact_sums(spark.createDataFrame(rows, "k int, v double"), ["k"], "v", "s").collect()}
    assert math.isnan(got.pop(0)) and math.isnan(got.pop(2))
    assert got == {1: math.inf, 3: None, 4: -math.inf, 5: 2.0, 6: 0.0}
    assert exact_sums(spark.createDataFrame([(1, None)], "k int, v float"), ["k"], "v", "s").collect()[0].s is None


@pytest.mark.parametrize("part_rows", [7, None])
def test_running_sum_is_exact_on_any_partitions(spark, part_rows):
    some = [v for _, v in values(5) if v == 0 or 1e-30 < abs(v) < 1e40][:150]
    data = [(1, i, v) for i, v in enumerate(some)]
    df = spark.createDataFrame(data, "k int, o int, v double")
    for rows in (df.repartition(1), df.repartition(13, F.rand(3))):
        got = [r.s for r in running_sum(rows, ["k"], ["o"], "v", "s", part_rows).orderBy("o").collect()]
        for i, found in enumerate(got):
            want = rounded([v for _, _, v in data[:i + 1]])
            assert found == want or abs(found - want) <= math.ulp(want)
