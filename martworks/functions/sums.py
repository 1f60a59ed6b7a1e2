"""Exact sums of floating-point values: the same result in whatever order and on whatever partitions they are added.

A finite value is cut into whole numbers by bands of twenty binary places, at most four for a double. Per band the
numbers are added as longs, which is exact up to 2^42 addends; NaN and the infinities are counted. The bands are put
together to a double only at the end, so intermediate results may exceed a double, and the result is off the exact
sum by one unit in the last place at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS = 20
_MASK = (1 << BITS) - 1
#: Digits of a value, from its highest band down: sixty places and more hold the 53 of a double, wherever they begin.
DIGITS = 4


def _scaled(value: Column, band: Column) -> Column:
    """value * 2^(BITS * band), in two steps, since the factor may lie beyond a double."""
    half = F.pow(F.lit(2.0), band * (BITS // 2))
    return value * half * half


def _names(name: str) -> tuple[str, str, str]:
    return f"{name}_band", f"{name}_digits", f"{name}_rest"


def with_digits(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add ``<name>_band``, the highest band of the value (null unless it is finite and not zero), and ``<name>_digits``,
    the list of its digits from there down."""
    band, digits, rest = _names(name)
    x = F.col(f"`{value}`").cast("double")
    size = F.abs(x)
    usual = (size > 0) & (size < float("inf"))
    rows = df.withColumn(band, F.when(usual, F.floor(F.log2(size) / BITS).cast("int"))).withColumn(rest, F.when(usual, x))
    # Steps of their own, so that none is evaluated more than once per row.
    single = [f"{name}_digit{i}" for i in range(DIGITS)]
    for i, digit in enumerate(single):
        part = _scaled(F.col(rest), i - F.col(band))
        rows = rows.withColumn(digit, F.when(part < 0, F.ceil(part)).otherwise(F.floor(part)))
        rows = rows.withColumn(rest, F.col(rest) - _scaled(F.col(digit).cast("double"), F.col(band) - i))
    return rows.withColumn(digits, F.array(*single)).drop(rest, *single)


def bands(df: DataFrame, name: str) -> list[int]:
    """All bands from the lowest to the highest that the digits of a frame lie in: a hundred and eight at most."""
    band = _names(name)[0]
    found = df.agg(F.min(band), F.max(band)).first()
    return [] if found[0] is None else list(range(found[0] - DIGITS + 1, found[1] + 1))


def addends(value: str, name: str, places: list[int]) -> dict[str, Column]:
    """The columns to add up (with :func:`with_digits` before): one per band, and counts of values, NaN and infinities."""
    band, digits, _ = _names(name)
    x = F.col(f"`{value}`").cast("double")
    zero = F.lit(0).cast("long")
    out = {_of(name, b): F.coalesce(F.get(digits, F.col(band) - b), zero) for b in places}
    flag = lambda c: F.coalesce(c.cast("long"), F.lit(0).cast("long"))
    return {**out, f"{name}_n": flag(x.isNotNull()), f"{name}_nan": flag(F.isnan(x)), f"{name}_up": flag(x == float("inf")),
            f"{name}_down": flag(x == float("-inf"))}


def _of(name: str, band: int) -> str:
    return f"{name}_{'m' if band < 0 else 'p'}{abs(band)}"


def total(df: DataFrame, name: str, places: list[int], result: str) -> DataFrame:
    """Add ``result``, the double of the summed addends; null without any value. The addends are dropped."""
    columns = [_of(name, b) for b in places]
    extra = [f"{name}_{x}" for x in ("n", "nan", "up", "down")]
    sign, found = f"{name}_sign", f"{name}_sum"
    zero = F.lit(0).cast("long")
    if not columns:
        rows, finite = df, F.lit(0.0)
    else:
        # The sign of the sum is that of what is carried beyond the highest band; then the same with the sum's amount,
        # every digit a double of its own, from the lowest band up.
        top = F.aggregate(F.array(*columns), zero, lambda carry, x: F.shiftright(carry + x, BITS))
        rows = df.withColumn(sign, F.when(top < 0, -1).otherwise(1).cast("long"))
        halves = [F.lit(2.0 ** (b * (BITS // 2))) for b in [*places, places[-1] + 1]]
        terms = F.array(*[F.struct((F.col(sign) * F.col(c)).alias("x"), h.alias("half")) for c, h in zip(columns, halves)])

        def add(acc: Column, term: Column) -> Column:
            whole = acc["carry"] + term["x"]
            digit = whole.bitwiseAND(_MASK).cast("double")
            return F.struct(F.shiftright(whole, BITS).alias("carry"), (acc["amount"] + digit * term["half"] * term["half"]).alias("amount"))

        finite = F.col(sign) * F.aggregate(
            terms, F.struct(zero.alias("carry"), F.lit(0.0).alias("amount")), add,
            lambda acc: acc["amount"] + acc["carry"].cast("double") * halves[-1] * halves[-1])
    n, nan, up, down = (F.col(c) > 0 for c in extra)
    value = (F.when(nan | (up & down), float("nan")).when(up, float("inf")).when(down, float("-inf")).when(n, finite))
    return rows.withColumn(found, value).drop(*columns, *extra, sign).withColumnRenamed(found, result)


def exact_sums(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Exact sum of a floating-point column per key. The frame is read twice."""
    from martworks.operators.skew import free_prefix

    tag = free_prefix(df, "x")
    rows = with_digits(df.select(*keys, value), value, tag)
    places = bands(rows, tag)
    parts = addends(value, tag, places)
    return total(rows.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in parts.items()]), tag, places, name)
