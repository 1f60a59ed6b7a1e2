"""Cutting sorted rows into parts of equal size, so that no window ever needs a whole key in one task.

A window over a key that holds a third of all rows would be one task. The window operators therefore cut the rows, in
the order of keys and order columns, at bounds taken from a sample: parts hold about equally many rows whatever the
values are, and a key lies in one part or in several that follow each other. Within (part, key) an ordinary window
does the work. Only keys that lie in several parts, at most one per bound, need something from the parts before
(totals, last values, neighbour rows); that is one small frame, joined by broadcast. Rows of equal keys and order
columns are never cut apart.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from martworks.session import scratch

#: Rows of a part; at most so many parts, which beyond that grow; rows sampled per part, and parts per range of the
#: sorted sample; bytes of a plan below which its rows are one part without being counted.
PART_ROWS = 1_000_000
MAX_PARTS = 1 << 14
SAMPLED = 64
RANGE_PARTS = 64
PLAIN_BYTES = 16 << 20


def null_safe(left: DataFrame, left_cols: list[str], right: DataFrame, right_cols: list[str]) -> Column:
    """Equality of two column lists under which null equals null."""
    pairs = zip(left_cols, right_cols)
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def free(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that the frame does not have yet."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def free_prefix(df: DataFrame, name: str) -> str:
    """A beginning like this that no column has."""
    while any(c.lower().startswith(name.lower()) for c in df.columns):
        name = f"_{name}"
    return name


def plan_bytes(df: DataFrame) -> int:
    """The size of a frame as the optimizer sees it: the bytes of its files, narrowed by the columns taken and multiplied
    by joins. An upper bound for plain scans, not a measurement."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


class Cut:
    """Rows with their part. ``part`` is None where all rows are one part; the others then hold nothing."""

    def __init__(self, rows: DataFrame, keys: list[str], part: str | None = None, spanning: DataFrame | None = None):
        self.rows, self.keys, self.part, self._spanning = rows, keys, part, spanning

    def window(self, *order: Column | str):
        return W.partitionBy(*[c for c in (self.part, *self.keys) if c]).orderBy(*order)

    def _key(self) -> Column:
        """The keys as one column under which null equals null."""
        return F.struct(F.lit(0).alias("k"), *[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(self.keys)])

    def spanning(self, **columns: Column) -> DataFrame:
        """The rows of keys that lie in several parts: ``k`` (the keys), ``p`` (the part) and these columns."""
        rows = self.rows.select(self._key().alias("k"), F.col(self.part).alias("p"), *[c.alias(n) for n, c in columns.items()])
        return rows.join(F.broadcast(self._spanning), "k", "left_semi")  # a row per bound at most

    def attach(self, rows: DataFrame, carried: DataFrame) -> DataFrame:
        """The rows with the columns that ``carried`` has for their (``k``, ``p``): a row per bound and key around it."""
        key, part = free(rows, "k", "p")
        named = carried.withColumnsRenamed({"k": key, "p": part})
        joined = rows.withColumns({key: self._key(), part: F.col(self.part)}).join(F.broadcast(named), [key, part], "left")
        return joined.drop(key, part)


def before():
    """For carried frames: the parts of a key before the current one."""
    return W.partitionBy("k").orderBy("p").rowsBetween(W.unboundedPreceding, -1)


def cut(df: DataFrame, keys: list[str], order: list[str], descending: tuple[str, ...] = (), part_rows: int | None = None) -> Cut:
    """Cut rows into parts of about ``part_rows`` in the order of ``keys`` and ``order`` (of any sortable types).

    Parts are numbered in that order. With the default, small plans are one part without any further job; else the
    rows are counted and a sample of their keys and order is sorted, so costly frames should be stored before.
    """
    if part_rows is None and plan_bytes(df) <= PLAIN_BYTES:
        return Cut(df, keys)
    rows = df.count()
    parts = min(MAX_PARTS, -(-rows // (part_rows or PART_ROWS)))
    if parts < 2:
        return Cut(df, keys)
    columns = [*keys, *order]
    names = [f"c{i}" for i in range(len(columns))]
    down = [c in descending for c in columns]
    sort = [F.desc(n) if d else F.asc(n) for n, d in zip(names, down)]
    sample = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)]).sample(min(1.0, SAMPLED * parts / rows), seed=17)
    each = max(1, round(min(SAMPLED, rows / parts)))
    # Ranges of many parts, few of them: a range is a task, and the driver gets a sample of every range. The first sampled
    # row of each part but the very first is a bound; they are stored as one file, so that every later reading sees the
    # same bounds.
    ranges = -(-parts // RANGE_PARTS)
    sample = sample.repartitionByRange(ranges, *sort).sortWithinPartitions(*sort).withColumn("at", F.monotonically_increasing_id())
    inside = F.col("at").bitwiseAND((1 << 33) - 1)
    firsts = sample.where((F.col("at") > 0) & (inside % each == 0)).repartition(1)
    path = scratch(df.sparkSession, "bounds")
    firsts.write.parquet(path)
    firsts = df.sparkSession.read.schema(firsts.schema).parquet(path)
    count = firsts.count()
    if not count:
        return Cut(df, keys)
    bound = F.struct(*names)
    bounds = firsts.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", bound.alias("b")))), lambda x: x["b"]).alias("b")).scalar()
    mine = [F.col(f"`{c}`") for c in columns]
    part, low = free(df, "part", "low")
    # Number of bounds not after the row, by halving: each step is a projection of its own, evaluated once per row. The
    # generator of one row keeps the optimizer from following the steps back wherever the part is joined by.
    placed, step = df.withColumn(low, F.lit(0)), 1 << (count.bit_length() - 1)
    while step:
        at = F.col(low) + step
        found = (at <= count) & _not_after(F.get(bounds, at - 1), mine, names, down)
        placed, step = placed.withColumn(low, F.col(low) + F.when(found, step).otherwise(0)), step // 2
    placed = placed.withColumn(part, F.explode(F.array(low))).drop(low)
    key = F.struct(F.lit(0).alias("k"), *[F.col(names[i]).alias(f"k{i}") for i in range(len(keys))])
    return Cut(placed, keys, part, firsts.select(key.alias("k")).distinct())


def _not_after(bound: Column, mine: list[Column], names: list[str], down: list[bool]) -> Column:
    """Whether a bound comes before a row in sort order, or is its equal. Nulls are the smallest values."""
    if not any(down):
        return bound <= F.struct(*[c.alias(n) for c, n in zip(mine, names)])
    out = F.lit(True)
    for c, n, d in reversed(list(zip(mine, names, down))):
        theirs, own = F.struct(bound.getField(n).alias(n)), F.struct(c.alias(n))
        out = (theirs > own if d else theirs < own) | (bound.getField(n).eqNullSafe(c) & out)
    return out


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Whole-frame row numbers from 1 in the order of any sortable columns, without a task that sees all rows.

    The rows are sorted by range and written once to the shared folder; each file's rows count from the sum of the
    files before it.
    """
    at, file, count, earlier = free(df, "at", "file", "n", "before")
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id())
    path = scratch(df.sparkSession, "numbered")
    placed.write.parquet(path)
    rows = df.sparkSession.read.schema(placed.schema).parquet(path).withColumn(file, F.shiftright(at, 33))
    others = W.orderBy(file).rowsBetween(W.unboundedPreceding, -1)
    # One row per written partition.
    files = rows.groupBy(file).agg(F.count(F.lit(1)).alias(count)).select(
        file, F.coalesce(F.sum(count).over(others), F.lit(0)).alias(earlier))
    number = F.col(earlier) + F.col(at).bitwiseAND((1 << 33) - 1) + 1
    return rows.join(F.broadcast(files), file).withColumn(name, number).drop(*{file, earlier, at} - {name})
