"""Window operators. Each gives the result of the plain window, but never needs a whole key in one task.

The ordered ones work in parts of equal size (see :mod:`martworks.operators.skew`); ``part_rows`` sets how many rows a
part has. They read their input more than once: pass a stored frame when it is costly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from martworks.functions import sums
from martworks.operators.skew import Cut, before, cut, free, free_prefix, null_safe, numbered


def top1(df: DataFrame, keys: list[str], by: list[str], largest: bool = True) -> DataFrame:
    """The row with the largest (or smallest) ``by`` values per key; the other columns decide between equals.

    A grouped maximum instead of a window: combined on the map side, so hot keys shrink before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in by]
    best = (F.max if largest else F.min)(F.struct(*by, *rest))
    return df.groupBy(*keys).agg(best.alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, name: str | None = None) -> DataFrame:
    """The first n rows per key. Spark limits each key to n rows before the shuffle (WindowGroupLimit)."""
    ranked = df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(f"_rn <= {n}")
    return ranked.withColumnRenamed("_rn", name) if name else ranked.drop("_rn")


def with_stats(df: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """Aggregates of the key attached to each of its rows (sum/avg/min/max/count over the partition).

    Grouped first and joined back: the grouping is combined on the map side, and the join has one row
    per key on its right, so adaptive execution can split a hot key's left rows over several tasks.
    """
    stats = df.groupBy(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)]).agg(
        *[c.alias(name) for name, c in aggregates.items()]
    )
    names = [f"_s{i}" for i in range(len(keys))]
    return df.join(stats, null_safe(df, keys, stats, names), "left").drop(*names)


def first_flag(df: DataFrame, keys: list[str], ts: str, name: str) -> DataFrame:
    """1 on rows at the key's earliest moment, else 0."""
    firsts = with_stats(df, keys, _first=F.min(ts))
    return firsts.withColumn(name, (F.col("_first") == F.col(ts)).cast("int")).drop("_first")


def shifted(df: DataFrame, keys: list[str], order: list[str], columns: dict[str, tuple[str, int]],
            part_rows: int | None = None) -> DataFrame:
    """Lag and lead: ``columns`` maps a new name to (column, offset), negative offsets looking back.

    ``order`` must be unique within a key for a result that is the same on every run. Rows next to a part border are
    copied into the neighbouring part for the window and removed afterwards.
    """
    return _shifted(cut(df, keys, order, part_rows=part_rows), order, columns).select(*df.columns, *[c for c in columns if c not in df.columns])


def _shifted(made: Cut, order: list[str], columns: dict[str, tuple[str, int]]) -> DataFrame:
    """The cut's rows with the new columns."""
    over = made.window(*order)
    shifts = {name: F.lag(column, -offset).over(over) if offset < 0 else F.lead(column, offset).over(over)
              for name, (column, offset) in columns.items()}
    if made.part is None:
        return made.rows.withColumns(shifts)
    own, = free(made.rows, "own")
    everything = made.rows.withColumn(own, F.lit(True))
    needed = list(dict.fromkeys([*made.keys, *order, *[c for c, _ in columns.values()]]))
    for count, backwards in ((max([0, *[-n for _, n in columns.values()]]), True), (max([0, *[n for _, n in columns.values()]]), False)):
        if count:
            halo = _edges(made, order, needed, count, backwards).withColumn(own, F.lit(False))
            everything = everything.unionByName(halo, allowMissingColumns=True)
    return everything.withColumns(shifts).where(own).drop(own)


def _edges(made: Cut, order: list[str], needed: list[str], count: int, backwards: bool) -> DataFrame:
    """For each part of a spanning key the nearest ``count`` rows of the key's parts before it (or after it)."""
    fields = {f"n{i}": F.col(f"`{c}`") for i, c in enumerate(needed)}
    at = {c: n for n, c in zip(fields, needed)}
    nearest = [F.desc(at[c]) if backwards else F.asc(at[c]) for c in order]
    item = F.struct(F.col("far"), *fields)
    edges = (top_n(made.spanning(**fields), ["k", "p"], nearest, count, "far")
             .groupBy("k", "p").agg(F.array_sort(F.collect_list(item)).alias("rows")))
    over = W.partitionBy("k").orderBy("p")
    step = F.lag if backwards else F.lead
    none = F.array().cast(edges.schema["rows"].dataType)
    # Nearest parts first, and in each the nearest rows first; every part has one row at least.
    near = F.slice(F.concat(*[F.coalesce(step("rows", i).over(over), none) for i in range(1, count + 1)]), 1, count)
    return edges.withColumn("near", near).select("p", F.explode("near").alias("r")).select(
        F.col("p").alias(made.part), *[F.col(f"r.{at[c]}").alias(c) for c in needed])


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: str, name: str, part_rows: int | None = None) -> DataFrame:
    """Sum of ``value`` from the key's first row up to the current one (range frame: ties count together).

    Rows of equal order are added first, so a moment that many rows share is one row of the scan. Sums of
    floating-point values are exact (see :mod:`martworks.functions.sums`): NaN and infinities count as in any sum, and
    neither order nor parts change the result. Null while no value has come yet.
    """
    floating = df.schema[value].dataType.typeName() in ("float", "double")
    moments = list(dict.fromkeys([*keys, *order]))
    tag, own = free_prefix(df, "sum"), free(df, "own")[0]
    if floating:
        digits = sums.with_digits(df.select(*dict.fromkeys([*moments, value])), value, tag)
        places = sums.bands(digits, tag)
        parts = sums.addends(value, tag, places)
    else:
        digits, parts = df, {tag: F.col(f"`{value}`")}
    grouped = digits.groupBy(*moments).agg(*[F.sum(c).alias(n) for n, c in parts.items()])
    summed = _so_far(grouped, keys, order, list(parts), part_rows)
    summed = sums.total(summed, tag, places, own) if floating else summed.withColumnRenamed(tag, own)
    return _back(df, summed, moments, own, name)


def _so_far(grouped: DataFrame, keys: list[str], order: list[str], columns: list[str], part_rows: int | None,
            descending: tuple[str, ...] = ()) -> DataFrame:
    """Rows of unique order, with each column replaced by its sum up to and with the row."""
    made = cut(grouped, keys, order, descending, part_rows)
    sort = [F.desc(c) if c in descending else F.asc(c) for c in order]
    over = made.window(*sort).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = made.rows.withColumns({c: F.sum(c).over(over) for c in columns})
    if made.part is None:
        return rows
    totals = made.spanning(**{c: F.col(c) for c in columns}).groupBy("k", "p").agg(*[F.sum(c).alias(c) for c in columns])
    carried = dict(zip(columns, free(rows, *[f"before_{c}" for c in columns])))
    rows = made.attach(rows, totals.select("k", "p", *[F.sum(c).over(before()).alias(n) for c, n in carried.items()]))
    return rows.withColumns({c: F.coalesce(F.col(c) + F.col(n), c, n) for c, n in carried.items()}).drop(made.part, *carried.values())


def _back(df: DataFrame, found: DataFrame, moments: list[str], column: str, name: str) -> DataFrame:
    """The rows with what was found for their keys and order; a moment with many rows can be split by the join."""
    names = free(df, *[f"m{i}" for i in range(len(moments))])
    other = found.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(moments, names)], F.col(column))
    joined = df.join(other, null_safe(df, moments, other, names), "left").withColumn(name, F.col(column))
    return joined.select(*df.columns, *([] if name in df.columns else [name]))


def carry_forward(df: DataFrame, keys: list[str], order: list[str], columns: dict[str, str], part_rows: int | None = None) -> DataFrame:
    """Last non-null value so far: ``columns`` maps a new name to the column it follows."""
    made = cut(df, keys, order, part_rows=part_rows)
    over = made.window(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = made.rows.withColumns({n: F.last(c, ignorenulls=True).over(over) for n, c in columns.items()})
    if made.part is not None:
        place = F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)])
        values = {f"v{i}": F.col(f"`{c}`") for i, c in enumerate(columns.values())}
        lasts = made.spanning(o=place, **values).groupBy("k", "p").agg(*[
            F.max_by(F.col(v), F.when(F.col(v).isNotNull(), F.col("o"))).alias(v) for v in values])
        carried = free(rows, *[f"before{i}" for i in range(len(columns))])
        rows = made.attach(rows, lasts.select("k", "p", *[
            F.last(v, ignorenulls=True).over(before()).alias(c) for v, c in zip(values, carried)]))
        rows = rows.withColumns({n: F.coalesce(n, c) for n, c in zip(columns, carried)})
    return rows.select(*df.columns, *[c for c in columns if c not in df.columns])


def ranked(df: DataFrame, keys: list[str], order: list[str], name: str, descending: bool = False,
           unique: bool = False, part_rows: int | None = None) -> DataFrame:
    """Rank of each row in its key; with ``unique`` a row number (the same on every run if ``order`` is unique).

    ``descending`` turns the first order column. An empty key list numbers the whole frame, as for surrogate ids
    (ascending row numbers only).
    """
    if not keys:
        if descending or not unique:
            raise ValueError("a whole frame has ascending row numbers only")
        return numbered(df, order, name)
    down = (order[0],) if descending else ()
    if not unique:
        moments = list(dict.fromkeys([*keys, *order]))
        count, own = free(df, "n", "own")
        sizes = df.groupBy(*moments).agg(F.count(F.lit(1)).alias(own))
        found = _so_far(sizes.withColumn(count, F.col(own)), keys, order, [count], part_rows, down)
        return _back(df, found.withColumn(own, F.col(count) - F.col(own) + 1), moments, own, name)
    made = cut(df, keys, order, down, part_rows)
    sort = [F.desc(order[0]) if descending else F.asc(order[0]), *[F.asc(c) for c in order[1:]]]
    rows = made.rows.withColumn(name, F.row_number().over(made.window(*sort)).cast("long"))
    if made.part is not None:
        sizes = made.spanning().groupBy("k", "p").agg(F.count(F.lit(1)).alias("n"))
        carried, = free(rows, "before")
        rows = made.attach(rows, sizes.select("k", "p", F.sum("n").over(before()).alias(carried)))
        rows = rows.withColumn(name, F.col(name) + F.coalesce(carried, F.lit(0)))
    return rows.select(*df.columns, *([] if name in df.columns else [name]))


def runs(df: DataFrame, key: str, value: str, ts: str, tiebreak: str, min_days: int | None = None,
         part_rows: int | None = None) -> DataFrame:
    """Gaps and islands: unbroken stretches of one value per key, with start, end and length in days.

    ``min_days`` keeps only stretches at least that long. A null tie-break is one like any other.
    """
    order = list(dict.fromkeys([ts, tiebreak]))
    names = {c: f"c{i}" for i, c in enumerate(dict.fromkeys([key, value, *order]))}
    rows = df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], F.lit(1).alias("one"))
    at, order = names[ts], [names[c] for c in order]
    made = cut(rows, [names[key]], order, part_rows=part_rows)
    marked = _shifted(made, order, {"prev": (names[value], -1), "first": ("one", -1)})
    new = (F.col("first").isNull() | ~F.col("prev").eqNullSafe(F.col(names[value]))).cast("long")
    flagged = Cut(marked.withColumn("new", new), made.keys, made.part, made._spanning)
    over = made.window(*order).rangeBetween(W.unboundedPreceding, W.currentRow)
    counted = flagged.rows.withColumn("run_no", F.sum("new").over(over))
    if made.part is not None:
        starts = flagged.spanning(n=F.col("new")).groupBy("k", "p").agg(F.sum("n").alias("n"))
        counted = made.attach(counted, starts.select("k", "p", F.sum("n").over(before()).alias("earlier")))
        counted = counted.withColumn("run_no", F.col("run_no") + F.coalesce("earlier", F.lit(0)))
    out = (
        counted.groupBy(F.col(names[key]).alias(key), "run_no")
        .agg(F.first(names[value]).alias(value), F.min(at).alias("run_start"), F.max(at).alias("run_end"),
             F.count(F.lit(1)).alias("events"))
        .withColumn("days", F.datediff(F.to_date("run_end"), F.to_date("run_start")))
    )
    return out if min_days is None else out.where(F.col("days") >= min_days)


def funnel(df: DataFrame, user: str, order: list[str], step: str, first: Column, then: list[str],
           part_rows: int | None = None) -> DataFrame:
    """Rows meeting ``first`` whose user's very next steps are exactly ``then``."""
    names = free(df, *[f"next{i}" for i in range(len(then))])
    ahead = shifted(df, [user], order, {n: (step, i) for i, n in enumerate(names, 1)}, part_rows).where(first)
    for n, wanted in zip(names, then):
        ahead = ahead.where(F.col(n) == wanted)
    return ahead.drop(*names)
