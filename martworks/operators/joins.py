"""Join operators beyond a plain ``DataFrame.join``."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from martworks.functions.geo import EARTH_KM, haversine
from martworks.operators.dedup import unique_pairs
from martworks.operators.skew import PLAIN_BYTES, free, plan_bytes
from martworks.operators.windows import carry_forward, shifted
from martworks.session import Copies, stored


def spine(keys_frame: DataFrame, on: list[str], *aggregates: DataFrame) -> DataFrame:
    """Every key once, with the aggregates that exist for it."""
    return reduce(lambda left, right: left.join(right, on, "left"), aggregates, keys_frame.select(*on).distinct())


#: Dimensions are broadcast up to so many bytes, and cut into versions by scanning where a key has more of them.
BROADCAST_BYTES = 16 << 20
JOINED_VERSIONS = 32
#: Rows of one block of a crowded cell, and blocks of a side at most: so many copies of a row of the other side are sent.
BLOCK_ROWS = 4096
MOST_BLOCKS = 8


def lookup(facts: DataFrame, dim: DataFrame, on: list[str], how: str = "left", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join to a dimension, with a broadcast hint if the optimizer's size of the dimension's plan is at most ``max_bytes``.

    Above, no hint is given: the join sorts, unless adaptive execution measures a side below its own threshold.
    """
    return facts.join(F.broadcast(dim) if plan_bytes(dim) <= max_bytes else dim, on, how)


def absent(df: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key does not occur in ``known`` (a null key never matches, so it stays).

    The known keys are made distinct first: copies of a frequent key end on the map side, and the join
    uses the partitioning of the distinct keys, so this adds no shuffle.
    """
    return df.join(known.select(*on).distinct(), on, "left_anti").select(*df.columns)


def present(df: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key occurs in ``known``, each once."""
    return df.join(known.select(*on).distinct(), on, "left_semi").select(*df.columns)


def not_in(df: DataFrame, col: str, known: DataFrame, known_col: str) -> DataFrame:
    """SQL ``NOT IN``: nothing at all when ``known`` holds a null, and null keys never qualify.

    The null-aware test is done on an aggregate, so the rows themselves go through an ordinary anti join.
    """
    facts = known.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(known_col).isNull()).alias("nulls"))
    kept = absent(df, known.select(F.col(known_col).alias(col)), [col])
    empty, no_nulls = facts.select(F.col("n") == 0).scalar(), facts.select(F.col("nulls") == 0).scalar()
    return kept.where(empty | (no_nulls & F.col(col).isNotNull()))


def without_pairs(pairs: DataFrame, known: DataFrame, a: str, b: str, known_a: str, known_b: str) -> DataFrame:
    """Drop pairs that occur in ``known`` in either direction. ``pairs`` must have the smaller value first."""
    seen = unique_pairs(known.select(F.col(known_a).alias(a), F.col(known_b).alias(b)), a, b)
    return pairs.join(seen, [a, b], "left_anti")


def as_of(left: DataFrame, right: DataFrame, key: str, ts: str, values: list[str], prefix: str = "last_",
          tiebreak: str | None = None, part_rows: int | None = None) -> DataFrame:
    """Each left row with the right side's last known values at that moment (right rows of the same
    moment count). One union and one pass in time order; no pairing of rows. Both sides are read more than once."""
    side, tie, seen, known = free(left, "side", "tie", "seen", "known")
    # A whole right row is carried, so that values of different rows never mix.
    right_rows = right.select(
        key, ts, F.struct(*[F.col(v).alias(f"v{i}") for i, v in enumerate(values)]).alias(seen), F.lit(0).alias(side),
        (F.col(tiebreak) if tiebreak else F.lit(0)).cast("long").alias(tie),
    )
    # Left rows of one moment may come in any order; a hash lets a moment with many of them be cut.
    left_rows = left.select("*", F.lit(1).alias(side), F.xxhash64(*left.columns).alias(tie))
    both = left_rows.unionByName(right_rows, allowMissingColumns=True)
    carried = carry_forward(both, [key], [ts, side, tie], {known: seen}, part_rows)
    return carried.where(F.col(side) == 1).select(
        *left.columns, *[F.col(f"{known}.v{i}").alias(f"{prefix}{v}") for i, v in enumerate(values)]
    )


def valid_at(facts: DataFrame, dim: DataFrame, on: str, ts: str, start: str = "active_from",
             end: str = "active_to", joined_versions: int = JOINED_VERSIONS, part_rows: int | None = None) -> DataFrame:
    """Facts joined to the dimension version that was valid at the fact's moment (end exclusive).

    Keys, moments or bounds that are null match nothing. Where no key has more than ``joined_versions`` versions, facts
    meet all versions of their key. Else, if the versions of a key do not overlap, they are the sorted starts of an
    as-of scan, so a fact meets one version whatever their number; overlapping versions are joined by key.
    """
    real = dim.where((F.col(start) < F.col(end)) & F.col(on).isNotNull())
    joined = facts.join(real, on).where((F.col(ts) >= F.col(start)) & (F.col(ts) < F.col(end)))
    most = real.groupBy(on).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if most <= joined_versions:
        return joined
    spans = real.select(on, F.col(start).alias("s"), F.col(end).alias("e"))
    met = shifted(spans, [on], ["s", "e"], {"before": ("e", -1)}, part_rows).where("before > s")
    if not met.isEmpty():
        return joined
    moment, = free(facts, "moment")
    same = facts.schema[ts].dataType == dim.schema[start].dataType
    as_moment = lambda c: F.col(c) if same else F.col(c).cast("timestamp")
    left = facts.where(F.col(on).isNotNull() & F.col(ts).isNotNull()).withColumn(moment, as_moment(ts))
    values = [c for c in dim.columns if c != on]
    found = as_of(left, real.withColumn(moment, as_moment(start)), on, moment, values, "", part_rows=part_rows)
    others = [c for c in facts.columns if c != on]
    return found.where(F.col(ts) < F.col(end)).select(on, *others, *values)


def valid_now(dim: DataFrame, now, end: str = "active_to") -> DataFrame:
    """Dimension rows still valid at ``now``."""
    return dim.where(F.col(end) > F.lit(now).cast(dim.schema[end].dataType))


def array_lookup_lines(df: DataFrame, key: str | list[str], owner: Column, items: str, menus: DataFrame, menu_owner: str,
                       menu: str, item_id: str = "id", menu_id: str = "_id", take: tuple[str, ...] = ("name", "category")) -> DataFrame:
    """One row per element of ``items`` with the key columns, its place ``_pos``, its own fields and those taken from its
    owner's menu entry of the same id. Elements without a menu entry are dropped."""
    keys = [key] if isinstance(key, str) else key
    element_fields = [f.name for f in df.schema[items].dataType.elementType.fields]
    others = [f for f in element_fields if f != item_id]
    opened = df.select(*keys, owner.alias("_owner"), F.posexplode(items).alias("_pos", "_e")).select(
        *keys, "_owner", "_pos", F.col(f"_e.{item_id}").alias("_id"), *[F.col(f"_e.{f}").alias(f"_e_{f}") for f in others])
    # One entry per (owner, id): the first of the menu, so a repeated entry never doubles an order line.
    entries = (
        menus.select(F.col(menu_owner).alias("_owner"), F.posexplode(menu).alias("_at", "_m"))
        .groupBy("_owner", F.col(f"_m.{menu_id}").alias("_id")).agg(F.min_by(F.struct(*[f"_m.{t}" for t in take]), "_at").alias("_m"))
    )
    met = opened.join(entries, ["_owner", "_id"])
    return met.select(*keys, "_pos", *[F.col("_id" if f == item_id else f"_e_{f}").alias(f) for f in element_fields],
                      *[F.col(f"_m.{t}").alias(t) for t in take])


def array_lookup(df: DataFrame, key: str, owner: Column, items: str, menus: DataFrame, menu_owner: str,
                 menu: str, item_id: str = "id", menu_id: str = "_id", take: tuple[str, ...] = ("name", "category"),
                 name: str = "products", onto: DataFrame | None = None, copies: Copies | None = None) -> DataFrame:
    """Each element of ``items`` completed with fields of its owner's menu entry of the same id.

    Both arrays are opened, joined on (owner, id) and closed again per ``key``; the list keeps its order.
    Elements without a menu entry are dropped. For work on single elements take :func:`array_lookup_lines`. The lists go
    to the rows of ``df``, or of ``onto`` with the same keys: columns that are looked up by other keys are better looked
    up before, or the lists would be sent along. With ``copies`` the elements are stored there between the join and the
    closing, so the shuffle files of both are not on disk together.
    """
    lines = array_lookup_lines(df, key, owner, items, menus, menu_owner, menu, item_id, menu_id, take)
    lines = copies.add(lines, "lines") if copies else lines
    fields = [c for c in lines.columns if c not in (key, "_pos")]
    # After the join the elements of a list lie apart, so partial lists would hold one each.
    closed = lines.repartition(key).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_pos", *fields))).alias("_list"))
    return (df if onto is None else onto).join(closed, key, "left").withColumn(
        name, F.transform("_list", lambda e: F.struct(*[e[f].alias(f) for f in fields]))
    ).drop("_list")


# --- distance-threshold join ------------------------------------------------------------------------

def _band_degrees(km: float) -> float:
    """Height of a band: the distance in degrees of latitude, plus a tenth."""
    return math.degrees(km / EARTH_KM) * 1.1


def _cells_in_band(band: Column, km: float) -> Column:
    """Longitude cells of a band, so wide that two points ``km`` apart are at most one cell apart.

    At latitude p the points differ by at most asin(sin(km/R) / cos p) in longitude. The widest case of the
    band and its neighbours decides; close to the poles one cell holds the whole band.
    """
    step = _band_degrees(km)
    reach = F.abs((band + 0.5) * step - 90) + 1.5 * step
    ratio = F.lit(math.sin(min(math.pi / 2, km / EARTH_KM))) / F.cos(F.radians(reach))
    return F.when((reach >= 89.9) | (ratio >= 0.99), F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.floor(356.0 / F.degrees(F.asin(ratio))))
    ).cast("long")


def _lon_cell(lon: Column, cells: Column) -> Column:
    return F.pmod(F.floor((lon + 180) * cells / 360).cast("long"), cells)


def in_cells(df: DataFrame, lat: str, lon: str, km: float) -> DataFrame:
    """Add the grid cell of each row's point as ``_band`` and ``_cell``; rows without a point are left out."""
    placed = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).withColumn(
        "_band", F.floor((F.col(lat) + 90) / _band_degrees(km)).cast("long")
    ).withColumn("_cells", _cells_in_band(F.col("_band"), km))
    return placed.withColumn("_cell", _lon_cell(F.col(lon), F.col("_cells"))).drop("_cells")


def near_cells(df: DataFrame, lat: str, lon: str, km: float) -> DataFrame:
    """One row per cell that can hold a point within ``km``: three bands, up to three cells in each."""
    own = F.floor((F.col(lat) + 90) / _band_degrees(km)).cast("long")
    banded = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).withColumn(
        "_band", F.explode(F.sequence(own - 1, own + 1))
    ).withColumn("_cells", _cells_in_band(F.col("_band"), km))
    middle = banded.withColumn("_mid", _lon_cell(F.col(lon), F.col("_cells")))
    around = F.array(*[F.pmod(F.col("_mid") + d, F.col("_cells")) for d in (-1, 0, 1)])
    return middle.withColumn("_cell", F.explode(F.array_distinct(around))).drop("_cells", "_mid")


def within_distance(left: DataFrame, right: DataFrame, km: float, left_at=("lat", "lon"),
                    right_at=("ref_lat", "ref_lon"), also: list[str] | None = None, block_rows: int | None = None) -> DataFrame:
    """Left and right rows at most ``km`` apart (and equal on the ``also`` columns), with ``distance``.

    An equi-join on grid cells: the right rows sit in their own cell, each left row visits the cells
    around it. Only rows that meet in a cell are ever compared. Rows of crowded cells are dealt into blocks of
    ``block_rows`` or more, ``MOST_BLOCKS`` a side at most, and each pair of blocks is a join key of its own, so a cell
    with many rows on both sides spreads over many tasks while a row is sent so many times at most. Cells are counted for that, unless the plans of both sides are small or one is a
    stream; costly sides should be stored before.
    """
    on = ["_band", "_cell", *(also or [])]
    visiting, sitting = near_cells(left, *left_at, km), in_cells(right, *right_at, km)
    crowded = None
    if not (left.isStreaming or right.isStreaming) and (
            block_rows is not None or max(plan_bytes(left), plan_bytes(right)) > PLAIN_BYTES):
        crowded = _crowded(visiting, sitting, on, block_rows or BLOCK_ROWS)
    if crowded is not None:
        visiting = _dealt(visiting, crowded, on, "_lefts", "_rights", left.columns)
        sitting = _dealt(sitting, crowded, on, "_rights", "_lefts", right.columns)
        on = [*on, "_lefts", "_rights"]
    met = visiting.join(sitting, on).drop("_band", "_cell", "_lefts", "_rights")
    return met.withColumn("distance", haversine(*left_at, *right_at)).where(F.col("distance") <= km)


def _crowded(visiting: DataFrame, sitting: DataFrame, on: list[str], block_rows: int) -> DataFrame | None:
    """Stored: the cells where more than four times a block's pairs would meet, with the blocks of either side."""
    counts = [rows.groupBy(*on).agg(F.count(F.lit(1)).alias(n)) for rows, n in ((visiting, "_l"), (sitting, "_r"))]
    blocks = [F.least(F.ceil(F.col(n) / block_rows), F.lit(MOST_BLOCKS)).cast("int").alias(name)
              for n, name in (("_l", "_lefts"), ("_r", "_rights"))]
    many = F.col("_l").cast("double") * F.col("_r") > 4.0 * block_rows * block_rows
    found = stored(counts[0].join(counts[1], on).where(many).select(*on, *blocks), "crowded")
    return None if found.isEmpty() else found


def _dealt(rows: DataFrame, crowded: DataFrame, on: list[str], own: str, other: str, columns: list[str]) -> DataFrame:
    """Each row in its block of its side, once for every block of the other side; cells that are not crowded are one."""
    placed = rows.join(crowded, on, "left")
    mine = F.pmod(F.xxhash64(*columns), F.coalesce(own, F.lit(1))).cast("int")
    return placed.withColumn(own, mine).withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)))
