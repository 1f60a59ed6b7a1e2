"""The nearest row of a reference set (cities, shops) for every row, without pairing rows and references.

Points lie on the unit sphere, inside one cube that is halved along each axis again and again. A cube with rows meets
the cubes of its size with references that can be nearest to any point in it; while these hold many references,
the cubes on both sides are halved and what is left is narrowed down. So cubes are large where references are rare and
small where they are dense, and every cube ends with a short list, which its rows meet in one join. Exact for
reference sets of any size and density.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from martworks.functions.geo import haversine, unit_vector
from martworks.operators.joins import BROADCAST_BYTES
from martworks.operators.skew import free, plan_bytes
from martworks.session import stored

#: References of a cube's list; how often cubes are halved at first, in each round, and at most: an edge is then about
#: 6 m long.
LIST = 64
FIRST_LEVEL, STEP, MAX_LEVEL = 4, 2, 22
_AXES = ("x", "y", "z")
_CELL, _BLOCK = [f"c{a}" for a in _AXES], [f"b{a}" for a in _AXES]


def _cubes(vector: dict[str, Column], names: list[str]) -> list[Column]:
    """The numbers of the smallest cube along the axes; a cube of a lower level has them shifted to the right."""
    return [F.floor((v + 2) * 2.0 ** (MAX_LEVEL - 2)).cast("int").alias(n) for v, n in zip(vector.values(), names)]


def _at(level: int, names: list[str], as_names: list[str] | None = None) -> list[Column]:
    return [F.shiftright(F.col(n), MAX_LEVEL - level).alias(m) for n, m in zip(names, as_names or names)]


def _narrowed(pairs: DataFrame, points: DataFrame, refs: DataFrame, level: int, step: int) -> DataFrame:
    """Pairs of cubes (rows, references) of a level out of those ``step`` levels above: of a cube with rows only the
    reference cubes that can hold the nearest one, with the number of references in each and in all of them."""
    parent = lambda names: [F.shiftright(F.col(n), step).alias(f"p{n}") for n in names]
    cells = points.select(*_at(level, _CELL)).distinct().select("*", *parent(_CELL))
    blocks = refs.select(*_at(level, _BLOCK)).groupBy(*_BLOCK).agg(F.count(F.lit(1)).alias("n")).select("*", *parent(_BLOCK))
    above = pairs.select(*[F.col(n).alias(f"p{n}") for n in (*_CELL, *_BLOCK)])
    met = above.join(cells, [f"p{n}" for n in _CELL]).join(blocks, [f"p{n}" for n in _BLOCK])
    gaps = [F.abs(F.col(c) - F.col(b)) for c, b in zip(_CELL, _BLOCK)]
    edge = 2.0 ** (2 - level)
    least = F.sqrt(sum((F.greatest(g - 1, F.lit(0)).cast("double") ** 2 for g in gaps), F.lit(0.0))) * edge
    most = F.sqrt(sum(((g + 1).cast("double") ** 2 for g in gaps), F.lit(0.0))) * edge
    of_cell = W.partitionBy(*_CELL)
    best = met.select(*_CELL, *_BLOCK, "n", least.alias("least"), most.alias("most")).withColumn("best", F.min("most").over(of_cell))
    kept = best.where(F.col("least") <= F.col("best") + 1e-9).select(*_CELL, *_BLOCK, "n", F.sum("n").over(of_cell).alias("total"))
    return stored(kept, f"nearest-{level}")


def _lists(rows: DataFrame, vector: dict[str, Column], refs: DataFrame, item: Column) -> dict[int, DataFrame]:
    """By level the cubes that end there, with the array ``refs`` of their references."""
    count = refs.count()
    if not count:
        return {}
    if count <= LIST:
        return {0: refs.agg(F.array_sort(F.collect_list(item)).alias("refs")).select(*[F.lit(0).alias(c) for c in _CELL], "refs")}
    points = stored(rows.select(*_cubes(vector, _CELL)).dropna().distinct(), "nearest-points")
    pairs = points.limit(1).select(*[F.lit(0).alias(n) for n in (*_CELL, *_BLOCK)])
    out: dict[int, DataFrame] = {}
    for level in range(FIRST_LEVEL, MAX_LEVEL + 1, STEP):
        found = _narrowed(pairs, points, refs, level, STEP if out or level > FIRST_LEVEL else FIRST_LEVEL)
        short = F.col("total") <= (LIST if level < MAX_LEVEL else 1 << 60)
        sizes = found.agg(F.count_if(short).alias("done"), F.count_if(~short).alias("left")).first()
        if sizes["done"]:
            near = refs.select("*", *_at(level, _BLOCK, [f"l{b}" for b in _BLOCK])).drop(*_BLOCK).withColumnsRenamed({f"l{b}": b for b in _BLOCK})
            lists = found.where(short).select(*_CELL, *_BLOCK).join(near, _BLOCK).groupBy(*_CELL)
            out[level] = stored(lists.agg(F.array_sort(F.collect_list(item)).alias("refs")), f"nearest-lists-{level}")
        if not sizes["left"]:
            break
        pairs = found.where(~short)
    return out


def nearest(df: DataFrame, ref: DataFrame, lat: str = "lat", lon: str = "lon", ref_id: str = "id",
            ref_lat: str = "lat_city", ref_lon: str = "lng_city", units: str = "degrees") -> DataFrame:
    """The closest reference row and its distance in km; the lower id wins a tie.

    Every input row comes out once, whatever its other columns hold; rows without coordinates get no reference, and
    references without coordinates are left out. With more than a short list of references the rows are read twice,
    first for the cubes they lie in.
    """
    attrs = [c for c in ref.columns if c not in (ref_id, ref_lat, ref_lon)]
    # One reference per place, under names of our own.
    fields = {c: f"f{i}" for i, c in enumerate((ref_id, ref_lat, ref_lon, *attrs))}
    places = ref.where(F.col(ref_lat).isNotNull() & F.col(ref_lon).isNotNull()).select(*[F.col(f"`{c}`").alias(n) for c, n in fields.items()])
    places = places.groupBy("f1", "f2").agg(F.min_by(F.struct(*[n for n in fields.values() if n not in ("f1", "f2")]), "f0").alias("r")).select("f1", "f2", "r.*")
    around = dict(zip(("rx", "ry", "rz"), unit_vector("f1", "f2", units)))
    refs = stored(places.withColumns(around).select("*", *_cubes({n: F.col(n) for n in around}, _BLOCK)), "references")
    own = free(df, *[f"e{a}" for a in _AXES])
    rows = df.withColumns(dict(zip(own, unit_vector(lat, lon, units))))
    vector = {n: F.col(n) for n in own}
    found, lists = rows, []
    for level, frame in _lists(rows, vector, refs, F.struct(*fields.values(), *around)).items():
        *cube, name = free(found, *[f"c{level}{a}" for a in _AXES], f"refs{level}")
        named = frame.withColumnsRenamed({**dict(zip(_CELL, cube)), "refs": name})
        place = [F.floor((v + 2) * 2.0 ** (level - 2)).cast("int") == F.col(c) for v, c in zip(vector.values(), cube)]
        small = level == 0 or plan_bytes(frame) <= BROADCAST_BYTES
        found = found.join(F.broadcast(named) if small else named, place, "left").drop(*cube)
        lists.append(name)
    best, = free(found, "best")
    # The closest point is the one whose unit vector has the largest product with the row's own: three
    # multiplications per candidate; the distance itself is worked out for the winner only.
    ex, ey, ez = vector.values()
    item = F.coalesce(*lists) if lists else F.lit(None).cast("array<struct<f0: long, rx: double, ry: double, rz: double>>")
    closest = F.array_min(F.transform(item, lambda c: F.struct((-(ex * c["rx"] + ey * c["ry"] + ez * c["rz"])).alias("far"), c["f0"].alias("id"), c.alias("c"))))
    usable = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    chosen = found.select(*df.columns, F.when(usable, closest).alias(best))
    if not lists:
        return chosen.select(*df.columns, *[F.lit(None).cast(ref.schema[c].dataType).alias(c) for c in (ref_id, *attrs)],
                             F.lit(None).cast("double").alias("distance"))
    distance = haversine(F.col(lat), F.col(lon), F.col(f"{best}.c.f1"), F.col(f"{best}.c.f2"), units=units)
    return chosen.select(
        *df.columns, *[F.col(f"{best}.c.{fields[c]}").alias(c) for c in (ref_id, *attrs)], distance.alias("distance"))
