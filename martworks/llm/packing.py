"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups of equal texts stay together. Groups above a fixed part of a shard are packed one by one; smaller ones are
joined by hash into cells, each an indivisible unit of many groups. The number of units is bounded by the two
parameters, whatever the number of rows, so the packing itself is small: units sorted by size enter the bin with the
least room that still holds them, found in a balanced tree.

With a fixed capacity every group is packed by itself: groups are dealt by hash into regions of a bounded number, each
packed in a task. In a region one bin at most is half empty; these bins, one a region, are packed once more.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import prefix_sums, shielded, stored, text_of

CELLS = 4096
SHARDS = 16
ROWS_PER_SLICE = 200_000
GROUPS_PER_REGION = 50_000


class RoomTree:
    """A treap of (room, bin), to find the least room of at least a size; priorities are a hash, so it is repeatable."""

    def __init__(self):
        self.root = None

    @staticmethod
    def _merge(a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            return (a[0], a[1], a[2], RoomTree._merge(a[3], b))
        return (b[0], b[1], RoomTree._merge(a, b[2]), b[3])

    @staticmethod
    def _split(node, key):
        """Those below the key, and the rest."""
        if node is None:
            return None, None
        if node[0] < key:
            low, high = RoomTree._split(node[3], key)
            return (node[0], node[1], node[2], low), high
        low, high = RoomTree._split(node[2], key)
        return low, (node[0], node[1], high, node[3])

    def add(self, room: int, bin_: int) -> None:
        priority = (bin_ * 0x9E3779B97F4A7C15 + room * 0xBF58476D1CE4E5B9) % (1 << 64)
        low, high = self._split(self.root, (room, bin_))
        self.root = self._merge(self._merge(low, ((room, bin_), priority, None, None)), high)

    def take(self, size: int):
        """Remove and return the tightest (room, bin) that holds the size; None if there is none."""
        node, found = self.root, None
        while node:
            if node[0] >= (size, -1):
                found, node = node[0], node[2]
            else:
                node = node[3]
        if found:
            low, rest = self._split(self.root, found)
            _, high = self._split(rest, (found[0], found[1] + 1))
            self.root = self._merge(low, high)
        return found


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """Bins of units that come in order of decreasing size; a unit above the capacity has a bin alone."""
    tree, bins, out = RoomTree(), 0, []
    for size in sizes:
        found = tree.take(size)
        if found is None:
            found, bins = (max(capacity, size), bins), bins + 1
        out.append(found[1])
        tree.add(found[0] - size, found[1])
    return out


def least_capacity(sizes: list[int], shards: int) -> int:
    """The least capacity found by halving at which the units need no more than ``shards`` bins."""
    if not sizes:
        return 0
    low, high = max(sizes[0], -(-sum(sizes) // shards)), max(sizes[0], 2 * -(-sum(sizes) // shards))
    while low < high:
        middle = (low + high) // 2
        if max(best_fit(sizes, middle)) < shards:
            high = middle
        else:
            low = middle + 1
    return high


def balanced(sizes: list[int], shards: int) -> list[int]:
    """Bins of units that come in order of decreasing size, at most ``shards``: a unit above the mean of what is left
    has a bin alone, the others are packed at the least capacity that does."""
    alone, left = 0, sum(sizes)
    while alone < min(shards - 1, len(sizes)) and sizes[alone] * (shards - alone) > left:
        left -= sizes[alone]
        alone += 1
    rest = sizes[alone:]
    return [*range(alone), *(alone + b for b in best_fit(rest, least_capacity(rest, shards - alone)))]


def _identity() -> dict:
    """Equal texts have equal digests; a null text is an empty one."""
    text = text_of()
    return {"_bytes": (F.octet_length(text) + 1).cast("long"), "_digest": F.md5(text.cast("binary"))}


def _units(thin: DataFrame, cells: int) -> tuple[DataFrame, DataFrame]:
    """Large groups (digest, unit), at most ``cells`` of them, and all units with their sizes and rows."""
    total = thin.agg(F.sum("_bytes")).first()[0] or 0
    large = (thin.groupBy("_digest").agg(F.sum("_bytes").alias("_sum")).filter(F.col("_sum") * cells > total)
             .select("_digest", F.concat(F.lit("text "), "_digest").alias("_large")))
    large = stored(large, "pack-large")
    units = _with_unit(thin, large, cells).groupBy("_unit").agg(F.sum("_bytes").alias("bytes"), F.count("*").alias("rows"))
    return large, stored(units, "pack-units")


def _with_unit(rows: DataFrame, large: DataFrame, cells: int) -> DataFrame:
    cell = F.concat(F.lit("cell "), F.pmod(F.xxhash64("_digest"), F.lit(cells)).cast("string"))
    joined = rows.join(F.broadcast(large), "_digest", "left")  # fewer than ``cells`` rows of fixed width
    return joined.withColumn("_unit", F.coalesce("_large", cell)).drop("_large")


def _assign(spark: SparkSession, units: DataFrame, shards: int) -> DataFrame:
    found = sorted(units.collect(), key=lambda u: (-u["bytes"], u["_unit"]))  # at most twice ``cells`` rows
    pairs = [(u["_unit"], b) for u, b in zip(found, balanced([u["bytes"] for u in found], shards))]
    return F.broadcast(spark.createDataFrame(pairs, "_unit string, shard int"))


def _packed_regions(groups: DataFrame, capacity: int, per_region: int) -> DataFrame:
    """Stored groups (``_digest``, ``bytes``) with ``region``, ``bin`` and ``filled``, the bytes of that bin."""
    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["bytes", "_digest"], ascending=[False, True], ignore_index=True)
        part["bin"] = best_fit(part["bytes"].tolist(), capacity)
        part["filled"] = part.groupby("bin")["bytes"].transform("sum")
        return part

    regions = max(1, -(-groups.count() // per_region))
    dealt = groups.withColumn("region", F.pmod(F.xxhash64("_digest"), F.lit(regions)).cast("int"))
    packed = dealt.groupBy("region").applyInPandas(pack, "_digest string, bytes long, region int, bin int, filled long")
    return stored(packed, "pack-regions")


def by_capacity(thin: DataFrame, capacity: int, per_region: int = GROUPS_PER_REGION) -> DataFrame:
    """Stored ``_digest`` and ``shard`` of every group of rows (``_digest``, ``_bytes``), in shards of the capacity; only
    a group above it has more, in a shard alone."""
    groups = stored(thin.groupBy("_digest").agg(F.sum("_bytes").alias("bytes")), "pack-groups")
    packed = _packed_regions(groups, capacity, per_region)
    bins = packed.select("region", "bin", "filled").distinct()
    full = bins.filter(F.col("filled") * 2 > capacity)
    counts = stored(full.groupBy("region").agg(F.count("*").alias("_n")).withColumn("_all", F.lit(0)), "pack-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    # One row a region goes through the first window, the bins of one region through the second.
    starts = prefix_sums(counts, ["_all"], "region", _before="_n").select("region", "_before")
    place = F.col("_before") + F.row_number().over(Window.partitionBy("region").orderBy("bin")) - 1
    numbers = full.join(starts, "region").select("region", "bin", place.cast("int").alias("shard"))
    # One bin a region at most is half empty.
    rest = sorted(bins.filter(F.col("filled") * 2 <= capacity).collect(), key=lambda b: (-b["filled"], b["region"], b["bin"]))
    again = [(b["region"], b["bin"], total + s) for b, s in zip(rest, best_fit([b["filled"] for b in rest], capacity))]
    numbers = numbers.unionByName(thin.sparkSession.createDataFrame(again, "region int, bin int, shard int"))
    return stored(packed.join(numbers, ["region", "bin"]).select("_digest", "shard"), "pack-places")


def _frequent(thin: DataFrame, cells: int) -> DataFrame:
    """Digests of the groups with more than one of ``cells`` parts of all rows, fewer than ``cells``."""
    rows = thin.count()
    return thin.groupBy("_digest").agg(F.count("*").alias("_n")).filter(F.col("_n") * cells > rows).select("_digest")


def sharded(docs: DataFrame, *, shards: int | None = SHARDS, capacity: int | None = None, cells: int = CELLS,
            per_region: int = GROUPS_PER_REGION) -> DataFrame:
    """The rows with their own columns and ``shard``: into ``shards`` of sizes as equal as the groups allow, without a
    shuffle of texts; or, with ``capacity`` in bytes, into few shards of that capacity, whatever it is, with one
    shuffle of the texts by group. A group above the capacity gets a shard of its own, and no other shard exceeds it. A
    column of the input named ``shard`` is replaced."""
    thin = stored(docs.select(*[c.alias(n) for n, c in _identity().items()]), "pack-sizes")
    own = [c for c in docs.columns if c.lower() != "shard"]
    hidden, back = shielded(docs.select(*own).withColumn("shard", F.lit(0)), "text", "shard")
    given = hidden.drop("shard").withColumns(_identity())
    if capacity is None:
        large, units = _units(thin, cells)
        return back(_with_unit(given, large, cells).join(_assign(docs.sparkSession, units, shards), "_unit"))
    places = by_capacity(thin, capacity, per_region)
    # Groups of very many rows are not shuffled by their digest.
    frequent = stored(places.join(_frequent(thin, cells), "_digest"), "pack-frequent")
    dealt = given.join(F.broadcast(frequent.withColumnRenamed("shard", "_known")), "_digest", "left")
    others = dealt.filter("_known is null").drop("_known").join(places, "_digest")
    return back(dealt.filter("_known is not null").withColumnRenamed("_known", "shard").unionByName(others))


def slots(docs: DataFrame, *, shards: int = SHARDS, cells: int = CELLS) -> DataFrame:
    """Per row ``doc_id``, ``size`` (bytes of the text and 1), ``text_crc32``, ``shard`` and ``slot``.

    Slots number the rows of a shard from 0 without gaps: rows are cut into slices by hash, slices are numbered
    inside, and the rows of the slices before are added. Identical rows may change places. Null texts are empty ones
    (size 1, checksum 0) and one group with them; null ids are allowed.
    """
    thin = stored(docs.select("doc_id", F.crc32(text_of().cast("binary")).alias("text_crc32"),
                              *[c.alias(n) for n, c in _identity().items()]), "pack-rows")
    large, units = _units(thin.select("_digest", "_bytes"), cells)
    rows = units.agg(F.sum("rows")).first()[0] or 0
    slices = max(1, -(-rows // (shards * ROWS_PER_SLICE)))
    placed = _with_unit(thin, large, cells).join(_assign(docs.sparkSession, units, shards), "_unit")
    # The id alone may be null for many rows, the digest equal for many; both together spread either.
    placed = placed.withColumn("_slice", F.pmod(F.xxhash64(F.lit("slot"), "doc_id", "_digest"), F.lit(slices * 8)).cast("int"))
    before = prefix_sums(placed.groupBy("shard", "_slice").agg(F.count("*").alias("_n")), ["shard"], "_slice",
                         _before="_n").drop("_n")
    order = Window.partitionBy("shard", "_slice").orderBy("doc_id", "text_crc32", "_digest")
    numbered = placed.join(before, ["shard", "_slice"])
    slot = (F.col("_before") + F.row_number().over(order) - 1).cast("long")
    return numbered.select("doc_id", F.col("_bytes").alias("size"), "text_crc32", "shard", slot.alias("slot"))
