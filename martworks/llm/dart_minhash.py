"""Near-duplicate classes by DartMinHash signatures.

A text is the weighted set of its five-word shingles, weighted by how often they occur; similarity is the sum of the
smaller weights over the sum of the larger ones. Darts fall at random on the plane of weight and rank of each
element, the same in every text, and each dart belongs to one coordinate of the signature. Of the darts that lie
below the element's weight, the one of the earliest rank per coordinate is the signature's value: it agrees between
two texts with their similarity as the chance. The plane is cut into cells of area one, which hold a Poisson number
of darts drawn from a hash of element and cell, so only cells near rank zero are ever looked at.

Signatures are cut into bands. Texts that share a band are candidates, and are compared by their exact shingles.
Only pairs that may join two components are: first each text is held against the most central one it shares a band
with; then the pairs of texts that these links have not joined follow, from narrow cells (several bands in common),
whose members are most alike, to single bands. Of these only pairs are listed that share one of their rarest
shingles, as every pair of the wanted similarity does. So no link between components that the bands show is lost,
while in a large group of near copies few of the many pairs are ever listed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import bounded, shielded, stored, text_key, text_of
from .components import connected, contracted, labels
from .shingle_arrays import mix64, occurrences, pieces, shingle_hashes, weighted

THRESHOLD = 0.8
#: 24 bands of 5: a pair of similarity 0.8 is missed with a chance below 1 in 10,000.
BANDS, ROWS = 24, 5
#: Neighbouring bands that texts of a narrow cell have in common.
NARROW = 4

#: Chances that a cell of area one holds at most 0, 1, 2, ... darts, as 32-bit fractions.
_POISSON = np.array([math.floor(sum(math.exp(-1) / math.factorial(j) for j in range(i + 1)) * (1 << 32))
                     for i in range(12)], dtype=np.uint64)
_NO_ID = (1 << 63) - 1


def _fraction(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def signatures(owner: np.ndarray, elements: np.ndarray, weights: np.ndarray, n: int, k: int) -> np.ndarray:
    """n x k signatures of n weighted sets given as (owner, element hash, weight above 0); rows without elements are 0."""
    totals = np.bincount(owner, weights, n)
    out = np.zeros(n * k, np.uint64)
    left, theta = totals > 0, k * math.log(k) + 2 * k
    while left.any():
        use = left[owner]
        o, e, w = owner[use], elements[use], weights[use].astype(np.float64)
        slot, rank, dart = _throw(o, e, w, theta / totals[o], k)
        earliest = np.full(n * k, np.inf)
        np.minimum.at(earliest, slot, rank)
        hit = rank == earliest[slot]
        out[slot[hit]] = dart[hit]
        # Texts with a coordinate that no dart has reached are thrown at once more, up to a later rank.
        left &= np.isinf(earliest).reshape(n, k).any(axis=1)
        theta *= 2
    return out.reshape(n, k)


def _throw(owner, elements, weights, limit, k):
    """All darts below the weights and below the rank limit: slot (owner and coordinate), rank and identity."""
    found = []
    level, low, width = 0, 0.0, 1.0
    while len(owner):
        bands = np.maximum(np.ceil(limit * width), 1).astype(np.int64)
        row = np.repeat(np.arange(len(owner)), bands)
        band = np.arange(len(row)) - np.repeat(np.cumsum(bands) - bands, bands)
        cell = mix64(elements[row] ^ mix64(band.astype(np.uint64) * np.uint64(64) + np.uint64(level + 1)))
        darts = np.searchsorted(_POISSON, cell >> np.uint64(32), side="right")
        number = np.arange(int(darts.sum())) - np.repeat(np.cumsum(darts) - darts, darts)
        row, band, cell = np.repeat(row, darts), np.repeat(band, darts), np.repeat(cell, darts)
        dart = mix64(cell + (number.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        rank = (band + _fraction(mix64(dart ^ np.uint64(0xA24BAED4963EE407)))) / width
        weight = low + width * _fraction(mix64(dart ^ np.uint64(0x9FB21C651E98DF25)))
        good = (rank < limit[row]) & (weight < weights[row])
        row, dart, rank = row[good], dart[good], rank[good]
        found.append((owner[row] * k + (dart % np.uint64(k)).astype(np.int64), rank, dart))
        low, width, level = low + width, max(1.0, low + width), level + 1
        more = weights > low
        owner, elements, weights, limit = owner[more], elements[more], weights[more], limit[more]
    return tuple(np.concatenate(x) for x in zip(*found))


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.broadcast_to(mix64(np.arange(1, bands + 1, dtype=np.uint64)), (len(sig), bands)).copy()
    for r in range(rows):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + sig[:, r::rows][:, :bands])
    return out


def with_bands(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id``, ``node`` and ``rest`` (the text's key and the bits that tell apart texts of one key) and the band hashes
    of each row; none for a text without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                owner, elements, weights = weighted(*shingle_hashes(piece.column("text")))
                sig = signatures(owner, elements, weights, len(piece), bands * rows)
                filled = np.bincount(owner, minlength=len(piece)) > 0
                values = band_hashes(sig, bands, rows)[filled].astype(np.int64).ravel()
                ends = np.append(0, np.cumsum(filled * bands)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c) for c in ("doc_id", "node", "rest")),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(values))],
                    ["doc_id", "node", "rest", "bands"])
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(text_of()).alias("node"),
                        text_key(text_of(), 1).alias("rest"), text_of().alias("text"))
    return given.mapInArrow(run, "doc_id long, node long, rest long, bands array<long>")


def _clashes(sig: DataFrame) -> DataFrame | None:
    """The texts whose key another text has, too, but for one of each key: ``node``, ``rest`` and a key of their own,
    ``_near_node``, below zero. They are numbered in one window: by chance there are tens of them among 10^10 texts."""
    several = sig.groupBy("node").agg(F.min("rest").alias("_lo"), F.max("rest").alias("_hi")).filter("_lo < _hi")
    texts = sig.select("node", "rest").join(several, "node").filter("rest > _lo").select("node", "rest").distinct()
    texts = stored(texts, "near-clashes")
    if texts.isEmpty():
        return None
    return stored(texts.withColumn("_near_node", -F.row_number().over(Window.orderBy("node", "rest")).cast("long")), "near-own")


def _told_apart(rows: DataFrame, clashes: DataFrame | None) -> DataFrame:
    """The rows with one ``node`` per text, without ``rest``."""
    if clashes is None:
        return rows.drop("rest")
    found = rows.join(bounded(clashes), ["node", "rest"], "left")
    return found.withColumn("node", F.coalesce("_near_node", "node")).drop("_near_node", "rest")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """``node`` and the sorted hashes of its counted shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                hashes, windows = shingle_hashes(piece.column("text"))
                ends = np.append(0, np.cumsum(windows)).astype(np.int32)
                values = occurrences(hashes, windows).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("node"), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], ["node", "shingles"])
    return texts.mapInArrow(run, "node long, shingles array<long>")


def _keyed(docs: DataFrame, clashes: DataFrame | None) -> DataFrame:
    """The rows with ``first_id`` (the id, the largest long for none) and ``node``."""
    keys = {"first_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)), "node": text_key(text_of())}
    return _told_apart(docs.withColumns(keys | ({"rest": text_key(text_of(), 1)} if clashes else {})), clashes)


def _sets(docs: DataFrame, wanted: DataFrame, clashes: DataFrame | None) -> DataFrame:
    """Stored shingle sets of the wanted nodes (``node``, ``first_id``). One copy of each text is taken; the ids keep
    a text with very many copies from meeting in one task."""
    keyed = _keyed(docs.select("doc_id", text_of().alias("text")), clashes)
    texts = keyed.join(wanted, ["first_id", "node"]).groupBy("node").agg(F.first("text").alias("text"))
    return stored(shingle_sets(texts), "near-shingles")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The stored pairs (a, b) of nodes whose exact similarity reaches the threshold."""
    both = (pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("_b")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("_a")), "a"))
    shared = F.size(F.array_intersect("_a", "_b"))
    return stored(both.withColumn("_s", shared).filter(F.col("_s") >= _least_shared(F.size("_a"), F.size("_b"), threshold))
                  .select("a", "b"), "near-edges")


def _least_shared(a: Column, b: Column, threshold: float) -> Column:
    """Shared shingles that sets of these sizes need; a little less than exact, against rounding."""
    return F.ceil((a + b) * (threshold / (1 + threshold)) - 1e-9)


def _rarest(sets: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Per node its number of shingles and the rarest of them, in one order for all: two sets that reach the threshold
    share one of their first ``size - least shared + 1``. Frequencies are counted among these nodes."""
    mine = sets.join(nodes, "node").select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    mine = mine.join(mine.groupBy("s").agg(F.count("*").alias("_often")), "s")
    first = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9).cast("int") + 1
    ordered = mine.groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("_often", "s"))).alias("_all"))
    return ordered.select("node", "n", F.transform(F.slice("_all", 1, first), lambda x: x["s"]).alias("rare"))


def _shared(long: DataFrame) -> DataFrame:
    """The stored distinct (cell, node) rows of cells with several nodes; most have one."""
    shared = long.groupBy("cell").agg(F.min("node").alias("_lo"), F.max("node").alias("_hi")).filter("_lo < _hi").select("cell")
    return stored(long.join(shared, "cell").distinct(), "near-cells")


def _cells(signed: DataFrame, bands: int, together: int) -> DataFrame:
    """``cell`` and ``node``: a cell for each ``together`` neighbouring bands; those of one text alone are left out."""
    def cell(i: Column) -> Column:
        return F.xxhash64(i, *[F.get("bands", F.pmod(i + k, F.lit(bands))) for k in range(together)])

    return _shared(signed.select("node", F.explode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), cell)).alias("cell")))


def _with_leaders(cells: DataFrame) -> DataFrame:
    """Add each cell's leader, the member that shares the most cells with the most texts, and that weight: the text
    that near copies were made from is nearer to each of them than they are to each other."""
    sizes = cells.groupBy("cell").agg(F.count("*").alias("_size"))
    weights = cells.join(sizes, "cell").groupBy("node").agg(F.sum("_size").alias("weight"))
    leaders = cells.join(weights, "node").groupBy("cell").agg(F.max(F.struct("weight", "node")).alias("_top"))
    return cells.join(leaders, "cell").select("cell", "node", F.col("_top.node").alias("leader"), F.col("_top.weight").alias("weight"))


def _mixed(cells: DataFrame, roots: DataFrame) -> DataFrame:
    """The members of cells that hold texts of several components, with their component's root."""
    placed = cells.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = placed.groupBy("cell").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi")).filter("_lo < _hi").select("cell")
    return stored(placed.join(several, "cell"), "near-mixed")


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def classes(docs: DataFrame, *, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row ``doc_id``, ``node``, ``class_id`` (the least id of its class), ``class_node`` (the text that stands for
    the class, one that has this id) and ``class_size`` (rows).

    Linked texts and the texts linked to them form a class; equal texts always do, null texts being empty ones. A
    text of one to four words has one shingle. Rows without an id belong to classes like others; a class without any
    id has a null ``class_id``. An empty table gives no rows.
    """
    return _classes(docs, threshold, bands, rows)[0]


def _classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame | None]:
    """The rows of :func:`classes`, and the texts whose key is that of another."""
    sig = stored(with_bands(docs, bands, rows), "near-bands")
    clashes = _clashes(sig)
    sig = _told_apart(sig, clashes)
    nodes = stored(sig.groupBy("node").agg(F.min(F.coalesce("doc_id", F.lit(_NO_ID))).alias("first_id"),
                                           F.count("*").alias("_copies")), "near-nodes")
    # Only texts that share a band go on.
    cells = {1: _shared(sig.select("node", F.explode("bands").alias("cell")))}
    linked = stored(cells[1].select("node").distinct(), "near-linked")
    sets = _sets(docs, linked.join(nodes, "node").select("node", "first_id"), clashes)
    cells[NARROW] = _cells(sig.join(linked, "node"), bands, NARROW)
    # Each text against the most central leader of its bands.
    central = _with_leaders(cells[1]).filter("node <> leader").groupBy("node").agg(F.max(F.struct("weight", "leader")).alias("_best"))
    tested = stored(_pairs(central.select("node", F.col("_best.leader").alias("other"))), "near-pairs")
    edges = contracted(_verified(tested, sets, threshold))
    # Then every pair that may join two components, in one cell and with a rare shingle in common: first in narrow
    # cells, whose texts are most alike, then in bands.
    left = _mixed(cells[1], labels(edges)).select("node").distinct()
    rare = stored(_rarest(sets, left, threshold), "near-rarest")
    for together in (NARROW, 1):
        mixed = _mixed(cells[together], labels(edges)).join(rare, "node").select("cell", "node", "root", "n", "rare")
        other = mixed.select(F.col("cell").alias("_cell"), F.col("node").alias("other"), F.col("root").alias("_root"),
                             F.col("n").alias("_n"), F.col("rare").alias("_rare"))
        need = _least_shared(F.col("n"), F.col("_n"), threshold).cast("int")
        first = [F.slice(c, 1, F.greatest(m - need + 1, F.lit(0))) for c, m in (("rare", F.col("n")), ("_rare", F.col("_n")))]
        pairs = mixed.join(other, (F.col("cell") == F.col("_cell")) & (F.col("root") < F.col("_root")) & F.arrays_overlap(*first))
        pairs = stored(_pairs(pairs).join(tested, ["a", "b"], "left_anti"), "near-pairs")
        if not pairs.isEmpty():
            edges = edges.unionByName(_verified(pairs, sets, threshold))
            edges = contracted(edges) if together > 1 else edges
            tested = tested.unionByName(pairs)
    roots = connected(edges)
    known = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    by_root = known.groupBy("root").agg(F.min("first_id").alias("class_id"), F.sum("_copies").alias("class_size"))
    known = stored(known.join(by_root, "root"), "near-classes")
    stands = known.filter("first_id = class_id").groupBy("root").agg(F.min("node").alias("class_node"))
    known = known.join(stands, "root").select("node", F.nullif("class_id", F.lit(_NO_ID)).alias("class_id"), "class_node", "class_size")
    out = sig.select("doc_id", "node").join(known, "node").select("doc_id", "node", "class_id", "class_node", "class_size")
    return out, clashes


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """One row of each class, with its own columns: that of the least id. Texts are shuffled once, by id and key."""
    found, clashes = _classes(docs, **options)
    stay = found.select("class_id", "class_node").distinct().select(
        F.coalesce("class_id", F.lit(_NO_ID)).alias("first_id"), F.col("class_node").alias("node"))
    hidden, back = shielded(docs, "doc_id", "text")
    keyed = _keyed(hidden, clashes)
    return back(keyed.join(stay, ["first_id", "node"], "left_semi").dropDuplicates(["first_id", "node"]))
