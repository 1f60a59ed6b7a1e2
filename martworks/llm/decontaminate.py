"""Benchmark decontamination: short test items found inside long documents.

Items are partitioned by their number of five-word shingles. For each partition that occurs, the shingles of a
document, however long, are cut into runs of about the size of the partition's smallest item, and each run gets a
MinHash signature; so run and item are of like size, and the containment asked for means a large similarity whatever
the document's length. An equal coordinate makes a candidate (bands of one row: any lower probability of a match
would lose small items), which is verified by the exact share of the item's different shingles that the whole
document holds.

With 16 independent coordinates and runs of the least item size the chance to miss an item of which 0.8 is there
stays below 1 in 10,000, also when its shingles are scattered one to a run: a coordinate matches with a chance of
shared / (item + run - 1), 0.46 at least.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded, computed, measured_bytes, shielded, shingle_hashes, stored, text_digest, text_of, words_of

THRESHOLD = 0.8
COORDINATES = 16
#: Least number of shingles of each partition of items, and the length of the runs searched for it.
PARTITIONS = {1: 1, 2: 2, 4: 4, 8: 8}
#: Items are broadcast in blocks of at most about so many bytes; each block is one pass over the documents.
BLOCK_BYTES = 32 << 20


def _shingled(rows: DataFrame, name: str) -> DataFrame:
    """Add the shingle hashes of the lower-cased text as column ``name``."""
    rows = computed(rows, _w=words_of(F.lower(text_of())))
    return computed(rows, **{name: shingle_hashes(F.col("_w"))}).drop("_w")


def _coordinates(least: int) -> int:
    return 1 if least == 1 else COORDINATES


def _minima(hashes: Column, least: int) -> Column:
    """The MinHash signature of a set of hashes under the functions of a partition: the least value of a hash with each
    seed. Seeds also tell partitions and coordinates apart."""
    seeds = F.array(*[F.lit(100 * least + j) for j in range(_coordinates(least))])
    return F.transform(seeds, lambda seed: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, seed))))


def _run_minima(hashes: str, least: int) -> Column:
    """The signatures of all runs of a document's hashes, in one array."""
    length = PARTITIONS[least]
    starts = F.sequence(F.lit(0), F.size(hashes) - 1, F.lit(length))
    runs = F.transform(starts, lambda i: F.slice(hashes, i + 1, length))
    return F.flatten(F.transform(runs, lambda run: _minima(run, least)))


def items_of(benchmark: DataFrame) -> DataFrame:
    """Stored ``item_id``, its different shingles and its partition; items without words are left out, and rows that
    repeat an id are items of their own under the same id."""
    items = _shingled(benchmark.select("item_id", "text"), "_all").withColumn("shingles", F.array_distinct("_all"))
    least = F.lit(None).cast("int")
    for bound in sorted(PARTITIONS):
        least = F.when(F.size("shingles") >= bound, F.lit(bound)).otherwise(least)
    items = items.select("item_id", "shingles", least.alias("least")).filter(F.size("shingles") > 0)
    return stored(items.withColumn("item_key", F.xxhash64("item_id", "shingles")).dropDuplicates(["item_key"]), "bench-items")


def _anchors(items: DataFrame, partitions: list[int]) -> DataFrame:
    parts = [items.filter(F.col("least") == p).select("item_key", F.explode(_minima(F.col("shingles"), p)).alias("minimum"))
             for p in partitions]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return stored(out, "bench-anchors")


def matches(docs: DataFrame, benchmark: DataFrame, *, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per matching row and item ``doc_id``, ``digest`` (of the text), ``item_id``, ``containment``; repeated.

    No text is shuffled: candidates are verified where the document was read. A null text has no words; a text or
    item of one to four words has one shingle, of them all. No item or no document gives no rows.
    """
    items = items_of(benchmark)
    partitions = sorted(r["least"] for r in items.select("least").distinct().collect())  # at most four
    if not partitions:
        return docs.sparkSession.createDataFrame([], "doc_id long, digest binary, item_id long, containment double")
    given = _shingled(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "_h")
    given = given.withColumn("digest", text_digest(text_of())).drop("text")
    given = given.filter(F.size("_h") > 0)
    given = given.withColumn("minimum", F.explode(F.concat(*[_run_minima("_h", p) for p in partitions])))
    blocks = max(1, -(-measured_bytes(items) * (COORDINATES + 1) // block_bytes))
    out = None
    for block in range(blocks):
        mine = items.filter(F.pmod("item_key", F.lit(blocks)) == block)
        anchors = _anchors(mine, partitions)
        found = given.join(bounded(anchors, 2 * block_bytes), "minimum")
        found = found.join(bounded(mine, 2 * block_bytes).select("item_key", "item_id", "shingles"), "item_key")
        share = F.size(F.array_intersect("shingles", "_h")) / F.size("shingles")
        found = (found.withColumn("containment", share).filter(F.col("containment") >= threshold)
                 .select("doc_id", "digest", F.col("item_id").cast("long").alias("item_id"), "containment"))
        out = found if out is None else out.unionByName(found)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id``, ``item_id`` and the best ``containment`` of the rows under these ids."""
    return matches(docs, benchmark, **options).groupBy("doc_id", "item_id").agg(F.max("containment").alias("containment"))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows whose text holds no item, with their own columns."""
    hit = stored(matches(docs, benchmark, **options).select("digest").distinct(), "bench-hits")
    hidden, back = shielded(docs, "text")
    keyed = hidden.withColumn("digest", text_digest(text_of()))
    return back(keyed.join(bounded(hit), "digest", "left_anti"))
