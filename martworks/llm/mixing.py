"""Mixing sources to target weights by Pareto order sampling.

A source's target over its size is the number of times each of its words is wanted. The whole part is given to every
document as certain copies. For the rest, documents are ranked by the odds of a random number over the odds of their
inclusion, and taken in that order until the words left to the source are used up. The random number is a hash of
the document's id and text, so reruns agree.

The order inside a source needs no window over the source: ranks fall into runs of buckets, sums of runs and of the
buckets in a run give the words before each, and running sums are formed inside buckets only. There are as many
buckets in a run as the rows ask for, so that a bucket holds about a thousand rows of its source at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import BLANK, bounded, prefix_sums, shielded, stored, text_of, words_of

MAX_COPIES = 3
RUNS = 1 << 12
ROWS_PER_BUCKET = 1000
#: The documents' preferences while they are mixed; no column of the input may have this name.
PREFERENCE = "preference of the mix"


def source_targets(sizes: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """Per source (null is one, the last) its size and target, from rows of ``source`` and ``size``.

    Sources in code point order weigh 1, 2, 3, repeating, and share the sum of all sizes. No target exceeds
    ``max_copies`` times its source's size; the excess goes to the others by weight until none is above. With sources
    ordered by capacity over weight the capped ones come first, so one pass over running sums finds the level.
    One row per source goes through the windows, which are not partitioned. ``place`` numbers the sources from 1.
    """
    by = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    by = by.withColumn("place", place).withColumn("_weight", ((F.col("place") - 1) % 3 + 1).cast("double"))
    room = F.col("source_size") * F.lit(float(max_copies))
    by = by.withColumn("_room", room).withColumn("_at", room / F.col("_weight"))
    before = Window.orderBy("_at", "place").rowsBetween(Window.unboundedPreceding, -1)
    onwards = Window.orderBy("_at", "place").rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("_room").over(before), F.lit(0.0)))
             / F.sum("_weight").over(onwards))
    by = by.withColumn("_level", level)
    # The level belongs to the first source that it does not fill.
    cut = F.min(F.when(F.col("_at") > F.col("_level"), F.struct("_at", "_level"))).over(everything)
    by = by.withColumn("_cut", cut["_level"])
    target = F.least(F.col("_room"), F.coalesce(F.col("_cut") * F.col("_weight"), F.col("_room")))
    return by.select("source", "place", "source_size", target.alias("target"))


def _random(seed: str, doc_id: str, text: Column) -> Column:
    """A number between 0 and 1, both excluded, for each id and text."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id), text), 12) + 0.5) / F.lit(float(1 << 52))


def _plan(docs: DataFrame, max_copies: int, seed: str, preference: Column) -> tuple[DataFrame, DataFrame]:
    """Thin rows with their copies, and per source what decides them."""
    sizes = stored(docs.select(
        "doc_id", "source", F.size(words_of(text_of())).cast("long").alias("size"),
        _random(seed, "doc_id", text_of()).alias("_u"), preference.cast("double").alias("_prefer")), "mix-sizes")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = source_targets(sizes, max_copies).withColumn("_whole", F.floor(ratio))
    sources = sources.withColumn("_part", ratio - F.col("_whole"))
    sources = stored(sources.withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size")), "mix-sources")
    rows = _of_source(sizes, sources)
    rows = rows.withColumn("_rank", pareto_rank(F.col("_u"), inclusion(F.col("_part"), F.col("_prefer"))))
    # Within a source this is in the order of the ranks, and even between 0 and 1 for equal preferences.
    odds = F.col("_u") / (1 - F.col("_u")) / F.col("_prefer")
    in_run = max(1, -(-sizes.count() // (RUNS * ROWS_PER_BUCKET)))
    rows = rows.withColumn("_bucket", F.floor(odds / (1 + odds) * float(RUNS * in_run)))
    parts = rows.groupBy("place", "_bucket").agg(F.sum("size").alias("_words"))
    parts = stored(parts.withColumn("_run", F.floor(F.col("_bucket") / in_run)), "mix-buckets")
    runs = prefix_sums(parts.groupBy("place", "_run").agg(F.sum("_words").alias("_all")), ["place"], "_run", _runs="_all")
    parts = prefix_sums(parts, ["place", "_run"], "_bucket", _inside="_words").join(runs, ["place", "_run"])
    parts = parts.select("place", "_bucket", (F.col("_runs") + F.col("_inside")).alias("_before"))
    order = Window.partitionBy("place", "_bucket").orderBy("_rank")
    rows = rows.join(parts, ["place", "_bucket"])
    inside = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    extra = (F.col("size") > 0) & (F.col("_before") + inside + F.col("size") / 2 <= F.col("_rest"))
    rows = rows.withColumns({"_extra": extra, "_twin": F.row_number().over(order) - F.rank().over(order) + 1})
    copies = F.when(F.col("size") > 0, F.col("_whole") + F.col("_extra").cast("long")).otherwise(F.lit(0))
    return rows.withColumn("copies", copies.cast("long")), sources


def _of_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    sources = bounded(sources.withColumnRenamed("source", "_source"))
    return rows.join(sources, rows["source"].eqNullSafe(sources["_source"])).drop("_source")


def inclusion(part: Column, preference: Column) -> Column:
    """The chance of one more copy: the source's part, its odds multiplied by the document's preference."""
    p = F.least(F.greatest(part, F.lit(1e-12)), F.lit(1 - 1e-12))
    odds = p / (1 - p) * preference
    return odds / (1 + odds)


def pareto_rank(random: Column, chance: Column) -> Column:
    """Odds of the random number over odds of inclusion; the smallest are taken first."""
    return random / (1 - random) * (1 - chance) / chance


def mix(docs: DataFrame, *, max_copies: int = MAX_COPIES, seed: str = "mix", preference: Column | None = None) -> DataFrame:
    """Per row ``doc_id``, ``source``, ``size`` (words; null text: 0), ``source_size``, ``target``, ``copies`` and
    ``taken`` (words).

    ``preference`` multiplies a document's odds of inclusion (1 for all by default). The document on a source's
    border is taken if that comes nearer to the target. Rows without words are never taken. Identical rows have equal
    ranks: so many of them are taken as come nearest to the target, whichever. An empty table gives no rows.
    """
    rows, _ = _plan(docs, max_copies, seed, preference if preference is not None else F.lit(1.0))
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies",
                       (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, *, max_copies: int = MAX_COPIES, seed: str = "mix", preference: Column | None = None) -> DataFrame:
    """The mixed corpus: each row, with its own columns, as often as :func:`mix` takes it.

    Texts are not shuffled: the last rank taken of each source decides in the row. Only identical rows at that very
    rank are numbered.
    """
    prefer = preference if preference is not None else F.lit(1.0)
    rows, sources = _plan(docs, max_copies, seed, prefer)
    last = rows.groupBy("place").agg(F.max(F.when(F.col("_extra"), F.struct("_rank", "_twin"))).alias("_last"))
    sources = sources.join(last, "place").select(
        "source", F.col("place").alias("_mix_place"), F.col("_whole").alias("_mix_whole"), F.col("_part").alias("_mix_part"),
        F.col("_last._rank").alias("_mix_rank"), F.col("_last._twin").alias("_mix_twin"))
    rank = pareto_rank(_random(seed, "doc_id", text_of()), inclusion(F.col("_mix_part"), F.col(PREFERENCE)))
    hidden, back = shielded(docs.withColumn(PREFERENCE, prefer), "doc_id", "text", "source", PREFERENCE)
    judged = _of_source(hidden, stored(sources, "mix-last")).filter(text_of().rlike(f"[^{BLANK[1:-2]}]"))
    judged = judged.withColumn("_mix_mine", rank)
    border = F.coalesce(F.col("_mix_mine") == F.col("_mix_rank"), F.lit(False))
    twins = Window.partitionBy("_mix_place").orderBy("_mix_mine")
    plain = judged.filter(~border).withColumn("_mix_more", F.col("_mix_mine") < F.col("_mix_rank"))
    tied = judged.filter(border).withColumn("_mix_more", F.row_number().over(twins) <= F.col("_mix_twin"))
    copies = F.col("_mix_whole").cast("int") + F.coalesce(F.col("_mix_more"), F.lit(False)).cast("int")
    out = plain.unionByName(tied)
    return back(out.withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(0), copies)))).drop(PREFERENCE)
