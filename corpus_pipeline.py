"""The corpus pipeline: from raw documents to shards of a training mix.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read again as the next
one's ``docs``. Stages keep the columns of ``documents``; the last adds ``shard``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martworks.llm import dart_minhash, decontaminate, mixing, packing, quality_rules
from martworks.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the base rules or the learned decision list reject."""
    return quality_rules.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies, that of the least id."""
    return dart_minhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that sources come near their targets."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the shard of each document."""
    return packing.sharded(docs)


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source mix", source_mix),
    ("shards", shards),
]

#: A learned stage has no SQL counterpart; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
