"""Starting, bounding and sinking streams; a checkpoint folder is always required."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from martworks.functions.nested import to_message
from martworks.operators import keyed
from martworks.session import Copies, tidy_shuffles

Sink = Callable[[DataFrame, int], None]
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state on disk instead of in the executors' heap; set before a query first starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def distinct_within(df: DataFrame, keys: list[str], ts: str, delay: str = "5 minutes") -> DataFrame:
    """Duplicates removed with bounded state: the watermark is declared before the deduplication."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def trigger_options(every: str | None = None) -> dict:
    """A fixed interval, or everything available now (which also stands in for the one-time trigger)."""
    return {"processingTime": every} if every else {"availableNow": True}


def start(df: DataFrame, sink: Sink, checkpoint: str, mode: str = "append", every: str | None = None) -> StreamingQuery:
    """Run a sink function on every micro-batch; continues from the checkpoint after a restart."""
    return (
        df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(every)).foreachBatch(sink).start()
    )


def start_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                every: str | None = None) -> StreamingQuery:
    """Append to files, each row exactly once."""
    return (
        df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(every)).start(path)
    )


def start_console(df: DataFrame, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Print batches, for a look at a small stream."""
    return (
        df.writeStream.format("console").outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def run_for(query: StreamingQuery, seconds: int | None = None) -> list[dict]:
    """Let a query run to its end or for a given time, stop it, and give its progress reports."""
    try:
        query.awaitTermination(seconds) if seconds is not None else query.awaitTermination()
    finally:
        query.stop()
    return list(query.recentProgress)


def fan_out(*sinks: Sink, on_disk: bool = False) -> Sink:
    """One micro-batch for several sinks: computed once, released afterwards. With ``on_disk`` it is kept in the shared
    folder and not in the executors' memory."""
    def write(batch: DataFrame, batch_id: int) -> None:
        copies = Copies(batch.sparkSession)
        kept = copies.add(batch, "batch") if on_disk else batch.persist()
        try:
            for sink in sinks:
                sink(kept, batch_id)
        finally:
            copies.drop() if on_disk else kept.unpersist()
    return write


def batch_folder(path: str, shape: Callable[[DataFrame], DataFrame] | None = None) -> Sink:
    """Each batch in its own folder, replaced when the batch is run again: repeated batches add nothing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = shape(batch) if shape else batch
        with tidy_shuffles(batch.sparkSession):
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
             .parquet(f"{path}/batch_id={batch_id}"))
    return write


def snapshot(path: str) -> Sink:
    """For complete mode: the whole result so far. Each batch is a version of its own; :func:`latest` reads the last
    one that is complete, and versions before the last two are removed."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch_folder(path)(batch, batch_id)
        for version in _versions(batch.sparkSession, path)[:-2]:
            folder, fs = keyed.fs_path(batch.sparkSession, f"{path}/batch_id={version}")
            fs.delete(folder, True)
    return write


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of a ``snapshot`` sink."""
    return spark.read.parquet(f"{path}/batch_id={_versions(spark, path)[-1]}")


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Complete batch folders, oldest first."""
    folder, fs = keyed.fs_path(spark, path)
    found = [str(f.getPath().getName()) for f in fs.listStatus(folder)]
    return sorted(int(n[9:]) for n in found if n.startswith("batch_id=") and keyed.exists(spark, f"{path}/{n}/_SUCCESS"))


def as_messages(batch: DataFrame) -> DataFrame:
    """Rows as JSON messages, ready for a topic."""
    return batch.select(to_message("*").alias("value"))


def batches(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a ``batch_folder`` sink, or of a keyed one."""
    if keyed.is_keyed(spark, path):
        return keyed.read(spark, path)
    return spark.read.option("basePath", path).parquet(path).drop("batch_id")


def newest_per_key(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """For update mode: the last written state of every key."""
    rows = spark.read.option("basePath", path).parquet(path)
    values = [c for c in rows.columns if c not in keys and c != "batch_id"]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v")).select(*keys, "_v.*")
