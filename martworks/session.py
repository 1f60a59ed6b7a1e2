"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "martworks", **extra: str) -> SparkSession:
    """A session with the settings the library expects; master and memory come from the deployment."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable options to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; on a cluster a missing
    setting is an error, since a machine-local folder would be lost with its executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    base = tempfile.mkdtemp(prefix="martworks-")
    spark.sparkContext.setCheckpointDir(base)
    return f"{base}"


_copies: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder, remembered for :func:`clear_scratch`."""
    _copies.append(f"{shared_dir(spark)}/martworks/{name}-{uuid.uuid4().hex}")
    return _copies[-1]


def stored(df, name: str):
    """Write a frame that several later steps read below the shared folder, and read it back: it is computed once, and a
    lost executor costs nothing."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: The shuffle files of a command go when it has ended, not when the driver next collects its garbage.
CLEANUP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: Frames that lie by some of the columns they are joined on are joined as they lie.
AS_THEY_LIE = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


@contextmanager
def tidy_shuffles(spark: SparkSession, **more: str):
    """Commands inside leave no shuffle files behind; ``more`` settings hold for them, too."""
    settings = {**CLEANUP, **more}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Copies:
    """Copies below the shared folder that are needed for a while: packed more tightly than those of :func:`stored`, made
    without leaving shuffle files, and dropped together."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def add(self, df, name: str, row_group: int | None = None):
        """The rows of a frame, written and read back. Rows of long lists are read a row group at a time, so it bounds
        what a task holds of them."""
        path = scratch(self.spark, name)
        self.paths.append(path)
        with tidy_shuffles(df.sparkSession):
            df.write.options(compression="zstd", **({"parquet.block.size": row_group} if row_group else {})).parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Remove the copies; no frame may read them any more."""
        while self.paths:
            _copies.remove(path := self.paths.pop())
            _remove(self.spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove the copies this process has made below the shared folder, once no frame reads them any more."""
    while _copies:
        _remove(spark, _copies.pop())


def cut_lineage(df):
    """Reliable checkpoint: the rows are written to the shared folder, so a lost executor costs nothing."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
