"""Tables by key in files, of which a batch or merge reads only what can hold its keys.

The rows lie in buckets by the leading bits of their key's hash. A bucket whose rows pass a bound is cut in two (and
these again), as in extendible hashing; one with many small folders is written as one. So buckets stay about equally
large while their number grows with the table, and a batch of a thousand keys reads a thousand buckets at most. Which
folders of which buckets count is listed in a directory file per batch beside the data: a batch that is repeated
starts from the directory before it and replaces what it wrote, and folders that no longer count are removed two
batches later.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from martworks.operators.dedup import keep_latest
from martworks.operators.skew import free, null_safe
from martworks.session import AS_THEY_LIE, Copies, stored, tidy_shuffles

#: Rows of a bucket above which it is cut, folders above which they are written as one, bits of a bucket's number.
SPLIT_ROWS = 1_000_000
MANY_FOLDERS = 16
MOST_BITS = 30
#: Tasks that a folder is at least written by.
WRITERS = 64
#: Rows, new and known, above which copied rows are written in several passes over the buckets; passes at most.
PASS_ROWS = 4_000_000
MOST_PASSES = 8

ROOT = 1


def fs_path(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, fs = fs_path(spark, path)
    return fs.exists(folder)


def _listed(spark: SparkSession, path: str) -> list[str]:
    folder, fs = fs_path(spark, path)
    return [str(f.getPath().getName()) for f in fs.listStatus(folder)] if fs.exists(folder) else []


def bucket_of(keys: list[str], leaves: dict[int, dict]) -> Column:
    """The bucket of a row: a leaf of the tree in which bucket b has the halves 2b and 2b + 1."""
    hashed = F.xxhash64(*keys)
    by_bits: dict[int, list[int]] = {}
    for leaf in leaves:
        by_bits.setdefault(leaf.bit_length() - 1, []).append(leaf)
    found = []
    # The leaves hold every hash, so the level with most of them is what is left over and needs no list.
    for place, (bits, some) in enumerate(levels := sorted(by_bits.items(), key=lambda x: len(x[1])), 1):
        number = (F.lit(1 << bits) + F.shiftrightunsigned(hashed, 64 - bits)).cast("int") if bits else F.lit(ROOT)
        found.append(F.when(number.isin(some), number) if place < len(levels) else number)
    return F.coalesce(*found)


class KeyedFolder:
    """A folder of rows by key, written by one stream or one load at a time. With ``newest`` there may be several rows of a key, of which the
    newest counts; else a key has one row."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: StructType, newest: list[str] | None = None,
                 split_rows: int = SPLIT_ROWS, many_folders: int = MANY_FOLDERS):
        self.spark, self.path, self.keys, self.schema, self.newest = spark, path, keys, schema, newest
        self.split_rows, self.many_folders = split_rows, many_folders

    # The directory.

    def _versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in _listed(self.spark, f"{self.path}/_buckets") if n.endswith(".json") and n[0] != ".")

    def _load(self, version: int) -> dict:
        folder, fs = fs_path(self.spark, f"{self.path}/_buckets/{version}.json")
        stream = fs.open(folder)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def leaves(self, before: int | None = None) -> dict[int, dict]:
        """The buckets with their rows and folders, as they were before a batch or are now."""
        known = [v for v in self._versions() if before is None or v < before]
        if not known:
            return {ROOT: {"rows": 0, "folders": []}}
        return {int(k): v for k, v in self._load(known[-1])["leaves"].items()}

    def _commit(self, batch_id: int, leaves: dict[int, dict], dead: list[str]) -> None:
        document = {"leaves": leaves, "dead": dead, "keys": self.keys, "newest": self.newest, "schema": self.schema.jsonValue()}
        draft, fs = fs_path(self.spark, f"{self.path}/_buckets/.{batch_id}.draft")
        target, _ = fs_path(self.spark, f"{self.path}/_buckets/{batch_id}.json")
        out = fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(document).encode()))
        finally:
            out.close()
        fs.delete(target, False)
        fs.rename(draft, target)

    def tidy(self, batch_id: int) -> None:
        """Remove what stopped counting two batches ago or earlier."""
        older = [v for v in self._versions() if v < batch_id][:-1]
        for version in older:
            for place in [*self._load(version)["dead"], f"_buckets/{version}.json"]:
                folder, fs = fs_path(self.spark, f"{self.path}/{place}")
                fs.delete(folder, True)

    # The rows.

    def bucket(self, leaves: dict[int, dict]) -> Column:
        return bucket_of(self.keys, leaves)

    def rows(self, leaves: dict[int, dict], buckets: list[int] | None = None) -> DataFrame:
        """The stored rows, of some buckets or of all."""
        wanted = leaves if buckets is None else buckets
        places = [f"{self.path}/batch_id={i}/_bucket={b}" for b in wanted for i in leaves[b]["folders"]]
        if not places:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*places)

    def ready(self, rows: int) -> dict[int, dict]:
        """The buckets of an empty table that is to get so many rows. A table of several starts half full, so that it
        need not be cut, which writes all of it again, as soon as it grows."""
        more = min((-(-2 * rows // self.split_rows) - 1).bit_length(), MOST_BITS) if rows > self.split_rows else 0
        return {(ROOT << more) + i: {"rows": 0, "folders": []} for i in range(1 << more)}

    def write(self, rows: DataFrame, folder: int, leaves: dict[int, dict], near: list[int] | None = None, unique: bool = True,
              passes: int = 1) -> None:
        """Rows in a folder of a batch, by bucket; replaces what an earlier attempt wrote. With ``near`` only those whose
        key these buckets lack, without ``unique`` one of a key. In several passes, each over a part of the buckets, the
        rows are read as often, but only as large a part of them is shuffled at a time."""
        for i in range(passes):
            known = self.rows(leaves, some) if (some := [b for b in near or [] if b % passes == i]) else None
            with tidy_shuffles(self.spark, **AS_THEY_LIE):
                (self.placed(rows, leaves, known, unique, (i, passes)).write.partitionBy("_bucket").mode("append" if i else "overwrite")
                 .options(partitionOverwriteMode="static", compression="zstd").parquet(f"{self.path}/batch_id={folder}"))

    def placed(self, rows: DataFrame, leaves: dict[int, dict], known: DataFrame | None = None, unique: bool = True,
               part: tuple[int, int] = (0, 1)) -> DataFrame:
        """The rows that a pass (its number, of so many) writes, with their bucket.

        Rows of several buckets are brought together first: there are about as many files as buckets, not one per bucket
        and task. They meet known keys and each other where they are then, so nothing is shuffled for that."""
        placed = rows.select(*[f.name for f in self.schema])
        if len(leaves) > 1:
            share, = free(rows, "_share")
            here, (number, passes) = ["_bucket", share], part
            # Few buckets are dealt in shares by their hash.
            shares = F.pmod(F.xxhash64(*self.keys), F.lit(-(-WRITERS * passes // len(leaves)))).cast("int")

            def together(some: DataFrame) -> DataFrame:
                some = some.withColumns({"_bucket": self.bucket(leaves), share: shares})
                return (some.where(F.pmod("_bucket", F.lit(passes)) == number) if passes > 1 else some).repartition(*here)
            placed, known = together(placed), known and together(known.select(*self.keys))
        else:
            here = []
        if not unique:
            placed = placed.dropDuplicates([*here, *self.keys])
        if known is not None:
            placed = with_keys(placed, known, [*here, *self.keys], "left_anti", plain=here)
        return placed.drop(share) if here else placed.withColumn("_bucket", self.bucket(leaves))

    def current(self) -> DataFrame:
        """All rows, one per key."""
        rows = self.rows(self.leaves())
        return keep_latest(rows, self.keys, self.newest) if self.newest else rows

    def _written(self, folder: int) -> DataFrame | None:
        """Rows per bucket of a folder, counted from the files' footers."""
        place = f"{self.path}/batch_id={folder}"
        folder, fs = fs_path(self.spark, place)
        found = fs.listStatusIterator(folder) if fs.exists(folder) else None
        while found and found.hasNext():
            if str(found.next().getPath().getName()).startswith("_bucket="):
                rows = self.spark.read.schema(StructType([*self.schema.fields, StructField("_bucket", IntegerType())]))
                return rows.parquet(place).groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
        return None


def settle(written: dict[str, tuple[KeyedFolder, dict[int, dict]]], batch_id: int) -> None:
    """After a batch is written: note its rows, cut buckets that became large, join those of many folders, and commit."""
    counts = _counted({name: folder._written(batch_id) for name, (folder, _) in written.items()})
    for name, (folder, old) in written.items():
        leaves = {b: {"rows": x["rows"], "folders": list(x["folders"])} for b, x in old.items()}
        for b, n in counts.get(name, {}).items():
            leaves[b]["rows"] += n
            leaves[b]["folders"].append(batch_id)
        changed = [b for b, x in leaves.items() if (x["rows"] > folder.split_rows and b.bit_length() <= MOST_BITS)
                   or len(x["folders"]) > folder.many_folders]
        dead: list[str] = []
        if changed:
            rows = folder.rows(leaves, changed)
            # A folder holds a key once.
            several = any(len(leaves[b]["folders"]) > 1 for b in changed)
            rows = keep_latest(rows, folder.keys, folder.newest) if folder.newest and several else rows
            after = {b: x for b, x in leaves.items() if b not in changed}
            for b in changed:
                dead += [f"batch_id={i}/_bucket={b}" for i in leaves[b]["folders"]]
                more = (max(1, -(-leaves[b]["rows"] // folder.split_rows)) - 1).bit_length()
                more = min(more, MOST_BITS + 1 - b.bit_length())
                after.update({(b << more) + i: {"rows": 0, "folders": []} for i in range(1 << more)})
            # Folders of earlier batches have numbers from 0; the one that joins them has its own below.
            joined = -batch_id - 1
            folder.write(rows, joined, after)
            for b, n in _counted({name: folder._written(joined)}).get(name, {}).items():
                after[b] = {"rows": n, "folders": [joined]}
            leaves = after
        folder._commit(batch_id, leaves, dead)


def _counted(frames: dict[str, DataFrame | None]) -> dict[str, dict[int, int]]:
    """Rows per bucket of several frames of few rows, in one job."""
    some = [rows.select(F.lit(name).alias("name"), "_bucket", "n") for name, rows in frames.items() if rows is not None]
    out: dict[str, dict[int, int]] = {}
    for r in reduce(DataFrame.unionByName, some).collect() if some else []:
        out.setdefault(r["name"], {})[r["_bucket"]] = r["n"]
    return out


def with_keys(df: DataFrame, known: DataFrame, keys: list[str], how: str, plain: list[str] | None = None) -> DataFrame:
    """Rows whose key occurs in ``known`` (``left_semi``) or does not (``left_anti``), null equal to null. Of the keys
    the ``plain`` ones are never null: frames that lie by them are joined as they lie."""
    names = {k: f"_known{i}" for i, k in enumerate(keys)}
    other = known.select(*[F.col(k).alias(n) for k, n in names.items()])
    never = plain or []
    same = null_safe(df, some := [k for k in keys if k not in never], other, [names[k] for k in some])
    return df.join(other, reduce(lambda a, k: a & (df[k] == other[names[k]]), never, same), how)


def touched(frames: dict[str, tuple[DataFrame, KeyedFolder, dict[int, dict]]]) -> dict[str, list[int]]:
    """The buckets that the keys of each frame lie in, found in one job; fewer than rows and than buckets."""
    found = [rows.select(F.lit(name).alias("name"), folder.bucket(leaves).alias("bucket")).distinct()
             for name, (rows, folder, leaves) in frames.items()]
    out: dict[str, list[int]] = {name: [] for name in frames}
    for r in reduce(DataFrame.unionByName, found).collect():
        out[r["name"]].append(r["bucket"])
    return out


def add_unseen(frames: dict[str, tuple[DataFrame, str, list[str]]], batch_id: int, most: dict[str, int] | None = None,
               unique: bool = True, **bounds: int) -> None:
    """Of each frame (rows, path, keys) write those whose key the table does not hold yet. The rows have unique keys, or
    without ``unique`` become so where they are written.

    The frames are written one after the other. A frame that is to meet the stored rows of several buckets is read
    twice, so a copy is kept on disk until it is written; one into a table of a single bucket meets that. One that goes
    into an empty table is copied only if it may have more rows than a bucket (``most``, or without ``unique`` always),
    to be counted: the table begins with as many buckets as it needs. Copies of many rows are written in passes.
    """
    folders = {}
    for name, (rows, path, keys) in frames.items():
        folder = KeyedFolder(rows.sparkSession, path, keys, rows.schema, **bounds)
        folder.tidy(batch_id)
        leaves = folder.leaves(before=batch_id)
        empty = not any(x["folders"] for x in leaves.values())
        copies, passes = Copies(rows.sparkSession), 1
        try:
            if not unique or (len(leaves) > 1 if not empty else (most or {}).get(name, 0) > folder.split_rows):
                rows = copies.add(rows, "batch")
                n = rows.count()
                leaves = folder.ready(n) if empty else leaves
                passes = min(MOST_PASSES, len(leaves), max(1, -(-(n + sum(x["rows"] for x in leaves.values())) // PASS_ROWS)))
            near = [] if empty else touched({name: (rows, folder, leaves)})[name] if len(leaves) > 1 else list(leaves)
            folder.write(rows, batch_id, leaves, near, unique, passes)
        finally:
            copies.drop()
        folders[name] = (folder, leaves)
    settle(folders, batch_id)


def first_seen(path: str, keys: list[str], shape: Callable[[DataFrame], DataFrame], few_repeats: bool = False,
               **bounds: int) -> Callable[[DataFrame, int], None]:
    """Sink for rows whose key no other batch has written, each key once (null equals null): what a deduplication over the
    whole stream gives, with the keys in files instead of state that grows without bound. Rows that repeat within a batch
    are left out before they are sent anywhere, or with ``few_repeats`` only after that: one shuffle less."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = shape(batch) if few_repeats else shape(batch).dropDuplicates(keys)
        add_unseen({"rows": (rows, path, keys)}, batch_id, unique=not few_repeats, **bounds)
    return write


def upsert_folder(path: str, keys: list[str], newest: list[str], shape: Callable[[DataFrame], DataFrame] | None = None,
                  **bounds: int) -> Callable[[DataFrame, int], None]:
    """Sink for a table with one row per key, the newest over all batches. A batch only adds its rows; older rows of a key
    go when its bucket is joined or cut, and :func:`read` leaves them out. A batch that is repeated changes nothing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = keep_latest(shape(batch) if shape else batch, keys, newest)
        folder = KeyedFolder(batch.sparkSession, path, keys, rows.schema, newest, **bounds)
        folder.tidy(batch_id)
        leaves = folder.leaves(before=batch_id)
        folder.write(rows, batch_id, leaves)
        settle({"rows": (folder, leaves)}, batch_id)
    return write


#: In tables of merges: the merge that a row came with.
MERGE = "_merge"


def merge(src: DataFrame, path: str, keys: list[str], newest: list[str] | None = None, insert: bool = True, **bounds: int) -> None:
    """Upsert into a table by key on disk, or with ``insert`` false only update the keys it holds; the source wins.

    Several source rows of a key are first reduced to the newest, or without ``newest`` to the one of the largest
    values. Only the merged rows are written, besides buckets that are cut or joined; an update reads the buckets its
    keys lie in. A null key equals a null key. A merge that is cut short leaves the table as it was.
    """
    spark = src.sparkSession
    rows = keep_latest(src, keys, newest or [c for c in src.columns if c not in keys])
    known = KeyedFolder(spark, path, keys, rows.schema)._versions()
    number = known[-1] + 1 if known else 0
    rows = stored(rows.withColumn(MERGE, F.lit(number)), "merge")
    folder = KeyedFolder(spark, path, keys, rows.schema, [MERGE], **bounds)
    folder.tidy(number)
    leaves = folder.leaves()
    if not insert:
        near = touched({"rows": (rows, folder, leaves)})["rows"]
        rows = with_keys(rows, folder.rows(leaves, near), keys, "left_semi")
    folder.write(rows, number, leaves)
    settle({"rows": (folder, leaves)}, number)


def is_keyed(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/_buckets")


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a keyed folder, one per key."""
    folder = KeyedFolder(spark, path, [], StructType())
    known = folder._load(folder._versions()[-1])
    return KeyedFolder(spark, path, known["keys"], StructType.fromJson(known["schema"]), known["newest"]).current().drop(MERGE)
