"""Exact deduplication against history by a minimal perfect hash.

The distinct digests of the texts seen so far are kept in shards by their first bytes. A shard is a minimal perfect
hash over its digests: levels of bits, each digest owning the only bit that no other digest of its level hits, and the
number of set bits before it being its slot. A slot holds the full digest and the locator of the text that stays.
Any digest leads to at most one slot; whether it is a member is decided by comparing all its bytes there. Members
are repeats, whose slots are brought up to date; the others are grouped among themselves and get shards of their own.

Shards lie in files in the shared folder, many in a file, and are read by range. Rows of a shard are looked up in as
many tasks as their number asks for, so a text with a third of all rows has no task of its own size.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F

from martworks.session import scratch

from .common import BLANKS, bounded, stored, text_of

#: Digests of a shard, and rows that one task looks up in it.
SHARD_DIGESTS = 1 << 15
PIECE_ROWS = 1 << 18
LEVELS = 64
ROOM = 1.5


# The hash.

class PerfectHash:
    """A minimal perfect hash of distinct digests of 32 bytes: every digest has one slot of 0 to n - 1."""

    def __init__(self, levels: list[np.ndarray]):
        """``levels``: an array of flags per level."""
        self.levels = levels
        sizes = [int(flags.sum()) for flags in levels]
        self.n = sum(sizes)
        self._before = [sum(sizes[:i]) + np.cumsum(flags) - flags for i, flags in enumerate(levels)]

    @staticmethod
    def _place(words: np.ndarray, level: int, size: int) -> np.ndarray:
        """Where digests (rows of four words) fall in a level."""
        with np.errstate(over="ignore"):
            mixed = (words[:, level % 4] + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(29)) ^ words[:, (level + 1) % 4]) * np.uint64(0x94D049BB133111EB)
        return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, digests: np.ndarray) -> "PerfectHash":
        left, levels = _words(digests), []
        while len(left):
            if len(levels) == LEVELS:
                raise ValueError("digests are repeated")
            size = int(ROOM * len(left)) + 8
            at = cls._place(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest; a digest that was not built in gets any slot, or -1."""
        words, out = _words(digests), np.full(len(digests), -1, np.int64)
        open_ = np.arange(len(digests))
        for level, flags in enumerate(self.levels):
            at = self._place(words[open_], level, len(flags))
            hit = flags[at]
            out[open_[hit]] = self._before[level][at[hit]]
            open_ = open_[~hit]
        return out


def _words(digests: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(digests).view("<u8").reshape(len(digests), 4)


#: What a slot holds beside the digest: code points, id (and whether it is null) and row of the text that stays, and
#: how many texts are equal to it.
FIELDS = {"chars": np.int64, "id": np.int64, "no_id": np.bool_, "row": np.int64, "n": np.int64}
ARROW = {"chars": pa.int64(), "id": pa.int64(), "no_id": pa.bool_(), "row": pa.int64(), "n": pa.int64()}
SLOT = "chars long, id long, no_id boolean, row long, n long"


class Shard:
    """A perfect hash with the contents of its slots, as arrays in the order of the slots."""

    def __init__(self, hashed: PerfectHash, digests: np.ndarray, fields: dict[str, np.ndarray]):
        self.hashed, self.digests, self.fields = hashed, digests, fields

    @classmethod
    def build(cls, digests: np.ndarray, fields: dict[str, np.ndarray]) -> "Shard":
        """Of distinct digests and their fields, in any order."""
        hashed = PerfectHash.build(digests)
        order = np.empty(len(digests), np.int64)
        order[hashed.slots(digests)] = np.arange(len(digests))
        return cls(hashed, digests[order], {k: v[order] for k, v in fields.items()})

    def find(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest that is a member, byte by byte; -1 for others."""
        slots = self.hashed.slots(digests)
        same = slots >= 0
        same[same] = (self.digests[slots[same]] == digests[same]).all(axis=1)
        return np.where(same, slots, -1)

    def absorb(self, slots: np.ndarray, other: dict[str, np.ndarray]) -> None:
        """Join the texts of ``other`` to those of their slots (each slot at most once): numbers add up, and the better
        text stays."""
        mine = {k: v[slots] for k, v in self.fields.items()}
        better, tied = other["chars"] > mine["chars"], other["chars"] == mine["chars"]
        for k in ("no_id", "id", "row"):
            better |= tied & (other[k] < mine[k])
            tied &= other[k] == mine[k]
        for k in ("chars", "id", "no_id", "row"):
            self.fields[k][slots[better]] = other[k][better]
        self.fields["n"][slots] += other["n"]

    def to_bytes(self) -> bytes:
        out, levels = io.BytesIO(), self.hashed.levels
        np.savez(out, sizes=np.array([len(f) for f in levels], np.int64), digests=self.digests, **self.fields,
                 bits=np.concatenate([np.packbits(f) for f in levels]) if levels else np.zeros(0, np.uint8))
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> "Shard":
        held = np.load(io.BytesIO(data))
        levels, at, bits = [], 0, held["bits"]
        for size in held["sizes"]:
            end = at + (size + 7) // 8
            levels.append(np.unpackbits(bits[at:end], count=int(size)).astype(bool))
            at = end
        return cls(PerfectHash(levels), held["digests"], {k: held[k] for k in FIELDS})


# The files.

class ShardWriter:
    """One file of many shards, under a name of its own, so a repeated attempt writes another."""

    def __init__(self, folder: str):
        system, path = pa.fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        self.name, self.at = f"{uuid.uuid4().hex}.mph", 0
        self._stream = system.open_output_stream(f"{path}/{self.name}")

    def add(self, shard: Shard) -> tuple[str, int, int]:
        """File name, place and length of the shard."""
        data = shard.to_bytes()
        self._stream.write(data)
        self.at += len(data)
        return self.name, self.at - len(data), len(data)

    def close(self) -> None:
        self._stream.close()


def read_shard(folder: str, file: str | None, place: int, length: int) -> Shard | None:
    if file is None:
        return None
    system, path = pa.fs.FileSystem.from_uri(folder)
    with system.open_input_file(f"{path}/{file}") as source:
        source.seek(place)
        return Shard.from_bytes(source.read(length))


def _digests(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), 32)


def _fields(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {k: batch.column(k).to_numpy(zero_copy_only=False).astype(kind) for k, kind in FIELDS.items()}


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``shard``, as one batch per shard."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        number = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if held and held[0].column("shard")[0].as_py() != number[start]:
                yield _joined(held)
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]


# The frames.

PLACES = "shard int, kind string, file string, place long, length long"
KINDS = ("known", "fresh")


def shard_of(digest: Column, shards: int) -> Column:
    """The shard of a digest, by its first four bytes."""
    return F.pmod(F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("long"), F.lit(shards)).cast("int")


def thin_rows(docs: DataFrame, earlier: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored, a row per document: ``digest`` of the text without ASCII white space, ``chars`` (code points of the whole
    text), ``id``, ``no_id``, ``earlier`` and a unique ``row``. Texts go no further than this."""
    text, id_ = text_of(text_col), F.col(f"`{id_col}`")
    rows = docs.select(
        F.unhex(F.sha2(F.translate(text, BLANKS, "").cast("binary"), 256)).alias("digest"), F.length(text).cast("long").alias("chars"),
        F.coalesce(id_.cast("long"), F.lit(0)).alias("id"), id_.isNull().alias("no_id"),
        F.coalesce(earlier, F.lit(False)).alias("earlier"),
    )
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "dedup-rows")


def grouped(rows: DataFrame) -> DataFrame:
    """Stored, a row per digest: the text that stays (most code points, then least id, null last) and their number.
    Combined on the map side, so a frequent text is one row per task."""
    best = F.min(F.struct((-F.col("chars")).alias("less"), "no_id", "id", "row"))
    found = rows.groupBy("digest").agg(best.alias("b"), F.count("*").alias("n"))
    return stored(found.select("digest", (-F.col("b.less")).alias("chars"), "b.id", "b.no_id", "b.row", "n"), "dedup-groups")


class History:
    """The digests seen so far: ``shards`` of them in ``folder``, and the stored ``places`` (shard, kind, file, place,
    length). A shard has up to two parts, the one first built (``known``) and one of what came later (``fresh``)."""

    def __init__(self, folder: str, shards: int, places: DataFrame):
        self.folder, self.shards, self.places = folder, shards, places

    def sides(self) -> DataFrame:
        """A row per shard with the places of both parts."""
        place = F.struct("file", "place", "length")
        both = self.places.groupBy("shard").agg(*[F.max(F.when(F.col("kind") == k, place)).alias(k) for k in KINDS])
        return both.select("shard", *[F.col(f"{k}.{c}").alias(f"{k}_{c}") for k in KINDS for c in ("file", "place", "length")])


def build(groups: DataFrame, shard_digests: int = SHARD_DIGESTS) -> History:
    """The history of a stored frame of distinct digests (as of :func:`grouped`)."""
    shards = max(1, -(-groups.count() // shard_digests))
    folder = scratch(groups.sparkSession, "dedup-index")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in _by_shard(batches):
            writer = writer or ShardWriter(folder)
            yield _place_row(batch, "known", writer.add(Shard.build(_digests(batch.column("digest")), _fields(batch))))
        if writer:
            writer.close()

    dealt = groups.withColumn("shard", shard_of(F.col("digest"), shards)).repartition(_tasks(shards), "shard").sortWithinPartitions("shard")
    return History(folder, shards, stored(dealt.mapInArrow(run, PLACES), "dedup-places"))


def _tasks(shards: int) -> int:
    """Tasks for so many shards; beyond some thousands a task takes several."""
    return max(1, min(shards, 4096 + shards // 16))


def _place_row(batch: pa.RecordBatch, kind: str, place: tuple[str, int, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "shard": batch.column("shard").slice(0, 1), "kind": pa.array([kind]), "file": pa.array([place[0]], pa.string()),
        "place": pa.array([place[1]], pa.int64()), "length": pa.array([place[2]], pa.int64())})


def _sides(folder: str, batch: pa.RecordBatch) -> list[Shard | None]:
    """Both parts of the shard of a batch's first row."""
    return [read_shard(folder, *[batch.column(f"{k}_{c}")[0].as_py() for c in ("file", "place", "length")]) for k in KINDS]


def absorb(history: History, groups: DataFrame) -> History:
    """The history after another delivery of distinct digests: members have their slots brought up to date, the others
    join the fresh part of their shard, which is built anew.

    A task holds one shard and the delivery's digests of it. Where deliveries outgrow the first, :func:`build` a new
    history, as the number of shards stays.
    """
    folder = history.folder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in _by_shard(batches):
            writer = writer or ShardWriter(folder)
            sides = _sides(folder, batch)
            digests, fields = _digests(batch.column("digest")), _fields(batch)
            stranger, changed = np.ones(len(digests), bool), [False, False]
            for i, side in enumerate(sides):
                if side:
                    slots = side.find(digests)
                    member = slots >= 0
                    side.absorb(slots[member], {k: v[member] for k, v in fields.items()})
                    stranger &= ~member
                    changed[i] = bool(member.any())
            if stranger.any():
                old = sides[1]
                more = {k: v[stranger] for k, v in fields.items()}
                sides[1] = Shard.build(np.vstack([old.digests, digests[stranger]]) if old else digests[stranger],
                                       {k: np.concatenate([old.fields[k], v]) for k, v in more.items()} if old else more)
                changed[1] = True
            for kind, side, new in zip(KINDS, sides, changed):
                if new:
                    yield _place_row(batch, kind, writer.add(side))
        if writer:
            writer.close()

    rows = groups.withColumn("shard", shard_of(F.col("digest"), history.shards)).join(bounded(stored(history.sides(), "dedup-sides")), "shard", "left")
    dealt = rows.repartition(_tasks(history.shards), "shard").sortWithinPartitions("shard")
    done = stored(dealt.mapInArrow(run, PLACES), "dedup-new-places")
    same = history.places.join(done.select("shard", "kind"), ["shard", "kind"], "left_anti").select(*done.columns)
    return History(folder, history.shards, stored(same.unionByName(done), "dedup-places"))


def look_up(history: History, rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The rows (with a unique ``row`` and a ``digest``) and what their slot holds, as the columns ``keep_chars``, ``keep_id``,
    ``keep_no_id``, ``keep_row``, ``keep_n``; null where the digest is in no slot.

    Rows of a shard are dealt to one task per ``piece_rows`` of them, whether they hold one text or many.
    """
    numbered = rows.withColumn("shard", shard_of(F.col("digest"), history.shards))
    pieces = numbered.groupBy("shard").agg(F.ceil(F.count("*") / piece_rows).cast("int").alias("pieces"))
    places = stored(pieces.join(history.sides(), "shard", "left"), "dedup-pieces")
    tasks = places.agg(F.sum("pieces")).first()[0] or 1
    dealt = (numbered.join(bounded(places), "shard").withColumn("piece", F.pmod(F.xxhash64("row"), F.col("pieces")))
             .repartition(min(tasks, 4096 + tasks // 16), "shard", "piece").sortWithinPartitions("shard"))
    own, folder = [f.name for f in rows.schema], history.folder
    names = [f"keep_{k}" for k in FIELDS]
    kept = ", ".join(f"keep_{part.strip()}" for part in SLOT.split(","))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, shards = None, []
        for batch in batches:
            number = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                part = batch.slice(start, end - start)
                if opened != number[start]:
                    opened = number[start]
                    shards = _sides(folder, part)
                digests = _digests(part.column("digest"))
                found = {k: np.zeros(len(digests), kind) for k, kind in FIELDS.items()}
                member = np.zeros(len(digests), bool)
                for shard in filter(None, shards):
                    slots = shard.find(digests)
                    hit = slots >= 0
                    member |= hit
                    for k in FIELDS:
                        found[k][hit] = shard.fields[k][slots[hit]]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in own], *[pa.array(found[k], ARROW[k], mask=~member) for k in FIELDS]], [*own, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return dealt.mapInArrow(run, f"{schema}, {kept}")


def deduplicate(docs: DataFrame, earlier: Column, *, id_col: str = "doc_id", text_col: str = "text",
                shard_digests: int = SHARD_DIGESTS, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Per document ``id_col``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``; ``earlier`` tells which documents
    are history (null counts as not).

    Texts are equal if they are without ASCII white space; null counts as empty. Of equal texts that of most code
    points stays, then of the least id, null ids last; of repeated rows exactly one is kept. An empty table gives no
    rows. Other columns are read only by ``earlier``. Ids are whole numbers.
    """
    rows = thin_rows(docs, earlier, id_col, text_col)
    history = absorb(build(grouped(rows.where("earlier")), shard_digests), grouped(rows.where("not earlier")))
    found = look_up(history, rows.drop("earlier"), piece_rows)
    return found.select(
        F.when(~F.col("no_id"), F.col("id")).alias(id_col), F.when(~F.col("keep_no_id"), F.col("keep_id")).alias("keep_id"),
        F.col("keep_n").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))
