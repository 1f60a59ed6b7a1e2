from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from corpus import awkward, documents
from pyspark.sql import functions as F

from martworks.llm import perfect_hash_dedup as ph


def digests(n, seed=0):
    return np.frombuffer(b"".join(hashlib.sha256(f"{seed}:{i}".encode()).digest() for i in range(n)), np.uint8).reshape(n, 32)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 64, 5000])
def test_hash_is_minimal_and_perfect(n):
    keys = digests(n)
    built = ph.PerfectHash.build(keys)
    assert sorted(built.slots(keys)) == list(range(n)) and built.n == n


def test_repeated_digests_are_refused():
    with pytest.raises(ValueError):
        ph.PerfectHash.build(digests(3)[[0, 1, 1]])


def fields(n):
    out = {k: np.arange(n).astype(kind) for k, kind in ph.FIELDS.items()}
    return {**out, "n": np.ones(n, np.int64), "no_id": np.zeros(n, bool)}


def test_members_are_told_byte_by_byte():
    keys, others = digests(3000), digests(3000, 1)
    shard = ph.Shard.from_bytes(ph.Shard.build(keys, fields(3000)).to_bytes())
    assert (shard.fields["id"][shard.find(keys)] == np.arange(3000)).all()
    assert (shard.find(others) == -1).all()
    assert (shard.hashed.slots(others) >= 0).any()  # the hash alone would take some of them
    almost = keys.copy()
    almost[:, 31] ^= 1
    assert (shard.find(almost) == -1).all()


def expected(rows):
    """(id, id that stays, group size, kept, digest) per document."""
    groups, out = {}, []
    for doc_id, text, *_ in rows:
        digest = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()
        groups.setdefault(digest, []).append((-len(text or ""), doc_id is None, doc_id))
    for digest, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1], m[2] or 0))
        out += [(m[2], members[0][2], len(members), i == 0, digest) for i, m in enumerate(members)]
    return sorted(out, key=repr)


def actual(frame, *args, **options):
    return sorted((tuple(r) for r in ph.deduplicate(frame, *args, **options).collect()), key=repr)


def rows():
    texts = awkward()
    copies = [(500 + i, "  ".join(t[1].split(" ")) if t[1] else t[1], "en", "x", 1) for i, t in enumerate(texts[:20])]
    frequent = [(9000 - i, "a" + " " * (i % 7) + "b", None, "hot", 2) for i in range(900)]
    return texts + copies + frequent + [(7, "longer  ünïcode", "", "", 0), (8, "longer ünïcode", "", "", 0), (2 ** 60, "\x85a ", "", "", 0)]


@pytest.mark.parametrize("earlier", ["doc_id % 2 = 0", "true", "false", "doc_id > 8000", "cast(null as boolean)"])
def test_equals_grouping(spark, earlier):
    frame = documents(spark, rows()).withColumns({c: F.lit("x") for c in ("id", "row", "digest", "shard", "n", "keep_id", "file")})
    assert actual(frame, F.expr(earlier)) == expected(rows())


def test_many_shards_and_pieces(spark):
    assert actual(documents(spark, rows()), F.col("doc_id") % 3 == 0, shard_digests=4, piece_rows=50) == expected(rows())


def test_three_deliveries(spark):
    all_rows = rows()
    thin = ph.thin_rows(documents(spark, all_rows), F.lit(True))
    history = ph.build(ph.grouped(thin.where("row % 3 = 0")), 16)
    for part in (1, 2):
        history = ph.absorb(history, ph.grouped(thin.where(f"row % 3 = {part}")))
    found = ph.look_up(history, thin)
    assert found.where("keep_n is null").count() == 0
    kept = found.where("row = keep_row").count()
    assert kept == len({r[4] for r in expected(all_rows)})


def test_empty(spark):
    assert actual(documents(spark, []), F.lit(True)) == []
