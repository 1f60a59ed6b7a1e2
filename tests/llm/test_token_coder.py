from __future__ import annotations

import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus
from martworks.llm import token_coder as T


def padded(ids):
    n = max(1, -(-len(ids) // T.BLOCK))
    out = np.zeros(n * T.BLOCK, np.uint16)
    out[:len(ids)] = ids
    return out.reshape(n, T.BLOCK)


@pytest.mark.parametrize("make", [
    lambda r: r.integers(0, 65536, 9000), lambda r: np.zeros(5000), lambda r: np.full(3000, 65535), lambda r: np.arange(5000) % 7,
    lambda r: np.minimum(r.zipf(1.2, 20_000), 65535), lambda r: np.repeat(r.integers(0, 65536, 300), 20), lambda r: r.integers(0, 2, 4000) * 65535])
def test_blocks_round_trip(make):
    ids = padded(make(np.random.default_rng(1)).astype(np.uint16))
    blocks = T.encode_blocks(ids)
    assert np.array_equal(T.decode_blocks(blocks), ids)
    # Every block stands alone.
    assert np.array_equal(T.decode_blocks(blocks[-1:]), ids[-1:])
    assert T.encode_blocks(ids[-1:]) == blocks[-1:]


def test_repetition_costs_little_and_noise_not_much_more_than_itself():
    rng = np.random.default_rng(2)
    again = T.encode_blocks(padded(np.tile(rng.integers(0, 50_000, 50), 41)[:2048]))
    noise = T.encode_blocks(padded(rng.integers(0, 65536, 2048)))
    assert len(again[0]) < 900 and len(noise[0]) < 2048 * 2 * 1.2


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.integers(0, 65535), max_size=60), max_size=30), st.integers(0, 3))
def test_files_round_trip(docs, groups):
    out = io.BytesIO()
    writer = T.Writer(out)
    for k in range(0, len(docs), groups + 1):
        part = docs[k:k + groups + 1]
        writer.add(np.arange(k, k + len(part)), np.array([i % 5 == 4 for i in range(k, k + len(part))], bool),
                   np.array([len(d) for d in part], np.int64), np.array([i for d in part for i in d], np.uint16))
    assert writer.close() == (len(docs), sum(map(len, docs)))
    data = out.getvalue()
    got = [(int(i), bool(n), p.tolist()) for ids, null, parts in T.read_documents(io.BytesIO(data), len(data)) for i, n, p in zip(ids, null, parts)]
    assert got == [(i, i % 5 == 4, d) for i, d in enumerate(docs)] or not sum(map(len, docs))


def test_damage_is_seen():
    out = io.BytesIO()
    writer = T.Writer(out)
    writer.add(np.array([1]), np.array([False]), np.array([3000]), np.arange(3000))
    writer.close()
    data = out.getvalue()
    for at in (20, len(data) // 2, len(data) - 60, len(data) - 3):
        broken = data[:at] + bytes([data[at] ^ 255]) + data[at + 1:]
        with pytest.raises(ValueError):
            list(T.read_documents(io.BytesIO(broken), len(broken)))


TEXTS = ["", "a  b\n\n c  d e  \n é è \x85 x ", "<|endoftext|> hi 's don't   ", "tab\tand nbsp   em  x", "日本 語 🙂 a é à b", " lead", "trail ", "\n",
         "a'b 'll we 've", "x" * 5000, "1 23 456 é2", "ß ö ü", "a  b", "c  d", "e 　f", "naïve café été"]


def test_ids_are_those_of_the_tokenizer():
    units = T.Units("byte_bpe_50k.json")
    texts = TEXTS + [corpus.sentence(corpus.random.Random(i), 200) for i in range(20)] + [None]
    want = [units.tokenizer.encode(t or "", add_special_tokens=False).ids + [T.END_ID] for t in texts]
    for _ in range(2):  # the second time from what is known
        ids, counts = units.ids(pa.array(texts))
        assert np.split(ids, np.cumsum(counts)[:-1])[0].tolist() == want[0]
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want


def test_pieces_of_one_kind_are_looked_up_once():
    units = T.Units("byte_bpe_50k.json")
    units.ids(pa.array(["one, two. one\ntwo one"]))
    assert units.known == len(["one", ",", " two", ".", " one", "\n", "two"])
    ids, _ = units.ids(pa.array([" two; one."]))
    assert units.known == 8
    assert ids.tolist() == units.tokenizer.encode(" two; one.", add_special_tokens=False).ids + [T.END_ID]


def test_kinds_are_cut_as_the_tokenizer_does():
    units = T.Units("byte_bpe_50k.json")
    rng = corpus.random.Random(5)
    signs = [*"abZ09.,-'\u2019 \n\t\r\x85\u00a0é×÷ÀɏɐĀ日\u0301ßº²½#", " the", "'s", "'ll", "\n\n", " \n", "\n "]
    for _ in range(20):
        texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(100)]
        ids, counts = units.ids(pa.array(texts))
        want = [units.tokenizer.encode(t, add_special_tokens=False).ids + [T.END_ID] for t in texts]
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want


def test_pieces_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(T, "mix64", lambda x: x * np.uint64(0))
    units = T.Units("byte_bpe_50k.json")
    for text in ("one", "two", "seven", "one"):
        assert units.ids(pa.array([text]))[0].tolist() == units.tokenizer.encode(text, add_special_tokens=False).ids + [T.END_ID]


def test_frequencies_count_early():
    ids = padded(np.random.default_rng(3).integers(0, 1024, 2048))
    assert len(T.encode_blocks(ids)[0]) < 2048 * 1.33


def test_documents_round_trip(spark):
    rows = corpus.awkward() + [(500 + i, t, "en", "s", 1) for i, t in enumerate(TEXTS)]
    docs = corpus.documents(spark, rows).withColumns({"tie": F.lit("x"), "start": F.lit(1)}).repartition(4)
    tokenizer = T.Units("byte_bpe_50k.json").tokenizer
    got = T.round_trip(docs).collect()

    def made(text):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [T.END_ID]
        return len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())

    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((repr(r[0]), *made(r[1])) for r in rows)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    known = [i for i in ids if i is not None]
    assert known == sorted(known) and ids[:len(known)] == known
    assert T.round_trip(docs.limit(0)).count() == 0
