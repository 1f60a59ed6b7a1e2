"""The registered corpus queries on the smallest tables, against SQL or plain Python."""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus
import oracle
from martworks.llm import packing, token_coder
from test_mixing import targets
from test_near_duplicates import brute_classes
from test_quality_rules import counts

FOLDER = "/root/testdata/sf0.001"


def result(spark, start):
    name = next(n for n in entry.queries() if n.startswith(start))
    return entry.queries()[name](spark, FOLDER).collect()


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").collect()


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{FOLDER}/pages.parquet").collect()


@pytest.mark.parametrize("start", ["op2_", "op4_"])
def test_those_with_sql(spark, start):
    name = next(n for n in entry.queries() if n.startswith(start))
    assert oracle.compare(spark, oracle.connect(FOLDER), FOLDER, name) == ""


def test_main_text(spark, pages):
    def article(source):
        inner = re.sub(r"<[^>]*\Z", "", re.search(r"<article>(.*?)(?:</article>|\Z)", source, re.S)[1])
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        return "\n".join(b for b in blocks if b)

    want = [(p.page_id, p.url, article(p.html), len(article(p.html))) for p in pages]
    assert sorted(tuple(r) for r in result(spark, "op1_")) == sorted(want)


def test_archives(spark, pages):
    got = {r.page_id: r for r in result(spark, "op3_")}
    assert len(got) == len(pages)
    for p in pages:
        data = (p.html or "").encode()
        assert (got[p.page_id].url, got[p.page_id].payload_bytes, got[p.page_id].payload_digest) == (p.url, len(data), hashlib.sha256(data).hexdigest())


def test_near_duplicates(spark, documents):
    assert Counter((r.doc_id, r.class_id) for r in result(spark, "op5_")) == brute_classes([(d.doc_id, d.text) for d in documents])


def test_mix(spark, documents):
    sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    source = {d.doc_id: d.source for d in documents}
    for d in documents:
        n = len(corpus.words(d.text))
        sizes[d.source] += n
        largest[d.source] = max(largest[d.source], n)
    want = targets(sizes)
    for r in result(spark, "op6_"):
        assert r.source_size == sizes[source[r.doc_id]] and abs(r.target - want[source[r.doc_id]]) < 1e-6 and r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1 for s in want)


def test_quality(spark, documents):
    want = {d.doc_id: counts(d.text) for d in documents}
    for r in result(spark, "op7_"):
        n, chars, symbols, _, lines, repeats = want[r.doc_id][:6]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeats)
        assert r.base_failed == (n < 10 or 100 * repeats > 20 * n) and not (r.kept and r.base_failed)


def test_languages(spark, pages):
    got = {r.page_id: r.lang for r in result(spark, "op8_")}
    said = {p.page_id: re.search(r'<html lang="(\w+)"', p.html)[1] for p in pages}
    assert sum(got[i] == x for i, x in said.items()) >= 0.97 * len(said)


def test_token_files(spark, documents):
    tokenizer, start, want = token_coder.Units("byte_bpe_50k.json").tokenizer, 0, []
    for d in sorted(documents, key=lambda d: d.doc_id):
        ids = tokenizer.encode(d.text or "", add_special_tokens=False).ids + [2]
        want.append((d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in result(spark, "op9_")) == want


def test_shards(spark, documents):
    got = result(spark, "op10_")
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {
        (d.doc_id, len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in documents}
    sums, slots, groups = defaultdict(int), defaultdict(list), defaultdict(int)
    text = {d.doc_id: d.text for d in documents}
    for r in got:
        sums[r.shard] += r.size
        slots[r.shard].append(r.slot)
        groups[text[r.doc_id]] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    bins = defaultdict(int)
    ordered = sorted(groups.values(), reverse=True)
    for size, b in zip(ordered, packing.balanced(ordered, 16)):
        bins[b] += size
    # Cells join small groups, so this may differ a little from packing every group by itself.
    assert max(sums.values()) <= 1.05 * max(bins.values())
