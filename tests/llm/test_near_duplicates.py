from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus
from martworks.llm import dart_minhash as D, shingle_arrays as S
from martworks.llm.components import connected


def similarity(a, b) -> float:
    a, b = Counter(corpus.windows(a)), Counter(corpus.windows(b))
    most = sum((a | b).values())
    return sum((a & b).values()) / most if most else 0.0


def brute_classes(rows, threshold=0.8):
    texts = sorted({r[1] or "" for r in rows})
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    holders = defaultdict(set)
    for t in texts:
        for x in set(corpus.windows(t)):
            holders[x].add(t)
    for t in texts:
        for other in set().union(*[holders[x] for x in corpus.windows(t)]) if corpus.windows(t) else ():
            if other > t and similarity(t, other) >= threshold:
                root[find(other)] = find(t)
    ids = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            ids[find(r[1] or "")].append(r[0])
    return Counter((r[0], min(ids[find(r[1] or "")], default=None)) for r in rows)


def copies(n=150):
    """Texts, near copies with a changed word here and there, chains of them, and texts that only share a part."""
    rng = corpus.random.Random(11)
    rows = []
    for k in range(n):
        text = corpus.sentence(rng, rng.randint(40, 150)).split()
        for _ in range(rng.choice([1, 1, 2, 3, 8])):
            rows.append((len(rows), " ".join(text), "en", "s", 1))
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = corpus.sentence(rng, 1)
        if k % 5 == 0:
            half = len(text) // 2
            rows.append((len(rows), " ".join(text[:half]) + " " + corpus.sentence(rng, half), "en", "s", 1))
    return rows


def test_classes_are_those_of_brute_force(spark):
    rows = copies() + corpus.awkward()
    docs = corpus.documents(spark, rows).withColumns({"node": F.lit("x"), "bands": F.lit(1), "class_id": F.lit(5)})
    got = D.classes(docs)
    assert Counter((r.doc_id, r.class_id) for r in got.collect()) == brute_classes(rows)
    stay = D.one_of_each(docs)
    assert stay.columns == docs.columns
    texts = [r.text or "" for r in stay.collect()]
    assert len(texts) == len(set(texts)) == got.select("class_node").distinct().count()


def test_one_large_group_and_no_group(spark):
    rng = corpus.random.Random(2)
    base = corpus.sentence(rng, 100).split()
    rows = []
    for i in range(300):
        own = list(base)
        own[rng.randrange(100)] = f"w{i}"
        rows.append((i, " ".join(own), "en", "s", 1))
    assert {r.class_id for r in D.classes(corpus.documents(spark, rows)).collect()} == {0}
    apart = [(i, corpus.sentence(rng, 50), "en", "s", 1) for i in range(50)]
    assert D.one_of_each(corpus.documents(spark, apart)).count() == 50
    assert D.classes(corpus.documents(spark, [])).count() == 0
    assert D.one_of_each(corpus.documents(spark, [])).count() == 0


@pytest.mark.parametrize("share", [0.3, 0.6, 0.9])
def test_coordinates_agree_with_the_weighted_similarity(share):
    rng = np.random.default_rng(5)
    elements = rng.integers(1, 1 << 62, 400, dtype=np.uint64)
    a = rng.uniform(0.2, 9, 400)
    b = np.where(rng.random(400) < share, a, a * rng.uniform(0, 3, 400))
    b[:20] = 1e-9
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    k = 4000
    sig = D.signatures(np.repeat([0, 1], 400), np.tile(elements, 2), np.concatenate([a, b]), 2, k)
    assert abs((sig[0] == sig[1]).mean() - want) < 4 * np.sqrt(want * (1 - want) / k)
    assert len(np.unique(sig[0] % np.uint64(k))) == k


def test_shingles_of_arrow_texts():
    texts = [r[1] for r in corpus.awkward()] + ["a b c d e a b c d e", "\x0bx\x0cy\rz"]
    hashes, windows = S.shingle_hashes(pa.array(texts))
    assert windows.tolist() == [len(corpus.windows(t)) for t in texts]
    seen, at = {}, 0
    for t in texts:
        for w in corpus.windows(t):
            assert seen.setdefault(w, hashes[at]) == hashes[at]
            at += 1
    assert len(set(seen.values())) == len(seen)
    sliced, n = S.shingle_hashes(pa.array(texts).slice(3, 5))
    assert n.tolist() == windows.tolist()[3:8] and sliced.tolist() == hashes[windows[:3].sum():windows[:8].sum()].tolist()


def test_components(spark):
    rng = corpus.random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_texts_of_one_key_are_told_apart(spark, monkeypatch):
    key = D.text_key
    monkeypatch.setattr(D, "text_key", lambda text, part=0: key(text, part) if part else F.pmod(key(text), F.lit(16)))
    rows = copies() + corpus.awkward()
    docs = corpus.documents(spark, rows)
    assert Counter((r.doc_id, r.class_id) for r in D.classes(docs).collect()) == brute_classes(rows)
    stay = [r.text or "" for r in D.one_of_each(docs).collect()]
    monkeypatch.undo()
    assert sorted(stay) == sorted(r.text or "" for r in D.one_of_each(docs).collect())
