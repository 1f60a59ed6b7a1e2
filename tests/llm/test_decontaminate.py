from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus
from martworks.llm import decontaminate as B


def brute(docs, items, threshold=0.8):
    out = {}
    for d, text in docs:
        have = set(corpus.windows((text or "").lower()))
        for i, item in items:
            want = set(corpus.windows((item or "").lower()))
            if want and len(want & have) >= threshold * len(want):
                out[d, i] = max(out.get((d, i), 0), len(want & have) / len(want))
    return out


def world(spark):
    rng = corpus.random.Random(21)
    items = [(i, corpus.sentence(rng, n)) for i, n in enumerate([3, 5, 6, 7, 8, 9, 11, 13, 15, 20, 40, 70, 200, 900])]
    docs = [(i, corpus.sentence(rng, rng.randint(20, 400))) for i in range(30)]
    for k, (i, item) in enumerate(items):
        words = item.split()
        inside = corpus.sentence(rng, 300).split()
        inside[137 + k:137 + k] = words
        docs.append((100 + i, " ".join(inside).upper()))                    # whole, in another case
        changed = list(words)
        changed[len(words) // 2] = "changed"
        docs.append((200 + i, corpus.sentence(rng, 61) + "\n" + "\t".join(changed) + "\n" + corpus.sentence(rng, 50)))
        docs.append((300 + i, " ".join(words[:len(words) // 2]) + " " + corpus.sentence(rng, 80)))  # half of it
        spread = [" ".join(words[j:j + 9]) for j in range(0, len(words), 9)]
        docs.append((400 + i, (" " + corpus.sentence(rng, 40) + " ").join(spread)))
        docs.append((500 + i, item))
    docs += [(900, None), (901, ""), (None, items[5][1]), (902, corpus.sentence(rng, 20_000) + " " + items[9][1]), (100, items[9][1]),
             (903, items[9][1]), (903, items[9][1])]
    items += [(50, None), (51, ""), (None, "just a question of some seven words"), (9, items[9][1])]
    docs.append((904, "here: just a question of some seven words twice"))
    return docs, items


@pytest.mark.parametrize("block_bytes", [32 << 20, 20_000])
def test_leaks_are_those_of_brute_force(spark, block_bytes):
    docs, items = world(spark)
    given = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"item_id": F.lit(3), "shingles": F.lit("x")})
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = {(r.doc_id, r.item_id): r.containment for r in B.leaks(given, bench, block_bytes=block_bytes).collect()}
    assert got == brute(docs, items)
    clean = B.clean(given, bench)
    hit = {(d, t) for d, t in docs if any(d2 == d for d2, _ in brute([(d, t)], items))}
    assert clean.columns == given.columns
    assert sorted(map(repr, clean.select("doc_id", "text").collect())) == sorted(
        repr(r) for r in given.select("doc_id", "text").collect() if (r.doc_id, r.text) not in hit)


def test_empty_tables(spark):
    docs, items = world(spark)
    given, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert B.leaks(given.limit(0), bench).count() == 0
    assert B.leaks(given, bench.limit(0)).count() == 0
    assert B.clean(given, bench.filter("text is null")).count() == len(docs)
