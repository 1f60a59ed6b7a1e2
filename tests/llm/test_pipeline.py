from __future__ import annotations

import random

from pyspark.sql import functions as F

import corpus
import corpus_pipeline
from martworks.llm import decontaminate, mixing, quality_rules
from test_near_duplicates import brute_classes


def folder(spark, tmp_path):
    rng = random.Random(13)
    items = [(i, corpus.sentence(rng, 30)) for i in range(5)]
    rows = list(corpus.awkward())
    for i in range(200, 600):
        text = corpus.sentence(rng, rng.randint(20, 100))
        if i % 10 == 0:
            text = " ".join(w + "###" for w in text.split())
        if i % 10 == 1:
            text += " " + items[i % 5][1] + " " + corpus.sentence(rng, 5)
        if i % 10 == 2:
            text = rows[-1][1] + " tail"
        rows.append((i, text, "en", f"src{i % 3}", len(text)))
    corpus.documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(i, int(i % 10 != 0), 0) for i in range(200, 600)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path), rows, items


def test_each_stage_on_what_its_predecessor_kept(spark, tmp_path):
    sf_dir, rows, items = folder(spark, tmp_path)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near-duplicates", "decontamination", "source mix", "shards"]
    after = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        path = str(tmp_path / f"stage{k}")
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        after[name] = docs
        if name != "shards":
            assert docs.columns == before.columns
        given, kept = before.collect(), docs.collect()
        if name == "quality rules":
            assert not [r for r in kept if r.doc_id and 200 <= r.doc_id and r.doc_id % 10 == 0]
            assert {r.doc_id for r in kept} >= {r[0] for r in rows if r[0] and r[0] >= 200 and r[0] % 10}
        elif name == "near-duplicates":
            classes = brute_classes([(r.doc_id, r.text) for r in given])
            assert sorted(r.doc_id for r in kept) == sorted({c for _, c in classes})
        elif name == "decontamination":
            hit = {r.doc_id for r in decontaminate.leaks(before, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
            assert hit and hit == {r.doc_id for r in given if any(t in r.text for _, t in items)}
            assert {r.doc_id for r in kept} == {r.doc_id for r in given} - hit
        elif name == "source mix":
            plan = {r.doc_id: r.copies for r in mixing.mix(before).collect()}
            assert sorted(r.doc_id for r in kept) == sorted(i for i, n in plan.items() for _ in range(n))
        else:
            assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in given)
            assert docs.groupBy("text").agg(F.countDistinct("shard").alias("n")).filter("n > 1").count() == 0
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, docs.collect()))


def test_empty_documents(spark, tmp_path):
    sf_dir, _, _ = folder(spark, tmp_path)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = list(entry.queries())
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert quality_rules.FEATURES
