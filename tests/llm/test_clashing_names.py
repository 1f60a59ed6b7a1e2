"""Stages on a table whose extra columns have the names that the operators use inside."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from corpus import awkward, documents
from pyspark.sql import functions as F

from martworks.llm import dart_minhash, decontaminate, mixing, packing, quality_rules

OWN = {"doc_id", "text", "lang", "source", "n_chars", "shard"}
# Every name in quotes in the modules that could be that of a column.
NAMES = sorted({n for module in ("common", "components", "dart_minhash", "decontaminate", "mixing", "packing", "quality_rules")
                for n in re.findall(r"[\"']([a-z_][a-z0-9_]{0,20})[\"']|\b(_[a-z_]+)=",
                                    (Path(packing.__file__).parent / f"{module}.py").read_text()) for n in n if n} - OWN | {"_q_text", "_quality_n_words", "_quality_text"})


@pytest.mark.parametrize("stage", ["quality", "near", "clean", "mix", "shards"])
def test_extra_columns_come_back_unchanged(spark, stage):
    assert {"_digest", "_source", "_near_node", "_mix_mine", "_unit", "_large", "_q_text"} <= set(NAMES)
    plain = documents(spark, [r for r in awkward() if r[0] is not None and r[0] < 104])
    more = plain.withColumns({n: F.concat(F.lit(n), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for n in NAMES})
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    benchmark = plain.where("doc_id < 3").select(F.col("doc_id").alias("item_id"), "text")
    run = {"quality": lambda d: quality_rules.accepted(d, labels), "near": dart_minhash.one_of_each,
           "clean": lambda d: decontaminate.clean(d, benchmark), "mix": mixing.mixed, "shards": lambda d: packing.sharded(d, shards=4)}[stage]
    found = run(more)
    assert found.columns == [*more.columns, *(["shard"] if stage == "shards" else [])]
    rows = found.select("doc_id", *NAMES).collect()
    assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in NAMES)
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in run(plain).collect())
