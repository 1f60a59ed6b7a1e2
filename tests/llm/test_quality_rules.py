from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

import corpus
from martworks.llm import quality_rules as Q


def counts(text):
    w, t = corpus.words(text), text or ""
    win = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    often, covered = Counter(win), set()
    for i, x in enumerate(win):
        if often[x] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in t.split("\n") if corpus.words(x)]
    return (len(w), sum(map(len, w)), sum(t.count(s) for s in "#*$%&|<>"), len(lines), len(lines) - len(set(lines)),
            len(covered), sum(c.isupper() for c in t), sum(t.count(s) for s in "0123456789"), t.count("!") + t.count("?"))


def test_statistics_of_whole_texts(spark):
    texts = [r[1] for r in corpus.awkward()] + [
        "a b c d e a b c d e", "x x x x x x x", "one line\n one line\none line\n\n\n", "A#b $$ %% <tag> | & *!? 12",
        "a b c d e f g h i j k a b c d e z", "\x0bfoo\x0c bar\rbaz\n", "p q r s\np q r s\np q r s"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r[0]: tuple(r)[2:] for r in Q.with_statistics(df).collect()}
    assert got == {i: counts(t) for i, t in enumerate(texts)}


def labelled(spark):
    rng = corpus.random.Random(3)
    rows, labels = [], []
    for i in range(400):
        text = corpus.sentence(rng, rng.randint(30, 90))
        if i % 4 == 0:
            text = " ".join(w + "###" if k % 2 else w for k, w in enumerate(text.split()))
        rows.append((i, text, "en", "src0", 1))
        if i % 10 != 9:
            labels.append((i, int(i % 4 != 0), 0))
    return corpus.documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learned_list_rejects_the_bad_and_keeps_the_good(spark):
    docs, labels = labelled(spark)
    got = {r.doc_id: r.kept for r in Q.judge(docs, labels).collect()}
    held_out = [i for i in range(400) if i % 10 == 9]
    assert all(got[i] == (i % 4 != 0) for i in held_out)
    assert {r.doc_id for r in Q.accepted(docs, labels).collect()} == {i for i, k in got.items() if k}


def test_rules_are_an_ordered_expression(spark):
    rules = [[Q.Condition("n_words", False, 20)], [Q.Condition("symbols_per_word", True, 0.5), Q.Condition("mean_word", True, 4)]]
    df = Q.with_statistics(spark.createDataFrame([(1, "a b c"), (2, "aaaa##### " * 30), (3, "aaaa bbbb " * 30)], "doc_id long, text string"))
    assert [r[0] for r in df.select(Q.verdict(rules).alias("k")).collect()] == [False, False, True]
    assert str(rules[1][0]) == "symbols_per_word >= 0.5"
    assert df.select(Q.verdict([])).distinct().count() == 1


def test_awkward_rows_and_clashing_columns(spark):
    docs = corpus.documents(spark).withColumns({"n_words": F.lit("x"), "kept": F.lit(1), "bad": F.lit(None).cast("int")})
    labels = spark.createDataFrame([(1, None, None), (None, 0, 0), (2, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    judged = Q.judge(docs, labels)
    assert judged.count() == docs.count()
    base = {r.doc_id: r.base_failed for r in judged.collect()}
    assert base[100] and base[101] and base[102] and not base[104]
    kept = Q.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == judged.filter("kept").count()


def test_empty_tables(spark):
    docs, labels = labelled(spark)
    assert Q.judge(docs.limit(0), labels).count() == 0
    assert Q.judge(docs, labels.limit(0)).filter("kept").count() == 400
    assert Q.accepted(docs.limit(0), labels.limit(0)).count() == 0
