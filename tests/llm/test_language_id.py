from __future__ import annotations

import math

from pyspark.sql import functions as F

import corpus
from martworks.llm import language_id as N

LETTERS = {"aa": "abcdefgh", "bb": "efghijkl", "cc": "mnopéüqr"}


def world(spark):
    rng = corpus.random.Random(8)
    docs = [(i, corpus.sentence(rng, 60, LETTERS[x]), x, "s", 1) for i in range(300) for x in [rng.choice(list(LETTERS))]]
    pages, truth = [], {}
    for i in range(400):
        x = rng.choice(list(LETTERS))
        host = f"{x}{rng.randrange(3)}.site{x}.example.{'org' if rng.random() < 0.5 else x}"
        text = corpus.sentence(rng, 50, LETTERS[x]) if i % 8 else ""
        said = x if rng.random() < 0.9 else "aa"
        pages.append((i, f"http://{host}/p{i}", f'<html lang="{said}-XX"><head><title>t</title></head><body><p>{text}</p></body></html>'))
        truth[i] = x
    return corpus.documents(spark, docs), pages, truth


def test_fused_evidence_beats_text_alone(spark):
    docs, pages, truth = world(spark)
    got = {r.page_id: r for r in N.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), docs).collect()}
    assert len(got) == 400
    right = sum(got[i].lang == x for i, x in truth.items())
    alone = sum(got[i].text_lang == x for i, x in truth.items())
    assert right >= 396 and right > alone
    assert all(0 < r.probability <= 1 for r in got.values())
    assert got[1].declared in LETTERS


def test_counts_cover_all_documents(spark):
    docs = corpus.documents(spark, [(1, "abcd", "x", "s", 1), (2, "ABCD é", "x", "s", 1), (3, None, "x", "s", 1), (4, "abc", None, "s", 1), (5, "ab", "y", "s", 1)])
    got = N.trigram_counts(docs.repartition(3)).groupBy("lang").agg(F.sum("n").alias("n")).collect()
    assert {r.lang: r.n for r in got} == {"x": 2 + (7 - 2)}


def test_awkward_pages(spark):
    docs, pages, _ = world(spark)
    odd = [(None, None, None), (1, "", ""), (2, "not an address", "<html lang=''>"), (3, "http://10.0.0.1/x", "<html lang=aa>" + corpus.sentence(corpus.random.Random(1), 30_000, LETTERS["cc"])),
           (4, "http://h", "<p>ab"), (4, "http://h", "<p>ab")]
    df = spark.createDataFrame(odd + pages[:50], "page_id long, url string, html string").withColumns({"lang": F.lit(1), "host": F.lit("x"), "share": F.lit(2)})
    got = N.identify(df, docs).collect()
    assert len(got) == 56 and all(r.lang in LETTERS for r in got)
    assert [r.text_lang for r in got if r.page_id == 3 and r.url == "http://10.0.0.1/x"] == ["cc"]
    assert N.identify(df.limit(0), docs).count() == 0
    none = N.identify(df, docs.limit(0)).collect()
    assert len(none) == 56 and {r.lang for r in none} == {None}


def test_declared_language_far_into_the_page(spark):
    docs, _, _ = world(spark)
    pages = [(i, f"http://h{i}", front + '<html lang="bb"><body><p>ab</p></body></html>') for i, front in
             enumerate(["<!--" + "x" * 5_000 + "-->", " " * 5_000, "<!DOCTYPE html>" + "\n" * 100_000])]
    got = N.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), docs).collect()
    assert [r.declared for r in got] == ["bb"] * 3


def test_declared_language_in_a_comment_is_none():
    assert N.declared_language('<!--[if IE]><html lang="xx"><![endif]--><html lang="de">') == "de"
    assert N.declared_language('<!-- a\n --><!--><html lang="xx">--><HTML xml:lang=fr>') == "fr"
    assert N.declared_language('<!-- never closed <html lang="xx">') is None
    assert N.declared_language("<!--" * 200_000) is None


def test_equals_fusion_in_plain_python(spark):
    """Grouped shares, smoothing from all pages over domain to host, and the signs' ratios, page by page."""
    docs, pages, _ = world(spark)
    pages = pages[:120] + [(900, None, None), (901, "http://10.0.0.1/x", "<p>abc"), (902, "http://alone.example", "<html lang=zz>mnop"), (902, "http://alone.example", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    names, model = N.text_model(docs)
    rows = [r.asDict() for r in N.page_evidence(df, names, model).collect()]
    n = len(names)
    for r in rows:
        powers = [math.exp(x - max(r["text_scores"])) for x in r["text_scores"]]
        r["share"] = [p / sum(powers) for p in powers]

    def others(key, r):
        """Sums of the shares of the other pages of the group, and their number."""
        if key and r[key] is None:
            return [0.0] * n, 0
        same = [x for x in rows if x is not r and (not key or x[key] == r[key])]
        return [sum(x["share"][i] for x in same) for i in range(n)], len(same)

    def smoothed(key, wide, r):
        sums, count = others(key, r)
        return [(x + w * N.SMOOTHING) / (count + N.SMOOTHING) for x, w in zip(sums, wide)]

    want = []
    for r in rows:
        sums, count = others(None, r)
        whole = [(x + 1) / (count + n) for x in sums]
        host = smoothed("host", smoothed("domain", whole, r), r)
        scores = [t + math.log(p) for t, p in zip(r["text_scores"], host)]
        for key in ("declared", "suffix"):
            scores = [s + math.log(p) - math.log(q) for s, p, q in zip(scores, smoothed(key, whole, r), whole)]
        powers = [math.exp(s - max(scores)) for s in scores]
        best = max(powers)
        want.append((r["page_id"], r["url"], names[powers.index(best)], round(best / sum(powers), 3), r["declared"]))
    got = [(r.page_id, r.url, r.lang, round(r.probability, 3), r.declared) for r in N.identify(df, docs).collect()]
    key = lambda x: repr((x[0], x[1], x[2], x[4]))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:3] + a[4:] == b[:3] + b[4:] and abs(a[3] - b[3]) <= 0.002
