"""Language of web pages by Bayesian fusion of evidence.

Four kinds of evidence are combined as log probabilities: the main text (byte trigrams, with a model counted over all
labelled documents; menus and adverts are often in another language), the language declared in the markup, the suffix of the address, and the host. What a declared
language or a suffix means, and which languages a host uses, is learned from the pages themselves: the text alone
gives each page a first distribution, and grouped sums of these, smoothed from host to domain to all pages, give the
rest. A page's own share is taken out of the sums it is judged by.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded, stored, text_of
from .html_density import main_text
from .shingle_arrays import pieces, text_bytes

CELLS = 1 << 14
#: A text counts as so many independent trigrams at most.
TEXT_WEIGHT = 60.0
#: Pages' worth of the wider group that a host or domain starts with.
SMOOTHING = 4.0
MAX_LANGUAGES = 1000

#: A comment, to the end of the page if it is not closed, or an html tag.
_HTML = re.compile(r"<!--.*?(?:-->|\Z)|<html\b[^>]*", re.I | re.S)
_LANG = re.compile(r"\s(?:xml:)?lang\s*+=\s*+[\"']?\s*+([A-Za-z]+)", re.I)


def declared_language(source: str) -> str | None:
    """The first language that an html tag anywhere in the page, but not in a comment, declares; linear in the page."""
    tags = (tag[0] for tag in _HTML.finditer(source) if not tag[0].startswith("<!--"))
    return next((m[1].lower() for tag in tags if (m := _LANG.search(tag))), None)


def _cells(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell and text of every trigram; letters in lower case as far as they are ASCII."""
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = data[:-2] | data[1:-1] << np.uint32(8) | data[2:] << np.uint32(16)
    cell = (code * np.uint32(2654435761)) >> np.uint32(32 - 14)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = owner[:-2] == owner[2:]
    return cell[whole].astype(np.int64), owner[:-2][whole]


def trigram_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``cell`` and ``n`` over all documents that have a language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in pieces(batch, "text"):
                cell, owner = _cells(*text_bytes(piece.column("text")))
                names, which = np.unique(np.array(piece.column("lang").to_pylist(), dtype=object).astype(str), return_inverse=True)
                counts = np.bincount(which[owner] * CELLS + cell, minlength=len(names) * CELLS).reshape(-1, CELLS)
                for name, row in zip(names, counts):
                    totals[name] = totals.get(name, 0) + row
        for name, row in totals.items():
            used = np.flatnonzero(row)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(used), pa.string()), "cell": pa.array(used.astype(np.int32)),
                                              "n": pa.array(row[used].astype(np.int64))})
    given = docs.select(F.col("lang").cast("string").alias("lang"), text_of().alias("text")).filter("lang is not null")
    return given.mapInArrow(run, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))


def text_model(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and the log probability of each cell; at most MAX_LANGUAGES x CELLS numbers."""
    counts = stored(trigram_counts(docs), "lang-counts")
    names = sorted(r["lang"] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in the labels")
    table = np.full((len(names), CELLS), 0.5)
    for r in counts.groupBy("lang").agg(F.collect_list(F.struct("cell", "n")).alias("rows")).toLocalIterator():
        row = table[names.index(r["lang"])]
        for cell, n in r["rows"]:
            row[cell] += n
    return names, np.log(table / table.sum(axis=1, keepdims=True)) if len(names) else table


def _host(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def _softmax(values: Column) -> Column:
    top = F.array_max(values)
    powers = F.transform(values, lambda x: F.exp(x - top))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def page_evidence(pages: DataFrame, names: list[str], model: np.ndarray) -> DataFrame:
    """Per page its address parts, the declared language and the log likelihoods of its text, up to a constant."""
    weight = TEXT_WEIGHT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "html"):
                sources = [x or "" for x in piece.column("html").to_pylist()]
                declared = [declared_language(x) for x in sources]
                plain = pa.array([main_text(x) for x in sources], pa.large_string())
                cell, owner = _cells(*text_bytes(plain))
                n = np.bincount(owner, minlength=len(sources))
                factor = np.minimum(1.0, weight / np.maximum(n, 1))
                scores = np.stack([np.bincount(owner, row[cell], len(sources)) for row in model], axis=1) * factor[:, None]
                flat = pa.array((scores - scores.max(axis=1, keepdims=True)).ravel())
                ends = pa.array(np.arange(len(sources) + 1, dtype=np.int32) * len(model))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("page_id"), piece.column("url"), pa.array(declared, pa.string()), pa.ListArray.from_arrays(ends, flat)],
                    ["page_id", "url", "declared", "text_scores"])

    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = given.mapInArrow(run, "page_id long, url string, declared string, text_scores array<double>")
    rows = rows.withColumn("host", _host(F.col("url")))
    labels = F.split("host", r"\.")
    named = F.col("host").rlike(r"\.[a-z][a-z0-9-]*$")
    return rows.withColumns({
        "suffix": F.when(named, F.element_at(labels, -1)),
        "domain": F.coalesce(F.when(named & (F.size(labels) > 1), F.concat_ws(".", F.slice(labels, -2, 2))), F.col("host"))})


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """Per page ``page_id``, ``url``, ``lang``, ``probability``, ``text_lang`` (by the text alone) and ``declared``.

    A null page has no text: the other evidence decides. Without a host, a suffix or a declared language that
    evidence is left out. Repeated rows are pages of their own. No labelled document: all languages are null.
    """
    names, model = text_model(docs)
    if not names:
        return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                            F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"),
                            F.lit(None).cast("string").alias("text_lang"), F.lit(None).cast("string").alias("declared"))
    n = len(names)
    rows = page_evidence(pages, names, model)
    rows = stored(rows.withColumn("share", _softmax(F.col("text_scores"))), "lang-pages")

    def sums(key: str | None) -> DataFrame:
        totals = F.array(*[F.coalesce(F.sum(F.get("share", F.lit(i))), F.lit(0.0)) for i in range(n)])
        grouped = rows.filter(F.col(key).isNotNull()).groupBy(key) if key else rows.groupBy()
        return grouped.agg(totals.alias(f"_{key or 'all'}"), F.count("*").alias(f"_n_{key or 'all'}"))

    whole = sums(None).first()  # one number per language
    out = rows.withColumns({"_all": F.array(*[F.lit(float(x)) for x in whole["_all"]]), "_n_all": F.lit(whole["_n_all"])})
    for key in ("declared", "suffix", "domain", "host"):
        out = out.join(bounded(stored(sums(key), f"lang-{key}")), key, "left")
    none = F.array_repeat(F.lit(0.0), n)

    def others(name: str) -> Column:
        """Sums of the group without this page."""
        return F.zip_with(F.coalesce(F.col(f"_{name}"), none), F.when(F.col(f"_{name}").isNull(), none).otherwise(F.col("share")),
                          lambda a, b: F.greatest(a - b, F.lit(0.0)))

    def count(name: str) -> Column:
        return F.greatest(F.coalesce(F.col(f"_n_{name}") - 1, F.lit(0)), F.lit(0))

    out = out.withColumn("_p_all", F.transform(others("all"), lambda x: (x + 1.0) / (count("all") + float(n))))
    for wide, name in (("all", "domain"), ("domain", "host")):
        out = out.withColumn(f"_p_{name}", _smoothed(others(name), f"_p_{wide}", count(name)))
    # A sign (declared language, suffix) speaks for a language by how far it raises its share above that of all pages.
    scores = F.zip_with("text_scores", "_p_host", lambda t, p: t + F.log(p))
    for name in ("declared", "suffix"):
        out = out.withColumn(f"_p_{name}", _smoothed(others(name), "_p_all", count(name)))
        out = out.withColumn(f"_r_{name}", F.zip_with(f"_p_{name}", "_p_all", lambda p, q: F.log(p) - F.log(q)))
        scores = F.zip_with(scores, f"_r_{name}", lambda s, r: s + r)
    out = out.withColumn("_final", _softmax(scores))
    languages = F.array(*[F.lit(x) for x in names])
    best = F.array_max("_final")
    return out.select(
        "page_id", "url", F.get(languages, F.array_position("_final", best).cast("int") - 1).alias("lang"),
        F.round(best, 4).alias("probability"),
        F.get(languages, F.array_position("text_scores", F.array_max("text_scores")).cast("int") - 1).alias("text_lang"), "declared")


def _smoothed(sums: Column, wide: str, n: Column) -> Column:
    return F.zip_with(sums, wide, lambda x, p: (x + p * SMOOTHING) / (n + SMOOTHING))
