"""Small frames with the awkward cases that every operator has to stand."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, n: int, letters: str = "abcdefghij") -> str:
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def awkward() -> list[tuple]:
    """Nulls in any column, empty and blank texts, a very long one, repeated rows and ids, copies."""
    rng = random.Random(7)
    texts = [sentence(rng, rng.randint(20, 120)) for _ in range(40)]
    rows = [(i, t, "en" if i % 2 else "de", f"src{i % 3}", len(t)) for i, t in enumerate(texts)]
    rows += [
        (100, None, "en", "src1", None), (101, "", "de", None, 0), (102, " \n\t ", None, "src2", 4),
        (None, texts[0], "en", None, None), (None, None, None, None, None), (103, texts[0], "en", "src0", 1),
        (104, sentence(rng, 30_000), "en", "src0", 1), (105, "one two", "en", "src1", 7), (105, "one two", "en", "src1", 7),
        (105, texts[1], "en", "src1", 7), (106, "ünïcode 日本語 🙂 text", "de", "src2", 3), (107, texts[3] + " more", "en", "src0", 1),
    ]
    return rows


def documents(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)


def words(text) -> list[str]:
    return WORD.findall(text or "")


def windows(text, size: int = 5) -> list[tuple]:
    w = words(text)
    return [tuple(w[i:i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [tuple(w)] if w else []
