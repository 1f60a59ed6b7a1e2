from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from martworks.llm import conversation_repair as cr
from martworks.llm.queries import op13_conversation_repair

BLANK = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def planted(rows):
    """The rows after damage."""
    out = []
    for conv, turn, role, text in rows:
        seal = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(seal.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [] if kind == 0 else [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def best(rows):
    """(cost, letters, repaired rows) by trying every edit of every row from every state, shortest strings first."""
    def allowed(state, initial):
        return {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}[state].get(initial)

    roles = {"u": "user", "a": "assistant"}
    # All paths of least cost are kept, so that the comparison of whole strings decides.
    paths = [("", 0, "", ())]
    for role, text, fault in rows:
        following = []
        grown = list(paths)
        fresh = paths
        for _ in range(3):
            fresh = [(allowed(s, r), c + 5, x + "I", k + ((roles[r], ""),)) for s, c, x, k in fresh for r in "ua" if allowed(s, r)]
            grown += fresh
        for s, c, x, k in grown:
            following.append((s, c + 2, x + "D", k))
            if fault in ("", "cut"):
                more = 5 if fault else 0
                if allowed(s, role[:1]):
                    following.append((allowed(s, role[:1]), c + more, x + "K", k + ((role, text),)))
                for r in "ua":
                    if allowed(s, r):
                        following.append((allowed(s, r), c + more + 1, x + "R", k + ((roles[r], text),)))
        least = {}
        for p in following:
            least[p[0]] = min(least.get(p[0], 10 ** 9), p[1])
        paths = list({p for p in following if p[1] == least[p[0]]})
    ends, fresh = [p for p in paths if p[0] in ("", "a")], paths
    for _ in range(3):
        fresh = [(allowed(s, r), c + 5, x + "I", k + ((roles[r], ""),)) for s, c, x, k in fresh for r in "ua" if allowed(s, r)]
        ends += [p for p in fresh if p[0] in ("", "a")]
    return min((c, x, k) for _, c, x, k in ends)


def expected(rows):
    """By conversation the counts, cost, letters and digest, row by row in plain Python."""
    out = {}
    after = planted(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted([r for r in after if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        said, marked, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in mine:
            last = text.rstrip(BLANK)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in said else "truncated" if last not in ".!?" else None
            said.add((role, text))
            if fault:
                counts[fault] += 1
            marked.append((role, text, {"truncated": "cut", None: ""}.get(fault, fault)))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, letters, kept = best(marked)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, letters, digest)
    return out


def actual(frame):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    found = [(r["conv_id"], tuple(r[n] for n in names)) for r in frame.collect()]
    assert len(found) == len(dict(found))
    return dict(found)


def awkward():
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "tool", "", None, "agent", "User"]
    texts = ["Yes.", "No", "Why?", "", None, " \n ", "So be it! \n", "x " * 50, "Yes.", "Ende 🙂"]
    rows = []
    for conv in [*range(150), None]:
        for turn in sorted(rng.sample(range(12), rng.randint(1, 7))):
            fair = rng.random() < 0.6
            role = ("user", "assistant")[turn % 2] if fair else rng.choice(roles)
            text = f"Turn {rng.randint(0, 3)}." if fair else rng.choice(texts)
            rows.append((conv, rng.choice([turn] * 9 + [None]), role, text))
    return rows + rows[:5] + [(2 ** 62 + 1, 2 ** 61 + 1, "user", "Far."), (2 ** 62 + 3, 2 ** 61 + 5, "user", "Far.")]


def test_equals_every_edit_tried(spark):
    rows = awkward()
    frame = cr.damaged(spark.createDataFrame(rows, SCHEMA).withColumns({"conv": F.lit(1), "fault": F.lit("x"), "here": F.lit(None)}))
    assert actual(cr.report(frame, F.col("here"))) == expected(rows)


def test_blocks_in_files_give_the_same(spark):
    rows = awkward()
    frame = cr.damaged(spark.createDataFrame(rows, SCHEMA))
    assert actual(cr.report(frame, F.col("here"), held_chars=20, held_rows=2)) == expected(rows)


def test_one_giant_conversation(spark):
    frame = spark.range(60_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
                                       F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                       F.concat(F.lit("Turn "), "id", F.lit(".")).alias("text"))
    r = cr.report(frame, held_rows=7_000).first()
    assert (r["cost"], r["audit"], r["duplicate"]) == (0, "K" * 60_000, 0)


def test_messages_are_the_repaired_conversation(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hello"), (1, 2, "user", "Fine."), (2, 0, "user", "")]
    found = cr.messages(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "step").collect()
    assert [tuple(r) for r in found if r["conv_id"] == 2] == [(2, 0, "D", "user", "")]
    kept = [r for r in found if r["conv_id"] == 1 and r["edit"] != "D"]
    assert [r["role"] for r in kept] == ["user", "assistant"] * (len(kept) // 2)


def test_no_rows(spark):
    assert cr.report(cr.damaged(spark.createDataFrame([], SCHEMA)), F.col("here")).collect() == []


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert actual(op13_conversation_repair(spark, folder)) == expected(rows)
