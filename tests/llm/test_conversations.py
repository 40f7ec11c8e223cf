"""Conversation repair against an exhaustive version, in pieces, and on odd tables."""

from __future__ import annotations

import functools
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from stratum.llm import conversations as C

SF = "/root/testdata/sf0.001"
STEPS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(initials, kinds):
    """Every sequence of edits, by plain recursion: (cost, audit)."""
    n = len(kinds)

    @functools.lru_cache(None)
    def rest(i, last, inserted):
        ways = [(0, "")] if i == n and last in ("", "a") else []
        for role in "ua":
            if (last, role) in STEPS:
                if inserted < 2 and (w := rest(i, role, inserted + 1)):
                    ways.append((w[0] + 3, "I" + w[1]))
                if i < n and kinds[i] in (C.FINE, C.CUT) and (w := rest(i + 1, role, 0)):
                    ways.append((w[0] + 3 + 3 * (kinds[i] == C.CUT), "R" + w[1]))
        if i < n:
            if w := rest(i + 1, last, 0):
                ways.append((w[0] + 4, "D" + w[1]))
            if kinds[i] in (C.FINE, C.CUT) and (last, initials[i]) in STEPS and (w := rest(i + 1, initials[i], 0)):
                ways.append((w[0] + 3 * (kinds[i] == C.CUT), "K" + w[1]))
        return min(ways) if ways else None

    return rest(0, "", 0)


def expected(rows):
    """conv_id -> result tuple for (conv_id, turn, role, text) rows, in plain Python."""
    groups = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        groups.setdefault(conv, []).append((turn, role, text))
    out = {}
    for conv, found in groups.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, kinds = set(), []
        for _, role, text in found:
            body = re.sub(r"[\x20\x09-\x0D]", "", text)
            kinds.append(C.BLANK if not body else C.DUPLICATE if (role, text) in seen
                         else C.CUT if body[-1] not in ".!?" else C.FINE)
            seen.add((role, text))
        initials = [r[1][:1] for r in found]
        cost, audit = cheapest(tuple(initials), tuple(kinds))
        at, lines, last = iter(found), [], ""
        for edit in audit:
            if edit == "D":
                next(at)
                continue
            role, text = (lambda r: (r[1], r[2]))(next(at)) if edit in "KR" else ("", "")
            if edit != "K":
                role = "assistant" if last == "u" else "user"
            last = role[:1]
            lines.append(f"{role}:{text}")
        turns = {t for t, _, _ in found if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out[conv] = (gaps, kinds.count(C.BLANK), kinds.count(C.DUPLICATE), kinds.count(C.CUT), illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found_rows(df):
    rows = df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                     "repaired_sha256").collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_search_against_every_sequence_of_edits():
    rnd = random.Random(3)
    for _ in range(1500):
        n = rnd.randint(0, 8)
        initials = [rnd.choice(["s", "u", "a", "u", "a", "", "x"]) for _ in range(n)]
        kinds = bytes(rnd.choice([0, 0, 0, 1, 2, 3]) for _ in range(n))
        want = cheapest(tuple(initials), tuple(kinds))
        assert C.repair(initials, kinds) == want
        chain, at = C.Chain(), 0
        while at < n:
            m = rnd.randint(1, 3)
            faults = C.Faults()
            for i, k in zip(initials[at:at + m], kinds[at:at + m]):
                faults.add(1, i, k)
            chain.add([(i, "t") for i in initials[at:at + m]], C.crossings(initials[at:at + m], kinds[at:at + m]),
                      faults.state())
            at += m
        if n:
            assert tuple(chain.result()[5:7]) == want


def test_bounds_never_exceed_the_cheapest_way():
    rnd = random.Random(4)
    for _ in range(500):
        n = rnd.randint(1, 8)
        initials = [rnd.choice("suax") for _ in range(n)]
        kinds = bytes(rnd.choice([0, 0, 1, 2, 3]) for _ in range(n))
        assert C.suffix_bounds(initials, kinds)[0] <= cheapest(tuple(initials), tuple(kinds))[0]


ODD = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."),
       (2, 0, "system", "Be kind."), (2, None, "user", "First."), (2, 5, "user", "cut off"), (2, 5, "user", "cut off"),
       (3, 0, None, None), (3, 1, "", "."), (3, None, "assistant", ""), (4, None, None, None), (4, None, None, None),
       (None, 1, "user", "Who?"), (None, 2, "assistant", "Me!"), (None, 2, "assistant", "Me!"), (None, 9, "assistant", "Me!"),
       (5, 0, "system", "alone."), (6, 3, "user", "x" * 200_000 + "."), (6, 1, "tool", "\t\n"), (6, 2, "user", "Ends é. \n"),
       (7, -(1 << 62), "user", "a."), (7, 1 << 62, "assistant", "b.")]


def test_odd_rows_and_clashing_names(spark):
    df = (spark.createDataFrame(ODD, "conv_id long, turn long, role string, text string")
          .withColumn("cost", F.lit("clash")).withColumn("part", F.lit(1)).withColumn("digest", F.lit(1)))
    assert found_rows(C.repair_conversations(df)) == expected(ODD)
    assert C.repair_conversations(df.limit(0)).count() == 0


@pytest.mark.parametrize("partitions", ["3", "40"])
def test_one_conversation_over_many_partitions(spark, partitions):
    """A conversation of most rows, rows that repeat, and pieces that end anywhere."""
    rnd = random.Random(5)
    rows = [(7, t, rnd.choice(["user", "assistant", "user", "assistant", "system"]),
             rnd.choice(["Well.", "No?", "and so", f"Turn {t}.", " "])) for t in range(700)]
    rows += [(7, 300, "user", "Again.")] * 150
    rows += [(c, t, ("user", "assistant")[t % 2], f"{c} {t}.") for c in range(20, 60) for t in range(3)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
        got = found_rows(C.repair_conversations(df))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    import sys
    sys.setrecursionlimit(20_000)
    assert got == expected(rows)


def test_query_against_plain_python(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    left = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        if fault:
            left += [(conv, turn, "user" if fault == 4 else role, "" if fault == 1 else
                      re.sub("[.!?]", "", text) if fault == 2 else text)] * (2 if fault == 3 else 1)
    want = {r[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for r in rows} | expected(left)
    assert found_rows(C.op13_conversation_repair(spark, SF)) == want
    assert any(w[5] for w in want.values())
