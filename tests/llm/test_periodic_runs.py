"""Periodic runs against comparison of every pair of words, on tiles of several sizes and on odd tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from stratum.llm import periodic_runs as P

SF = "/root/testdata/sf0.001"


def every_run(words):
    """(start, period, length) by comparing words q apart, for every q."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1 if j == i else j
    return sorted((s, q, e - s) for (s, e), q in found.items())


def expected(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = every_run(words)
    gone = {i for s, q, length in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1])) if runs else None
    best = (top[0], top[2], top[1], 1000 * top[2] // top[1]) if top else (None,) * 4
    return (len(runs), *best, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, q, n in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


def some_words(rnd, n, letters):
    words = []
    while len(words) < n:
        block = [str(rnd.randrange(letters)) for _ in range(rnd.randint(1, max(1, n // rnd.choice([4, 5, 8, 20]))))]
        words += (block * 10)[:rnd.randint(1, len(block) * rnd.choice([1, 3, 5, 9]) + 6)]
    return words


@pytest.mark.parametrize("tile", [(32, 256), (4, 4)])
def test_tiles_find_and_stitch_every_run(spark, monkeypatch, tile):
    monkeypatch.setattr(P, "TILE_PERIODS", tile[0])
    monkeypatch.setattr(P, "TILE_WORDS", tile[1])
    rnd = random.Random(6)
    fragments, want = [], set()
    for doc in range(250):
        words = some_words(rnd, rnd.choice([3, 6, 30, 300, 1500]), rnd.choice([1, 2, 3, 40]))
        key = str(doc).encode()
        want |= {(key, s, n, q) for s, q, n in every_run(words)}
        for p, lo, at_start, at_end, starts, periods, ids in P.tiles(P.word_numbers(words)):
            fragments += [(key, q, lo + first, lo + end) for q, first, end in
                          P.solve_tile(p, at_start, at_end, starts.tolist(), periods.tolist(), ids.tolist())]
    df = spark.createDataFrame(fragments, "key binary, period long, first long, stop long")
    got = P.stitched(df).collect()
    assert {(bytes(r.key), r.start, r.length, r.period) for r in got} == want and len(got) == len(want)


def test_odd_rows_and_clashing_names(spark):
    texts = [None, "", " \t\n", "a", "a " * 5, "a " * 6, "a b a b a b a b", "a b a b a b a", "x " + "a b c " * 4 + "y",
             "é ö é ö\x0b" * 9, "w " * 30_000, " ".join(str(i % 700) for i in range(9_000)),
             "a a a a a a b b b b b b", "p q " * 4 + "r s " * 4, "\x1c \x1c \x1c \x1c \x1c \x1c \x85"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, texts[5]), (5, "other"), (None, texts[6]), (None, None)]
    df = (spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1))
          .withColumn("period", F.lit("clash")).withColumn("n_runs", F.lit("clash")))
    got = P.periodic_runs(df).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((i, *expected(t)) for i, t in rows), key=repr)
    assert P.periodic_runs(df.limit(0)).count() == 0


def test_query_against_every_pair(spark):
    got = {r.doc_id: tuple(r)[1:] for r in P.op11_periodic_runs(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    planted = 0
    for doc_id, text in docs:
        h = zlib.crc32(str(doc_id).encode())
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(n))
            planted += 1
        assert got[doc_id] == expected(text), doc_id
    assert planted and any(r[0] for r in got.values())
