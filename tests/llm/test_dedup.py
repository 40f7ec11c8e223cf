"""Exact dedup, SimHash and suffix dedup against brute force, with the odd cases of their docstrings."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stratum.llm.components import components
from stratum.llm.exact_dedup import DigestIndex, drop_exact_duplicates, exact_dedup
from stratum.llm.simhash import _links, drop_near_duplicates, fingerprint, near_duplicates, segments
from stratum.llm.suffix_dedup import front_code, merge_runs, remove_repeats

DOCS = "doc_id long, text string, lang string, kept string"


def docs(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))


# ---------------------------------------------------------------- exact

def test_exact_keeps_longest_then_smallest(spark):
    rows = [(1, "a b"), (2, "a  b"), (3, "ab"), (4, None), (5, ""), (6, " \n"), (None, "q"), (7, "q"), (None, "z"), (8, "é")]
    got = {(r.doc_id, r.text_sha256): r for r in exact_dedup(docs(spark, rows)).collect()}
    by = {r.doc_id: r for r in got.values() if r.doc_id is not None}
    assert [(by[i].keep_id, by[i].group_size, by[i].kept) for i in (1, 2, 3)] == [(2, 3, False), (2, 3, True), (2, 3, False)]
    assert [(by[i].keep_id, by[i].kept) for i in (4, 5, 6)] == [(6, False), (6, False), (6, True)]
    assert by[7].kept and by[7].keep_id == 7 and by[7].group_size == 2
    nulls = sorted(r.kept for r in got.values() if r.doc_id is None)
    assert nulls == [False, True]  # beaten by 7, and alone with its text
    assert by[8].text_sha256 == hashlib.sha256("é".encode()).hexdigest()


def test_exact_empty_repeated_rows_and_clashing_columns(spark):
    assert exact_dedup(docs(spark, [])).count() == 0
    rows = [(1, "x y", "en", "no"), (1, "x y", "en", "no"), (2, "xy", "fr", "yes"), (3, "w" * 100_000, "de", None)]
    kept = drop_exact_duplicates(docs(spark, rows, DOCS))
    assert kept.columns == ["doc_id", "text", "lang", "kept"]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_exact_unlike_texts_of_one_doc_id_stay(spark):
    rows = [(i, t) for i in (None, 5) for t in ("a", "a", "b", "b", "c")]
    rows = [(i, f"{t} {i}") for i, t in rows]
    got = [(r.doc_id, r.text) for r in drop_exact_duplicates(docs(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted(set(rows), key=repr)


def test_index_keeps_what_an_earlier_batch_brought(spark, scratch):
    first = DigestIndex(spark, f"{scratch}/index", buckets=4)
    assert drop_exact_duplicates(docs(spark, [(1, "a"), (2, "b")]), first).count() == 2
    first.close()
    later = DigestIndex(spark, f"{scratch}/index", buckets=4)  # opened again by its path
    got = {r.doc_id: r for r in exact_dedup(docs(spark, [(3, " a"), (4, "c")]), later).collect()}
    assert (got[3].keep_id, got[3].kept, got[4].kept) == (1, False, True)
    assert later.rows().count() == 3
    plan = spark.table(later.name).groupBy("digest").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # the index is bucketed by digest


# ---------------------------------------------------------------- simhash

def brute_components(fps, distance):
    root = {d: d for d in fps}
    while True:
        before = dict(root)
        for a, b in itertools.combinations(sorted(fps), 2):
            if bin(fps[a] ^ fps[b]).count("1") <= distance:
                root[a] = root[b] = min(root[a], root[b])
        if root == before:
            return root


def test_segments_leave_one_bit():
    for distance in (0, 1, 3, 5, 7):
        parts = segments(distance)
        assert sum(w for _, w in parts) == 64
        assert distance // len(parts) <= 1 and parts[0][0] == 0


def test_simhash_matches_brute_force(spark):
    rows, r = [], random.Random(3)
    for base in range(12):
        text = words(base, 120).split()
        for k in range(8):
            t = list(text)
            for _ in range(k % 4):
                t[r.randrange(len(t))] = "zz" + str(k)
            rows.append((len(rows) * 7 % 101, " ".join(t).upper() if k == 5 else " ".join(t)))
    rows += [(900, None), (901, ""), (902, " \t"), (903, "one"), (904, "ONE"), (905, "one two")]
    fps = {d: fingerprint(t, 3) for d, t in rows}
    want = brute_components(fps, 3)
    got = {x.doc_id: x for x in near_duplicates(docs(spark, rows)).collect()}
    assert {d: x.component_id for d, x in got.items()} == want
    assert {d: int(x.fingerprint, 16) for d, x in got.items()} == fps
    assert got[900].fingerprint == "0" * 16 and got[902].component_id == 900


def test_simhash_cut_buckets_lose_no_link(spark, monkeypatch):
    from stratum.llm import simhash
    monkeypatch.setattr(simhash, "BLOCK", 4)
    r = random.Random(5)
    base = r.getrandbits(64)
    fps = sorted({base} | {base ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for _ in range(40)})
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    edges = simhash.near_edges(spark.createDataFrame(signed, "fp long"), 3)
    found = {x.node: x.root for x in components(edges).collect()}
    want = brute_components({s[0] & (2**64 - 1): s[0] & (2**64 - 1) for s in signed}, 3)
    groups = {}
    for s in signed:
        groups.setdefault(found.get(s[0], s[0]), set()).add(s[0] & (2**64 - 1))
    expect = {}
    for k, v in want.items():
        expect.setdefault(v, set()).add(k)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expect.values()))


def test_links_stay_in_their_group():
    fp = np.array([0, 1, 0, 3, 7], np.uint64)
    a, b = _links(np.array([0, 0, 1, 1, 1]), np.zeros(5, np.int8), fp, 1)
    assert sorted(zip(a.tolist(), b.tolist())) == [(1, 0), (7, 3)]


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(300)] + [(500, 500), (600, 601), (601, 600)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, 600: 600, 601: 600}


def test_near_duplicates_one_stays(spark):
    assert drop_near_duplicates(docs(spark, [])).count() == 0
    t = words(1, 200)
    rows = [(5, t), (3, t + " "), (3, t + " "), (9, words(2, 50)), (None, words(3, 50))]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in drop_near_duplicates(docs(spark, rows)).collect()) == [
        (False, 3), (False, 9), (True, 0)]


def plain_fingerprint(text, n=3):
    """The contract word by word: a bit is one when over half of the shingles' hashes have it."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    grams = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_fingerprints_match_a_plain_count_of_bits(monkeypatch):
    from stratum.llm import simhash
    texts = [words(i, n) for i, n in enumerate((1, 2, 3, 4, 60, 700))]
    texts += [None, "", " \n\x0b", "A b\tÀ É", "a\xa0b c\u2003d e", "same same same same", words(9, 4).upper()]
    for chunk in (1 << 16, 7):  # long texts are counted in pieces
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        assert [fingerprint(t, 3) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_near_duplicates_of_empty_long_and_clashing_input(spark):
    schema = "doc_id long, text string, fp string, row string, root string, component_id string"
    assert near_duplicates(docs(spark, [], schema)).count() == 0
    long = words(1, 30_000)
    rows = [(i, t, "a", "b", "c", "d") for i, t in ((4, long), (2, long + " x"), (9, words(2, 60)), (9, words(2, 60)))]
    got = near_duplicates(docs(spark, rows, schema))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((x.doc_id, x.fingerprint, x.component_id) for x in got.collect()) == sorted(
        (i, f"{plain_fingerprint(t):016x}", 2 if i < 9 else 9) for i, t, *_ in rows)


def test_near_duplicates_are_dropped_row_by_row(spark):
    """Unlike texts under one doc_id stay, a near copy under it goes, and of copies without a doc_id one stays."""
    a, b, c, d, e = (words(i, 200) for i in range(5))
    rows = [(3, a), (5, a + " "), (5, b), (7, c), (7, d), (None, e), (None, e.upper()), (None, e), (None, b.upper())]
    kept = [(r.doc_id, r.text) for r in drop_near_duplicates(docs(spark, rows)).collect()]
    assert sorted(x for x in kept if x[0] is not None) == sorted([(3, a), (5, b), (7, c), (7, d)])
    assert [t.lower() for i, t in kept if i is None] == [e]
    named = docs(spark, [(*r, "mine", "too") for r in rows], "doc_id long, text string, row_number string, ROW string")
    left = drop_near_duplicates(named)
    assert left.columns == named.columns and {(x[2], x[3]) for x in left.collect()} == {("mine", "too")}
    assert left.count() == len(kept)


def test_one_row_of_every_component_stays(spark):
    """Groups of near copies, one of them a third of all rows, against components by brute force."""
    r, rows = random.Random(7), []
    for base, copies in ((1, 40), (2, 6), (3, 3)):
        text = words(base, 900).split()
        for _ in range(copies):
            t = list(text)
            for _ in range(r.randrange(3)):
                t[r.randrange(len(t))] = "zz" + str(r.randrange(1000))
            rows.append((len(rows) * 37 % 211, " ".join(t)))
    rows += [(1000 + i, words(100 + i, 60)) for i in range(70)] + [(1200, None), (1201, ""), (1202, " \t")]
    root = brute_components({d: plain_fingerprint(t) for d, t in rows}, 3)
    kept = sorted(x.doc_id for x in drop_near_duplicates(docs(spark, rows)).collect())
    assert kept == sorted(set(root.values())) and len(kept) < len(rows) - 30


# ---------------------------------------------------------------- suffixes

def brute_repeats(rows, n=50):
    out = []
    for d, t in rows:
        raw = (t or "").encode()
        mark = bytearray(len(raw))
        earlier = {r[i:i + n] for e, u in rows if d is not None and e is not None and e < d
                   for r in [(u or "").encode()] for i in range(len(r) - n + 1)}
        for i in range(len(raw) - n + 1):
            if raw[i:i + n] in earlier:
                mark[i:i + n] = b"\1" * n
        kept = bytes(c for c, m in zip(raw, mark) if not m)
        out.append((d, len(raw), sum(mark), sum(1 for x in bytes(mark).split(b"\0") if x), hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_match_brute_force(spark, monkeypatch):
    from stratum.llm import suffix_dedup
    monkeypatch.setattr(suffix_dedup, "RUN_BYTES", 4000)  # many runs to merge
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    r = random.Random(11)
    line, passage = words(100, 12), words(101, 80)
    rows = []
    for i in range(60):
        parts = [words(i, r.randint(1, 60))]
        if i % 3 == 0:
            parts.insert(r.randrange(2), line)
        if i % 7 == 0:
            parts.insert(r.randrange(len(parts)), passage[r.randrange(200):])
        rows.append((i * 37 % 211, r.choice([" ", "\n"]).join(parts)))
    rows += [(500, rows[0][1]), (501, rows[0][1][:49]), (502, rows[0][1][:50]), (503, None), (504, ""), (505, "a" * 3000),
             (506, "a" * 2999), (507, "ab" * 700), (508, "é" * 60), (509, "é" * 61), (None, rows[0][1]), (500, rows[1][1])]
    got = [(x.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in remove_repeats(docs(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted(brute_repeats(rows), key=repr)
    assert remove_repeats(docs(spark, [])).count() == 0


@pytest.mark.parametrize("runs", [0, 1, 2, 3, 9])
def test_loser_tree_sorts_and_knows_common_prefixes(runs):
    r = random.Random(runs)
    keys = [sorted(bytes(r.choice(b"ab") for _ in range(r.randint(0, 6))) for _ in range(r.randint(0, 30))) for _ in range(runs)]

    def stream(run):
        known, left = front_code(run)
        at, key = 0, b""
        for c, k in zip(known, run):
            key = key[:c] + left[at:at + len(k) - c]
            at += len(k) - c
            yield c, key, None

    got = list(merge_runs([stream(k) for k in keys]))
    assert [k for _, k, _ in got] == sorted(itertools.chain(*keys))
    for (_, x, _), (common, y, _) in zip(got, got[1:]):
        n = 0
        while n < min(len(x), len(y)) and x[n] == y[n]:
            n += 1
        assert common == n


@pytest.mark.parametrize("partitions", ["4", "16"])
def test_index_opened_with_other_shuffle_partitions_keeps_its_buckets(spark, scratch, partitions):
    docs = spark.range(2000).selectExpr("id as doc_id", "concat('text ', id) as text")
    first = DigestIndex(spark, f"{scratch}/index", buckets=8)
    assert exact_dedup(docs, first).where("kept").count() == 2000
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        again = DigestIndex(spark, f"{scratch}/index")
        assert again.buckets == 8
        assert exact_dedup(docs, again).where("kept").count() == 0
        more = docs.unionByName(spark.range(5000, 5010).selectExpr("id as doc_id", "concat('more ', id) as text"))
        assert exact_dedup(more, again).where("kept").count() == 10
        assert again.rows().count() == 2010
        with pytest.raises(ValueError, match="8 buckets"):
            DigestIndex(spark, f"{scratch}/index", buckets=16)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_stages_keep_columns_named_like_their_own(spark):
    rows = [(1, "the same text"), (1, "the same text"), (2, "the  same text"), (3, "another one")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("d", "n", "same", "__d", "digest", "id"):
        df = df.withColumn(name, F.lit(name))
    out = drop_exact_duplicates(df)
    assert out.columns == df.columns and out.select("doc_id", "same", "__d").orderBy("doc_id").collect() == [
        (2, "same", "__d"), (3, "same", "__d")]
    left = drop_near_duplicates(df.withColumn("__row", F.lit("mine")))
    assert {r["__row"] for r in left.collect()} == {"mine"} and left.columns == [*df.columns, "__row"]


def test_keys_of_one_run_alone_are_left_out_of_the_merge():
    import numpy as np

    from stratum.llm import suffix_dedup as s
    rnd = np.random.default_rng(3)
    pool = rnd.integers(0, 3, (400, s.GRAM)).astype(np.uint8)

    def blob(first, rows):
        rows = rows[np.lexsort(rows.T[::-1])]
        same, left = s.front_code([r.tobytes() for r in rows])
        n = len(rows)
        assert (s._front_decoded(np.frombuffer(same, np.uint8), np.frombuffer(left, np.uint8)) == rows).all()
        return [r.tobytes() for r in rows], s.pack(
            same, left, bytes(n), np.arange(n).astype("<u4").tobytes(), np.arange(n).astype("<u4").tobytes(),
            s.steps(np.arange(first, first + n)), s.steps(np.arange(first, first + n)))

    keys, blobs = zip(*[blob(1000 * i, pool[rnd.choice(400, 90)]) for i in range(3)])
    shared = {k for i in range(3) for k in keys[i] if any(k in keys[j] for j in range(3) if j != i)}
    got = [(k, e) for _, k, e in s.merge_runs(s._gram_streams(list(blobs)))]
    assert [k for k, _ in got] == sorted(k for k, _ in got)
    for i in range(3):  # every entry of a key that another run has; nearly nothing else
        for at, k in enumerate(keys[i]):
            assert k not in shared or (k, (0, 1000 * i + at, 1000 * i + at, at)) in got
    assert len(got) < sum(map(len, keys)) and sum(k not in shared for k, _ in got) < 20
    assert list(s.merge_runs(s._gram_streams([]))) == []
