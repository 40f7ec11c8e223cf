"""Nearest neighbours, URL filters, quality, licences, mixing and the pipeline."""

from __future__ import annotations

import math
import os
import re
import sys

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import __spark_entry__  # noqa: E402
import corpus_pipeline  # noqa: E402
from stratum.llm import quality, url_filter  # noqa: E402
from stratum.llm.ann import build_graph, nearest  # noqa: E402
from stratum.llm.license_scan import TEMPLATES, scan_licenses, template_bigrams, telling_words  # noqa: E402
from stratum.llm.mixing import mix, mixed_documents, route, source_targets  # noqa: E402

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- nearest neighbours

def test_nearest_against_brute_force(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(700, 16))
    x[200:420] = x[5]  # one vector that a third of the rows have
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(1000, None), (1100, [0.0] * 16), (1200, [float("nan")] * 16), (1300, [None] * 16), (1400, []), (None, rows[0][1]),
             (1500, [1.0, 2.0]), (1600, [1.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = nearest(df, F.col("id") % 100 == 0, k=10, shard=256).collect()
    lists: dict = {}
    for g in sorted(got, key=lambda g: (g.query_id, g["rank"])):
        lists.setdefault(g.query_id, []).append((g.score, g.vec_id))
    assert sorted(lists) == [0, 100, 200, 300, 400, 500, 600, 1500, 1600]
    hits = total = 0
    for q in range(0, 700, 100):
        want = sorted((math.sqrt(((x[i] - x[q]) ** 2).sum()), i) for i in range(700) if i != q)[:10]
        total += 10
        hits += len({i for _, i in want} & {i for _, i in lists[q]})
        assert lists[q] == sorted(lists[q])
        for s, i in lists[q]:
            assert s == pytest.approx(math.sqrt(((x[i] - x[q]) ** 2).sum()), abs=1e-12)
    assert hits / total >= 0.9
    assert lists[200] == [(0.0, i) for i in [5, *range(201, 210)]]
    assert lists[1500] == [(2.0, 1600)]  # vectors of another length don't meet
    assert nearest(df.limit(0), F.lit(True)).count() == 0


def test_nearest_with_repeated_rows(spark):
    """The queried row once, twice and twelve times; a neighbour that comes three times counts three times."""
    place = {i: [1.0 + i, 2.0] for i in range(40)}
    rows = [(i, v) for i, v in place.items()] + [(100, [5.0, 2.0])] * 2 + [(200, [9.0, 2.0])] * 12 + [(3, place[3])] * 2
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 100 == 0, k=10).collect()
    for q, v in ((0, place[0]), (100, [5.0, 2.0]), (200, [9.0, 2.0])):
        want = sorted((abs(w[0] - v[0]), i) for i, w in rows if i != q)[:10]
        assert sorted((g["rank"], g.score, g.vec_id) for g in got if g.query_id == q) == [
            (n + 1, s, i) for n, (s, i) in enumerate(want)]


def test_graph_reaches_its_nodes():
    x = np.random.default_rng(2).normal(size=(500, 8)).astype(np.float32)
    edges, middle = build_graph(x)
    seen, todo = {middle}, [middle]
    while todo:
        for v in edges[todo.pop()]:
            if v >= 0 and int(v) not in seen:
                seen.add(int(v))
                todo.append(int(v))
    assert len(seen) >= 495
    assert build_graph(x[:1])[0].max() == -1


# ---------------------------------------------------------------- urls

URLS = ["http://example.org/es/x", "http://a.example.org/ES/x", "http://A.Example.ORG/en/12?q#f", "http://example.org/en/2",
        "http://example.org", "http://example.org?x", "http://fr.com/fr/a", "http://xcom/fr/a", "https://com/de/", "x://y.com/DE/",
        "nothing", "", None, "http://h.net/p?utm_source=feed", "http://h.net/UTM_SOURCE=feed", "http://h.net/xxx/", "http://h.net/xxxy/",
        "http://ads.h.net/", "http://h.net/login", "http://h.net/wp-login.php", "http://user@example.org:80/es/", "a://b://c.org/d",
        "http://H.net/CASINO\n", "http://h.net/" + "z" * 50_000, "http://h.net/\u212aart/cart"]


def test_urls_match_the_rules_tried_one_by_one(spark):
    rules = url_filter.HOST_RULES + url_filter.PATTERN_RULES
    loose = tuple(url_filter.Rule(r.verdict, r.pattern, (), r.site) for r in rules)
    df = spark.createDataFrame([(i, u, "old") for i, u in enumerate(URLS)], "page_id long, url string, verdict string")
    got = sorted(tuple(r) for r in url_filter.judge_urls(df, rules).collect())
    assert got == sorted(tuple(r) for r in url_filter.judge_urls(df, loose).collect())
    by = {r[1]: r[2:] for r in got}
    assert by["http://example.org/es/x"] == ("example.org/es/", "block")
    assert by["http://a.example.org/ES/x"] == ("org/", "allow")
    assert by["http://A.Example.ORG/en/12?q#f"] == ("example.org/en/1", "block")
    assert by["http://example.org"] == (None, "allow") and by[None] == (None, "allow")
    assert by["http://h.net/p?utm_source=feed"] == (None, "block") and by["http://h.net/xxxy/"] == (None, "allow")
    assert url_filter.judge_urls(df.limit(0), rules).count() == 0


def test_an_embedded_address_is_not_the_host(spark):
    urls = ["http://evil.com/?u=http://example.org/es/x", "https://web.site.com/cache/http://x.org/a",
            "http://h.net/de#x://a.com/fr/", "a:://x.org/", "http://x.org/http://h.com/de/"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r.url: (r.rule, r.verdict) for r in url_filter.judge_urls(df, url_filter.HOST_RULES).collect()}
    assert [got[u] for u in urls] == [(None, "allow")] * 3 + [("org/", "allow")] * 2


def test_rules_are_filed_under_their_rarest_token():
    rules = (url_filter.token_rule("block", "aa", "bbb"), url_filter.Rule("block", "x", ()))
    assert url_filter.build_index(rules, {"aa": 1, "bbb": 9}) == ({"aa": [0]}, [1])
    assert url_filter.build_index(rules, {"aa": 9, "bbb": 1}) == ({"bbb": [0]}, [1])


# ---------------------------------------------------------------- quality

def test_quality_learns_and_handles_odd_rows(spark):
    rows = [(i, ("good clear words here " if i % 2 else "junk!! spam!! buy!! ") * (1 + i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows + [(900, None), (901, ""), (None, "good clear words"), (902, "good " * 100_000)],
                               "doc_id long, text string").withColumn("score", F.lit("old"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 100)] + [(3, None), (None, 1), (5, 1), (5, 1)],
                                   "doc_id long, quality int")
    w = quality.train(df, labels)
    assert np.array_equal(w, quality.train(df.repartition(5), labels.repartition(3)))  # reruns agree
    got = {r.doc_id: r.score for r in quality.score(df, w).collect()}
    assert all((got[i] >= 0.5) == bool(i % 2) for i in range(200))
    assert got[900] == got[901] and 0 < got[900] < 1 and got[None] > 0.5
    assert not quality.train(df, labels.limit(0)).any()
    assert quality.score(df.limit(0), w).count() == 0


def test_held_out_accuracy(spark):
    q = quality.op8_quality_classifier(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("held_out")
    r = q.agg(F.count("*").alias("n"), F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("ok")).first()
    assert r.n > 50 and r.ok > 0.95


# ---------------------------------------------------------------- licences

def brute_license(text, threshold=0.8):
    from collections import Counter
    best, n = None, 0
    lines = (text or "").lower().split("\n")
    for no, line in [*enumerate(lines), *([(-1, " ".join(lines))] if len(lines) > 1 else [])]:
        w = re.findall("[a-z0-9]+", line)
        bag = Counter(f"{a} {b}" for a, b in zip(w, w[1:]))
        scores = []
        for k, (name, t) in enumerate(TEMPLATES):
            tb = template_bigrams(t)
            d = 2.0 * sum((bag & tb).values()) / (sum(bag.values()) + sum(tb.values()))
            if d >= threshold:
                scores.append((-d, no, k, name))
        if scores:
            n += 1
            best = min([*scores, *([best] if best else [])])
    words = [(w, no) for no, line in enumerate(lines) for w in re.findall("[a-z0-9]+", line)]
    grams = [(f"{a} {b}", no) for (a, no), (b, _) in zip(words, words[1:])]
    for k, (name, t) in enumerate(TEMPLATES):
        tb = template_bigrams(t)
        size = sum(tb.values())
        for at, (gram, no) in enumerate(grams):
            if gram in tb:
                bag = Counter(g for g, _ in grams[at:at + size])
                d = 2.0 * sum((bag & tb).values()) / (sum(bag.values()) + size)
                if d >= threshold:
                    best = min([(-d, no, k, name), *([best] if best else [])])
    return (best[3], -best[0], best[1], n) if best else (None, 0.0, None, 0)


def wrapped(text, width, lead=""):
    import textwrap
    return "\n".join(lead + line for line in textwrap.wrap(text, width))


def test_wrapped_notices_inside_longer_texts(spark):
    """Headers as files carry them, and a notice inside a longer line."""
    from stratum.llm.license_scan import op9_sql
    prose = "\n".join(f"def part_{i}(x): return the value of the software that {i} holds" for i in range(40))
    cases = [(name, f"#!/bin/sh\n{wrapped(t, width, lead)}\n\n{prose}") for name, t in TEMPLATES
             for width, lead in ((30, "# "), (72, " * "))]
    cases += [(name, f"{prose} {t} {prose}") for name, t in TEMPLATES]
    cases += [("MIT", prose + "\n" + wrapped(TEMPLATES[1][1].replace("charge", "cost").replace("deal in", "use"), 60)),
              (None, prose), (None, wrapped("The software is free of charge to any person, in the public domain.", 20))]
    rows = [(i, t) for i, (_, t) in enumerate(cases)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.license, r.dice, r.line, r.n_matches) for r in scan_licenses(df).collect()}
    for i, (name, t) in enumerate(cases):
        assert got[i] == pytest.approx(brute_license(t)), (i, t)
        assert got[i][0] == name, (i, t)
    import duckdb
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    sql = {r[0]: r[1:] for r in db.execute(op9_sql()).fetchall()}
    assert sql == got


def test_licences_keep_clashing_columns(spark):
    df = spark.createDataFrame([(1, TEMPLATES[0][1], "a", "b", 7)], "doc_id long, text string, __hits string, __top string, __near int")
    r = scan_licenses(df).first()
    assert (r["__hits"], r["__top"], r["__near"], r.license, r.n_matches) == ("a", "b", 7, "MIT", 1)


def test_licences_match_brute_force(spark):
    notes = [t for _, t in TEMPLATES]
    texts = [None, "", "released", "under the", *notes, *[n.upper() + "\nwords" for n in notes], "prose\n" + notes[0] + "\n" + notes[2],
             notes[1].replace("software", "code"), notes[1].replace(", ", "\n"), notes[0] * 30, "license " * 50, " ".join(notes),
             "Released under the MIT", "This work is licensed under the GNU General Public License, version 4.", "under the license\n" * 500]
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id long, text string, license string")
    got = {r.doc_id: (r.license, r.dice, r.line, r.n_matches) for r in scan_licenses(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(brute_license(t)), (i, t)
    assert scan_licenses(df.limit(0)).count() == 0
    assert "ArrowEvalPython" not in scan_licenses(df)._jdf.queryExecution().executedPlan().toString()


def test_every_match_has_a_telling_word():
    bags = [template_bigrams(t) for _, t in TEMPLATES]
    words = telling_words(bags, 0.8)
    for bag in bags:
        without = sum(c for g, c in bag.items() if not words & set(g.split()))
        assert without < sum(bag.values()) * 0.8 / 1.2


# ---------------------------------------------------------------- mixing

def test_targets():
    assert source_targets({"a": 100, "b": 100, "c": 100, None: 100}) == pytest.approx(
        {"a": 200.0, "b": 400 * 1 / 6, "c": 400 * 2 / 6, None: 200.0})
    t = source_targets({"a": 10, "b": 1000, "c": 1000})
    assert t["a"] == 20 and sum(t.values()) == pytest.approx(3015)
    assert source_targets({}) == {} and source_targets({"a": 0}) == {"a": 0.0}


def test_flow_meets_quotas_at_least_repetition():
    flows = route([(("a",), 100), (("b",), 100), (("a", "b"), 100)], {"a": 150.0, "b": 150.0})
    assert sum(f.get("a", 0) for f in flows) == pytest.approx(150) and sum(f.get("b", 0) for f in flows) == pytest.approx(150)
    assert all(sum(f.values()) <= 100 + 1e-6 for f in flows)  # enough words for one copy each
    flows = route([(("a",), 10), (("a", "b"), 100)], {"a": 100.0, "b": 100.0})
    assert [round(sum(f.values())) for f in flows] == [20, 180] or sum(map(lambda f: sum(f.values()), flows)) == pytest.approx(200)


def test_mix_comes_near_its_targets(spark):
    rows = [(i, "w " * (1 + i * 7 % 50), ["x", "y", None][i % 3], "old") for i in range(900)]
    rows += [(2000, None, "x", "o"), (2001, "", "z", "o"), (None, "a b", "y", "o"), (5, rows[5][1], rows[5][2], "o")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = mix(df).collect()
    assert len(got) == len(rows)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mix(df.repartition(7)).collect()), key=repr)  # reruns agree
    for r in got:
        assert r.size == len((next(t for d, t, *_ in rows if d == r.doc_id) or "").split())
        assert r.taken in (0, r.size, 2 * r.size)
    taken: dict = {}
    for r in got:
        taken.setdefault((r.pattern, r.target), []).append(r.taken)
    want = source_targets({s: sum(len((t or "").split()) for _, t, q, _ in rows if q == s) for s in ("x", "y", "z", None)})
    for (_, target), sizes in taken.items():
        assert abs(sum(sizes) - target) <= 60, (target, sum(sizes))
    assert sorted(t for _, t in taken) == sorted(want.values())
    assert mix(df.limit(0)).count() == 0
    out = mixed_documents(df)
    assert out.columns == df.columns and out.count() > 900


def test_mix_of_overlapping_sources(spark):
    rows = [(i, "w " * 10, [["a"], ["b"], ["b", "a"]][i % 3]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    got = mix(df, targets={"a": 1500, "b": 1500}).collect()
    assert sum(r.taken for r in got) == pytest.approx(3000, abs=30) and max(r.taken for r in got) == 10


def test_mix_hands_on_the_words_it_takes(spark):
    """Rows without a doc_id, rows that share one, and repeated rows: words out equal words taken."""
    rows = [(None, f"{i} " * 10, "a") for i in range(150)] + [(None, "w " * 10, "b")] * 40
    rows += [(7, "z " * 10, "b")] * 90 + [(7, "z " * 10, "a")] * 15 + [(i, f"{i} " * 10, "b") for i in range(100, 220)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copies", F.lit("clash"))
    df = df.withColumn("taken", F.lit(1)).withColumn("who", F.lit(2)).withColumn("w", F.lit(3))
    for targets in (None, {"a": 1230, "b": 417}, {"a": 3300, "b": 2505}):
        got = mix(df, targets=targets).collect()
        out = mixed_documents(df, targets=targets)
        assert out.columns == df.columns
        handed = {s: n for s, n in out.groupBy("source").agg(F.sum(F.lit(10))).collect()}
        for source in ("a", "b"):
            mine = [r for r in got if r.pattern == f'[{{"s":"{source}"}}]']
            assert sum(r.taken for r in mine) == handed.get(source, 0)
            assert abs(handed.get(source, 0) - mine[0].target) <= 10
            assert all(r.taken <= 20 for r in mine)


def test_mix_of_empty_and_null_memberships(spark):
    rows = [(1, "a b", None), (2, "a b", []), (3, "a b", ["x", None]), (4, "a b", ["x"]), (5, None, ["x"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    got = {r.doc_id: r for r in mix(df).collect()}
    assert got[1].pattern == got[2].pattern == '[{}]' and got[5].taken == 0
    assert mixed_documents(df).where("doc_id is null").count() == 0


def cheapest_flow(capacity, targets, repeats):
    """The most tokens that can be sent, and the least cost of doing so, by trying all whole amounts."""
    import itertools
    names = list(targets)
    arcs = [(p, s) for p, (sources, _) in enumerate(capacity) for s in sources]
    best = None
    for amounts in itertools.product(*[range(int(min(repeats * capacity[p][1], targets[s])) + 1) for p, s in arcs]):
        of = [sum(a for a, (q, _) in zip(amounts, arcs) if q == p) for p in range(len(capacity))]
        into = {s: sum(a for a, (_, t) in zip(amounts, arcs) if t == s) for s in names}
        if any(o > repeats * c for o, (_, c) in zip(of, capacity)) or any(into[s] > targets[s] for s in names):
            continue
        cost = sum(copy * min(max(o - copy * c, 0), c) for o, (_, c) in zip(of, capacity) for copy in range(repeats))
        key = (-sum(of), cost)
        best = key if best is None or key < best else best
    return best


def test_route_costs_no_more_than_the_cheapest_flow():
    r = np.random.default_rng(4)
    for _ in range(25):
        capacity = [(tuple(sorted(r.choice(["a", "b"], size=r.integers(1, 3), replace=False))), int(r.integers(1, 4)))
                    for _ in range(int(r.integers(1, 4)))]
        targets = {"a": float(r.integers(0, 6)), "b": float(r.integers(0, 6))}
        flows = route(capacity, targets, 2)
        sent = [sum(f.values()) for f in flows]
        cost = sum(copy * min(max(o - copy * c, 0), c) for o, (_, c) in zip(sent, capacity) for copy in range(2))
        assert (-sum(sent), cost) == pytest.approx(cheapest_flow(capacity, targets, 2))


# ---------------------------------------------------------------- queries and pipeline

SQL = [k for k in __spark_entry__.oracle_sql() if re.match("op[0-9]+_", k)]


@pytest.mark.parametrize("name", SQL)
def test_sql_agrees(spark, scratch, name):
    __spark_entry__.queries()[name](spark, SF).write.parquet(f"{scratch}/r")
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    con.execute(f"create table o as {__spark_entry__.oracle_sql()[name]}")
    cols = ", ".join(c[0] for c in con.execute("describe o").fetchall())
    con.execute(f"create table r as select {cols} from read_parquet('{scratch}/r/*.parquet')")
    assert con.execute("select count(*) from o").fetchall() == con.execute("select count(*) from r").fetchall()
    assert con.execute("select count(*) from (select * from o except all select * from r)").fetchall() == [(0,)]


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert [sum(k.startswith(f"op{n}_") for k in names) for n in range(1, 11)] == [1] * 10 and "pipeline" in names


def test_pipeline_stages(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{scratch}/{k}")
        after = spark.read.parquet(f"{scratch}/{k}")
        if name != "bpe":
            assert after.columns == columns
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        assert {r.doc_id for r in after.select("doc_id").collect()} <= before
        if name == "exact_dedup":
            texts = [re.sub(r"[\x20\x09-\x0D]", "", r.text) for r in after.collect()]
            assert len(texts) == len(set(texts))
            assert set(texts) == {re.sub(r"[\x20\x09-\x0D]", "", r.text) for r in docs.collect()}
        counts.append(after.count())
        docs = after
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] <= counts[2] and counts[5] == counts[4]
    assert "n_tokens" in docs.columns
