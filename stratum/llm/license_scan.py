"""Licence scans: Dice coefficient over word bigrams, size bounds first (DataFrame functions only)."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import free_names, table, text_or_empty

#: notices as licences ask for them, by SPDX identifier; a parameter of the scan
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
THRESHOLD = 0.8


def template_bigrams(text: str) -> Counter:
    words = re.findall("[a-z0-9]+", text.lower())
    return Counter(f"{a} {b}" for a, b in zip(words, words[1:]))


def telling_words(bags: list[Counter], threshold: float) -> set[str]:
    """Words of which every candidate that reaches the threshold with some template has at least one.

    A match with a template of n bigrams holds at least n*t/(2-t) of them, so it can't miss
    all of any n - ceil(n*t/(2-t)) + 1 bigrams. Those with the longest words are taken, and
    of each its longer word, or one that another bigram gave already.
    """
    words: set[str] = set()
    for bag in sorted(bags, key=lambda bag: sum(bag.values())):
        n = sum(bag.values())
        spare = n - math.ceil(n * threshold / (2 - threshold) - 1e-9)
        # grams that a word taken for an earlier template tells already come first
        for gram in sorted(bag, key=lambda g: (not words & set(g.split()), -max(map(len, g.split())), g)):
            if spare < 0:
                break
            if not words & set(gram.split()):
                words.add(max(gram.split(), key=lambda w: (len(w), w)))
            spare -= bag[gram]
    return words


def scan_licenses(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD,
                  text: str = "text") -> DataFrame:
    """``docs`` with license (the best match's name, else null), dice, line (from 0) and n_matches.

    Candidates are every line of the text, the whole text where it has several lines (line
    -1), and for each template of b bigrams the windows of b successive bigrams of the whole
    text, across line breaks, that begin where one of its bigrams stands (fewer bigrams where the text ends
    before); a window's line is that of its first word. So a notice is found wrapped over
    lines, or inside a longer line. A candidate is normalised (lower case, everything but a-z
    and 0-9 a gap between words) and compared as a bag of word bigrams: twice the bigrams in
    common over all bigrams. Bags of a and b bigrams reach a coefficient t only if b lies
    between a*t/(2-t) and a*(2-t)/t; a text of w words has w-1 bigrams, so lines and templates
    are pruned by word counts before any bigram is formed. The same bound says how many of a
    template's bigrams a match must hold, and so a few words of which it has at least one:
    other texts and lines are passed over, and of the windows only those are compared that
    hold so many places with bigrams of the template.

    ``n_matches`` counts the lines, and the whole text, that reach ``threshold`` with some
    template (0 where only a window does). The best is the highest coefficient of all
    candidates, then the smaller line, then the earlier template. Null and empty texts match
    nothing (dice 0.0, no line); an empty table gives an empty one; very long texts are
    compared whole, with work in their length and in the notices they hold. All of it happens
    inside each row: nothing is shuffled and repeated rows get equal answers. Columns of
    ``docs`` named license, dice, line or n_matches are replaced, all others kept.
    """
    bags = [(name, template_bigrams(t)) for name, t in templates]
    shrink = threshold / (2 - threshold)
    lits = F.array(*[F.struct(F.lit(-i).alias("back"), F.array(*[F.lit(x) for x in sorted(b)]).alias("grams"),
                              F.array(*[F.lit(b[x]) for x in sorted(b)]).alias("counts"),
                              F.lit(sum(b.values())).alias("n"),
                              F.lit(math.ceil(sum(b.values()) * shrink - 1e-9)).alias("need"))
                     for i, (_, b) in enumerate(bags)])
    names = F.array(*[F.lit(name) for name, _ in bags])
    every = sorted(set().union(*(b for _, b in bags)))
    words = sorted(telling_words([b for _, b in bags], threshold))
    telling = F.array(*[F.lit(x) for x in words])
    sizes = sorted({sum(b.values()) for _, b in bags})

    def fits(n, size):
        return (n >= size * shrink) & (n * shrink <= size)

    def any_fits(n):
        found = F.lit(False)
        for size in sizes:
            found = found | fits(n, F.lit(size))
        return found

    # split rather than regexp_replace, which costs some ten times as much for each gap
    low = F.lower(text_or_empty(text))
    lines = F.split(low, "\n")
    pieces = F.concat(
        F.transform(lines, lambda x, i: F.struct(_words(x).alias("w"), i.alias("line"))),
        F.when(F.size(lines) > 1, F.array(F.struct(_words(low).alias("w"), F.lit(-1).alias("line"))))
        .otherwise(F.array().cast("array<struct<w:array<string>,line:int>>")))
    right = F.filter(pieces, lambda s: any_fits(F.size(s["w"]) - 1) & F.arrays_overlap(s["w"], telling))
    grams = F.transform(right, lambda s: F.struct(s["line"].alias("line"), _bigrams(s["w"]).alias("g")))

    def overlap(g, t):
        return F.aggregate(F.array_intersect(g, t["grams"]), F.lit(0), lambda acc, x: acc + F.least(
            F.size(F.filter(g, lambda y: y == x)),
            F.element_at(t["counts"], F.array_position(t["grams"], x).cast("int"))))

    def best(s):
        return F.array_max(F.transform(
            F.filter(lits, lambda t: fits(F.size(s["g"]), t["n"])),
            lambda t: F.struct((F.lit(2.0) * overlap(s["g"], t) / (F.size(s["g"]) + t["n"])).alias("dice"),
                               (-s["line"]).alias("up"), t["back"].alias("back"))))

    hits = F.filter(F.transform(grams, best), lambda h: h["dice"] >= threshold)
    # bigrams of the whole text that stand in some template, with place and line
    spread = F.flatten(F.transform(lines, lambda x, i: F.transform(
        _words(x), lambda w: F.struct(w.alias("w"), i.alias("line")))))
    shared = _let(spread, lambda v: F.filter(
        F.transform(
            F.zip_with(F.slice(v, F.lit(1), F.greatest(F.size(v) - 1, F.lit(0))), F.slice(v, 2, F.size(v)),
                       lambda a, b: F.struct(F.concat(a["w"], F.lit(" "), b["w"]).alias("gram"), a["line"].alias("line"))),
            lambda g, at: F.struct(g["gram"].alias("gram"), g["line"].alias("line"), at.alias("at"),
                                   (F.size(v) - 1 - at).alias("left"))),
        lambda g: g["gram"].isin(every)))

    def windows(found, t):
        own = F.filter(found, lambda g: F.array_contains(t["grams"], g["gram"]))
        return _let(own, lambda o: F.transform(
            # the place of the last bigram that the least overlap needs lies inside the window
            F.filter(F.transform(o, lambda g, k: F.struct(g["at"].alias("at"), g["line"].alias("line"), g["left"].alias("left"),
                                                          k.alias("k"))),
                     lambda g: F.get(o, g["k"] + t["need"] - 1)["at"] - g["at"] < t["n"]),
            lambda g: F.struct(
                (F.lit(2.0) * overlap(F.transform(F.filter(F.slice(o, g["k"] + 1, t["n"]), lambda y: y["at"] - g["at"] < t["n"]),
                                                  lambda y: y["gram"]), t)
                 / (F.least(t["n"], g["left"]) + t["n"])).alias("dice"),
                (-g["line"]).alias("up"), t["back"].alias("back"))))

    # texts without any of the telling words are done
    gate = F.arrays_overlap(F.split(low, "[^a-z0-9]+"), telling)
    none = F.array().cast("array<struct<dice:double,up:int,back:int>>")
    hits = F.when(gate, hits).otherwise(none)
    near = F.when(gate, _let(shared, lambda found: F.filter(
        F.flatten(F.transform(lits, lambda t: windows(found, t))), lambda h: h["dice"] >= threshold))).otherwise(none)
    h, n, b = free_names(docs, "__hits", "__near", "__top")
    top = F.col(b)
    return (docs.withColumns({h: hits, n: near}).withColumn(b, F.array_max(F.concat(h, n)))
            .withColumn("license", F.when(top.isNotNull(), F.element_at(names, 1 - top["back"])))
            .withColumn("dice", F.coalesce(top["dice"], F.lit(0.0)))
            .withColumn("line", -top["up"])
            .withColumn("n_matches", F.size(h).cast("long"))
            .drop(h, n, b))


def _let(value, body):
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _words(text):
    return F.filter(F.split(text, "[^a-z0-9]+"), lambda w: w != "")


def _bigrams(words):
    n = F.size(words) - 1
    return F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licenses(docs).drop("text")


def op9_sql(templates=TEMPLATES, threshold: float = THRESHOLD) -> str:
    def lit(text):
        return "'" + text.replace("'", "''") + "'"

    rows = ", ".join(f"({i}, {lit(name)}, {lit(text)})" for i, (name, text) in enumerate(templates))
    low = "lower(%s)"
    return f"""
WITH tpl AS (
  SELECT no, name, regexp_extract_all({low % 'body'}, '[a-z0-9]+') AS w
  FROM (VALUES {rows}) AS v(no, name, body)),
tb AS (
  SELECT no, name, len(w) - 1 AS n, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS gram FROM tpl),
tc AS (SELECT no, name, n, gram, count(*) AS c FROM tb GROUP BY ALL),
l AS (SELECT doc_id, string_split({low % "coalesce(text, '')"}, chr(10)) AS ls FROM documents),
piece AS (
  SELECT doc_id, unnest(range(len(ls))) AS line, unnest(ls) AS t FROM l
  UNION ALL SELECT doc_id, -1, array_to_string(ls, ' ') FROM l WHERE len(ls) > 1),
pw AS (SELECT doc_id, line, regexp_extract_all(t, '[a-z0-9]+') AS w FROM piece),
pb AS (
  SELECT doc_id, line, len(w) - 1 AS n, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS gram
  FROM pw WHERE len(w) > 1),
pc AS (SELECT doc_id, line, n, gram, count(*) AS c FROM pb GROUP BY ALL),
score AS (
  SELECT doc_id, line, no, name, 2.0::DOUBLE * sum(least(pc.c, tc.c)) / (pc.n + tc.n) AS dice
  FROM pc JOIN tc USING (gram) GROUP BY doc_id, line, no, name, pc.n, tc.n),
wl AS (
  SELECT doc_id, line, unnest(w) AS word, unnest(range(len(w))) AS k FROM pw WHERE line >= 0),
seq AS (
  SELECT doc_id, line, word || ' ' || lead(word) OVER in_text AS gram,
         row_number() OVER in_text - 1 AS place, count(*) OVER (PARTITION BY doc_id) - 1 AS total
  FROM wl WINDOW in_text AS (PARTITION BY doc_id ORDER BY line, k)),
shared AS (SELECT doc_id, line, place, total, gram, no, name, n, c FROM seq JOIN tc USING (gram)),
win AS (
  SELECT a.doc_id, a.line, a.place, a.total, a.no, a.name, a.n, b.gram, least(count(*), any_value(b.c)) AS o
  FROM shared a JOIN shared b ON a.doc_id = b.doc_id AND a.no = b.no AND b.place >= a.place AND b.place < a.place + a.n
  GROUP BY ALL),
wscore AS (
  SELECT doc_id, line, place, no, name, 2.0::DOUBLE * sum(o) / (least(n, total - place) + n) AS dice
  FROM win GROUP BY doc_id, line, place, no, name, n, total),
best AS (
  SELECT doc_id, line, name, dice, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, line, no) AS k
  FROM (SELECT doc_id, line, no, name, dice FROM score UNION ALL SELECT doc_id, line, no, name, dice FROM wscore)
  WHERE dice >= {threshold}),
whole AS (SELECT doc_id, count(DISTINCT line) AS n FROM score WHERE dice >= {threshold} GROUP BY doc_id)
SELECT d.doc_id, b.name AS license, coalesce(b.dice, 0.0)::DOUBLE AS dice, b.line::INTEGER AS line, coalesce(m.n, 0)::BIGINT AS n_matches
FROM documents d LEFT JOIN (SELECT * FROM best WHERE k = 1) b ON b.doc_id = d.doc_id
LEFT JOIN whole m ON m.doc_id = d.doc_id
"""
