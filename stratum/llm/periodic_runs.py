"""Periodic runs of words: overlapping tiles per period octave, stitched by document and period."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import table, written

#: a run's length is at least this many periods, and this many words
MIN_PERIODS, MIN_WORDS = 4, 6
#: words that a tile answers for: a number of the octave's smallest period, but not less than the second
TILE_PERIODS, TILE_WORDS = 32, 256
#: words, in smallest periods, that a tile sees before and after those it answers for
BEFORE, AFTER = 4, 6


def word_numbers(words: list) -> np.ndarray:
    """Each word as a number, equal for equal words (of one document) only."""
    numbers = defaultdict(count(1).__next__)
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def octave_hits(ids: np.ndarray):
    """For each octave of periods [p, 2p): (p, starts, periods) where a run may pass.

    A run of period q has at least 4q words, so that at some two neighbouring multiples b and
    b + p the window of p words there equals the one q words later. Windows are compared by
    hashes that double from octave to octave: all starts and periods of an octave are n
    comparisons. Equal windows are never missed; unequal hashes alike cost a look only.
    """
    n = len(ids)
    windows = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    p = 1
    while MIN_PERIODS * p <= n:
        rows = n // p + 2
        grid = np.zeros(rows * p, np.uint64)
        grid[:len(windows)] = windows
        grid = grid.reshape(rows, p)
        same = grid[1:] == grid[:-1, :1]      # window at b = row * p against those at b + p .. b + 2p - 1
        same = same[1:] & same[:-1]           # and the same for b + p
        if same.any():
            row, offset = np.nonzero(same)
            starts, periods = row * p, offset + p
            inside = starts + periods + 2 * p <= n
            if inside.any():
                yield p, starts[inside], periods[inside]
        if len(windows) <= p:
            return
        windows = windows[:-p] * np.uint64(0xC2B2AE3D27D4EB4F) + (windows[p:] ^ (windows[p:] >> np.uint64(29)))
        p *= 2


def tiles(ids: np.ndarray):
    """The document's tiles in which a run may pass: (octave p, first word, first and last word of
    the document or not, starts, periods, numbers of the words); places are counted within the tile."""
    n = len(ids)
    for p, starts, periods in octave_hits(ids):
        span = max(TILE_PERIODS * p, TILE_WORDS)
        owner = starts // span
        cuts = np.flatnonzero(np.diff(owner)) + 1
        for part_starts, part_periods, number in zip(np.split(starts, cuts), np.split(periods, cuts),
                                                     owner[np.concatenate([[0], cuts])]):
            lo, hi = max(0, number * span - BEFORE * p), min(n, (number + 1) * span + AFTER * p)
            yield p, int(lo), bool(lo == 0), bool(hi == n), part_starts - lo, part_periods, ids[lo:hi]


def z_function(s: list) -> list[int]:
    """z[i]: length of the longest common prefix of s and s[i:]."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        if i + k >= right:
            while i + k < n and s[k] == s[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def primitive(z: list[int], q: int) -> bool:
    """Whether the first q symbols are no repetition of a shorter block."""
    return not any(q % d == 0 and z[d] >= q - d for d in range(1, q // 2 + 1))


def solve_tile(p: int, at_start: bool, at_end: bool, starts, periods, words: list):
    """(period, first word, end) of the stretches that keep a period of the octave and pass a marked
    place, as far as the tile sees them. What ends inside the tile is whole and is passed on only
    if it is a run; what touches an edge that is no document's edge may go on in the next tile.

    Z-functions at the boundary b: of the words from b on (how far they agree with those q later)
    and, reversed, of the words before b against those before b + q. A block of q words from b
    that repeats a shorter one has a smaller period, which another mark finds.
    """
    n = len(words)
    reach: dict[int, int] = {}   # by period: end of the last stretch found
    at = None
    ahead = back = None
    for b, q in zip(starts, periods):
        if b + q <= reach.get(q, -1):
            continue  # within a stretch found before
        if b != at:
            at = b
            ahead = z_function(words[b:])
            far = words[:b + 2 * p][::-1]
            back = z_function(words[:b][::-1] + [None] + far)
        # the word before b + q stands 2p - q places into the reversed words before b + 2p
        beyond = len(far) - (b + q)
        lead = back[b + 1 + beyond] if b else 0
        first, end = b - lead, b + q + ahead[q]
        if end - first < 2 * q:
            continue
        reach[q] = end
        whole = (first > 0 or at_start) and (end < n or at_end)
        if whole and end - first < max(MIN_WORDS, MIN_PERIODS * q):
            continue
        if primitive(ahead, q):
            yield q, first, end


DOC = "key binary, n long, text string, plain string"
TILE = "p long, lo long, at_start boolean, at_end boolean, starts array<int>, periods array<int>, words array<int>"


def few_rows(batches, rows: int = 256):
    """The same rows in small batches, so that texts and word lists of few documents are held at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").split()


def explode_tiles(place_id: int, place_text: int):
    """Rows of (doc_id, DOC, TILE) per document: one for the document itself (with its text only if it
    has tiles, else with the digest of its words), then one per tile."""
    types = [pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(),
             pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32())]
    names = ["doc_id"] + [f.split()[0] for f in (DOC + ", " + TILE).split(", ")]

    def emit(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    def run(batches):
        for b in few_rows(batches):
            out, weight = [], 0
            for doc_id, text in zip(b.column(place_id).to_pylist(), b.column(place_text)):
                text = text.as_py()
                words = split_words(text)
                found = False
                key = None
                for p, lo, at_start, at_end, starts, periods, part in tiles(word_numbers(words)):
                    if not found:
                        found = True
                        key = hashlib.blake2b(f"{doc_id}:{text}".encode("utf-8"), digest_size=16).digest()
                        out.append((doc_id, key, len(words), text, None, *[None] * 7))
                        weight += len(text)
                    out.append((None, key, None, None, None, p, lo, at_start, at_end,
                                starts.astype(np.int32), periods.astype(np.int32), part.astype(np.int32)))
                    weight += 4 * len(part) + 8 * len(starts)
                    if weight > 1 << 20:
                        yield emit(out)
                        out, weight = [], 0
                if not found:
                    out.append((doc_id, None, len(words), None, hashlib.sha256(b" ".join(words)).hexdigest(), *[None] * 7))
            if out:
                yield emit(out)

    return run


def solve_tiles(batches):
    """(key, period, first, stop) of every stretch of every tile, counted in the document's words."""
    for b in few_rows(batches):
        keys, qs, firsts, stops = [], [], [], []
        for i in range(b.num_rows):
            row = {f: b.column(j)[i].as_py() for j, f in enumerate(b.schema.names)}
            for q, first, end in solve_tile(row["p"], row["at_start"], row["at_end"], row["starts"], row["periods"],
                                            row["words"]):
                keys.append(row["key"])
                qs.append(q)
                firsts.append(row["lo"] + first)
                stops.append(row["lo"] + end)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(qs, pa.int64()),
                                          pa.array(firsts, pa.int64()), pa.array(stops, pa.int64())],
                                         names=["key", "period", "first", "stop"])


def stitched(fragments: DataFrame) -> DataFrame:
    """(key, start, length, period) of the runs that the fragments of a document and period make.

    Two stretches of one period that share a period's words are parts of one; unlike runs of
    one period share less. The window goes over one document and period.
    """
    once = fragments.groupBy("key", "period", "first").agg(F.max("stop").alias("stop"))
    order = Window.partitionBy("key", "period").orderBy("first")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = once.withColumn("new", F.when(F.col("first") + F.col("period") <= before, 0).otherwise(1))
    numbered = opened.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return (numbered.groupBy("key", "period", "run").agg(F.min("first").alias("start"), F.max("stop").alias("stop"))
            .select("key", "start", (F.col("stop") - F.col("start")).alias("length"), "period")
            .where((F.col("length") >= MIN_WORDS) & (F.col("length") >= MIN_PERIODS * F.col("period"))))


RESULT = ("n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def collapse(batches):
    """(doc_id, n, text, runs) -> doc_id and RESULT."""
    names = ["doc_id", *[f.split()[0] for f in RESULT.split(", ")]]
    types = [pa.int64()] * 6 + [pa.string()] * 2
    for b in few_rows(batches):
        out = []
        for i in range(b.num_rows):
            doc_id, text, runs = (b.column(b.schema.get_field_index(f))[i].as_py() for f in ("doc_id", "text", "runs"))
            words = split_words(text)
            runs = sorted((r["start"], r["period"], r["length"]) for r in runs or [])
            keep = np.ones(len(words), bool)
            best = None
            for start, q, length in runs:
                keep[start + q:start + length] = False
                if best is None or length * best[1] > best[2] * q:  # sorted, so ties stay with the first
                    best = (start, q, length)
            listed = "".join(f"{s},{length},{q}\n" for s, q, length in runs)
            left = b" ".join([w for w, k in zip(words, keep.tolist()) if k])
            out.append((doc_id, len(runs), *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else [None] * 4),
                        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def periodic_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_runs, the run of greatest exponent (start, length,
    period, exponent_milli; nulls where there is none), runs_sha256, collapsed_sha256.

    Words are runs of characters between ASCII white space. A run is a stretch of consecutive
    words with smallest period q, at least max(6, 4q) long, that no neighbour extends. Among
    equal exponents the smallest start, then period, is told. ``collapsed_sha256`` is the
    digest of the words outside of what follows each run's first period, joined by blanks.

    Every document is cut into overlapping tiles for each octave of periods, so that no tile's
    work depends on the document's length; tiles that window hashes show to hold no run are
    dropped where they are made. The others are solved each by itself, and their stretches are
    shuffled by document and period and stitched. Texts are shuffled only of documents with
    such tiles. Null and empty texts have no words and no runs, repeated rows get equal
    answers, a null doc_id stays null, and an empty table gives no rows. Other columns are
    ignored, whatever their names.
    """
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    cut = written(slim.mapInArrow(explode_tiles(0, 1), f"doc_id long, {DOC}, {TILE}"), "tiles")
    fragments = (cut.where("p IS NOT NULL").select("key", *[f.split()[0] for f in TILE.split(", ")])
                 .mapInArrow(solve_tiles, "key binary, period long, first long, stop long"))
    runs = (stitched(fragments).groupBy("key")
            .agg(F.collect_list(F.struct("start", "length", "period")).alias("runs")))
    found = cut.where("p IS NULL AND key IS NOT NULL").select("key", "doc_id", "text")
    told = (found.join(runs.hint("merge"), "key", "left").select("doc_id", "text", "runs")
            .mapInArrow(collapse, f"doc_id long, {RESULT}"))
    none = F.lit(None).cast("long")
    plain = cut.where("key IS NULL").select(
        "doc_id", F.lit(0).cast("long").alias("n_runs"), none.alias("start"), none.alias("length"), none.alias("period"),
        none.alias("exponent_milli"), F.lit(hashlib.sha256().hexdigest()).alias("runs_sha256"),
        F.col("plain").alias("collapsed_sha256"))
    return plain.unionByName(told)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of documents whose crc32(doc_id) is divisible by 10 the words from some place on
    are made periodic, as the query's contract says; the other texts are as they were."""

    def run(batches):
        for b in few_rows(batches):
            ids, texts = b.column(0).to_pylist(), []
            for doc_id, text in zip(ids, b.column(1).to_pylist()):
                h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
                words = split_words(text) if h % 10 == 0 else []
                if words:
                    n, g = len(words), h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    block = words[a:a + p]
                    text = b" ".join(words[:a] + (block * ((n - a) // p + 1))[:n - a]).decode("utf-8")
                texts.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, text string")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(planted(table(spark, sf_dir, "documents")))
