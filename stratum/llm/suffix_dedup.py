"""Repeated passages by a distributed merge sort of suffixes: front-coded runs, loser trees with known prefixes.

A passage of MIN_BYTES bytes that repeats is found at an anchor: of the STEP places where
GRAM bytes begin inside a window of MIN_BYTES bytes, the one whose bytes hash lowest (the
leftmost of equals). Equal windows have their anchor at the same offset, so it is enough to
sort the suffixes that begin at anchors, some 6 % of all.

Round one sorts those suffixes by their first GRAM bytes and keeps anchors that several
documents share; keys that one run alone has are left out of the merge. Round two sorts, for the anchors kept, all bytes of the windows that have
that anchor: from the anchor to the right, then from it to the left. Whatever is equal is
then adjacent, and windows of neighbouring suffixes with an equal anchor are compared byte
by byte.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import shared_folder, table, text_or_empty, written

MIN_BYTES = 50
GRAM = 16
STEP = MIN_BYTES - GRAM + 1
#: bytes of text sorted into one run, and bytes of a long text looked at in one go
RUN_BYTES = 24 << 20
PIECE = 60_000
_PLACE = np.uint64(0xFFFF)


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(number, anchor, first, last, high, low) of all texts, in order: the text's number, the
    place of an anchor, the first and last window that has it, its GRAM bytes as two numbers.

    The texts are looked at as one, PIECE windows in one go (at a piece's end an anchor's
    windows are cut in two rows); windows across the end of a text are left out.
    """
    joined = b"".join(texts)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    found: list[tuple] = []
    n = len(joined) - MIN_BYTES + 1  # windows
    for base in range(0, n, PIECE):
        count = min(PIECE, n - base)
        x = np.frombuffer(joined, np.uint8, count + MIN_BYTES - 1, base)
        eight = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(x, 8)).view(">u8").ravel().astype(np.uint64)
        high, low = eight[:-8], eight[8:]
        h = (high ^ (low * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x165667B19E3779F9)
        h = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        m, width = h, 1
        while width * 2 <= STEP:
            m = np.minimum(m[:-width], m[width:])
            width *= 2
        if width < STEP:
            rest = STEP - width
            m = np.minimum(m[:-rest], m[rest:])
        at = (m & _PLACE).astype(np.int64)
        # windows whole within their text; a text's first window begins anew
        inside = np.ones(count + 1, dtype=bool)
        inside[count] = False
        cut = np.ones(count + 1, dtype=bool)
        cut[1:count] = at[1:] != at[:-1]
        for e in ends[np.searchsorted(ends, base + 1):np.searchsorted(ends, base + count + MIN_BYTES)].tolist():
            inside[max(0, e - MIN_BYTES + 1 - base):max(0, min(count, e - base))] = False
            if e - base < count:
                cut[e - base] = True
        start = np.flatnonzero(inside[:count] & (cut[:count] | np.concatenate(([True], ~inside[:count - 1]))))
        last = np.flatnonzero(inside[:count] & (cut[1:] | ~inside[1:]))
        a = at[start]
        found.append((a + base, start + base, last + base, high[a], low[a]))
    if not found:
        e = np.zeros(0, np.int64)
        return e, e, e, e, e.astype(np.uint64), e.astype(np.uint64)
    a, first, last, high, low = (np.concatenate(c) for c in zip(*found))
    number = np.searchsorted(ends, a, side="right")
    begin = (ends - sizes)[number]
    return number, a - begin, first - begin, last - begin, high, low


def _slot(high: np.ndarray, low: np.ndarray, parts: int) -> np.ndarray:
    mixed = (high * np.uint64(0xFF51AFD7ED558CCD)) ^ (low * np.uint64(0xC4CEB9FE1A85EC53))
    return ((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def front_code(keys: list[bytes], known: np.ndarray | None = None) -> tuple[bytes, bytes]:
    """(lengths in common with the key before, as bytes; what is left of the keys, joined)."""
    if known is None:
        known = np.zeros(len(keys), np.uint8)
        if len(keys) > 1:
            sizes = np.fromiter(map(len, keys), np.int64, len(keys))
            width = int(sizes.max()) + 1  # one more than any key: the longest place that can differ
            square = np.frombuffer(b"".join([k.ljust(width, b"\0") for k in keys]), np.uint8).reshape(-1, width)
            differ = square[1:] != square[:-1]
            differ[:, -1] = True
            known[1:] = np.minimum(differ.argmax(1), np.minimum(sizes[1:], sizes[:-1]))
    return known.astype(np.uint8).tobytes(), b"".join(k[c:] for k, c in zip(keys, known.tolist()))


def pack(*columns: bytes) -> bytes:
    sizes = np.array([len(c) for c in columns], "<u8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(bytes([len(columns)]) + sizes + b"".join(columns))


def unpack(blob: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(raw, "<u8", raw[0], 1).tolist()
    out, at = [], 1 + 8 * raw[0]
    for s in sizes:
        out.append(raw[at:at + s])
        at += s
    return out


def steps(x: np.ndarray) -> bytes:
    """Numbers as differences to the one before: small and alike where they rise evenly."""
    return np.diff(x.astype(np.int64), prepend=0).astype("<i8").tobytes()


def unsteps(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, "<i8"))


def merge_runs(runs: list[Iterator[tuple[int, bytes, object]]]) -> Iterator[tuple[int, bytes, object]]:
    """Merge sorted runs of (bytes in common with the run's key before, key, payload).

    A loser tree over the runs. Every run's head knows how many bytes it has in common with
    the key that left last; of two heads the one with more in common is the smaller, and only
    heads with equally many are compared, from there on. Yields the same triples in sorted
    order, the first now the bytes in common with the key that was yielded before.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads: list = [next(r, None) for r in runs] + [None] * (k - len(runs))
    known = [0 if h is not None else -1 for h in heads]
    loser = [-1] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser learns what it has in common with the winner."""
        x, y = known[a], known[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        p, q = heads[a][1], heads[b][1]
        n = len(p) if len(p) < len(q) else len(q)
        if x < n and p[x] == q[x]:
            x += 1
            if p[x:n] == q[x:n]:
                x = n
            else:
                while p[x] == q[x]:
                    x += 1
        if x == n:
            first = len(p) <= len(q)
        else:
            first = p[x] < q[x]
        if first:
            known[b] = x
            return a, b
        known[a] = x
        return b, a

    winners = list(range(k))
    level = k // 2
    while level:
        following = []
        for i in range(level):
            w, lost = play(winners[2 * i], winners[2 * i + 1])
            loser[level + i] = lost
            following.append(w)
        winners = following
        level //= 2
    top = winners[0]
    best = known[top]  # what the top has in common with the key that left last
    while best >= 0:
        head = heads[top]
        yield best, head[1], head[2]
        heads[top] = head = next(runs[top], None)
        known[top] = best = -1 if head is None else head[0]
        node = (top + k) >> 1
        while node:
            other = loser[node]
            y = known[other]
            if best < y:
                loser[node] = top
                top, best = other, y
            elif best == y and y >= 0:
                w, lost = play(top, other)
                if w != top:
                    loser[node] = lost
                    top = w
            node >>= 1


# ---------------------------------------------------------------- round one: which anchors are shared

def _documents(batches) -> Iterator[list[tuple[int, int, bytes, object]]]:
    """Rows (doc_id, row number, utf-8 text, last column) in lists of about RUN_BYTES bytes."""
    held, size = [], 0
    for b in batches:
        extra = b.column(3) if b.num_columns > 3 else None
        for i in range(b.num_rows):
            raw = b.column(2)[i].as_py().encode("utf-8")
            if len(raw) < MIN_BYTES:
                continue
            held.append((b.column(0)[i].as_py(), b.column(1)[i].as_py(), raw, extra and extra[i].as_py()))
            size += len(raw)
            if size >= RUN_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def _gram_run(docs, parts: int):
    """Rows (slot, blob) of one sorted run, and (number of the document, shared anchors) found inside it."""
    number, place, _, _, high, low = anchors([d[2] for d in docs])
    order = np.lexsort((low, high))  # stable: equal ones stay by document and place
    number, place, high, low = number[order], place[order], high[order], low[order]
    new = np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])]
    starts = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    several = np.maximum.reduceat(number, starts) > np.minimum.reduceat(number, starts)
    inside = several[group]
    # what this run knows to be shared goes on as one suffix, marked; the rest one by one
    go = ~inside | new
    own = {}
    hit = np.flatnonzero(inside)
    hit = hit[np.argsort(number[hit], kind="stable")]
    cuts = np.flatnonzero(np.r_[True, number[hit][1:] != number[hit][:-1]]) if len(hit) else []
    for at, end in zip(cuts, [*cuts[1:], len(hit)]):
        own[int(number[hit[at]])] = place[hit[at:end]]
    number, place, high, low, inside = number[go], place[go], high[go], low[go], inside[go]
    slot = _slot(high, low, parts)
    if parts <= 1 << 16:
        slot = slot.astype(np.uint16)  # sorted by its digits
    order = np.argsort(slot, kind="stable")
    bounds = np.searchsorted(slot[order], np.arange(parts + 1))
    ids = np.array([d[0] for d in docs], "<i8")
    lines = np.array([d[1] for d in docs], "<i8")
    blobs = []
    for p in range(parts):
        at = order[bounds[p]:bounds[p + 1]]
        if not len(at):
            continue
        key = np.stack((high[at], low[at]), 1).astype(">u8").view(np.uint8).reshape(-1, GRAM)
        same = np.ones(len(at), dtype=np.int64) * GRAM
        same[0] = 0
        if len(at) > 1:
            diff = key[1:] != key[:-1]
            same[1:] = np.where(diff.any(1), diff.argmax(1), GRAM)
        left = key[np.arange(GRAM)[None, :] >= same[:, None]].tobytes()
        used, local = np.unique(number[at], return_inverse=True)
        blobs.append((p, pack(same.astype(np.uint8).tobytes(), left, inside[at].astype(np.uint8).tobytes(),
                              local.astype("<u4").tobytes(), place[at].astype("<u4").tobytes(),
                              steps(ids[used]), steps(lines[used]))))
    return blobs, own


def _front_decoded(same: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Front-coded keys of GRAM bytes as rows of a square: every byte is that of the last key that has its own there."""
    same = same.astype(np.int64)
    begin = np.cumsum(GRAM - same) - (GRAM - same) - same
    line = np.arange(len(same))
    square = np.empty((len(same), GRAM), np.uint8)
    for j in range(GRAM):
        own = np.maximum.accumulate(np.where(same <= j, line, 0))
        square[:, j] = left[begin[own] + j]
    return square


#: most cells of the table that tells which keys come in several runs
CELLS = 1 << 26


def _gram_streams(blobs: list[bytes]) -> list[Iterator[tuple[int, bytes, tuple]]]:
    """The runs to merge, front-coded anew without the keys that no other run has: those are
    not shared, or their run has settled them by itself.

    Whether another run has a key is looked up by hash, so a few of them stay; never is one lost.
    """
    runs = []
    for blob in blobs:
        same, left, *rest = unpack(blob)
        same = np.frombuffer(same, np.uint8)
        key = _front_decoded(same, np.frombuffer(left, np.uint8))
        half = key.view("<u8")
        h = (half[:, 0] * np.uint64(0x9E3779B97F4A7C15)) ^ (half[:, 1] * np.uint64(0xD6E8FEB86659FD93))
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xC2B2AE3D27D4EB4F)
        runs.append((same, key, (h >> np.uint64(32)).astype(np.uint32), rest))
    size = 1 << 10
    while size < min(CELLS, 8 * sum(len(r[0]) for r in runs)):
        size *= 2
    low = np.uint32(size - 1)
    seen, again = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
    for same, _, h, _ in runs:
        cell = h[same < GRAM] & low  # each key of the run once
        again[cell[seen[cell]]] = True
        seen[cell] = True

    def stream(key, inside, local, place, ids, lines):
        same = np.zeros(len(key), np.int64)
        if len(key) > 1:
            diff = key[1:] != key[:-1]
            same[1:] = np.where(diff.any(1), diff.argmax(1), GRAM)
        raw = key.tobytes()
        entries = zip(inside.tolist(), ids[local].tolist(), lines[local].tolist(), place.tolist())
        for at, (c, entry) in enumerate(zip(same.tolist(), entries)):
            yield c, raw[at * GRAM:(at + 1) * GRAM], entry

    streams = []
    for _, key, h, (inside, local, place, ids, lines) in runs:
        keep = np.flatnonzero(again[h & low])
        if len(keep):
            streams.append(stream(key[keep], np.frombuffer(inside, np.uint8)[keep], np.frombuffer(local, "<u4")[keep],
                                  np.frombuffer(place, "<u4")[keep], unsteps(ids), unsteps(lines)))
    return streams


FLUSH = 400_000


def _scattered(lines: list[int], numbers: list[int], width: int, keys: list[int]):
    """(slot, blob) rows that take ``width`` numbers each to the partition of their document's row."""
    line = np.array(lines, np.int64)
    number = np.array(numbers, np.uint32).reshape(-1, width)
    slot = line % len(keys)
    order = np.lexsort((line, slot))
    line, number, slot = line[order], number[order], slot[order]
    bounds = np.searchsorted(slot, np.arange(len(keys) + 1))
    some = [(keys[p], pack(steps(line[x:y]), number[x:y].tobytes()))
            for p, (x, y) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())) if y > x]
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in some], pa.int32()),
                                       pa.array([x for _, x in some], pa.binary())], names=["slot", "blob"])


def _gathered(width: int):
    """For one partition's scattered blobs: (line, numbers), one row per document's row."""
    def run(batches):
        parts = [unpack(x) for b in batches for x in b.column(1).to_pylist()]
        if not parts:
            return
        line = np.concatenate([unsteps(p[0]) for p in parts])
        number = np.concatenate([np.frombuffer(p[1], "<u4").reshape(-1, width) for p in parts])
        order = np.argsort(line, kind="stable")
        line, number = line[order], number[order]
        start = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
        ends = [*start[1:].tolist(), len(line)]
        for at in range(0, len(start), 1024):
            yield pa.RecordBatch.from_arrays(
                [pa.array(line[start[at:at + 1024]]),
                 pa.array([number[x:y].tobytes() for x, y in zip(start[at:at + 1024].tolist(), ends[at:at + 1024])],
                          pa.binary())], names=["line", "numbers"])

    return run


def _merged_grams(keys: list[int]):
    """Documents' places of anchors that several documents share, from one partition's runs."""
    def run(batches):
        blobs = []
        for b in batches:
            blobs += b.filter(b.column(2)).column(1).to_pylist()
            settled = b.filter(pc.invert(b.column(2)))  # what a run found by itself goes on as it is
            if settled.num_rows:
                yield settled.select(["slot", "blob"])
        lines, places = [], []
        # of the entries with the present key: the first, those after it while none is of another document
        first, waiting, shared = None, [], False
        for common, _, entry in merge_runs(_gram_streams(blobs)):
            if common < GRAM:
                first, shared = entry, entry[0]
                if waiting:
                    waiting = []
                continue
            done, doc_id, line, place = entry
            if not shared:
                if not done and doc_id == first[1]:
                    waiting.append(entry)
                    continue
                shared = True
                for _, _, line_, place_ in (first, *waiting):
                    lines.append(line_)
                    places.append(place_)
            if not done:
                lines.append(line)
                places.append(place)
                if len(lines) >= FLUSH:
                    yield _scattered(lines, places, 1, keys)
                    lines, places = [], []
        if lines:
            yield _scattered(lines, places, 1, keys)

    return run


# ---------------------------------------------------------------- round two: which windows are repeated

def _unit_run(docs, parts: int):
    """Rows (slot, blob): the sorted units of the documents' shared anchors, equal ones as one with all their places."""
    units: dict[tuple[bytes, int], list[int]] = {}  # places: document << 32 | first window
    number, a, first, last, _, _ = anchors([d[2] for d in docs])
    mark = np.concatenate([np.frombuffer(d[3], "<u4").astype(np.int64) | i << 32 for i, d in enumerate(docs)])
    at = np.flatnonzero(np.isin(a | number << 32, mark))
    for i, x, s, e in zip(number[at].tolist(), a[at].tolist(), first[at].tolist(), last[at].tolist()):
        raw = docs[i][2]
        unit = raw[x:e + MIN_BYTES] + raw[s:x][::-1], x - s
        places = units.get(unit)
        if places is None:
            units[unit] = [i << 32 | s]
        else:
            places.append(i << 32 | s)
    slots: dict[int, list] = {}
    heads = np.frombuffer(b"".join(k[0][:GRAM] for k in units), ">u8").reshape(-1, 2).astype(np.uint64)
    slot = _slot(heads[:, 0], heads[:, 1], parts).tolist()
    for s, unit in zip(slot, units):
        slots.setdefault(s, []).append(unit)
    ids = np.array([d[0] for d in docs], "<i8")
    lines = np.array([d[1] for d in docs], "<i8")
    for s, found in slots.items():
        found.sort()
        same, left = front_code([k for k, _ in found])
        places = [units[u] for u in found]
        flat = np.fromiter(chain.from_iterable(places), np.int64)
        used, local = np.unique(flat >> 32, return_inverse=True)
        yield s, pack(same, left, np.array([len(k) for k, _ in found], "<u1").tobytes(),
                      np.array([b for _, b in found], "<u1").tobytes(),
                      np.array([len(p) for p in places], "<u4").tobytes(), local.astype("<u4").tobytes(),
                      (flat & 0xFFFFFFFF).astype("<u4").tobytes(), steps(ids[used]), steps(lines[used]))


def _unit_stream(blob: bytes):
    same, left, sizes, before, counts, local, place, ids, lines = unpack(blob)
    counts = np.frombuffer(counts, "<u4").tolist()
    local, place = np.frombuffer(local, "<u4"), np.frombuffer(place, "<u4").tolist()
    ids, lines = unsteps(ids)[local].tolist(), unsteps(lines)[local].tolist()
    at, key, o = 0, b"", 0
    for c, n, back, count in zip(same, sizes, before, counts):
        end = at + n - c
        key = key[:c] + left[at:end]
        at = end
        yield c, key, (back, list(zip(ids[o:o + count], lines[o:o + count], place[o:o + count])))
        o += count


def _repeats(units: dict[tuple[bytes, int], list[tuple[int, int, int]]]):
    """(row number, start, end) of windows of these units (all of one anchor) that begin in a smaller document too."""
    least: dict[bytes, int] = {}
    whole = []
    for (key, back), places in units.items():
        cut = len(key) - back
        full = key[cut:][::-1] + key[:cut]
        low = min(places)[0]
        windows = [full[i:i + MIN_BYTES] for i in range(len(full) - MIN_BYTES + 1)]
        whole.append((windows, places))
        for w in windows:
            if least.setdefault(w, low) > low:
                least[w] = low
    for windows, places in whole:
        lows = [least[w] for w in windows]
        lowest, highest = min(lows), max(lows)
        for d, v, s in places:
            if d <= lowest:
                continue
            if d > highest:
                yield v, s, s + len(windows) - 1 + MIN_BYTES
                continue
            start = None
            for i, low in enumerate(lows):
                if low < d:
                    if start is None:
                        start = i
                elif start is not None:
                    yield v, s + start, s + i - 1 + MIN_BYTES
                    start = None
            if start is not None:
                yield v, s + start, s + len(lows) - 1 + MIN_BYTES


def _merged_units(keys: list[int]):
    """Byte ranges to remove from documents, from one partition's runs."""
    def run(batches):
        blobs = [x for b in batches for x in b.column(1).to_pylist()]
        lines, ranges = [], []
        units: dict[tuple[bytes, int], list] = {}

        def settle():
            if len(units) == 1:  # most anchors: all their windows are equal
                ((key, _), places), = units.items()
                low = min(places)[0]
                found = [(v, s, s + len(key)) for d, v, s in places if d > low]
            else:
                found = _repeats(units)
            for line, start, end in found:
                lines.append(line)
                ranges.append(start)
                ranges.append(end)

        for common, key, (back, places) in merge_runs([_unit_stream(b) for b in blobs]):
            if common < GRAM and units:
                settle()
                units = {}
                if len(lines) >= FLUSH:
                    yield _scattered(lines, ranges, 2, keys)
                    lines, ranges = [], []
            unit = units.get((key, back))
            if unit is None:
                units[key, back] = places
            else:
                unit.extend(places)
        if units:
            settle()
        if lines:
            yield _scattered(lines, ranges, 2, keys)

    return run


# ---------------------------------------------------------------- the whole

def _slot_keys(spark: SparkSession, parts: int) -> list[int]:
    """For every partition a number that Spark's hash partitioning deals to it, so that slots spread evenly."""
    keys: dict[int, int] = {}
    start, step = 0, 32 * parts
    while len(keys) < parts:
        for r in (spark.range(start, start + step).select("id", F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts)).alias("p"))
                  .groupBy("p").agg(F.min("id").alias("id")).collect()):
            keys.setdefault(r["p"], r["id"])
        start += step
    return [keys[p] for p in range(parts)]


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes that stay).

    Removes every byte covered by MIN_BYTES bytes that also begin in a document with a smaller
    doc_id, judged on the input as UTF-8 bytes (null: empty); matches never cross documents.
    Rows that share a doc_id don't take from one another, and rows without a doc_id neither
    take nor lose. Texts shorter than MIN_BYTES stay whole. An empty table gives no rows.

    Text moves once, into a table bucketed by row. Runs hold at most RUN_BYTES of text;
    what a run already knows to be shared goes on as one suffix, so an anchor that a third of
    all documents share reaches the merge once per run.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = text_or_empty(text)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("line"),
                       body.alias("text"))
    name = f"repeats_{uuid.uuid4().hex}"
    path = shared_folder(spark, "texts")
    # row numbers are those of this table from here on
    rows.write.option("path", path).option("compression", "zstd").bucketBy(parts, "line").saveAsTable(name)
    stored = spark.table(name)
    keys = _slot_keys(spark, parts)
    known = stored.where("doc_id is not null")

    def first_round(batches):
        for docs_ in _documents(batches):
            blobs, own = _gram_run(docs_, parts)
            for p, blob in blobs:
                yield pa.RecordBatch.from_arrays([pa.array([keys[p]], pa.int32()), pa.array([blob], pa.binary()),
                                                  pa.array([True])], names=["slot", "blob", "open"])
            if own:
                lines = np.concatenate([np.full(len(x), docs_[i][1]) for i, x in own.items()])
                found = _scattered(lines, np.concatenate(list(own.values())), 1, keys)
                yield pa.RecordBatch.from_arrays([*found.columns, pa.array([False] * found.num_rows)],
                                                 names=["slot", "blob", "open"])

    # the table's many small files are read by as few tasks as there are buckets, for longer runs
    found = (known.select("doc_id", "line", "text").coalesce(parts).mapInArrow(first_round, "slot int, blob binary, open boolean")
             .repartition(parts, "slot").mapInArrow(_merged_grams(keys), "slot int, blob binary"))
    shared = found.repartition(parts, "slot").mapInArrow(_gathered(1), "line long, numbers binary")
    shared = written(shared, "anchors")

    def second_round(batches):
        for docs_ in _documents(batches):
            for p, blob in _unit_run(docs_, parts):
                yield pa.RecordBatch.from_arrays([pa.array([keys[p]], pa.int32()), pa.array([blob], pa.binary())],
                                                 names=["slot", "blob"])

    units = (known.join(shared.hint("merge"), "line").select("doc_id", "line", "text", "numbers")
             .mapInArrow(second_round, "slot int, blob binary"))
    spans = (units.repartition(parts, "slot").mapInArrow(_merged_units(keys), "slot int, blob binary")
             .repartition(parts, "slot").mapInArrow(_gathered(2), "line long, numbers binary"))
    spans = written(spans, "spans")

    def cut(batches):
        for b in batches:
            out = []
            for d, raw, spans_ in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                raw = raw.encode("utf-8")
                n = len(raw)
                at, kept, removed, count, end = 0, [], 0, 0, -1
                ranges = np.frombuffer(spans_ or b"", "<u4").reshape(-1, 2)
                for s, e in ranges[np.argsort(ranges[:, 0], kind="stable")].tolist():
                    if s > end:
                        kept.append(raw[at:s])
                        count += 1
                        removed += e - s
                        end = at = e
                    elif e > end:
                        removed += e - end
                        end = at = e
                kept.append(raw[at:])
                whole = b"".join(kept)
                out.append((d, n, removed, count, hashlib.sha256(whole).hexdigest(), whole))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    joined = stored.join(spans.hint("merge"), "line", "left").select("doc_id", "text", "numbers")
    return joined.mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
