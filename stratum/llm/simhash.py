"""SimHash near-dedup by deletion-variant signatures."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import free_names, table, written
from stratum.llm.components import components

SEED = 42
#: shingles hashed at a time (bounds the bit matrix of a very long text)
CHUNK = 1 << 16
#: members of a bucket compared in one block; larger buckets are cut into pairs of blocks
BLOCK = 2048


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of the word shingles, repeats counted; no words: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
        total = 1
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        total = len(words) - shingle + 1
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, total, CHUNK):
        n = min(CHUNK, total - start)
        h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED, n)) if total > CHUNK else
                        map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype="<u8", count=n)
        counts += np.unpackbits(h.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, text: str = "text", doc_id: str = "doc_id",
                 row: str | None = None) -> DataFrame:
    """(doc_id, fp), with a ``row`` between them where a column of row numbers is named; fp is a signed long."""
    ids = {"doc_id": F.col(doc_id).cast("long")} | ({"row": F.col(row)} if row else {})
    schema = pa.schema([(c, pa.int64()) for c in (*ids, "fp")])

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.columns[-1]], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps.view(np.int64))], schema=schema)

    return docs.select(*[c.alias(n) for n, c in ids.items()], F.col(text).alias("text")).mapInArrow(
        run, ", ".join(f"{n} long" for n in schema.names))


def segments(distance: int) -> list[tuple[int, int]]:
    """(shift, width) of the segments: so few that one of them differs by at most one bit."""
    n = distance // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def signatures(fps: DataFrame, distance: int) -> DataFrame:
    """(sig, fp): for every segment its exact value and its variants with one bit deleted.

    A signature is (place, left): the segment's number with the place of the deleted bit (or
    none), and the bits left. Two fingerprints within ``distance`` bits agree on a segment, or
    on all of it but one bit, and so share a signature.
    """
    out = []
    for number, (shift, width) in enumerate(segments(distance)):
        part = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
        for place in range(-1, width):
            left = part if place < 0 else part.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << place)))
            out.append(F.struct(F.lit(number * 128 + place + 1).cast("short").alias("place"), left.alias("left")))
    return fps.select("fp", F.explode(F.array(*out)).alias("sig")).select("sig.place", "sig.left", "fp")


def forest(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of n nodes over the links u-v."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[u], root[v])
        before = root.copy()
        np.minimum.at(root, root[u], low)
        np.minimum.at(root, root[v], low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        if (before == root).all():
            return root


def _links(group: np.ndarray, side: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links (fp, fp) joining what is linked within each group; rows are sorted by group.

    ``side``: 0 compares with all, 1 and 2 are the two blocks of a cut bucket, compared across.
    """
    n = len(fp)
    ends = np.r_[np.flatnonzero(group[1:] != group[:-1]) + 1, n]
    starts = np.r_[0, ends[:-1]]
    left = np.repeat(ends, ends - starts) - np.arange(n) - 1  # members of the group after this row
    us, vs = [], []
    rows = np.arange(n)
    step = 1
    while len(rows := rows[left[rows] >= step]):
        other = rows + step
        near = np.bitwise_count(fp[rows] ^ fp[other]) <= distance
        near &= (side[rows] == 0) | (side[rows] != side[other])
        us.append(rows[near])
        vs.append(other[near])
        step += 1
    if not us:
        return fp[:0], fp[:0]
    root = forest(np.concatenate(us), np.concatenate(vs), n)
    linked = np.flatnonzero(root != np.arange(n))
    return fp[linked], fp[root[linked]]


def in_groups(batches, key: list[str], work):
    """``work(table, group numbers)`` over batches sorted by ``key``, never cutting a group in two."""
    held: list[pa.RecordBatch] = []

    def numbered(t):
        change = np.zeros(t.num_rows, dtype=bool)
        for c in key:
            x = t.column(c).to_numpy()
            change[1:] |= x[1:] != x[:-1]
        return np.cumsum(change)

    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        t = pa.Table.from_batches(held)
        group = numbered(t)
        cut = int(np.searchsorted(group, group[-1]))  # where the last, perhaps unfinished, group begins
        if cut:
            yield work(t.slice(0, cut), group[:cut])
            held = t.slice(cut).combine_chunks().to_batches()
    if held:
        t = pa.Table.from_batches(held)
        yield work(t, numbered(t))


def near_edges(fps: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to connect all that lie within ``distance``.

    Signatures are joined by equality: those that several fingerprints share are found by a
    count that is combined before the shuffle. A bucket of more than BLOCK members is dealt,
    by a hash of the fingerprint, into blocks, and every pair of blocks is one task's unit, so
    no unit holds more than two blocks. Inside a unit all members are compared; only a spanning
    forest of the links leaves it, at most one row per member.
    """
    sigs = signatures(fps, distance)
    shared = sigs.groupBy("place", "left").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    rows = sigs.join(shared, ["place", "left"])
    parts = F.ceil(F.col("members") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("fp"), parts).cast("int")
    partners = F.when(parts == 1, F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), parts - 1))
    units = (rows.select("place", "left", "fp", mine.alias("mine"), F.explode(partners).alias("other"))
             .select("place", "left", "fp",
                     F.when(F.col("other") < 0, F.lit(0)).otherwise(F.least("mine", "other")).alias("low"),
                     F.when(F.col("other") < 0, F.lit(0)).otherwise(F.greatest("mine", "other")).alias("high"),
                     F.when((F.col("other") < 0) | (F.col("mine") == F.col("other")), 0)
                     .when(F.col("mine") < F.col("other"), 1).otherwise(2).cast("byte").alias("side")))
    key = ["place", "left", "low", "high"]

    def work(t, group):
        a, b = _links(group, t.column("side").to_numpy(), t.column("fp").to_numpy().view(np.uint64), distance)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def run(batches):
        return in_groups(batches, key, work)

    return units.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "a long, b long").distinct()


def component_roots(rows: DataFrame, distance: int, first) -> DataFrame:
    """(fp, first, root) for every distinct fingerprint of ``rows``: the least ``first`` of its rows,
    and the fingerprint that names its component. Copies share one fingerprint and are combined
    before the shuffle, so only distinct fingerprints are compared."""
    prints = written(rows.groupBy("fp").agg(F.min(first).alias("first")), "fingerprint-ids")
    comp = components(near_edges(prints.select("fp"), distance))
    return prints.join(comp, prints["fp"] == comp["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3,
                    text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Words are the runs between ASCII white space, A-Z in lower case; fewer words than
    ``shingle`` make one shingle, none (a null or blank text) the fingerprint zero, which links
    like any other. Very long texts are read whole, CHUNK shingles at a time. Two fingerprints
    link at ``distance`` or fewer differing bits; ``component_id`` is the smallest doc_id
    reachable over links. Rows with a null doc_id take part and get their component's smallest
    id (null where it has none). Repeated rows each have a row of the result. Other columns are
    not looked at. An empty table gives no rows.
    """
    rows = written(fingerprints(docs, shingle, text, doc_id), "fingerprints")
    roots = component_roots(rows, distance, F.col("doc_id"))
    ids = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    label = written(roots.join(ids, "root").select("fp", "component_id"), "fingerprint-components")
    return rows.join(label, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """Rows of ``docs`` that stay: one of every component of ``near_duplicates``, all columns as they were.

    It is the row with the smallest doc_id; one without a doc_id stays only where its component
    has none with one. Rows are told apart by a number of their own: unlike texts under one
    doc_id (or none) are judged each by its component, and of repeated rows one stays. A user's
    columns may have any names. An empty table gives no rows.
    """
    key, = free_names(docs, "row_number")
    rows = written(docs.withColumn(key, F.monotonically_increasing_id()), "near-rows")
    prints = written(fingerprints(rows, shingle, row=key), "fingerprints")
    roots = component_roots(prints, distance, F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    best = roots.groupBy("root").agg(F.min("first").alias("first"))
    keep = written(best.select(F.col("first.row").alias(key)), "near-kept")
    return rows.join(keep.hint("merge"), key, "left_semi").select(*docs.columns)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)
