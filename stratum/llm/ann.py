"""Approximate nearest neighbours on robust-pruned directed graphs, one graph per shard."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import table, written

#: distinct vectors in a shard, queries in a block
SHARD, BLOCK = 4096, 2048
#: edges kept per node, beam widths for building and searching, relaxation of the pruning rule
DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA = 24, 48, 80, 1.2
#: nodes that a greedy search opens per step; searches that run side by side
OPEN, LANES = 4, 256
ENTRIES = 8


def _entries(n: int, middle: int) -> np.ndarray:
    """Where searches begin: the node nearest to the mean, and some spread over the shard."""
    return np.unique(np.r_[middle, np.linspace(0, n - 1, min(n, ENTRIES)).astype(np.int64)])


def beam_search(x: np.ndarray, edges: np.ndarray, entries: np.ndarray, queries: np.ndarray,
                beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, squared distances) of the ``beam`` nearest nodes that a greedy search finds per query.

    Ids are nearest first, -1 where there are fewer. ``edges``: neighbours per node, -1 where
    there is none. All queries walk together: each step opens the nearest unopened nodes of
    every beam, until no beam has one.
    """
    lanes, n = len(queries), len(x)
    seen = np.zeros((lanes, n + 1), dtype=bool)
    seen[:, n] = True
    rows = np.arange(lanes)[:, None]
    ids = np.broadcast_to(entries, (lanes, len(entries)))
    seen[rows, ids] = True
    dist = _squared(x[ids], queries)
    ids = np.concatenate((ids, np.full((lanes, beam), n)), 1)
    dist = np.concatenate((dist, np.full((lanes, beam), np.inf, dist.dtype)), 1)
    order = np.argsort(dist, 1, kind="stable")[:, :beam]
    ids, dist = ids[rows, order], dist[rows, order]
    opened = np.zeros(ids.shape, dtype=bool)
    padded = np.vstack((edges, np.full((1, edges.shape[1]), -1, edges.dtype)))
    while True:
        fresh = np.where(opened | (ids == n), np.inf, dist)
        if not np.isfinite(fresh).any():
            break
        pick = np.argpartition(fresh, OPEN - 1, 1)[:, :OPEN] if beam > OPEN else np.argsort(fresh, 1)
        nodes = np.where(np.isfinite(fresh[rows, pick]), ids[rows, pick], n)
        opened[rows, pick] = True
        near = padded[nodes].reshape(lanes, -1)
        near = np.where(near < 0, n, near)
        # a neighbour counts once per search
        near = np.sort(near, 1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        near[seen[rows, near]] = n
        seen[rows, near] = True
        live = near < n
        width = int(live.sum(1).max())
        if not width:
            continue
        near = np.sort(near, 1)[:, :width]
        live = near < n
        far = np.where(live, _squared(x[np.minimum(near, n - 1)], queries), np.inf)
        ids = np.concatenate((ids, near), 1)
        dist = np.concatenate((dist, far), 1)
        opened = np.concatenate((opened, np.zeros(near.shape, dtype=bool)), 1)
        order = np.argsort(dist, 1, kind="stable")[:, :beam]
        ids, dist, opened = ids[rows, order], dist[rows, order], opened[rows, order]
    return np.where(ids == n, -1, ids), dist


def _squared(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = x - q[:, None, :]
    return np.einsum("bcd,bcd->bc", d, d)


def robust_prune(x: np.ndarray, nodes: np.ndarray, cand: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """At most ``degree`` of each node's candidates: the nearest, without those that a kept one is nearer to.

    A candidate c goes when a kept neighbour k has alpha * |k - c| <= |node - c|, so edges
    point in diverse directions. ``cand``: ids per node, -1 for none; repeats and the node
    itself don't count.
    """
    cand = np.sort(cand, 1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
    cand[cand == nodes[:, None]] = -1
    points = x[np.maximum(cand, 0)]
    dist = np.where(cand >= 0, _squared(points, x[nodes]), np.inf)
    order = np.argsort(dist, 1, kind="stable")
    rows = np.arange(len(nodes))[:, None]
    cand, dist, points = cand[rows, order], dist[rows, order], points[rows, order]
    norm = np.einsum("bcd,bcd->bc", points, points)
    between = norm[:, :, None] + norm[:, None, :] - 2 * np.matmul(points, points.transpose(0, 2, 1))
    alive = np.isfinite(dist)
    out = np.full((len(nodes), degree), -1, np.int32)
    line = np.arange(len(nodes))
    for k in range(degree):
        some = alive.any(1)
        if not some.any():
            break
        first = alive.argmax(1)
        out[some, k] = cand[line, first][some]
        near = alpha * alpha * between[line, first] <= dist
        alive &= ~near
        alive[line, first] = False
    return out


def build_graph(x: np.ndarray, seed: int = 0) -> tuple[np.ndarray, int]:
    """(edges, middle): a directed graph over the rows of ``x`` (distinct vectors) with DEGREE edges each.

    Nodes enter in batches that grow with the graph. The greedy search for a node proposes its
    neighbours, pruning keeps diverse ones, and edges back are added, pruned anew where a node
    has too many. A second pass over all nodes prunes with the relaxed rule.
    """
    n = len(x)
    middle = int(np.argmin(((x - x.mean(0)) ** 2).sum(1)))
    edges = np.full((n, DEGREE), -1, np.int32)
    turn = np.random.default_rng(seed).permutation(n)
    turn = np.r_[middle, turn[turn != middle]]

    def insert(nodes: np.ndarray, entries: np.ndarray, alpha: float) -> None:
        ids, _ = beam_search(x, edges, entries, x[nodes], BUILD_BEAM)
        edges[nodes] = robust_prune(x, nodes, np.concatenate((ids, edges[nodes]), 1).astype(np.int64), alpha, DEGREE)
        source = np.repeat(nodes, DEGREE)
        target = edges[nodes].ravel()
        source, target = source[target >= 0], target[target >= 0]
        known = (edges[target] == source[:, None]).any(1)
        source, target = source[~known], target[~known]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        # edges back, as many at a time as one prune looks at
        while len(target):
            start = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
            rank = np.arange(len(target)) - np.repeat(start, np.diff(np.r_[start, len(target)]))
            now = rank < DEGREE
            heads = target[start]
            extra = np.full((len(heads), DEGREE), -1, np.int64)
            extra[np.searchsorted(heads, target[now]), rank[now]] = source[now]
            free = (edges[heads] < 0).sum(1) >= (extra >= 0).sum(1)
            for at in range(0, len(heads), LANES):
                part = slice(at, at + LANES)
                both = np.concatenate((edges[heads[part]].astype(np.int64), extra[part]), 1)
                full = robust_prune(x, heads[part], both.copy(), alpha, DEGREE)
                room = -np.sort(-both, 1)[:, :DEGREE]
                edges[heads[part]] = np.where(free[part][:, None], room, full)
            source, target = source[~now], target[~now]

    at = 1
    while at < n:
        size = min(max(16, at // 2), LANES, n - at)
        insert(turn[at:at + size], np.array([middle]), 1.0)
        at += size
    entries = _entries(n, middle)
    for at in range(0, n, LANES):
        insert(turn[at:at + LANES], entries, ALPHA)
    return edges, middle


def _vectors(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(rep, ids, vec, dim): each vector once, with its ``k`` + 1 smallest ids and the rows of each; rep is the smallest.

    More ids of one vector can't be among a query's ``k`` nearest, since ties go to the smaller id
    and only one of the ids is the query's own.
    """
    w = Window.partitionBy("vec").orderBy("id")
    first = (rows.groupBy("vec", "id").agg(F.count(F.lit(1)).alias("same"))
             .withColumn("k", F.row_number().over(w)).where(F.col("k") <= k + 1))
    return (first.groupBy("vec").agg(F.array_sort(F.collect_list(F.struct("id", "same"))).alias("ids"))
            .select(F.col("ids")[0]["id"].alias("rep"), "ids", "vec", F.size("vec").alias("dim")))


def usable(rows: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, vec): rows with an id whose vector is not null, empty or zero and has only finite components."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (rows.select(F.col(id_column).cast("long").alias("id"), v.alias("vec"))
            .where(F.col("id").isNotNull() & F.col("vec").isNotNull())
            .where(fine & F.exists("vec", lambda c: c != 0)))


def build_index(vectors: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per shard: its vectors, their reps and its graph, written to the shared folder.

    Vectors are dealt by a hash of their rep, so shards are of even size (about ``shard``) and
    every distinct vector is a node of one graph; only vectors of one length share a shard.
    """
    n = vectors.count()
    shards = max(1, math.ceil(n / shard))
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("rep"), F.lit(shards)).cast("int"))

    def graph(t: pa.Table) -> pa.Table:
        t = t.sort_by("rep")
        x = _vectors(t.column("vec"), t.num_rows)
        edges, middle = build_graph(x.astype(np.float32))
        return pa.table({"dim": t.column("dim").slice(0, 1), "shard": t.column("shard").slice(0, 1),
                         "middle": pa.array([middle], pa.int32()),
                         "reps": pa.array([t.column("rep").to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "vectors": pa.array([x.astype("<f8").tobytes()], pa.binary()),
                         "edges": pa.array([edges.astype("<i4").tobytes()], pa.binary())})

    index = dealt.select("dim", "shard", "rep", "vec").groupBy("dim", "shard").applyInArrow(
        graph, "dim int, shard int, middle int, reps binary, vectors binary, edges binary")
    return written(index, "graph-index")


def search(index: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH_BEAM) -> DataFrame:
    """(query, rep, score): the ``k`` nearest indexed vectors found for each query (rep, vec, dim).

    Queries go in blocks of about BLOCK to every shard of their length; each (shard, block)
    pair is one row of work, whose beam search proposes candidates that are then measured in
    double precision on the original vectors.
    """
    blocks = max(1, math.ceil(queries.count() / BLOCK))
    packed = (queries.withColumn("block", F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int"))
              .groupBy("dim", "block").agg(F.collect_list(F.struct("rep", "vec")).alias("queries")))
    shards = index.groupBy("dim").agg(F.max("shard").alias("last"))
    work = (packed.join(shards, "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), "last"))).drop("last")
            .join(index, ["dim", "shard"]).select("dim", "middle", "reps", "vectors", "edges", "queries"))

    def walk(batches):
        for b in batches:
            for i in range(b.num_rows):
                dim, middle, reps, vectors, edges = (b.column(c)[i].as_py() for c in range(5))
                asked = b.column(5)[i].values
                names = asked.field(0).to_numpy()
                q = asked.field(1).flatten().to_numpy().reshape(-1, dim)
                x = np.frombuffer(vectors, "<f8").reshape(-1, dim)
                reps = np.frombuffer(reps, "<i8")
                edges = np.frombuffer(edges, "<i4").reshape(len(x), -1)
                small = x.astype(np.float32)
                for at in range(0, len(q), LANES):
                    part = q[at:at + LANES]
                    ids, _ = beam_search(small, edges, _entries(len(x), middle), part.astype(np.float32), beam)
                    exact = np.where(ids >= 0, np.sqrt(_squared(x[np.maximum(ids, 0)], part)), np.inf)
                    found = np.where(ids >= 0, reps[np.maximum(ids, 0)], np.iinfo(np.int64).max)
                    order = np.lexsort((found, exact), axis=1)[:, :k]
                    rows = np.arange(len(part))[:, None]
                    exact, found = exact[rows, order], found[rows, order]
                    fine = np.isfinite(exact)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.broadcast_to(names[at:at + LANES, None], fine.shape)[fine]),
                         pa.array(found[fine]), pa.array(exact[fine])], names=["query", "rep", "score"])

    hits = work.mapInArrow(walk, "query long, rep long, score double")
    best = Window.partitionBy("query").orderBy("score", "rep")
    return hits.withColumn("k", F.row_number().over(best)).where(F.col("k") <= k).drop("k")


def nearest(rows: DataFrame, asked, k: int = 10, id_column: str = "vec_id", vector: str = "embedding",
            shard: int = SHARD, beam: int = SEARCH_BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each row that ``asked`` selects.

    ``asked`` is a condition on ``id``. A row's own id is no candidate; nearness is Euclidean,
    ties go to the smaller id. Rows without an id, and vectors null, empty, zero or with null
    or non-finite components take no part; vectors only meet vectors of their length. Equal
    vectors are one node with their smallest ids, so a vector that a third of all rows have
    costs one node. Rows that repeat an id count each as neighbours, and a repeated row that is asked for
    is answered once, without any of its own; with too few rows there are fewer ranks.
    """
    fine = written(usable(rows, id_column, vector), "vectors")
    vectors = written(distinct_vectors(fine, k), "distinct-vectors")
    index = build_index(vectors, shard)
    asking = written(fine.where(asked).join(vectors.select("vec", "rep"), "vec").select("id", "rep"), "queries")
    queries = vectors.join(asking.select("rep").distinct(), "rep", "left_semi").select("rep", "vec", "dim")
    hits = search(index, queries, k + 1, beam)
    named = hits.join(vectors.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("x")).select(
        "query", "score", F.col("x.id").alias("vec_id"), F.least("x.same", F.lit(k)).cast("int").alias("same"))
    # of one query vector only its k + 1 first ids can be in the answer of any row that has it
    named = named.withColumn("first", F.min("score").over(Window.partitionBy("query", "vec_id")))
    w = Window.partitionBy("query").orderBy("first", "vec_id")
    named = named.withColumn("n", F.dense_rank().over(w)).where(F.col("n") <= k + 1).drop("n", "first")
    rank = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (asking.select(F.col("id").alias("query_id"), F.col("rep").alias("query")).distinct()
            .join(named, "query").where("vec_id != query_id")
            .withColumn("same", F.explode(F.array_repeat(F.lit(1), F.col("same"))))
            .withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)
