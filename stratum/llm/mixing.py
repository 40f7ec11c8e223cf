"""Mixing sources to target weights: min-cost flow over membership patterns, then seeded documents."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stratum.llm.common import free_names, table, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEATS = 2
SEED = 17
#: documents of a pattern are dealt into so many bins by a seeded hash
BINS = 1 << 16
#: the flow is solved on the driver over one row per membership pattern; more than this many is an error
MAX_PATTERNS = 100_000


def with_size(docs: DataFrame, text: str, size: str) -> DataFrame:
    """``docs`` with the number of words (runs between ASCII white space) of the whole text; null: 0."""
    place = docs.columns.index(text)
    names = [*docs.columns, size]

    def run(batches):
        for b in batches:
            counts = [len((t.as_py() or "").encode("utf-8").split()) for t in b.column(place)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(counts, pa.int64())], names=names)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(size, LongType())]))


def source_targets(sizes: dict[str | None, int], weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   cap: float = MAX_REPEATS) -> dict[str | None, float]:
    """Words that each source should give: ``share`` of all words by weight, at most ``cap`` times its size.

    Sources in code point order, null last, take the weights in turn. What a target exceeds its
    cap by is shared anew among the others by weight until none is above.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    total = share * sum(sizes.values())
    target: dict[str | None, float] = {}
    open_ = list(order)
    while open_:
        left = total - sum(target.values())
        among = sum(weight[s] for s in open_)
        over = [s for s in open_ if among > 0 and left * weight[s] / among >= cap * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / among if among else 0.0 for s in open_}
        target |= {s: float(cap * sizes[s]) for s in over}
        open_ = [s for s in open_ if s not in target]
    return target


def route(capacity: list[tuple[tuple, float]], targets: dict, repeats: int = MAX_REPEATS) -> list[dict]:
    """Tokens that each pattern sends to each of its sources: a min-cost flow.

    ``capacity``: (sources of the pattern, its tokens). One copy of a pattern's tokens costs
    nothing, every further copy one more per token than the copy before (a convex cost), up to
    ``repeats`` copies; a source takes its target at most. Successive cheapest paths with
    potentials; paths that cost the same are taken in the order of the nodes.
    """
    names = list(targets)
    place = {s: i for i, s in enumerate(names)}
    n_p, n_s = len(capacity), len(names)
    start, end = n_p + n_s, n_p + n_s + 1
    head: list[list[int]] = [[] for _ in range(n_p + n_s + 2)]
    to: list[int] = []
    room: list[float] = []
    cost: list[int] = []

    def arc(u, v, c, w):
        head[u].append(len(to)); to.append(v); room.append(c); cost.append(w)
        head[v].append(len(to)); to.append(u); room.append(0.0); cost.append(-w)

    flow_arcs: list[dict] = []
    for p, (sources, tokens) in enumerate(capacity):
        for copy in range(repeats):
            arc(start, p, float(tokens), copy)
        flow_arcs.append({})
        for s in sources:
            flow_arcs[p][s] = len(to)
            arc(p, n_p + place[s], float("inf"), 0)
    for s in names:
        arc(n_p + place[s], end, float(targets[s]), 0)

    tiny = 1e-9 * max(1.0, sum(targets.values()))
    potential = [0] * len(head)
    while True:
        best: list[float] = [float("inf")] * len(head)
        via = [-1] * len(head)
        best[start] = 0
        queue: list[tuple[float, int]] = [(0, start)]
        while queue:
            d, u = heapq.heappop(queue)
            if d > best[u]:
                continue
            for a in head[u]:
                if room[a] > tiny:
                    v = to[a]
                    nd = d + cost[a] + potential[u] - potential[v]
                    if nd < best[v]:
                        best[v], via[v] = nd, a
                        heapq.heappush(queue, (nd, v))
        if best[end] == float("inf"):
            break
        far = best[end]
        potential = [p + (int(min(b, far)) if b < float("inf") else int(far)) for p, b in zip(potential, best)]
        # all cheapest paths are saturated by depth-first walks over arcs without reduced cost
        at = [0] * len(head)
        while True:
            path, u, seen = [], start, {start}
            while u != end:
                step = None
                while at[u] < len(head[u]):
                    a = head[u][at[u]]
                    if room[a] > tiny and to[a] not in seen and cost[a] + potential[u] - potential[to[a]] == 0:
                        step = a
                        break
                    at[u] += 1
                if step is None:
                    if not path:
                        break
                    u = to[path.pop() ^ 1]
                    seen = {start} | {to[x] for x in path}
                    at[u] += 1
                else:
                    path.append(step)
                    u = to[step]
                    seen.add(u)
            if u != end:
                break
            amount = min(room[a] for a in path)
            for a in path:
                room[a] -= amount
                room[a ^ 1] += amount
    return [{s: room[a ^ 1] for s, a in arcs.items()} for arcs in flow_arcs]


def membership(sources: str, kind: str):
    """(the sources of a document, sorted and distinct; the same as text)."""
    nowhere = F.array(F.lit(None).cast("string"))
    members = F.array(F.col(sources))
    if kind.startswith("array"):
        listed = F.array_sort(F.array_distinct(F.col(sources)))
        members = F.when(F.size(listed) > 0, listed).otherwise(nowhere)
    members = F.coalesce(members, nowhere)
    # one text key per pattern: json keeps null apart from the string "null"
    return members, F.to_json(F.transform(members, lambda x: F.struct(x.alias("s"))))


def identity(doc_id: str, text: str):
    """What a document is known by: its id, or the digest of its text where it has none."""
    return F.coalesce(F.concat(F.lit("i"), F.col(doc_id).cast("string")),
                      F.concat(F.lit("t"), F.md5(F.coalesce(F.col(text), F.lit("")))))


def mix(docs: DataFrame, targets=None, sources: str = "source", text: str = "text", doc_id: str = "doc_id",
        repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken.

    ``sources`` is a string column, or an array of the sources that a document belongs to.
    Documents are grouped by their membership pattern (sorted, distinct); one row per pattern
    goes to the driver, where the flow gives every pattern the words it shall yield. A pattern
    with a yield of r times its words gives every document floor(r) copies and one more to the
    documents that come first by a seeded hash, until the yield is reached: bins of the hash
    are summed and accumulated, and only the bin in which the yield is reached is walked
    document by document; what is then left goes to the one other document whose size is
    nearest. Reruns agree, and no pattern is ever sorted as a whole.

    ``targets``: words by source, or None for ``source_targets``. Size is the words of the
    text (null: 0); documents of no words are never taken. A null source is a source of its
    own, as is a null or empty array of them. Documents are told apart by ``who``: the doc_id,
    or the digest of the text where there is none; rows that share it share a hash, and each
    is taken or left by itself. ``source_size`` and ``target`` are those of the pattern's
    sources together. Whole texts of any length are counted, other columns are ignored
    whatever their names, and an empty table gives no rows.
    """
    kind = dict(docs.dtypes)[sources]
    members, pattern = membership(sources, kind)
    who = identity(doc_id, text)
    dealt = F.md5(F.concat_ws(":", F.lit(str(seed)), who))
    sized = with_size(docs.select(F.col(doc_id).alias("doc_id"), who.alias("who"), members.alias("members"),
                                  pattern.alias("pattern"), dealt.alias("hash"), F.col(text).alias("text")),
                      "text", "size").drop("text")
    # the number of a row is written with it, so that one row alone can be meant later on
    sized = written(sized.withColumn("bin", F.conv(F.substring("hash", 1, 4), 16, 10).cast("int"))
                    .withColumn("row", F.monotonically_increasing_id()), "sizes")
    found = (sized.groupBy("pattern").agg(F.first("members").alias("members"), F.sum("size").alias("tokens"))
             .limit(MAX_PATTERNS + 1).collect())
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    found.sort(key=lambda r: r["pattern"])
    whole: dict[str | None, int] = {}
    for r in found:
        for s in r["members"]:
            whole[s] = whole.get(s, 0) + r["tokens"]
    goal = source_targets(whole, cap=repeats) if targets is None else {s: float(targets.get(s, 0.0)) for s in whole}
    flows = route([(tuple(r["members"]), r["tokens"]) for r in found], goal, repeats)
    spark = docs.sparkSession
    plan = []
    for r, flow in zip(found, flows):
        out = sum(flow.values())
        base = min(int(out // r["tokens"]), repeats) if r["tokens"] else 0
        plan.append((r["pattern"], sum(whole[s] for s in r["members"]), sum(goal[s] for s in r["members"]),
                     base, out - base * r["tokens"]))
    yields = spark.createDataFrame(plan, "pattern string, source_size long, target double, base int, extra double")

    bins = sized.groupBy("pattern", "bin").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("pattern").orderBy("bin")) - F.col("words")
    bins = bins.select("pattern", "bin", "words", before.alias("before")).join(yields, "pattern")
    open_words = F.col("extra") - F.col("before")
    bins = bins.select("pattern", "bin", "source_size", "target", "base", open_words.alias("left"),
                       (F.col("words") <= open_words).alias("all_in"), (open_words > 0).alias("some"))
    rows = sized.join(bins, ["pattern", "bin"])
    sure = rows.where("all_in or not some").withColumn("plus", F.when(F.col("all_in"), 1).otherwise(0))
    walk = F.sum("size").over(Window.partitionBy("pattern", "bin").orderBy("hash", "who", "size", "row")
                              .rowsBetween(Window.unboundedPreceding, -1))
    edge = (rows.where("not all_in and some").withColumn("ahead", F.coalesce(walk, F.lit(0)))
            .withColumn("plus", F.when(F.col("ahead") + F.col("size") <= F.col("left"), 1).otherwise(0)).drop("ahead"))
    chosen = written(sure.unionByName(edge).select("doc_id", "who", "row", "pattern", "size", "hash", "plus"), "chosen")
    # what is left of the yield goes to the one document, not yet chosen, that fits it best
    gaps = (chosen.groupBy("pattern").agg(F.sum(F.col("size") * F.col("plus")).alias("got"))
            .join(yields, "pattern").select("pattern", "source_size", "target", "base", (F.col("extra") - F.col("got")).alias("gap")))
    rows = chosen.join(gaps, "pattern")
    miss = F.abs(F.col("size") - F.col("gap"))
    last = (rows.where((F.col("plus") == 0) & (F.col("size") > 0) & (F.col("base") < repeats) & (miss < F.col("gap")))
            .groupBy("pattern").agg(F.min(F.struct(miss.alias("miss"), "hash", "who", "size", "row")).alias("best"))
            .select("pattern", F.col("best.row").alias("last_row")))
    rows = rows.join(last, "pattern", "left")
    plus = F.when(F.col("row") == F.col("last_row"), 1).otherwise(F.col("plus"))
    copies = F.when(F.col("size") > 0, F.least(F.col("base") + plus, F.lit(repeats))).otherwise(0).cast("int")
    return (rows.withColumn("copies", copies)
            .select("doc_id", "who", "pattern", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix: every document as often as it is taken, with the columns of ``docs``.

    Rows of one pattern that share ``who`` and size can stand in for one another: together they
    come as often as ``mix`` takes them, dealt evenly, so that the words of the rows handed on
    are those that the mix counts, of every pattern.
    """
    source, text, doc_id = options.get("sources", "source"), options.get("text", "text"), options.get("doc_id", "doc_id")
    size, who, pattern, taken, rows_, copy = free_names(docs, "size", "who", "pattern", "taken", "rows", "copy")
    marks = (mix(docs, **options).groupBy(F.col("pattern").alias("p"), F.col("who").alias("w"), F.col("size").alias("s"))
             .agg(F.sum("copies").alias(taken), F.count(F.lit(1)).alias(rows_)).where(F.col(taken) > 0))
    marks = written(marks, "mix")
    rows = with_size(docs, text, size).withColumn(who, identity(doc_id, text)).withColumn(
        pattern, membership(source, dict(docs.dtypes)[source])[1])
    rest = F.col(taken) % F.col(rows_)

    def joined(marks):
        p, w, s = free_names(rows, "p", "w", "s")
        marks = marks.withColumnsRenamed({"p": p, "w": w, "s": s})
        return rows.join(marks.hint("merge"), (rows[pattern] == F.col(p)) & (rows[who] == F.col(w))
                         & (rows[size] == F.col(s)))

    def repeated(df, times):
        return df.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), times))).select(*docs.columns)

    each = F.floor(F.col(taken) / F.col(rows_)).cast("long")
    even = repeated(joined(marks.where(rest == 0)), each)
    # one more for the first of the rows that stand in for one another
    number = F.row_number().over(Window.partitionBy(pattern, who, size).orderBy(who))
    odd = joined(marks.where(rest > 0)).withColumn(copy, F.when(number <= rest, each + 1).otherwise(each))
    return even.unionByName(repeated(odd.where(F.col(copy) > 0), F.col(copy)))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")
