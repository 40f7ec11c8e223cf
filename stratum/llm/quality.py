"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader."""

from __future__ import annotations

from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import table, written

#: weights are hashed into so many slots
SLOTS = 1 << 18
#: at most so many labelled rows are fitted (those that come first by a seeded hash of their doc_id)
MAX_SAMPLE = 12_000
PASSES = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 1e-4
CHUNK = 1 << 16


def _chunks(text: str | None):
    """Slot numbers of the words and word pairs of the whole text, some thousand words at a time."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    last = None
    for at in range(0, len(words), CHUNK):
        part = words[at:at + CHUNK]
        h = np.fromiter(map(crc32, part), dtype=np.uint64, count=len(part))
        before = np.concatenate(([last], h[:-1])).astype(np.uint64) if last is not None else h[:-1]
        after = h if last is not None else h[1:]
        pair = (before * np.uint64(0x9E3779B97F4A7C15) + after) * np.uint64(0xC2B2AE3D27D4EB4F)
        yield (h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(46)).astype(np.int32), \
            (pair >> np.uint64(46)).astype(np.int32)
        last = h[-1]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(slots, values): n-gram counts, dampened by their square root and scaled to length one."""
    parts = [x for pair in _chunks(text) for x in pair]
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0)
    slots, counts = np.unique(np.concatenate(parts), return_counts=True)
    values = np.sqrt(counts)
    return slots, values / np.sqrt(counts.sum())


class Ftrl:
    """Per-coordinate follow-the-regularised-leader for logistic loss; slot ``SLOTS`` is the constant."""

    def __init__(self):
        self.z = np.zeros(SLOTS + 1)
        self.n = np.zeros(SLOTS + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, slots: np.ndarray, values: np.ndarray, label: float, importance: float) -> None:
        at = np.append(slots, SLOTS)
        x = np.append(values, 1.0)
        w = self.weights(at)
        g = (_sigmoid(float(w @ x)) - label) * importance * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _sigmoid(v: float) -> float:
    return 1.0 / (1.0 + np.exp(-min(max(v, -30.0), 30.0)))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_sample: int = MAX_SAMPLE) -> np.ndarray:
    """Weights fitted on at most ``max_sample`` labelled rows of ``docs``.

    ``labels`` (doc_id, label): rows without a doc_id or label are left out, of repeated rows
    for a doc_id the larger label counts. Which rows are fitted, and in which order, follows a
    seeded hash of the doc_id, so reruns agree. The rows are hashed where they lie; one task
    fits the bounded sample and hands back only the weights (SLOTS + 1 numbers at most). The
    rarer class weighs more, so that both weigh the same together. Without any labelled row
    all weights are zero.
    """
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
              .groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
              .withColumn("turn", F.xxhash64(F.lit(8).cast("int"), "doc_id"))
              .orderBy("turn", "doc_id").limit(max_sample))
    chosen = written(chosen, "sample")
    picked = docs.select(F.col("doc_id"), F.col("text")).join(F.broadcast(chosen), "doc_id")

    def hashed(batches):
        for b in batches:
            rows = [features(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("turn"), b.column("label"),
                 pa.array([r[0].astype("<i4").tobytes() for r in rows], pa.binary()),
                 pa.array([r[1].astype("<f8").tobytes() for r in rows], pa.binary())],
                names=["doc_id", "turn", "label", "slots", "x"])

    sample = picked.mapInArrow(hashed, "doc_id long, turn long, label double, slots binary, x binary")

    def fit(batches):
        rows = [r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(1, 5)))]
        model = Ftrl()
        good = sum(r[1] > 0.5 for r in rows)
        weigh = {True: len(rows) / 2 / max(good, 1), False: len(rows) / 2 / max(len(rows) - good, 1)}
        for _ in range(PASSES):
            for _, y, slots, x in rows:
                model.learn(np.frombuffer(slots, "<i4"), np.frombuffer(x, "<f8"), float(y > 0.5), weigh[y > 0.5])
        w = model.weights()
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(w[at])], names=["slot", "w"])

    found = (sample.repartition(1).sortWithinPartitions("turn", "doc_id")
             .mapInArrow(fit, "slot int, w double").toPandas())
    weights = np.zeros(SLOTS + 1)
    weights[found["slot"].to_numpy(np.int64)] = found["w"].to_numpy()
    return weights


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``: the chance of label 1, a sparse dot product per whole text.

    Null and blank texts have no n-grams and get the score of the constant alone. A column
    named ``out`` is replaced. Equal texts get equal scores, an empty table gives no rows. The
    weights, of a fixed size, are broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    columns = [c for c in docs.columns if c != out]
    place = docs.columns.index(text)

    def run(batches):
        w = shared.value
        for b in batches:
            chances = []
            for t in b.column(place):
                slots, x = features(t.as_py())
                chances.append(_sigmoid(float(w[slots] @ x) + w[SLOTS]))
            yield pa.RecordBatch.from_arrays([b.column(docs_at) for docs_at in keep] + [pa.array(chances, pa.float64())],
                                             names=columns + [out])

    keep = [i for i, c in enumerate(docs.columns) if c != out]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields) if i in keep)
    return docs.mapInArrow(run, schema + f", `{out}` double")


def held_out(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1


def fitted(spark: SparkSession, sf_dir: str) -> np.ndarray:
    """Weights from the labels of rows that are not held out."""
    labels = table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "quality")
    return train(table(spark, sf_dir, "documents"), labels)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, fitted(spark, sf_dir)).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
