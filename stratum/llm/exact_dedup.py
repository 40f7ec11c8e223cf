"""Exact dedup against a persistent digest index, bucketed and sorted by hash (DataFrame code only)."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import free_names, shared_folder, table, text_or_empty, without_white, written


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_chars, digest): SHA-256 of the text without white space; a null text counts as empty."""
    body = text_or_empty(text)
    return docs.select(F.col(doc_id).alias("doc_id"), F.char_length(body).cast("long").alias("n_chars"),
                       F.unhex(F.sha2(without_white(body), 256)).alias("digest"))


class DigestIndex:
    """Digests seen so far with the document that stays, bucketed and sorted by digest.

    The files lie at ``path``; opening the same path in a later session finds the same index.
    The number of buckets is fixed when the index is made (``buckets``, or the session's shuffle
    partitions) and kept beside it, at ``path``.buckets; a later session uses that number whatever
    its own is, and naming another one is an error.
    ``merge`` adds a batch: one row per digest of the batch, anti-joined (sort-merge, without
    a shuffle of the index) against the digests already there, then appended.
    """

    COLUMNS = "digest binary, keep_id long, keep_chars long, group_size long, batch string"

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        kept = self._kept_buckets()
        if kept is not None and buckets not in (None, kept):
            raise ValueError(f"the index at {path} has {kept} buckets, not {buckets}")
        self.buckets = kept or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if kept is None:
            spark.range(1).select(F.lit(self.buckets).alias("buckets")).coalesce(1).write.parquet(self._note())
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.name} ({self.COLUMNS}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'")

    def _note(self) -> str:
        return self.path.rstrip("/") + ".buckets"

    def _kept_buckets(self) -> int | None:
        try:
            return self.spark.read.parquet(self._note()).first()["buckets"]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def merge(self, batch_digests: DataFrame) -> str:
        """Append the digests of the batch that are new; returns the batch's own mark."""
        batch = uuid.uuid4().hex
        # the longest text, then the smallest doc_id: ~ turns the order round without overflow,
        # and a null doc_id, smallest in a struct, loses every tie
        best = F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("inv")))
        found = (batch_digests.groupBy("digest")
                 .agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
                 .select("digest", F.bitwise_not("best.inv").alias("keep_id"),
                         F.col("best.n_chars").alias("keep_chars"), "group_size", F.lit(batch).alias("batch")))
        known = self.spark.table(self.name).select("digest")
        fresh = found.join(known.hint("merge"), "digest", "left_anti")
        (fresh.repartition(self.buckets, "digest").sortWithinPartitions("digest")
         .write.mode("append").insertInto(self.name))
        return batch

    def rows(self) -> DataFrame:
        """The index as a plain scan, so that a join may split a hot digest at run time."""
        return self.spark.read.schema(self.COLUMNS).parquet(self.path)

    def verdicts(self, batch_digests: DataFrame) -> DataFrame:
        """The index rows of the batch's digests, by a join that leaves the index where it lies."""
        wanted = batch_digests.select("digest").distinct()
        return wanted.join(self.spark.table(self.name).hint("merge"), "digest")

    def close(self) -> None:
        """Forget the table's name in this session; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None,
                text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_chars.

    Texts are equal when identical without white space (null: empty). Of equal texts in one
    batch the one with the most characters stays, then the smallest doc_id; a null doc_id
    stays only where all are null. Rows of a digest that an earlier batch brought are dropped
    in favour of that batch's document (``group_size`` is then that of the earlier batch).
    Rows that repeat a doc_id with an equal text of the same length are the same document and
    share one verdict. Only digests are shuffled, never texts. An empty table gives no rows.
    """
    spark = docs.sparkSession
    own = index is None
    index = index or DigestIndex(spark, shared_folder(spark, "digest-index"))
    rows = written(digests(docs, text, doc_id), "digests")
    batch = index.merge(rows)
    # an index of this batch alone holds nothing else; a longer one is asked for the batch's digests only
    out = (rows.join(index.rows() if own else index.verdicts(rows), "digest")
           .select("doc_id", "keep_id", "group_size",
                   (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))
                    & (F.col("batch") == batch)).alias("kept"),
                   F.lower(F.hex("digest")).alias("text_sha256"), "n_chars"))
    if own:
        index.close()
    return out


def drop_exact_duplicates(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns; repeated rows of a document stay once."""
    marks = exact_dedup(docs, index).where("kept").groupBy("doc_id", "n_chars", "text_sha256").agg(
        F.count(F.lit(1)).alias("same"))
    marks = written(marks, "kept")
    # one plan at every size: the marks grow with the documents and are never broadcast
    d, i, n, digest, same = free_names(docs, "d", "id", "n", "digest", "same")
    key = [F.col("doc_id").alias(i), F.col("n_chars").alias(n),
           F.unhex("text_sha256").alias(digest), F.col("same").alias(same)]
    body = text_or_empty("text")
    rows = docs.withColumn(d, F.unhex(F.sha2(without_white(body), 256)))
    kept = rows.join(marks.select(*key).hint("merge"), (rows[d] == F.col(digest))
                     & rows["doc_id"].eqNullSafe(F.col(i))
                     & (F.char_length(body) == F.col(n))).drop(i, d)
    single = kept.where(F.col(same) == 1)
    # unlike texts may share a doc_id, or have none: they are told apart by the digest
    several = kept.where(F.col(same) > 1).groupBy("doc_id", n, digest).agg(
        *[F.first(c).alias(c) for c in docs.columns if c != "doc_id"])
    return single.select(*docs.columns).unionByName(several.select(*docs.columns))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("n_chars")


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""
