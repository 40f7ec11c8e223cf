"""A training corpus from ``documents``: quality, exact and near duplicates, mixing, token ids.

Every stage takes (spark, docs, sf_dir) and is written as Parquet before the next one reads
it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.bpe import encode_documents
from stratum.llm.common import free_names, table, written
from stratum.llm.exact_dedup import drop_exact_duplicates
from stratum.llm.mixing import mixed_documents
from stratum.llm.quality import held_out, score, train
from stratum.llm.simhash import drop_near_duplicates

#: documents below this chance of being good go
MIN_QUALITY = 0.5
#: near copies: words of a shingle and the differing fingerprint bits up to which two texts link
NEAR_SHINGLE, NEAR_BITS = 3, 3


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels that are not held out, finds good."""
    labels = table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", "quality")
    chance, = free_names(docs, "score")
    scored = score(docs, train(docs, labels), out=chance)
    return scored.where(F.col(chance) >= MIN_QUALITY).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (without white space) the longest, then the first."""
    return drop_exact_duplicates(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest doc_id, one without only where none has one."""
    return drop_near_duplicates(docs, NEAR_SHINGLE, NEAR_BITS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents left out, taken once, or repeated as further rows."""
    return mixed_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, with the digests of the ids and of the decoded text."""
    return encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality_classifier", quality_classifier), ("exact_dedup", exact_dedup),
          ("simhash_near_dedup", simhash_near_dedup), ("mixing", mixing), ("bpe", bpe)]

#: neither the classifier nor fingerprints or merges can be put in SQL; tests/llm holds the stages
#: against brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
