"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: the six ASCII white-space characters (\x20 and \x09-\x0D) that separate words
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, or the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts the lineage,
    so that a lost executor rereads files, and keeps several readers from computing it anew."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Each wanted name, lengthened until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(c):
    return F.translate(c, UPPER, LOWER)


def without_white(c):
    """The text without ASCII white space (byte-wise replacement: much faster than translate)."""
    for w in WHITE:
        c = F.replace(c, F.lit(w), F.lit(""))
    return c


def per_worker(key, make):
    """What ``make`` returns, made once in each Python worker process and kept for its later tasks.

    Functions of this package reach the workers by value and so have no module state there;
    this keeps it in a module object of its own.
    """
    state = sys.modules.setdefault("_stratum_worker_state", types.ModuleType("_stratum_worker_state"))
    if key not in state.__dict__:
        state.__dict__[key] = make()
    return state.__dict__[key]
