"""Landing-area presence check before a load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum import fixed
from stratum.operators.quality import GateError


def listed_paths(spark: SparkSession, directory: str) -> DataFrame:
    """``(path)`` of every file under ``directory`` (any Hadoop FS URI).

    Only the path column is selected, so file contents are never read; the
    listing itself is parallelised by Spark for large directories.
    """
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .load(directory).select("path"))


def source_presence(spark: SparkSession, directory: str,
                    required: Sequence[str] = fixed.REQUIRED_SOURCES) -> DataFrame:
    """``(required_name, files, present)``: per required name, how many paths contain it.

    One aggregate over the listing; the required list is turned into
    columns, so no join (and no pairing of names with paths) is needed.
    """
    paths = listed_paths(spark, directory)
    counts = paths.agg(*[F.count_if(F.col("path").contains(n)).alias(f"__{i}")
                         for i, n in enumerate(required)])
    rows = [F.struct(F.lit(n).alias("required_name"), F.col(f"__{i}").alias("files"))
            for i, n in enumerate(required)]
    return (counts.select(F.inline(F.array(*rows)))
            .withColumn("present", F.col("files") > 0))


def require_sources(spark: SparkSession, directory: str,
                    required: Sequence[str] = fixed.REQUIRED_SOURCES) -> None:
    """Raise when the directory is empty or a required name matches no path."""
    try:
        empty = listed_paths(spark, directory).isEmpty()
    except Exception as exc:  # missing directory reads as "no files"
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        empty = True
    if empty:
        raise GateError(f"no files found in {directory}; upload the sources first")
    missing = [r.required_name for r in source_presence(spark, directory, required).collect()
               if not r.present]
    if missing:
        raise GateError(f"required source missing: {', '.join(missing)}")
