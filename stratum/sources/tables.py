"""Layered table storage: path routing and materialisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratum.session import shared_dir

DEFAULT_LAYER = "DEFAULT"


def layer_name(layer: str | None, default: str = DEFAULT_LAYER) -> str:
    """Layer to storage schema: trimmed and upper-cased; the default when unset."""
    return default if layer is None else layer.strip().upper()


def layer_path(root: str, layer: str | None, name: str) -> str:
    return f"{root.rstrip('/')}/{layer_name(layer)}/{name}"


def write_table(df: DataFrame, root: str, layer: str | None, name: str,
                mode: str = "overwrite") -> DataFrame:
    """Materialise ``df`` as a Parquet table and return a scan of it.

    ``overwrite`` is the full refresh (a re-run replaces, never duplicates).
    Reading back cuts the lineage: later stages restart from the files,
    so a lost executor re-reads Parquet instead of recomputing the chain.
    """
    path = layer_path(root, layer, name)
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)


def read_table(spark: SparkSession, root: str, layer: str | None, name: str, version: int | None = None) -> DataFrame:
    """A table of the published snapshot under ``root`` (the newest, or ``version``); where nothing
    was ever published, the plain table of the layer."""
    from stratum.sources.snapshots import Snapshots
    store = Snapshots(spark, root)
    if store.versions():
        return store.read(layer, name, version)
    return spark.read.parquet(layer_path(root, layer, name))


def register_view(df: DataFrame, name: str) -> DataFrame:
    """A lazily evaluated model: the plan is inlined wherever the view is read."""
    df.createOrReplaceTempView(name)
    return df


def materialize(df: DataFrame, label: str = "materialized") -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but stores columnar, compressed
    files instead of serialized rows, and keeps file statistics for the
    planner. Each call writes a fresh folder.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)
