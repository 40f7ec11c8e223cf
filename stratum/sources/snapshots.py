"""Versioned table snapshots, published by one atomic step, and a ledger of finished writes.

Every write goes to a folder of its own and is never changed afterwards. A version is a small
manifest, which names the folder of each of its tables; publishing makes the manifest's file
appear under its number by a rename. Readers take the manifest of the highest number, so they
see all tables of one version or all of another, never a mixture or a half-written table, and a
run that dies leaves the earlier version as it was. Numbered files are created, never replaced:
of two runs that publish at once the later one gets the next number.

A version holds views too, as SQL text over its tables: they need no session and no metastore
to be read, and always see the tables of their own version.

The ledger holds, per key, the folder and the metrics of a finished write. The key is a digest
of all that the write depends on; a rerun with the same key takes the folder and skips the work.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratum.sources.tables import layer_name


def digest_of(*parts) -> str:
    """One key for everything given (texts, numbers, lists of them)."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def files_digest(spark: SparkSession, paths: list[str]) -> str:
    """A key of the files under ``paths``: names, lengths and times of change, contents unread."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
             .select("path", "length", "modificationTime"))
    # an order-free sum of the files' hashes: nothing is sorted or collected
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    found = files.agg(F.count(F.lit(1)), F.sum(one), F.sum("length")).first()
    return digest_of(*map(str, found))


class Table:
    """A finished write: its folder, its metrics, and whether it was taken from the ledger."""

    def __init__(self, spark: SparkSession, path: str, metrics: Mapping[str, int], reused: bool):
        self.spark, self.path, self.metrics, self.reused = spark, path, dict(metrics), reused

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


@dataclass(frozen=True)
class View:
    """SQL text in which ``{alias}`` stands for the table or view (layer, name) that ``inputs`` gives."""

    sql: str
    inputs: Mapping[str, tuple[str, str]]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # --- small files -----------------------------------------------------------------

    def _put(self, path: str, content: dict) -> bool:
        """The file with its whole content, or no file; False where it was there before."""
        if self._fs.exists(self._path(path)):
            return False
        temp = self._path(f"{self.root}/_tmp/{uuid.uuid4().hex}")
        out = self._fs.create(temp, True)
        out.write(bytearray(json.dumps(content, sort_keys=True).encode("utf-8")))
        out.close()
        target = self._path(path)
        self._fs.mkdirs(target.getParent())
        return bool(self._fs.rename(temp, target))

    def _get(self, path: str) -> dict | None:
        if not self._fs.exists(self._path(path)):
            return None
        return json.loads(self.spark.read.text(path, wholetext=True).first()[0])

    # --- writes and the ledger ---------------------------------------------------------

    def write(self, df: DataFrame, layer: str | None, name: str, key: str | None = None,
              metrics: Mapping[str, Column] | None = None) -> Table:
        """Write ``df`` to a fresh folder, counting its rows (and ``metrics``, aggregates over
        it) while it is written. With a ``key`` that the ledger knows nothing is computed."""
        note = None if key is None else f"{self.root}/_ledger/{key}"
        if note and (known := self._get(note)):
            return Table(self.spark, known["path"], known["metrics"], True)
        path = f"{self.root}/_tables/{layer_name(layer)}/{name}/{uuid.uuid4().hex}"
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (metrics or {}).items()]).write.parquet(path)
        found = dict(seen.get)
        if note:
            self._put(note, {"path": path, "metrics": found, "table": f"{layer_name(layer)}/{name}"})
        return Table(self.spark, path, found, False)

    # --- versions ----------------------------------------------------------------------

    def _manifest(self, version: int) -> str:
        return f"{self.root}/_versions/{version:010d}"

    def versions(self) -> list[int]:
        folder = self._path(f"{self.root}/_versions")
        if not self._fs.exists(folder):
            return []
        return sorted(int(f.getPath().getName()) for f in self._fs.listStatus(folder))

    def publish(self, tables: Mapping[tuple[str, str], Table],
                views: Mapping[tuple[str, str], View] | None = None) -> int:
        """Make (layer, name) -> table, and the views over them, the newest version; its number."""
        content = {f"{layer_name(layer)}/{name}": t.path for (layer, name), t in tables.items()}
        kept = {f"{layer_name(layer)}/{name}": {
            "sql": v.sql, "inputs": {alias: f"{layer_name(of)}/{table}" for alias, (of, table) in v.inputs.items()}}
            for (layer, name), v in (views or {}).items()}
        for name, view in kept.items():
            if missing := set(view["inputs"].values()) - set(content):
                raise LookupError(f"view {name} reads what its version lacks: {', '.join(sorted(missing))}")
        while True:
            version = max(self.versions(), default=0) + 1
            if self._put(self._manifest(version), {"tables": content, "views": kept}):
                return version

    def read(self, layer: str | None, name: str, version: int | None = None) -> DataFrame:
        """A table or view of the newest version, or of the one named."""
        version = version or max(self.versions(), default=0)
        manifest = self._get(self._manifest(version)) or {"tables": {}}
        wanted = f"{layer_name(layer)}/{name}"
        if wanted in (views := manifest.get("views", {})):
            return self.spark.sql(views[wanted]["sql"], **{
                alias: self.spark.read.parquet(manifest["tables"][at]) for alias, at in views[wanted]["inputs"].items()})
        path = manifest["tables"].get(wanted)
        if path is None:
            raise LookupError(f"version {version} of {self.root} has no table {wanted}")
        return self.spark.read.parquet(path)

    def attach(self, version: int | None = None, prefix: str = "") -> list[str]:
        """Name the tables and views of a version in the session's catalog; the names.

        Every layer is a schema (``prefix`` and the layer in lower case). Tables are external
        and carry the version in their name; under the plain name stands a view, replaced by
        one statement, so that readers of the catalog see the earlier version or this one.
        With a lasting metastore the names outlive the session.
        """
        version = version or max(self.versions(), default=0)
        manifest = self._get(self._manifest(version))
        if manifest is None:
            raise LookupError(f"{self.root} has no version {version}")

        def name_of(entry: str, suffix: str = "") -> str:
            layer, name = entry.split("/", 1)
            return f"{_quoted(prefix + layer.lower())}.{_quoted(name + suffix)}"

        for layer in sorted({entry.split("/", 1)[0] for entry in (*manifest["tables"], *manifest.get("views", {}))}):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(prefix + layer.lower())}")
        texts = {}
        for entry, path in manifest["tables"].items():
            stored = name_of(entry, f"_v{version}")
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {stored} USING parquet LOCATION '{path}'")
            texts[entry] = f"SELECT * FROM {stored}"
        for entry, view in manifest.get("views", {}).items():
            texts[entry] = view["sql"].format(**{alias: name_of(at, f"_v{version}") for alias, at in view["inputs"].items()})
        for entry, text in texts.items():
            self.spark.sql(f"CREATE OR REPLACE VIEW {name_of(entry)} AS {text}")
        return sorted(name_of(entry).replace("`", "") for entry in texts)
