"""Publishing a set of tables as one version, all or nothing.

A version is a folder of parquet tables under ``root/versions``.  It is written and read
back first; then the gates run; only then a manifest (tables, rows, columns) is moved into
``root/manifests`` under the next number, in one rename.  A version without a manifest does
not exist for readers, so a failure at any point leaves the last version as it was.  Readers
take the highest number, or pin one, and keep reading that version's folder while others
are published.  Two publishers cannot take one number: it is claimed by creating a file
that must not exist.

Paths may be of any file system that Spark reaches; files are named, listed and moved
through Hadoop's file system interface.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import TABLE_CODEC, release


class PublishError(RuntimeError):
    """The version was not published; the previous one is untouched."""


class Mart:
    """One published version."""

    def __init__(self, spark: SparkSession, root: str, number: int, manifest: dict):
        self.spark, self.root, self.number, self.manifest = spark, root, number, manifest

    @property
    def tables(self) -> list[str]:
        return sorted(self.manifest["tables"])

    def rows(self, name: str) -> int:
        return self.manifest["tables"][name]["rows"]

    def table(self, name: str) -> DataFrame:
        held = self.manifest["tables"][name]
        schema = T.StructType.fromJson(held["schema"])
        return self.spark.read.schema(schema).parquet(f"{self.root}/{held['path']}")

    def frames(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in self.tables}

    def register(self, prefix: str = "") -> None:
        """The tables as session views (replace semantics): the mart that SQL reads."""
        for name in self.tables:
            self.table(name).createOrReplaceTempView(f"{prefix}{name}")


class _Files:
    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, path: str) -> list[str]:
        if not self.fs.exists(self._path(path)):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self._path(path))]

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """A new file; raises if there is one."""
        stream = self.fs.create(self._path(path), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def move(self, source: str, target: str) -> None:
        if self.fs.exists(self._path(target)) or not self.fs.rename(self._path(source), self._path(target)):
            raise PublishError(f"{target} could not be put in place")

    def remove(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def mkdirs(self, path: str) -> None:
        self.fs.mkdirs(self._path(path))


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published versions, ascending."""
    root = root.rstrip("/")
    return sorted(int(n[:-5]) for n in _Files(spark, root).names(f"{root}/manifests") if n.endswith(".json") and n[:-5].isdigit())


def open_mart(spark: SparkSession, root: str, number: int | None = None) -> Mart:
    """The latest version, or the one that ``number`` pins."""
    root = root.rstrip("/")
    if number is None:
        found = versions(spark, root)
        if not found:
            raise PublishError(f"nothing is published under {root}")
        number = found[-1]
    return Mart(spark, root, number, json.loads(_Files(spark, root).read(f"{root}/manifests/{number:08}.json")))


def publish(spark: SparkSession, root: str, tables: Mapping[str, DataFrame | Callable[[Mapping[str, DataFrame]], DataFrame]],
            gates: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None, note: Mapping | None = None) -> Mart:
    """Write ``tables`` as the next version, in their order; a function among them makes its
    table from those written before.

    ``gates`` gets the tables as they were written and returns rows (check_name, status);
    anything but PASS stops the publication.
    """
    root = root.rstrip("/")
    files, version = _Files(spark, root), uuid.uuid4().hex
    staging = f"{root}/versions/{version}"
    try:
        held, written = {}, {}
        for name, table in tables.items():
            df = table(written) if callable(table) else table
            path = f"versions/{version}/{name}"
            df.write.mode("error").option("compression", TABLE_CODEC).parquet(f"{root}/{path}")
            held[name] = {"path": path, "schema": json.loads(df.schema.json())}
            written[name] = spark.read.schema(df.schema).parquet(f"{root}/{path}")
            del df, table
            release(spark)
        for name, df in written.items():
            held[name]["rows"] = df.count()
        if gates is not None:
            failed = sorted(r["check_name"] for r in gates(written).where(~F.col("status").eqNullSafe("PASS")).select("check_name").collect())
            if failed:
                raise PublishError(f"gates failed: {', '.join(failed)}")
        files.mkdirs(f"{root}/manifests")
        taken = [int(n.split(".")[0]) for n in files.names(f"{root}/manifests") if n.split(".")[0].isdigit()]
        number = max(taken, default=0) + 1
        files.create(f"{root}/manifests/{number:08}.claim", version)
        manifest = {"number": number, "version": version, "tables": held, **({"note": dict(note)} if note else {})}
        files.create(f"{staging}/manifest.json", json.dumps(manifest, sort_keys=True, default=str))
    except BaseException:
        files.remove(staging)  # no manifest names it
        raise
    files.move(f"{staging}/manifest.json", f"{root}/manifests/{number:08}.json")
    return open_mart(spark, root, number)


def retire(spark: SparkSession, root: str, keep: int) -> list[int]:
    """Remove all but the latest ``keep`` versions: the manifest first, so that no reader
    finds a version half gone.  Returns the numbers removed."""
    root = root.rstrip("/")
    files, old = _Files(spark, root), versions(spark, root)[: -keep if keep else None]
    for number in old:
        folder = f"{root}/versions/{open_mart(spark, root, number).manifest['version']}"
        files.remove(f"{root}/manifests/{number:08}.json")
        files.remove(folder)
    return old
