"""Helpers shared by the operators: table scans, numbered result files, code shipping."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize  # noqa: F401

PACKAGE_DIR = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once per application, so that
    functions in tasks import it whatever folder the executors run in."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="cairn-src-"), "cairn_src.zip")
    root = os.path.dirname(PACKAGE_DIR)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(PACKAGE_DIR):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def work_path(spark: SparkSession, kind: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"


def write_blobs(df: DataFrame, path: str) -> None:
    """Write each row (blob long, body binary) as one file, followed by a newline.

    The text writer copies the bytes as they are, goes through Spark's commit protocol
    (a repeated task leaves no second copy) and reaches every file system Spark can.
    """
    (df.select("blob", F.col("body").cast("string").alias("value"))
     .write.partitionBy("blob").option("lineSep", "\n").text(path))


def read_blobs(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, content) of the files of ``write_blobs``; an empty folder gives no rows."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.txt").load(path).select("path", "length", "content"))
