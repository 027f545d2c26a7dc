"""Spark session helpers.

Lineage is cut by writing parquet tables into the shared folder named by
``spark.checkpoint.dir``.  Only a ``local`` session may leave it unset: everything then
runs on one machine and a fresh temporary folder is shared.  Any other session without
the setting is refused.
"""

from __future__ import annotations

import gc
import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: of the parquet tables in the shared folder
TABLE_CODEC = "zstd"


def build_session(master: str | None = None, app: str = "cairn", shuffle_partitions: int = 8,
                  extra: dict[str, str] | None = None) -> SparkSession:
    master = master or os.environ.get("CAIRN_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("CAIRN_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder.  A ``local`` session without one gets a temporary
    folder; any other raises, since executors on other machines would not see it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors share (master {master})")
    local = tempfile.mkdtemp(prefix="cairn-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def shuffle_partitions(spark: SparkSession) -> int:
    value = spark.conf.get("spark.sql.shuffle.partitions", "200")
    try:
        return max(1, int(value))
    except ValueError:  # "auto" on some platforms
        return 200


def materialize(df, partition_by: tuple[str, ...] = (), bucket_by: str | None = None, placed: bool = False):
    """Cut the lineage: write ``df`` as a parquet table in the shared checkpoint folder
    and read it back.

    Used where a frame feeds several branches of one plan (ranking joins it back to
    its own aggregate) or several queries; without it the logical plan doubles at
    every such step.  The table lives in ``spark.checkpoint.dir`` (shared storage on a
    cluster, never ``localCheckpoint`` or a machine-local folder), so a lost executor
    does not lose it.  Parquet rather than an RDD checkpoint: it is columnar and
    compressed, and every later scan of it gets column pruning and filter pushdown.
    ``partition_by`` writes one folder per value of those (few-valued) columns, so a
    filter on them prunes whole folders.  ``bucket_by`` hashes the rows by a column into as
    many buckets as there are shuffle partitions and sorts them, so that joins and
    aggregations of such tables on it need no exchange.  ``placed`` says that the plan of
    ``df`` ends in that partitioning already, so the rows are written where they are.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite").option("compression", TABLE_CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        name = f"cairn_{uuid.uuid4().hex}"
        n = shuffle_partitions(spark)
        # one task a bucket, so a bucket is one file (of a folder)
        writer = (df if placed else df.repartition(n, bucket_by)).write.mode("overwrite").format("parquet").option("compression", TABLE_CODEC).option("path", path)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.bucketBy(n, bucket_by).sortBy(bucket_by).saveAsTable(name)
        return spark.table(name).select(*df.columns)
    writer.parquet(path)
    # the declared schema keeps partition column types; the select keeps column order
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def release(spark: SparkSession) -> None:
    """Let the executors delete the shuffle files of frames that are no longer held.  Spark
    does so when the driver's JVM collects its garbage, which may be long after."""
    gc.collect()
    spark._jvm.System.gc()


_shipped: set[str] = set()
_shipping = threading.Lock()  # models train in threads


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once per application, so that
    functions in tasks import it whatever folder the executors run in."""
    with _shipping:
        _ship(spark)


def _ship(spark: SparkSession) -> None:
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="cairn-src-"), "cairn_src.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
