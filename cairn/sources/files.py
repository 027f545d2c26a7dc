"""File sources and sinks: CSV with explicit schemas, Parquet table publishing, a JSON
metadata record, row counts, scalar queries and type maps."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Header, ISO dates (yyyy-MM-dd), overwrite.  Partitioned output; pass
    ``partitions`` only to bound the file count, never to force one task."""
    out = df.repartition(partitions) if partitions else df
    (out.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).option("dateFormat", "yyyy-MM-dd")
     .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss").csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, empty_only_null: bool = True) -> DataFrame:
    """Header CSV with a declared schema (dates parsed as yyyy-MM-dd); when
    ``empty_only_null`` only an empty field is null (text like "NA" stays text)."""
    reader = spark.read.schema(schema).option("header", True).option("dateFormat", "yyyy-MM-dd")
    if empty_only_null:
        reader = reader.option("nullValue", "").option("emptyValue", "")
    return reader.option("mode", "FAILFAST").csv(path)


def head_columns(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """S3: column-pruned scan and the first ``n`` rows (the limit is the feature)."""
    return df.select(*columns).limit(n)


def publish_tables(tables: Mapping[str, DataFrame], root: str, fmt: str = "parquet") -> dict[str, str]:
    """Write every table under ``root/<name>`` with replace semantics."""
    out = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}"
        df.write.mode("overwrite").format(fmt).save(path)
        out[name] = path
    return out


def register_mart(tables: Mapping[str, DataFrame]) -> None:
    """The reporting mart as session views (replace semantics)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows) as one union of per-table counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def query_scalar(spark: SparkSession, sql: str, **frames: DataFrame) -> float:
    """First column of the first row as float; no row or null -> 0.0."""
    row = spark.sql(sql, **frames).first()
    return 0.0 if row is None or row[0] is None else float(row[0])


def type_map(df: DataFrame) -> dict[str, str]:
    """Column -> date / bool / int / double / text."""
    def kind(t: T.DataType) -> str:
        if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return "date"
        if isinstance(t, T.BooleanType):
            return "bool"
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            return "int"
        if isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            return "double"
        return "text"

    return {f.name: kind(f.dataType) for f in df.schema.fields}


def write_json_record(spark: SparkSession, payload: Mapping, path: str) -> None:
    """One nested metadata record as JSON (numbers, lists and sub-objects kept)."""
    spark.createDataFrame([(json.dumps(payload, sort_keys=True, default=str),)], "value string").write.mode(
        "overwrite").text(path)


def read_json_record(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])
