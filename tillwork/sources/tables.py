"""Reading, writing and publishing tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import Any

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillwork.sources.contracts import conform, schema_of


#: Compares texts without regard to case and trailing spaces.
STATUS_COLLATION = "UTF8_LCASE_RTRIM"


def read_relation(
    spark: SparkSession,
    path: str,
    relation: str,
    clean_status: bool = True,
    collated_status: bool = False,
) -> DataFrame:
    """A Parquet table as one of the input relations.

    With ``collated_status`` the status is read as a text that compares without regard to case and trailing
    spaces.  Filters on it then reach the scan, which they do not through the upper-casing that stands in for it otherwise;
    reports that group by it name each status by one of its spellings.
    """
    if not collated_status:
        return conform(spark.read.parquet(path), relation, clean_status)
    schema = spark.read.parquet(path).schema
    kinds = [StructField(f.name, StringType(STATUS_COLLATION)) if f.name == "status" else f for f in schema]
    return conform(spark.read.schema(StructType(kinds)).parquet(path), relation, clean_status=False)


def constant_rows(spark: SparkSession, rows: Sequence[tuple], relation: str) -> DataFrame:
    """A few fixed rows as a local relation.

    The planner knows its size and broadcasts it under its own threshold, which
    it cannot for rows parallelised from Python.
    """
    schema = schema_of(relation)
    records = [dict(zip(schema.names, row, strict=True)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records), schema)


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a Parquet table."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def reload_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Clear a Parquet table and load the rows, which may come from the table itself.

    The rows are written beside the table first; only then do they take its place, by renaming.  A run that fails
    before leaves the old rows where they are.  Readers that list the folder between the two renames find
    none; partitioned tables of which parts change are better served by ``reload_partitions``.
    """
    mark = uuid.uuid4().hex
    staged, old = f"{path}.staged-{mark}", f"{path}.old-{mark}"
    jvm = df.sparkSession._jvm
    folder = jvm.org.apache.hadoop.fs.Path
    system = folder(path).getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    try:
        df.write.partitionBy(*partition_by).parquet(staged)
    except Exception:
        system.delete(folder(staged), True)
        raise
    if system.exists(folder(path)) and not system.rename(folder(path), folder(old)):
        raise OSError(f"{path} cannot be replaced; the new rows are in {staged}")
    if not system.rename(folder(staged), folder(path)):
        raise OSError(f"{path} cannot be replaced; the new rows are in {staged}, the old ones in {old}")
    system.delete(folder(old), True)


def reload_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace those partitions of a Parquet table that the rows belong to; the files of all others stay untouched.

    Spark writes to a staging folder and moves whole partitions when all tasks are done, so a run that fails leaves the old
    rows.  A partition for which there are no rows is not cleared.
    """
    if not partition_by:
        raise ValueError("partition_by names the columns whose partitions are replaced")
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def create_if_absent(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write the rows unless the table exists."""
    df.write.mode("ignore").partitionBy(*partition_by).parquet(path)


def publish_view(df: DataFrame, name: str) -> None:
    """Create or replace a view, for use from SQL."""
    df.createOrReplaceTempView(name)


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> None:
    """Store a table in ``buckets`` files by a hash of its keys, sorted by them, replacing it.

    Two tables bucketed alike by their join key are joined, and each is grouped by it, without a shuffle: rows move once, here, however
    many reports read them.  ``path`` is where the files go, by default the warehouse.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def newest_value(spark: SparkSession, path: str, column: str) -> Any:
    """The largest value of a column of a Parquet table, read from the files' footers alone; None without any.

    Footers hold the largest value of dates and numbers, not of texts, timestamps or decimals; for those, and for files
    without statistics, the column is read.
    """
    settings = {
        "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
        "spark.sql.parquet.aggregatePushdown": "true",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        return _newest(spark, path, column).first()[0]
    except (PySparkException, Py4JJavaError):
        pass  # a file without statistics of the column
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return _newest(spark, path, column).first()[0]


def _newest(spark: SparkSession, path: str, column: str) -> DataFrame:
    return spark.read.parquet(path).agg(F.max(column).alias("newest"))
