"""Helpers of the operators: input columns, shared folders, Arrow batches."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Documents are long: so few rows keep an Arrow batch within some tens of MB.
ROWS_PER_BATCH = 400
#: Bytes of a Parquet row group, which its writer holds in memory.
ROW_GROUP = 32 << 20


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns of ``df`` under new names (``new="old"``).

    Columns are found by exact spelling and, if several share it, by place, so other columns
    whose names differ by case or repeat do no harm.
    """
    places = [df.columns.index(old) for old in columns.values()]
    flat = df.toDF(*(f"_{i}" for i in range(len(df.columns))))
    return flat.select(*(F.col(f"_{i}").alias(new) for i, new in zip(places, columns, strict=True)))


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with its columns named by place (c0, c1, ...), so that none can clash with another."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def kind_of(df: DataFrame) -> str:
    """The columns of ``df`` as a schema string."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` and ``text`` of a table of documents."""
    return pick(df, doc_id=id_col, text=text_col)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def ready(spark: SparkSession) -> None:
    """Make a session fit for the operators that run Python in tasks.

    Few documents go to Python at a time, unless the session asks for fewer; Parquet files are written in row groups of a size that
    leaves room for Python beside the writers, unless the session names one; and the executors get this package,
    which need not be installed there.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if not 0 < now <= ROWS_PER_BATCH:
        spark.conf.set(key, str(ROWS_PER_BATCH))
    if not spark.conf.get("parquet.block.size", None):
        spark.conf.set("parquet.block.size", str(ROW_GROUP))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        package = Path(__file__).resolve().parent.parent
        packed = Path(tempfile.mkdtemp(prefix="tillwork-")) / f"{package.name}.zip"
        with zipfile.ZipFile(packed, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(packed))


_shipped: set[str] = set()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Where that setting is missing a local folder stands in for it if all tasks run in the driver's process, as in tests;
    on a cluster executors would not see each other's files, and that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        base = "file://" + tempfile.mkdtemp(prefix="tillwork-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tillwork/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
