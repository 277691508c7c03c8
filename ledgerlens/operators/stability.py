"""Materialise an intermediate once so that everything derived from it agrees; code for the workers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

FILE_ROWS = 20_000  # rows of a table of known size that share a file


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared checkpoint folder: ``spark.checkpoint.dir``, or one in the SQL warehouse where that is unset."""
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    context.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame, most_rows: int | None = None) -> DataFrame:
    """Reliable checkpoint: survives lost executors and cuts lineage.

    ``most_rows``: a bound on the rows, where it is known.  A small table then takes few files, however many
    shuffle partitions there are; without native libraries an executor starts processes for each file it creates.
    """
    checkpoint_folder(df.sparkSession)
    if most_rows is not None:
        df = df.coalesce(max(1, -(-most_rows // FILE_ROWS)))
    return df.checkpoint(eager=True)


def landed(df: DataFrame) -> DataFrame:
    """Write to the shared folder as Parquet and read back: later reads take only the columns and row groups they need."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partition_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over the session's tasks, before work that takes long per row.

    Small tables are otherwise read, or joined into, a handful of partitions: Spark counts bytes, not the time that a row takes.
    """
    spark = df.sparkSession
    return df.repartition(max(partition_count(spark), spark.sparkContext.defaultParallelism))


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per session, as ``--py-files`` would."""
    context = spark.sparkContext
    if getattr(context, "_ledgerlens_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(root):
        handle, path = tempfile.mkstemp(prefix="ledgerlens-", suffix=".zip")
        with os.fdopen(handle, "wb") as raw, zipfile.ZipFile(raw, "w") as package:
            for folder, _, files in sorted(os.walk(root)):
                for name in sorted(f for f in files if f.endswith(".py")):
                    full = os.path.join(folder, name)
                    package.write(full, os.path.join("ledgerlens", os.path.relpath(full, root)))
        context.addPyFile(path)
    context._ledgerlens_shipped = True
