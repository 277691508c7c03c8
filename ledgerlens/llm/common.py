"""What the training-data operators share: table access, landed intermediates, words, code for the workers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.stability import checkpoint_folder

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

# ASCII letters and digits stay (capitals lowered), other ASCII becomes a blank, UTF-8 bytes above stay.
_PLAIN = bytes(
    (c + 32 if 65 <= c <= 90 else c) if chr(c).isalnum() or c >= 128 else 32 for c in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def land(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: lineage is cut, columns can be pruned, the size is known."""
    return land_at(df)[0]


def land_at(df: DataFrame) -> tuple[DataFrame, str]:
    """As :func:`land`, with the path written, for :func:`discard`."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark).rstrip('/')}/landed-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a landed table that nothing reads any more, through the file system Spark itself uses."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


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
                for name in sorted(files):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        package.write(full, os.path.join("ledgerlens", os.path.relpath(full, root)))
        context.addPyFile(path)
    context._ledgerlens_shipped = True


def word_count(text: Column | str) -> Column:
    """Number of words; a null text has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def hash48(key: Column | str) -> Column:
    """First 48 bits of md5 of the key's text, so that any SQL engine can follow; null hashes as empty."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased words without ASCII punctuation, as UTF-8."""
    return text.lower().encode("utf-8", "replace").translate(_PLAIN).split() if text else []
