"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelic.session import scratch_path

SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Setting, Spark's default, this package's value.
BATCH_SIZES = (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "4000"),
               ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "16m"))
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives this package to the application's Python workers, as spark-submit
    --py-files does; once per application.  Batches that Spark hands to Python
    are kept small, unless the session has sizes of its own, because a batch
    of whole texts is held several times over while it is worked on."""
    context = spark.sparkContext
    for key, default, own in BATCH_SIZES:
        if spark.conf.get(key) == default:
            spark.conf.set(key, own)
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    archive = os.path.join(tempfile.mkdtemp(prefix="allelic-package-"), "allelic-package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted((root / "allelic").rglob("*.py")):
            z.write(file, file.relative_to(root))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return scratch_path(spark, os.path.join("llm", f"{name}-{uuid.uuid4().hex}"))


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts the lineage: a lost executor costs at most the stage at hand, and
    what several branches read is computed once.
    """
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def crc_remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; null keys count as ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus
