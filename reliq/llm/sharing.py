"""What every executor gets a copy of: files of the Spark context, and this package's modules."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from reliq.session import fresh_dir

PACKAGE = Path(__file__).resolve().parent.parent
_SHIPPED: set[str] = set()


def _write_shared(spark: SparkSession, content: bytes, purpose: str, suffix: str) -> str:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{fresh_dir(spark, purpose)}/{purpose}-{uuid.uuid4().hex}{suffix}")
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    return path.toString()


def share_file(spark: SparkSession, path: str) -> str:
    """Give an existing file to all executors and return its name there."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def share_bytes(spark: SparkSession, content: bytes, purpose: str) -> str:
    """Write a file to the shared folder, give it to all executors and return its name there."""
    path = _write_shared(spark, content, purpose, ".bin")
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def ship_package(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package, once per application."""
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as archive:
            for file in sorted(PACKAGE.rglob("*.py")):
                archive.write(file, str(file.relative_to(PACKAGE.parent)))
        spark.sparkContext.addPyFile(_write_shared(spark, packed.getvalue(), "package", ".zip"))
        _SHIPPED.add(application)
    return spark
