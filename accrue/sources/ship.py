"""Settings of a session whose executors run this library's functions in Python workers."""

from __future__ import annotations

import zipfile
from pathlib import Path
from tempfile import mkdtemp

from pyspark.sql import SparkSession

_SENT: set[str] = set()


ROWS_PER_BATCH, BYTES_PER_BATCH = 1000, 16 << 20


def ship_library(spark: SparkSession) -> None:
    """Send the library to the executors and keep Arrow batches of texts small."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ROWS_PER_BATCH:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_PER_BATCH)
    send_library(spark)


def send_library(spark: SparkSession) -> None:
    """Send the library's source files to the executors, once per application."""
    application = spark.sparkContext.applicationId
    if application in _SENT:
        return
    root = Path(__file__).resolve().parent.parent
    archive = f"{mkdtemp()}/{root.name}.zip"  # the driver serves it to the executors
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(archive)
    _SENT.add(application)
