"""Prepare a session: executors get this package, for launchers that did not send it (--py-files does the same),
and batches that cross to Python are kept small."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

#: Rows of a batch between Spark and Python. Texts are long; this bounds the buffers on both sides.
BATCH_ROWS = 1000
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bytes of a batch, where rows are long; one row may be longer.
BATCH_BYTES = 8 << 20
BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

_done: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources as a zip through Spark's file distribution, once per application."""
    if not 0 < int(spark.conf.get(BATCH)) <= BATCH_ROWS:
        spark.conf.set(BATCH, str(BATCH_ROWS))
    spark.conf.set(BYTES, str(BATCH_BYTES))
    sc = spark.sparkContext
    if sc.applicationId in _done:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark_sources.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    z.write(file, os.path.relpath(file, os.path.dirname(top)))
    sc.addPyFile(path)
    _done.add(sc.applicationId)
