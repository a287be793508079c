"""Hand a file to every executor: written to the shared folder, fetched by Spark."""

from __future__ import annotations

import os

from pyspark import SparkFiles
from pyspark.sql import SparkSession

from sifter.llm.common import shared_path


def ship(spark: SparkSession, path: str) -> str:
    """Register ``path`` (any file system that Spark reads) with ``addFile``; returns the
    name under which ``local`` finds each executor's copy."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def ship_bytes(spark: SparkSession, data: bytes, name: str) -> str:
    """Write ``data`` to a new file in the shared folder and ``ship`` it."""
    path = shared_path(spark, name)
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        for i in range(0, len(data), 1 << 22):
            out.write(bytearray(data[i: i + (1 << 22)]))
    finally:
        out.close()
    return ship(spark, path)


def local(name: str) -> str:
    """The executor's copy of a shipped file."""
    return SparkFiles.get(name)
