"""Result sink (S7): results are written by Spark, never collected by the library."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_results(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                  fmt: str = "parquet") -> None:
    """Write a result frame (e.g. corpus-mode rankings partitioned by query id)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
