"""Table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan of ``{folder}/{name}.parquet``, a file or a folder of parts."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
