"""Curation of a stream of candidates: an extension, the batch operators are the reference.

Candidates arrive as files. The gates that look at one record at a time run on the
stream as they are; exact duplicates within the watermark are dropped with state,
keyed by the hash of the statement; what was accepted before is a static join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def candidates(spark: SparkSession, folder: str, schema: str, files_a_trigger: int = 64) -> DataFrame:
    """The Parquet files that arrive in a folder, as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).parquet(folder)


def statement_key(text: str = "problem_statement"):
    return F.md5(F.trim(F.coalesce(F.col(text), F.lit(""))))


def novel(stream: DataFrame, accepted: DataFrame, time: str = "submitted_at", delay: str = "7 days") -> DataFrame:
    """Candidates with steps whose stripped statement neither was accepted nor came before within the watermark."""
    shaped = stream.where(F.size("construction_steps") > 0).withColumn("_k", statement_key())
    known = accepted.select(statement_key().alias("_k")).distinct()
    fresh = shaped.join(known, "_k", "left_anti")
    return fresh.withWatermark(time, delay).dropDuplicatesWithinWatermark(["_k"]).drop("_k")


def arrivals(stream: DataFrame, time: str = "submitted_at", width: str = "1 hour", delay: str = "7 days") -> DataFrame:
    """Candidates a window of event time; late rows count until the watermark passes."""
    counts = stream.withWatermark(time, delay).groupBy(F.window(time, width)).agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("start"), "n")


def append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Exactly-once append of a stream to JSON lines, as far as it has come."""
    return stream.writeStream.format("json").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(path)
