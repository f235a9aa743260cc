"""Incremental landing as Structured Streaming (R02, R03); master.py keeps the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placeweave.operators.tables import checksum


def landing_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def without_redelivery(stream: DataFrame, keys: list[str], at: str = "fetched_at", delay: str = "1 day") -> DataFrame:
    """Each delivered record once within the watermark."""
    marked = stream.withWatermark(at, delay).withColumn("checksum", checksum([c for c in stream.columns if c != at]))
    return marked.dropDuplicatesWithinWatermark([*keys, "checksum"])


def progress_windows(events: DataFrame, stage: str = "stage", at: str = "ts", width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Events of each stage in tumbling windows (R03); late ones count within ``delay``."""
    marked = events.withWatermark(at, delay) if events.isStreaming else events
    return marked.groupBy(F.window(at, width), stage).agg(F.count("*").alias("n")).select(F.col("window.start").alias("started"), stage, "n")
