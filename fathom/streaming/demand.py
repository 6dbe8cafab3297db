"""The monthly demand and event counts over streams of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def events(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def windowed_counts(stream: DataFrame, keys: list[str], time: str = "ts", width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts and sums by window; rows later than the watermark are left out, and state older than it is dropped."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), *keys, "n", "total")


def deduplicated(stream: DataFrame, key: str, time: str = "ts", late: str = "2 days") -> DataFrame:
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark([key])
