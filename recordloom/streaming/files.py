"""Result files as a stream: records as they arrive, counts by day with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.operators.answers import records

FILES = T.StructType([T.StructField("file_id", T.LongType()), T.StructField("folder", T.StringType()), T.StructField("file_name", T.StringType()), T.StructField("written_at", T.TimestampType()), T.StructField("ingested_at", T.TimestampType()), T.StructField("payload", T.StringType())])


def stream_files(spark: SparkSession, path: str, late: str = "30 days") -> DataFrame:
    """Files as they land in a folder, each once: a file delivered twice within the watermark is dropped."""
    s = spark.readStream.schema(FILES).parquet(path).withColumn("written_at", F.col("written_at").cast("timestamp"))
    return s.withWatermark("written_at", late).dropDuplicatesWithinWatermark(["file_id"])


def stream_records(files: DataFrame) -> DataFrame:
    """(file_id, pos, model_name): records of streamed files."""
    return records(files).select("file_id", "pos", F.try_variant_get(F.try_element_at("record", F.lit("model_name")), "$", "string").alias("model_name"))


def daily_counts(files: DataFrame) -> DataFrame:
    """Files of each folder and day; days are final once the watermark has passed them."""
    return files.groupBy(F.window("written_at", "1 day").alias("day"), "folder").agg(F.count("*").alias("n_files"))
