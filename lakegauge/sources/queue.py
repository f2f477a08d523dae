"""The job queue: files of descriptors, or a Kafka topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.schemas import QUEUE_ENTRY

# How many entries a micro-batch reads at most, and how long it waits.
BATCH_WINDOW = "10 seconds"


def read_queue(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(QUEUE_ENTRY).option("recursiveFileLookup", "true").parquet(path)


def stream_queue(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Unread entries of the Parquet files in and below a folder; the checkpoint remembers what was read."""
    reader = spark.readStream.schema(QUEUE_ENTRY).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_kafka(spark: SparkSession, servers: str, topic: str, max_entries: int) -> DataFrame:
    """Unread entries of a topic, at most ``max_entries`` per micro-batch. Needs the Kafka package."""
    records = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("maxOffsetsPerTrigger", max_entries)
        .load()
    )
    entry = F.concat_ws("-", F.col("partition").cast("string"), F.col("offset").cast("string"))
    return records.select(entry.alias("entry_id"), F.col("value").cast("string").alias("job"))
