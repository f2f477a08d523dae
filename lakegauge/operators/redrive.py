"""Bounded retries: transient failures go back to the queue, then to dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegauge.operators.dedup import one_per_key
from lakegauge.schemas import MAX_ATTEMPTS, QUEUE_ENTRY, RETRYABLE_REASONS


def worth_retrying(max_attempts: int = MAX_ATTEMPTS) -> Column:
    return F.col("reason").isin(*RETRYABLE_REASONS) & (F.col("attempt") < max_attempts)


def to_queue(jobs: DataFrame) -> DataFrame:
    """Descriptor columns as queue entries for their next attempt."""
    following = F.col("attempt") + 1
    payload = F.struct("mode", "data", "s3_key", "size_bytes", "sha256")
    job = F.struct(
        "job_id",
        "trace_id",
        "stage",
        "tenant_id",
        "device_id",
        F.date_format("received_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("received_at"),
        payload.alias("payload"),
        "pipeline_hint",
        "parent_job_id",
        following.alias("attempt"),
    )
    entry = F.concat(F.col("job_id"), F.lit("/"), following.cast("string"))
    return jobs.select(entry.alias("entry_id"), F.to_json(job).alias("job")).select(*QUEUE_ENTRY.names)


def retries(outcomes: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Queue entries for the outcomes of one bronze batch that deserve another try: a fetch or an append failed.

    Inline jobs take their payload along; the others are fetched anew.
    """
    data = F.when(F.col("mode") == "inline", F.col("payload"))
    return to_queue(outcomes.filter(worth_retrying(max_attempts)).withColumn("data", data))


def redrive(letters: DataFrame, jobs: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Queue entries for dead letters, rebuilt from the jobs (parsed entries) that failed.

    A dead letter does not hold its descriptor, so it is looked up by job id and
    attempt; copies of one job give one entry.
    """
    failed = letters.filter(worth_retrying(max_attempts)).groupBy("job_id").agg(F.max("attempt").alias("attempt"))
    usable = jobs.filter("violations IS NULL")
    again = usable.join(failed, ["job_id", "attempt"], "left_semi")
    return to_queue(one_per_key(again, keys=("job_id",)))
