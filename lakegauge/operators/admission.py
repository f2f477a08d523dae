"""The edge: which request bodies become jobs, and how they travel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegauge.schemas import QUEUE_ENTRY

# Request cap and the largest payload that travels inside a job.
MAX_REQUEST_BYTES = 1024 * 1024
INLINE_MAX_BYTES = 65536


def admit(requests: DataFrame, max_bytes: int = MAX_REQUEST_BYTES) -> DataFrame:
    """Add ``admit_reason``, NULL for accepted requests.

    Needs ``body`` (binary), ``device_id`` and ``tenant_id``. An empty device id
    is accepted, an absent one is not; the body need not be JSON.
    """
    size = F.octet_length("body")
    return requests.withColumn(
        "admit_reason",
        F.when(F.col("device_id").isNull(), "missing_device_id")
        .when(F.col("tenant_id").isNull(), "missing_tenant_id")
        .when(size > max_bytes, "request_too_large")
        .when(F.col("body").isNull() | (size == 0), "empty_body")
        .when(~F.is_valid_utf8(F.col("body").cast("string")), "not_utf8"),
    )


def stamp(accepted: DataFrame, *identity: str | Column) -> DataFrame:
    """Give each reading its lineage ids and arrival time, keeping those it has.

    Missing ids are derived from ``identity`` (source file and position, say): a
    random id would change when a lost task is run again.
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in identity]
    seed = F.concat_ws("/", *[p.cast("string") for p in parts])
    have = set(accepted.columns)

    def keep(name: str, derived: Column) -> Column:
        return F.coalesce(F.col(name), derived) if name in have else derived

    return (
        accepted.withColumn("job_id", keep("job_id", F.upper(F.substring(F.sha2(seed, 256), 1, 26))))
        .withColumn("trace_id", keep("trace_id", F.substring(F.sha2(F.concat(F.lit("trace/"), seed), 256), 1, 32)))
        .withColumn("received_at", keep("received_at", F.current_timestamp()))
        .withColumn("stage", F.lit("bronze"))
        .withColumn("attempt", F.lit(1))
    )


def landing_key(received_at: str | Column, job_id: str | Column) -> Column:
    job_id = F.col(job_id) if isinstance(job_id, str) else job_id
    return F.concat(F.date_format(received_at, "yyyy/MM/dd"), F.lit("/"), job_id, F.lit(".json"))


def route(stamped: DataFrame, inline_max: int = INLINE_MAX_BYTES) -> DataFrame:
    """Add size, digest, mode and landing key; the limit itself still travels inline."""
    inline = F.col("size_bytes") <= inline_max
    return (
        stamped.withColumn("size_bytes", F.octet_length("body").cast("bigint"))
        .withColumn("sha256", F.sha2("body", 256))
        .withColumn("mode", F.when(inline, "inline").otherwise("reference"))
        .withColumn("data", F.when(inline, F.col("body").cast("string")))
        .withColumn("s3_key", F.when(~inline, landing_key("received_at", "job_id")))
    )


def to_queue(routed: DataFrame) -> DataFrame:
    """Routed readings as queue entries: the descriptor as one JSON text."""
    hint = F.col("pipeline_hint") if "pipeline_hint" in routed.columns else F.lit(None).cast("string")
    payload = F.struct("mode", "data", "s3_key", "size_bytes", "sha256")
    job = F.struct(
        "job_id",
        "trace_id",
        "stage",
        "tenant_id",
        "device_id",
        F.date_format("received_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("received_at"),
        payload.alias("payload"),
        hint.alias("pipeline_hint"),
        "attempt",
    )
    return routed.select(F.col("job_id").alias("entry_id"), F.to_json(job).alias("job")).select(*QUEUE_ENTRY.names)
