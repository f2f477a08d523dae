"""Descriptor + payload bytes -> one bronze row, or one dead letter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegauge.functions.casts import as_timestamp
from lakegauge.functions.fingerprint import EMPTY_SHAPE, with_fingerprint
from lakegauge.functions.strict_json import is_object_text, kind, members, once, with_json
from lakegauge.operators.descriptor import parse_jobs
from lakegauge.operators.fence import fence
from lakegauge.operators.redrive import worth_retrying
from lakegauge.schemas import BRONZE_RAW, DEAD_LETTER, SOURCE

# Where a payload may carry its own time, in order of preference.
EVENT_TIME_KEYS = ("ts", "timestamp", "time")


def event_time(value: str, fallback: str | Column) -> Column:
    """First usable time among EVENT_TIME_KEYS of an object; else ``fallback``."""
    fallback = F.col(fallback) if isinstance(fallback, str) else fallback

    def first_usable(m: Column) -> Column:
        found = F.filter(F.array(*[m[key] for key in EVENT_TIME_KEYS]), lambda x: x.isNotNull())
        times = F.transform(found, lambda x: as_timestamp(x, kind(x)))
        return F.get(F.filter(times, lambda t: t.isNotNull()), 0)

    return F.coalesce(once(members(value), first_usable), fallback)


def attach_payload(jobs: DataFrame, landing: DataFrame | None = None) -> DataFrame:
    """Add ``content``: the payload bytes, NULL where the landed object is missing.

    Inline jobs stay where they are. Only reference jobs meet ``landing``
    (``key``, ``content``, maybe ``fetch_error``) in a join, so inline rows are
    never shuffled and their missing keys never pile up in one partition.
    """
    no_error = F.lit(None).cast("string").alias("fetch_error")
    inline = jobs.filter("mode = 'inline'").select("*", F.encode("data", "UTF-8").alias("content"), no_error)
    reference = jobs.filter("mode = 'reference'")
    if landing is None:
        fetched = reference.select("*", F.lit(None).cast("binary").alias("content"), no_error)
    else:
        error = F.col("fetch_error") if "fetch_error" in landing.columns else no_error
        objects = landing.select(F.col("key").alias("s3_key"), "content", error.alias("fetch_error"))
        fetched = reference.join(objects, "s3_key", "left").select(*jobs.columns, "content", "fetch_error")
    return inline.unionByName(fetched)


def check_integrity(fetched: DataFrame) -> DataFrame:
    """Add ``payload`` text, and ``reason``/``detail`` where the bytes cannot be trusted."""
    digest = F.sha2("content", 256)
    checked = fetched.withColumn("_digest", digest).withColumn(
        "payload", F.try_validate_utf8(F.col("content").cast("string"))
    )
    failed = F.col("fetch_error").isNotNull()
    missing, mismatch = F.col("content").isNull(), F.col("_digest") != F.col("sha256")
    verdicts = checked.withColumn(
        "reason",
        F.when(failed, "fetch_failed").when(missing, "object_missing").when(mismatch, "sha256_mismatch").when(F.col("payload").isNull(), "invalid_utf8"),
    ).withColumn(
        "detail",
        F.when(failed, F.col("fetch_error"))
        .when(missing, F.concat(F.lit("no object at "), F.col("s3_key")))
        .when(mismatch, F.concat(F.lit("got "), F.col("_digest"), F.lit(", expected "), F.col("sha256")))
        .when(F.col("payload").isNull(), F.lit("payload bytes are not UTF-8")),
    ).drop("_digest", "content", "fetch_error")
    return fence(verdicts)


def describe_payload(checked: DataFrame) -> DataFrame:
    """Add ``event_time`` and ``schema_fp``.

    Good rows whose payload is no object count as the empty shape; a set-aside
    payload is described as it is, and not at all if it is not JSON.
    """
    parsed = with_json(checked, "payload", "_v")
    good = F.col("reason").isNull()
    is_object = F.col("_v").isNotNull() & is_object_text("payload")
    shaped = parsed.withColumn("_shape", F.when(is_object | ~good, F.col("_v"))).withColumn(
        "event_time", F.when(good, event_time("_v", "received_at"))
    )
    return (
        with_fingerprint(shaped, "_shape", "payload", "schema_fp")
        .withColumn("schema_fp", F.when(good, F.coalesce("schema_fp", F.lit(EMPTY_SHAPE))).otherwise(F.col("schema_fp")))
        .drop("_v", "_shape", "data")
    )


_OUTCOME = (
    "job_id", "trace_id", "stage", "tenant_id", "device_id", "received_at", "event_time", "pipeline_hint",
    "parent_job_id", "attempt", "mode", "s3_key", "size_bytes", "sha256", "schema_fp", "payload", "reason", "detail",
)


def bronze_outcomes(entries: DataFrame, landing: DataFrame | None = None, parsed: DataFrame | None = None) -> DataFrame:
    """One row per queue entry; ``reason`` is NULL for rows that belong in bronze.

    ``parsed`` may hold the already parsed (and perhaps stored) entries.
    """
    jobs = parse_jobs(entries) if parsed is None else parsed
    usable = jobs.filter("violations IS NULL").drop("violations", "job")
    good = describe_payload(check_integrity(attach_payload(usable, landing)))
    absent = {
        **dict.fromkeys(("pipeline_hint", "parent_job_id", "mode", "s3_key", "sha256", "schema_fp"), "string"),
        "event_time": "timestamp",
        "size_bytes": "bigint",
    }
    known = {
        "job_id": F.col("entry_id"),
        "trace_id": F.lit(""),
        "stage": F.lit("bronze"),
        "tenant_id": F.lit(""),
        "device_id": F.lit(""),
        "received_at": F.current_timestamp(),
        "attempt": F.lit(1),
        "payload": F.col("job"),
        "reason": F.lit("unparseable_descriptor"),
        "detail": F.concat(F.lit("descriptor failed validation: "), F.col("violations")),
        **{name: F.lit(None).cast(t) for name, t in absent.items()},
    }
    unusable = jobs.filter("violations IS NOT NULL").select(*[known[name].alias(name) for name in _OUTCOME])
    return good.select(*_OUTCOME).unionByName(unusable)


def bronze_rows(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter("reason IS NULL").withColumn("source", F.lit(SOURCE)).select(*BRONZE_RAW.names)


def dead_letters(outcomes: DataFrame, retried: bool = True) -> DataFrame:
    """The set-aside side of any outcome frame, in dead-letter layout.

    Where transient failures with tries left are ``retried`` (see ``redrive.retries``), they are not dead yet.
    """
    alive = worth_retrying() if retried else F.lit(False)
    return (
        outcomes.filter(F.col("reason").isNotNull() & ~alive)
        .withColumn("failed_at", F.current_timestamp())
        .select(*DEAD_LETTER.names)
    )
