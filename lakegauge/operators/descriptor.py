"""Job descriptors: strict JSON text in, typed columns or a list of violations out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegauge.functions.isotime import has_zone, iso_ts
from lakegauge.functions.strict_json import members, once, with_json
from lakegauge.operators.fence import fence
from lakegauge.schemas import STAGES

# Field names of a descriptor and of its two payload forms.
FIELDS = (
    "job_id", "trace_id", "stage", "tenant_id", "device_id", "received_at", "payload",
    "pipeline_hint", "parent_job_id", "attempt",
)
REQUIRED_TEXT = ("job_id", "trace_id", "stage", "tenant_id", "device_id", "received_at")
OPTIONAL_TEXT = ("pipeline_hint", "parent_job_id")
PAYLOAD_FIELDS = {
    "inline": ("mode", "data", "size_bytes", "sha256"),
    "reference": ("mode", "s3_key", "size_bytes", "sha256"),
}


# Looking a field up twice costs less than binding it.
def _text(value: Column) -> Column:
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def _integer(value: Column) -> Column:
    return F.when(F.schema_of_variant(value) == "BIGINT", F.try_variant_get(value, "$", "bigint"))


def _other_keys(opened: Column, allowed: tuple[str, ...]) -> Column:
    return F.size(F.array_except(F.map_keys(opened), F.array(*[F.lit(k) for k in allowed]))) > 0


def _payload_fields(p: Column) -> Column:
    return F.struct(
        *[_text(p[n]).alias(n) for n in ("mode", "data", "s3_key", "sha256")],
        _integer(p["size_bytes"]).alias("size_bytes"),
        *[_other_keys(p, names).alias(f"more_than_{mode}") for mode, names in PAYLOAD_FIELDS.items()],
    )


def _job_fields(j: Column) -> Column:
    return F.struct(
        *[_text(j[n]).alias(n) for n in (*REQUIRED_TEXT, *OPTIONAL_TEXT)],
        *[(~F.coalesce(F.schema_of_variant(j[n]), F.lit("VOID")).isin("VOID", "STRING")).alias(f"wrong_{n}") for n in OPTIONAL_TEXT],
        F.when(j["attempt"].isNull(), F.lit(1).cast("bigint")).otherwise(_integer(j["attempt"])).alias("attempt"),
        _other_keys(j, FIELDS).alias("more"),
        once(members(j["payload"]), _payload_fields).alias("payload"),
    )


def parse_jobs(entries: DataFrame) -> DataFrame:
    """Queue entries (``entry_id``, ``job``) with descriptor columns and ``violations``.

    ``violations`` is NULL for a usable descriptor, else the failed checks joined
    by ';'. Types are strict: a number in quotes is not a number.
    """
    parsed = with_json(entries, "job", "_job")
    opened = parsed.select(
        "entry_id", "job", once(members("_job"), _job_fields).alias("_f"), members("_job").isNotNull().alias("_is_object")
    )
    fields = opened.select(
        "entry_id", "job", "_is_object", "_f.*", iso_ts(F.col("_f.received_at")).alias("_instant")
    ).select(
        "*", "payload.*"
    ).drop("payload")

    inline, reference = F.col("mode") == "inline", F.col("mode") == "reference"
    checks = [
        *[(f"{n}_missing", F.col(n).isNull()) for n in REQUIRED_TEXT if n != "received_at"],
        *[(f"{n}_type", F.col(f"wrong_{n}")) for n in OPTIONAL_TEXT],
        ("extra_field", F.col("more")),
        ("stage_unknown", F.col("stage").isNotNull() & ~F.col("stage").isin(*STAGES)),
        ("received_at_invalid", F.col("_instant").isNull()),
        ("received_at_naive", F.col("_instant").isNotNull() & ~has_zone(F.col("received_at"))),
        ("attempt_invalid", F.coalesce((F.col("attempt") < 1) | (F.col("attempt") > 2**31 - 1), F.lit(True))),
        ("mode_unknown", F.col("mode").isNull() | ~F.col("mode").isin(*PAYLOAD_FIELDS)),
        ("size_bytes_invalid", F.coalesce(F.col("size_bytes") < 0, F.lit(True))),
        ("sha256_missing", F.col("sha256").isNull()),
        ("data_missing", inline & F.col("data").isNull()),
        ("size_mismatch", inline & (F.octet_length("data") != F.col("size_bytes"))),
        ("s3_key_missing", reference & F.col("s3_key").isNull()),
        ("payload_extra_field", (inline & F.col("more_than_inline")) | (reference & F.col("more_than_reference"))),
    ]
    found = F.concat_ws(";", *[F.when(failed, name) for name, failed in checks])
    checked = fields.select(
        "entry_id",
        "job",
        "job_id",
        "trace_id",
        "stage",
        "tenant_id",
        "device_id",
        F.col("_instant").alias("received_at"),
        "pipeline_hint",
        "parent_job_id",
        F.col("attempt").try_cast("int").alias("attempt"),
        "mode",
        "data",
        "s3_key",
        "size_bytes",
        "sha256",
        F.when(~F.col("_is_object"), "not_an_object")
        .otherwise(F.nullif(found, F.lit("")))
        .alias("violations"),
    )
    return fence(checked)
