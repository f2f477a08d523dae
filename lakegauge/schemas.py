"""Table layouts. Names, order, types and nullability are fixed values."""

from pyspark.sql import types as T

SPARK_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def _schema(spec: str) -> T.StructType:
    """'name type' pairs; '!' after the type marks a column that is always filled."""
    schema = T.StructType()
    for item in spec.split(","):
        name, type_name = item.split()
        schema = schema.add(name, SPARK_TYPES[type_name.rstrip("!")], nullable=not type_name.endswith("!"))
    return schema


BRONZE_RAW = _schema(
    "job_id string!, trace_id string!, received_at timestamp!, event_time timestamp, tenant_id string!, "
    "device_id string!, source string!, pipeline_hint string, schema_fp string!, payload string!"
)

DEAD_LETTER = _schema(
    "job_id string!, trace_id string!, stage string!, reason string!, detail string, failed_at timestamp!, "
    "received_at timestamp!, tenant_id string!, device_id string!, attempt int!, s3_key string, "
    "schema_fp string, payload string"
)

SILVER_ENVELOPE = _schema(
    "job_id string!, trace_id string!, tenant_id string!, device_id string!, event_time timestamp!, "
    "received_at timestamp!, mapper_id string!, mapper_version int!"
)

# One queue entry: its id and the descriptor as JSON text.
QUEUE_ENTRY = _schema("entry_id string!, job string")

# What a batch did to one table: the days it wrote, and folders of other batches that its rows replace.
COMMITS = _schema("stage string!, batch_id bigint!, table_name string!, rows_in bigint!, added_records bigint!, duplicates bigint!")
COMMITS = (
    COMMITS.add("days", T.ArrayType(T.DateType()))
    .add("replaces", T.ArrayType(T.StructType().add("batch", T.StringType()).add("day", T.DateType())))
    .add("committed_at", T.TimestampType(), nullable=False)
)

# What a batch added to one table, by day, tenant and mapper, in a form that can be merged; devices are an HLL sketch.
SUMMARIES = _schema("table_name string, tenant_id string, mapper_id string, mapper_version int, n_rows bigint, first_time timestamp, last_time timestamp")
SUMMARIES = SUMMARIES.add("day", T.DateType()).add("devices", T.BinaryType())

STAGES = ("bronze", "silver", "publish")
SOURCE = "http"

# Why a reading was set aside.
BRONZE_REASONS = (
    "unparseable_descriptor",
    "object_missing",
    "fetch_failed",
    "sha256_mismatch",
    "append_failed",
    "invalid_utf8",
)
SILVER_REASONS = ("unresolved", "bad_payload", "bad_value", "missing_value", "out_of_range")
RETRYABLE_REASONS = ("fetch_failed", "append_failed")
MAX_ATTEMPTS = 3
