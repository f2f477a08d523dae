"""Sensor traffic derived from the ``events`` table, so every operator has whole-table input.

The texts below are SQL that Spark and DuckDB read alike; only the two time
formats differ by dialect. Numbers are written from integers, so both engines
produce the same payload bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CENTS = "CAST(round(value * 100) AS BIGINT)"


def _decimal(cents: str) -> str:
    whole = f"CAST(CAST(floor({cents} / 100) AS BIGINT) AS STRING)"
    return f"({whole} || '.' || lpad(CAST({cents} % 100 AS STRING), 2, '0'))"


_VALUE = _decimal(_CENTS)
_USER = "CAST(user_id AS STRING)"

# A payload time: mostly ISO with Z, sometimes another form, sometimes unusable.
_TIME = """(CASE event_id % 13
  WHEN 0 THEN '1803456789'
  WHEN 1 THEN 'null'
  WHEN 2 THEN '"' || {hour} || '+02:00"'
  WHEN 3 THEN '"' || {hour} || '"'
  WHEN 4 THEN '"any-day-now"'
  WHEN 5 THEN '"' || {basic_hour} || '"'
  ELSE '"' || {hour} || 'Z"' END)"""

_TEMP = f"""(CASE event_id % 11
  WHEN 0 THEN 'null' WHEN 1 THEN 'true' WHEN 2 THEN '"hot"' WHEN 3 THEN '" {{v}} "' ELSE '{{v}}' END)""".replace(
    "{v}", f"' || {_VALUE} || '"
).replace("'' || ", "").replace(" || ''", "")

_HUM = "(CASE WHEN event_id % 10 = 0 THEN '1.50' ELSE '0.' || lpad(CAST(event_id % 100 AS STRING), 2, '0') END)"

_TAGS = """(CASE event_id % 5
  WHEN 0 THEN ', "tags": []'
  WHEN 1 THEN ', "tags": [1, "x", null, {"q": true, "r": [{"s": 1}, {"s": "t"}]}, [2.5], [3]]'
  ELSE ', "charge": 64' END)"""

_METER = f"""(CASE event_id % 7
  WHEN 0 THEN '' WHEN 1 THEN '"meter": 21.0, ' ELSE '"meter": "meter-' || CAST(user_id % 50 AS STRING) || '", ' END)"""

_CLICK = (
    f"""'{{"device_id": "dev-' || {_USER} || '", "ts": ' || {_TIME} || CASE WHEN event_id % 11 = 4 THEN ', "tmp": ' """
    f"""ELSE ', "temp": ' END || {_TEMP} || ', "hum": ' || {_HUM} || '}}'"""
)
_VIEW = (
    f"""'{{"time": ' || {_TIME} || ', "measurements": {{"temperature_f": ' || {_VALUE} || ', "rh": ' || """
    f"""CAST(event_id % 100 AS STRING) || '.5}}, "build": "r7-b"' || {_TAGS} || '}}'"""
)
_PURCHASE = (
    f"""'{{"timestamp": ' || {_TIME} || ', "power": ' || {_VALUE} || ', "energy": ' || CAST({_CENTS} AS STRING) || """
    f"""', "current": ' || CASE WHEN event_id % 7 = 0 THEN 'null' ELSE {_decimal('(event_id % 1000)')} END || '}}' || """
    f"""CASE WHEN event_id % 29 = 0 THEN ' trailing' ELSE '' END"""
)
_SIGNUP = (
    f"""'{{' || {_METER} || '"ts": ' || {_TIME} || ', "readings": {{"active_power_kw": ' || {_VALUE} || """
    f"""', "total_kwh": ' || {_decimal('(event_id % 100000)')} || '}}}}'"""
)
_ERROR = f"""CASE event_id % 5
  WHEN 0 THEN '{{"dev": "x", "ts": ' || {_TIME} || ', "t": ' || {_VALUE} || ', "h": 51, "e": {{}}}}'
  WHEN 1 THEN 'not json: ' || {_VALUE}
  WHEN 2 THEN '[1, 2, ' || {_VALUE} || ']'
  WHEN 3 THEN '{{"ts": ' || {_TIME} || ', "flow_lpm": ' || {_VALUE} || ', "total_l": ' || CAST({_CENTS} AS STRING) || '}}'
  ELSE '{{"ts": ' || {_TIME} || ', "power": 5, "energy": 7, "temp": 20.5, "hum": ' || {_HUM} || '}}' END"""

_READINGS = f"""
  lpad(CAST(event_id AS STRING), 26, '0') AS job_id,
  md5(CAST(event_id AS STRING)) AS trace_id,
  {{received}} AS received_at,
  't' || CAST(user_id % 4 AS STRING) AS tenant_id,
  'dev-' || {_USER} AS device_id,
  CASE WHEN event_id % 17 = 0 THEN 'indoor-air-quality' WHEN event_id % 19 = 0 THEN 'nobody-known'
       WHEN event_id % 23 = 0 THEN 'water-meter' END AS pipeline_hint,
  event_id,
  CASE event_type WHEN 'click' THEN {_CLICK} WHEN 'view' THEN {_VIEW} WHEN 'purchase' THEN {_PURCHASE}
       WHEN 'signup' THEN {_SIGNUP} ELSE {_ERROR} END AS payload
"""

_SPARK = {
    "hour": "date_format(date_trunc('hour', ts), \"yyyy-MM-dd'T'HH:mm:ss\")",
    "basic_hour": "date_format(date_trunc('hour', ts), \"yyyyMMdd'T'HHmmss'Z'\")",
    "received": "CAST(ts AS TIMESTAMP)",
}
_DUCKDB = {
    "hour": "strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S')",
    "basic_hour": "strftime(date_trunc('hour', ts), '%Y%m%dT%H%M%SZ')",
    "received": "ts",
}


def _in(dialect: dict[str, str]) -> str:
    text = _READINGS
    for name, sql in dialect.items():
        text = text.replace("{" + name + "}", sql)
    return text


READINGS_SQL = f"SELECT {_in(_DUCKDB)} FROM events"


def events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Columns of ``events``, dealt out to all tasks.

    A scan has at most as many tasks with rows as the file has row groups, which may be one for a million rows. Rows
    are small here, and all that is made of one is worked out where it lies, so they are dealt out before.
    """
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(*columns).repartition(tasks)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per event: envelope columns, ``event_id`` and ``payload``."""
    source = events(spark, sf_dir, "event_id", "ts", "user_id", "event_type", "value")
    view = f"lakegauge_events_{abs(hash(sf_dir))}"
    source.createOrReplaceTempView(view)
    return spark.sql(f"SELECT {_in(_SPARK)} FROM {view}")


# --- the same readings as queue entries ------------------------------------

# Every seventh reading travels by reference. A few have a wrong digest, a missing
# object, a fetch that fails, bytes that are not UTF-8, or a broken descriptor.
IS_REFERENCE = "event_id % 7 = 3"
WRONG_DIGEST = "event_id % 23 = 5"
MISSING_OBJECT = f"({IS_REFERENCE} AND event_id % 3 = 1)"
FAILED_FETCH = f"({IS_REFERENCE} AND event_id % 9 = 2)"
BAD_BYTES = f"({IS_REFERENCE} AND event_id % 11 = 6)"
ATTEMPT = "CAST(1 + event_id % 4 AS INT)"
LANDING_KEY = "('2026/11/27/' || job_id || '.json')"

# (condition, name of the broken field, its JSON value or NULL to leave it out)
FAULTS = (
    ("event_id % 41 = 1", "received_at", "'\"2026-12-06T10:00:00\"'"),
    ("event_id % 41 = 2", "stage", "'\"gold\"'"),
    ("event_id % 41 = 3", "attempt", "'0'"),
    ("event_id % 41 = 4", "tenant_id", "NULL"),
    ("event_id % 41 = 5", "pipeline_hint", "'7'"),
    ("event_id % 41 = 6", "undeclared", "'\"value\"'"),
    ("event_id % 41 = 7", "size_bytes", "'999999'"),
    ("event_id % 41 = 8", "mode", "'\"smoke-signal\"'"),
    ("event_id % 41 = 9", "sha256", "NULL"),
    ("event_id % 41 = 10", "size_bytes", "'\"12\"'"),
    ("event_id % 41 = 13", "attempt", "'3000000000'"),
)
# Readings whose descriptor is unusable: the faults above, a tail and no text. Nobody checks the size of a reference.
BROKEN = f"(event_id % 41 BETWEEN 1 AND 13 AND NOT (event_id % 41 = 7 AND {IS_REFERENCE}))"


def queue_entries(spark: SparkSession, sf_dir: str, mended: bool = False) -> DataFrame:
    """Readings as descriptors: ``entry_id`` and ``job`` text.

    ``mended`` gives those of the broken ones as they are sent again, without a fault.
    """
    rows = readings(spark, sf_dir)
    if mended:
        rows = rows.filter(BROKEN)
    reference = F.expr(IS_REFERENCE)
    digest = F.when(F.expr(WRONG_DIGEST), F.repeat(F.lit("0"), 64)).otherwise(F.sha2(body(), 256))

    def quoted(c) -> F.Column:
        return F.concat(F.lit('"'), c, F.lit('"'))

    def fault(name: str, usual):
        out = usual
        for condition, field, value in () if mended else FAULTS:
            if field == name:
                out = F.when(F.expr(condition), F.expr(f"CAST({value} AS STRING)")).otherwise(out)
        return out

    def member(name: str, value):
        # a NULL value leaves the member out
        return F.concat(F.lit(f'"{name}":'), value)

    data = F.regexp_replace("payload", r'(["\\])', r"\\$1")
    payload = F.concat_ws(
        ",",
        member("mode", fault("mode", F.when(reference, '"reference"').otherwise('"inline"'))),
        F.when(reference, member("s3_key", quoted(F.expr(LANDING_KEY)))).otherwise(member("data", quoted(data))),
        member("size_bytes", fault("size_bytes", F.octet_length(body()).cast("string"))),
        member("sha256", fault("sha256", quoted(digest))),
    )
    received = F.date_format("received_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    no_text = F.lit(None).cast("string")
    job = F.concat_ws(
        ",",
        member("job_id", quoted(F.col("job_id"))),
        member("trace_id", quoted(F.col("trace_id"))),
        member("stage", fault("stage", F.lit('"bronze"'))),
        member("tenant_id", fault("tenant_id", quoted(F.col("tenant_id")))),
        member("device_id", quoted(F.col("device_id"))),
        member("received_at", fault("received_at", quoted(received))),
        F.concat(F.lit('"payload":{'), payload, F.lit("}")),
        member("pipeline_hint", fault("pipeline_hint", quoted(F.col("pipeline_hint")))),
        member("attempt", fault("attempt", F.expr(ATTEMPT).cast("string"))),
        member("undeclared", fault("undeclared", no_text)),
    )
    entry = F.concat(F.lit("{"), job, F.lit("}"))
    if not mended:
        entry = F.when(F.expr("event_id % 41 = 11"), F.concat(entry, F.lit(" tail"))).when(
            F.expr("event_id % 41 = 12"), no_text
        ).otherwise(entry)
    return rows.select(F.concat(F.lit("entry-"), F.col("event_id").cast("string")).alias("entry_id"), entry.alias("job"))


def body() -> F.Column:
    """Payload bytes as they were received; some landed ones are not UTF-8."""
    text = F.col("payload").cast("binary")
    return F.when(F.expr(BAD_BYTES), F.concat(text, F.unhex(F.lit("FF")))).otherwise(text)


def landing_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed objects of the reference readings: ``key``, ``content``, ``fetch_error``."""
    landed = readings(spark, sf_dir).filter(IS_REFERENCE).filter(f"NOT {MISSING_OBJECT}")
    failed = F.expr(FAILED_FETCH)
    return landed.select(
        F.expr(LANDING_KEY).alias("key"),
        F.when(~failed, body()).alias("content"),
        F.when(failed, "fetch timed out").alias("fetch_error"),
    )
