"""The registered queries in plain SQL, written from the rules and not from the Spark code."""

from __future__ import annotations

from lakegauge.plans.queries import AIR, ENERGY, NEWER_POWER, SLICE, TYPED_PAYLOAD, WATER
from lakegauge.plans.readings import (
    ATTEMPT, BAD_BYTES, FAILED_FETCH, FAULTS, IS_REFERENCE, LANDING_KEY, MISSING_OBJECT, READINGS_SQL, WRONG_DIGEST,
)

A, B, C, E, W = "indoor-air-quality", "vendor-b-airquality", "vendor-c-energy", "iot-energy", "water-meter"


def stamp(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%dT%H:%M:%S.%f')"


def iso(expr: str) -> str:
    """The time forms the derived readings hold."""
    return f"""(CASE WHEN regexp_full_match({expr}, '\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}Z?')
        THEN strptime(left({expr}, 19), '%Y-%m-%dT%H:%M:%S')
      WHEN regexp_full_match({expr}, '\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}\\+02:00')
        THEN strptime(left({expr}, 19), '%Y-%m-%dT%H:%M:%S') - INTERVAL 2 HOUR
      WHEN regexp_full_match({expr}, '\\d{{8}}T\\d{{6}}Z') THEN strptime({expr}, '%Y%m%dT%H%M%SZ') END)"""


def get(path: str, source: str = "js") -> str:
    return f"json_extract_string({source}, '$.{path}')"


def has(*paths: str) -> str:
    return "(js IS NOT NULL AND " + " AND ".join(f"json_exists(js, '$.{p}')" for p in paths) + ")"


def num(path: str) -> str:
    return f"""(CASE json_type(js, '$.{path}') WHEN 'BOOLEAN' THEN CASE {get(path)} WHEN 'true' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
      WHEN 'NULL' THEN NULL ELSE TRY_CAST(trim({get(path)}) AS DOUBLE) END)"""


def bad(path: str) -> str:
    return f"coalesce(json_type(js, '$.{path}') NOT IN ('NULL') AND {num(path)} IS NULL, false)"


def kind(json_type: str) -> str:
    return f"""(CASE {json_type} WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'bool' WHEN 'VARCHAR' THEN 'string'
      WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' ELSE 'number' END)"""


READINGS = f"readings AS ({READINGS_SQL})"
PARSED = f"""{READINGS},
parsed AS (SELECT *, CASE WHEN json_valid(payload) THEN CASE WHEN json_type(payload) = 'OBJECT' THEN payload END END AS js,
  json_valid(payload) AS valid FROM readings)"""
TIMED = f"""{PARSED},
timed AS (SELECT *, coalesce({iso(get('ts'))}, {iso(get('timestamp'))}, {iso(get('time'))}, received_at) AS bronze_time FROM parsed)"""

_MATCH = {
    A: has("temp", "hum"),
    E: has("power", "energy"),
    B: has("measurements.temperature_f", "measurements.rh"),
    C: has("readings.active_power_kw", "readings.total_kwh"),
    W: has("flow_lpm", "total_l"),
}
_RESOLVE = (
    f"CASE WHEN pipeline_hint IN ({', '.join(repr(m) for m in _MATCH)}) THEN pipeline_hint "
    + " ".join(f"WHEN {test} THEN '{m}'" for m, test in _MATCH.items())
    + " END"
)
# mapper -> (path, value, low, high) per column, in order
_COLUMNS = {
    A: [("temp", num("temp"), -40, 85), ("hum", f"{num('hum')} * 100::DOUBLE", 0, 100)],
    E: [("power", num("power"), 0, None), ("energy", num("energy"), 0, None), ("current", num("current"), 0, None)],
    B: [
        ("measurements.temperature_f", f"({num('measurements.temperature_f')} - 32::DOUBLE) * 5::DOUBLE / 9::DOUBLE", -40, 85),
        ("measurements.rh", num("measurements.rh"), 0, 100),
    ],
    C: [
        ("readings.active_power_kw", f"{num('readings.active_power_kw')} * 1000::DOUBLE", 0, None),
        ("readings.total_kwh", f"{num('readings.total_kwh')} * 1000::DOUBLE", 0, None),
    ],
    W: [("flow_lpm", num("flow_lpm"), 0, None), ("total_l", num("total_l"), 0, None)],
}


def _reason(mapper: str) -> str:
    checks = []
    for path, value, low, high in _COLUMNS[mapper]:
        limits = f"{value} < {low}" + (f" OR {value} > {high}" if high is not None else "")
        checks.append(f"WHEN {bad(path)} THEN 'bad_value' WHEN {limits} THEN 'out_of_range'")
    return f"CASE {' '.join(checks)} END"


_NAMES = {A: ("temperature", "humidity"), B: ("temperature", "humidity"), C: ("power", "energy"), E: ("power", "energy", "current"), W: ("flow", "volume")}


def _detail(mapper: str) -> str:
    """The first column that fails: its name, path and value, and the bounds if these are the reason. Numbers lose closing zeros."""
    checks = []
    for (path, value, low, high), name in zip(_COLUMNS[mapper], _NAMES[mapper], strict=True):
        raw = f"CASE WHEN json_type(js, '$.{path}') = 'DOUBLE' THEN rtrim(rtrim(json_extract(js, '$.{path}')::VARCHAR, '0'), '.') ELSE json_extract(js, '$.{path}')::VARCHAR END"
        shown = f"'{name} <- {path}=' || {raw}"
        limits = f"{value} < {low}" + (f" OR {value} > {high}" if high is not None else "")
        checks.append(f"WHEN {bad(path)} THEN {shown} WHEN {limits} THEN {shown} || ' not within [{low}, {'' if high is None else high}]'")
    return f"CASE {' '.join(checks)} END"


def _value(**by_mapper: int) -> str:
    names = {"a": A, "b": B, "c": C, "e": E, "w": W}
    cases = " ".join(f"WHEN '{names[k]}' THEN {_COLUMNS[names[k]][n][1]}" for k, n in by_mapper.items())
    return f"CASE mapper_id {cases} END"


MAPPED = f"""{TIMED},
resolved AS (SELECT *, {_RESOLVE} AS mapper_id FROM timed),
mapped AS (SELECT job_id, trace_id, tenant_id, device_id AS bronze_device_id, received_at, payload, event_id, bronze_time, mapper_id,
  CASE WHEN mapper_id = '{C}' THEN coalesce({get('meter')}, device_id) ELSE device_id END AS device_id,
  coalesce(CASE mapper_id WHEN '{A}' THEN {iso(get('ts'))} WHEN '{E}' THEN {iso(get('timestamp'))} WHEN '{B}' THEN {iso(get('time'))}
    ELSE {iso(get('ts'))} END, bronze_time) AS event_time,
  CASE WHEN mapper_id IS NOT NULL THEN 1 END AS mapper_version,
  CASE WHEN mapper_id IN ('{A}', '{B}') THEN '{AIR}' WHEN mapper_id IN ('{C}', '{E}') THEN '{ENERGY}' WHEN mapper_id = '{W}' THEN '{WATER}' END AS target_table,
  CASE WHEN mapper_id IS NULL THEN 'unresolved' WHEN js IS NULL THEN 'bad_payload' ELSE
    CASE mapper_id {' '.join(f"WHEN '{m}' THEN {_reason(m)}" for m in _COLUMNS)} END END AS reason,
  CASE mapper_id {' '.join(f"WHEN '{m}' THEN {_detail(m)}" for m in _COLUMNS)} END AS detail,
  {_value(a=0, b=0)} AS temperature, {_value(a=1, b=1)} AS humidity,
  {_value(c=0, e=0)} AS power, {_value(c=1, e=1)} AS energy, {_value(e=2)} AS current,
  {_value(w=0)} AS flow, {_value(w=1)} AS volume
  FROM resolved)"""

_MEASURES = {AIR: ("humidity", "temperature"), ENERGY: ("current", "energy", "power"), WATER: ("flow", "volume")}


def kept(target: str, keys: str = "device_id, event_time", order: str = "received_at, job_id", source: str = "mapped") -> str:
    return f"""SELECT * FROM {source} WHERE target_table = '{target}' AND reason IS NULL
      QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"""


def silver(target: str) -> str:
    return f"""SELECT job_id, trace_id, tenant_id, device_id, {stamp('event_time')} AS event_time, {stamp('received_at')} AS received_at,
      mapper_id, mapper_version, {', '.join(_MEASURES[target])} FROM ({kept(target)})"""


def shapes(source: str, text: str, keep: str = "true") -> str:
    """CTEs ending in ``shapes(job_id, schema_fp)``: leaves out of json_tree, hashed."""
    return f"""
nodes AS (SELECT s.job_id, t.id, t.parent, t.type, t.fullkey,
    regexp_replace(regexp_replace(t.fullkey, '^\\$\\.?', ''), '\\[\\d+\\]', '[]', 'g') AS path
  FROM (SELECT job_id, {text} AS j FROM {source} WHERE {text} IS NOT NULL AND {keep}) s, json_tree(s.j) t),
linked AS (SELECT n.*, p.type AS parent_type, {kind('n.type')} AS kind FROM nodes n LEFT JOIN nodes p ON p.job_id = n.job_id AND p.id = n.parent AND n.id <> p.id),
array_kinds AS (SELECT job_id, parent AS id, string_agg(DISTINCT kind, '|' ORDER BY kind) AS kinds FROM linked WHERE parent_type = 'ARRAY' GROUP BY ALL),
leaves AS (
  SELECT job_id, path || ':' || kind AS leaf, CASE WHEN contains(fullkey, '[') THEN regexp_extract(fullkey, '^[^\\[]*') END AS owner
    FROM linked WHERE type NOT IN ('OBJECT', 'ARRAY') AND parent_type IS DISTINCT FROM 'ARRAY'
  UNION ALL
  SELECT l.job_id, l.path || '[]:' || coalesce(a.kinds, 'empty'), regexp_extract(l.fullkey, '^[^\\[]*') FROM linked l LEFT JOIN array_kinds a USING (job_id, id) WHERE l.type = 'ARRAY'),
counted AS (SELECT job_id, leaf FROM leaves WHERE owner IS NULL UNION ALL SELECT job_id, leaf FROM (SELECT DISTINCT job_id, owner, leaf FROM leaves WHERE owner IS NOT NULL)),
hashed AS (SELECT job_id, left(sha256('["' || string_agg(leaf, '","' ORDER BY leaf) || '"]'), 12) AS schema_fp FROM counted GROUP BY job_id)"""


EMPTY = "left(sha256('[]'), 12)"
_BRONZE = f"""WITH {TIMED}, {shapes('parsed', 'js')},
bronze AS (SELECT t.*, coalesce(h.schema_fp, {EMPTY}) AS schema_fp FROM timed t LEFT JOIN hashed h USING (job_id))"""

# --- queue entries ---------------------------------------------------------

# What each broken descriptor is reported as; the first eleven groups of 41 are broken.
_REPORTED = {
    1: "received_at_naive", 2: "stage_unknown", 3: "attempt_invalid", 4: "tenant_id_missing", 5: "pipeline_hint_type", 6: "extra_field",
    8: "mode_unknown", 9: "sha256_missing", 10: "size_bytes_invalid", 13: "attempt_invalid", 11: "not_an_object", 12: "not_an_object",
}
assert len(FAULTS) == 11
_BYTES = f"(strlen(payload) + CASE WHEN {BAD_BYTES} THEN 1 ELSE 0 END)"
_VIOLATION = (
    f"CASE event_id % 41 {' '.join(f'WHEN {n} THEN {v!r}' for n, v in _REPORTED.items())} "
    f"WHEN 7 THEN CASE WHEN NOT ({IS_REFERENCE}) THEN 'size_mismatch' END END"
)
_NO_JOB = "event_id % 41 IN (11, 12)"
_JOBS = f"""{READINGS},
jobs AS (SELECT *, 'entry-' || event_id AS entry_id, {ATTEMPT} AS attempt, {IS_REFERENCE} AS is_reference, {LANDING_KEY} AS landing_key,
  CASE WHEN {IS_REFERENCE} THEN 'reference' ELSE 'inline' END AS mode, {_VIOLATION} AS violations,
  CASE WHEN {FAILED_FETCH} THEN 'fetch_failed' WHEN {MISSING_OBJECT} THEN 'object_missing' WHEN {WRONG_DIGEST} THEN 'sha256_mismatch'
    WHEN {BAD_BYTES} THEN 'invalid_utf8' END AS reason
  FROM readings)"""
# FAILED_FETCH only shows for objects that were landed at all
_JOBS = _JOBS.replace(f"WHEN {FAILED_FETCH} THEN", f"WHEN {FAILED_FETCH} AND NOT {MISSING_OBJECT} THEN")
_FAILED_PAYLOAD = "reason = 'sha256_mismatch' AND NOT bad_bytes"
_OUTCOMES = f"""{_JOBS},
outcomes AS (SELECT *, {BAD_BYTES} AS bad_bytes FROM jobs WHERE violations IS NULL)"""

_BRONZE_DETAIL = f"""CASE reason WHEN 'fetch_failed' THEN 'fetch timed out' WHEN 'object_missing' THEN 'no object at ' || landing_key
  WHEN 'sha256_mismatch' THEN 'got ' || sha256(encode(payload) || CASE WHEN bad_bytes THEN unhex('FF') ELSE ''::BLOB END) || ', expected ' || repeat('0', 64)
  ELSE 'payload bytes are not UTF-8' END"""

_TYPED = f"""WITH source AS (SELECT *, CAST(CAST(round(value * 100) AS BIGINT) AS STRING) AS c, CAST(round(value * 100) AS BIGINT) AS cents FROM events),
made AS (SELECT *, {TYPED_PAYLOAD} AS payload FROM source),
cast_values AS (SELECT event_id, lpad(CAST(event_id AS STRING), 26, '0') AS job_id,
  CASE event_id % 8 WHEN 0 THEN cents WHEN 1 THEN cents WHEN 2 THEN cents WHEN 3 THEN cents * 10 WHEN 4 THEN 1 WHEN 7 THEN -cents END AS n,
  CASE event_id % 5 WHEN 0 THEN c WHEN 1 THEN c WHEN 2 THEN c || '.5' WHEN 3 THEN 'False' END AS s,
  CASE event_id % 7 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN false WHEN 3 THEN cents <> 0 WHEN 4 THEN false WHEN 5 THEN true ELSE true END AS b,
  CASE event_id % 6 WHEN 0 THEN '2026-11-19T15:26:41.000000' WHEN 1 THEN '2026-11-19T00:00:00.000000' WHEN 2 THEN '2026-11-19T00:00:00.000000'
    WHEN 4 THEN '2026-11-19T17:26:00.000000' WHEN 5 THEN '2026-11-20T00:00:00.000000' END AS t,
  CASE event_id % 9 WHEN 2 THEN 1000::DOUBLE WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 3 THEN NULL ELSE cents::DOUBLE END AS d FROM made),
judged AS (SELECT *, CASE WHEN event_id % 8 = 6 THEN 'bad_value' WHEN n < 0 OR n > 30000 THEN 'out_of_range'
  WHEN event_id % 9 IN (0, 1) THEN 'missing_value' WHEN event_id % 9 = 3 THEN 'bad_value' END AS reason FROM cast_values)
SELECT job_id, reason, CASE WHEN reason IS NULL THEN n END AS n, CASE WHEN reason IS NULL THEN s END AS s, CASE WHEN reason IS NULL THEN b END AS b,
  CASE WHEN reason IS NULL THEN t END AS t, CASE WHEN reason IS NULL THEN d END AS d FROM judged"""

_MIDDLE = "TIMESTAMP '2024-01-16 00:00:00'"
_START, _END = SLICE["start"].strftime("%Y-%m-%d %H:%M:%S"), SLICE["end"].strftime("%Y-%m-%d %H:%M:%S")
_SLICE = f"""slice AS (SELECT * FROM ({kept(AIR)}) WHERE tenant_id = '{SLICE['tenant_id']}'
  AND event_time >= TIMESTAMP '{_START}' AND event_time < TIMESTAMP '{_END}' ORDER BY event_time, device_id, job_id LIMIT {SLICE['limit']})"""
_SILVER_JOBS = " UNION ALL ".join(f"SELECT job_id FROM ({kept(t)})" for t in _MEASURES)
_LAYERS = f"""WITH {MAPPED}, silver AS ({_SILVER_JOBS}),
layers AS (SELECT m.job_id, bronze_device_id AS device_id, CASE WHEN reason IS NOT NULL THEN 'dead_letter' WHEN s.job_id IS NOT NULL THEN 'silver' ELSE 'duplicate' END AS outcome
  FROM mapped m LEFT JOIN silver s USING (job_id))"""
# The streamed readings are those of usable entries whose bytes could be had.
_STREAMED = f"""{MAPPED}, {_OUTCOMES.replace(READINGS + ',', '')},
arrived AS (SELECT m.* FROM mapped m JOIN outcomes o USING (job_id) WHERE o.reason IS NULL)"""
_AGAIN = "reason = 'fetch_failed' AND attempt < 3"


def _text_of(expr: str) -> str:
    """2024-01-05 00:00:00[.ffffff]+00:00"""
    return f"(strftime({expr}, '%Y-%m-%d %H:%M:%S') || CASE WHEN strftime({expr}, '%f') <> '000000' THEN '.' || strftime({expr}, '%f') ELSE '' END || '+00:00')"


_TOO_MUCH = f"mapper_id = '{E}' AND coalesce(power, 0) > {NEWER_POWER}"
_BASE = "https://example.org/sensors"
# name -> what it measures, and in which unit
_ABOUT = {
    "temperature": ("qudt:Temperature", "unit:DEG_C"), "humidity": ("qudt:RelativeHumidity", "unit:PERCENT_RH"), "power": ("qudt:Power", "unit:W"),
    "energy": ("qudt:Energy", "unit:W-HR"), "current": ("qudt:current", "unit:Amper"), "flow": ("qudt:VolumeFlowRate", "unit:L-PER-MIN"), "volume": ("qudt:Volume", "unit:L"),
}
_LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT job_id, tenant_id, device_id, event_time, '{t.replace('silver_', 'silver.')}' AS table_name, '{c}' AS name, {c} AS value, '{_ABOUT[c][0]}' AS property_iri, '{_ABOUT[c][1]}' AS unit FROM ({kept(t)}) WHERE {c} IS NOT NULL"
    for t, names in _MEASURES.items()
    for c in names
) + ")"
_ALL_KEPT = "all_kept AS (" + " UNION ALL ".join(f"SELECT * FROM ({kept(t)})" for t in _MEASURES) + ")"

_KIND_PATHS = ("ts", "time", "temp", "hum", "tags", "measurements", "measurements.rh", "current", "meter", "e")

ORACLE: dict[str, str] = {
    "admission_checks": """WITH bodies AS (SELECT doc_id, CASE WHEN doc_id % 29 = 0 THEN 0 ELSE strlen(text) + CASE WHEN doc_id % 31 = 0 THEN 1 ELSE 0 END END AS size_bytes FROM documents)
        SELECT doc_id, size_bytes, CASE WHEN doc_id % 37 = 0 THEN 'missing_device_id' WHEN doc_id % 41 = 0 THEN 'missing_tenant_id'
          WHEN size_bytes > 65536 THEN 'request_too_large' WHEN size_bytes = 0 THEN 'empty_body' WHEN doc_id % 31 = 0 AND doc_id % 29 <> 0 THEN 'not_utf8' END AS admit_reason FROM bodies""",
    "size_route": f"""WITH bodies AS (SELECT lpad(doc_id::VARCHAR, 26, '0') AS job_id, text, doc_id AS minute FROM documents
          UNION ALL SELECT 'c-' || conv_id || '-' || turn, text, conv_id FROM conversations),
        sized AS (SELECT *, strlen(text) AS size_bytes, TIMESTAMP '2026-01-01' + to_minutes(minute) AS received_at FROM bodies)
        SELECT job_id, size_bytes, sha256(text) AS sha256, CASE WHEN size_bytes <= 1024 THEN 'inline' ELSE 'reference' END AS mode,
          CASE WHEN size_bytes > 1024 THEN strftime(received_at, '%Y/%m/%d') || '/' || job_id || '.json' END AS s3_key,
          CASE WHEN size_bytes <= 1024 THEN size_bytes END AS inline_bytes FROM sized""",
    "envelope_stamp": f"""SELECT event_id, upper(left(sha256('events/' || event_id), 26)) AS job_id, left(sha256('trace/events/' || event_id), 32) AS trace_id,
          {stamp('ts')} AS received_at, 'bronze' AS stage, 1 AS attempt FROM events""",
    "queue_round_trip": f"""WITH {READINGS} SELECT job_id, device_id, pipeline_hint, {stamp('received_at')} AS received_at,
          CASE WHEN strlen(payload) <= 100 THEN 'inline' ELSE 'reference' END AS mode,
          CASE WHEN strlen(payload) > 100 THEN strftime(received_at, '%Y/%m/%d') || '/' || job_id || '.json' END AS s3_key, sha256(payload) AS sha256,
          CASE WHEN strlen(payload) <= 100 THEN sha256(payload) END AS data_sha256, NULL::VARCHAR AS violations FROM readings""",
    "descriptor_validate": f"""WITH {_JOBS} SELECT entry_id, violations, CASE WHEN NOT ({_NO_JOB}) THEN job_id END AS job_id,
          CASE WHEN NOT ({_NO_JOB}) AND event_id % 41 <> 4 THEN tenant_id END AS tenant_id,
          CASE WHEN NOT ({_NO_JOB}) THEN CASE event_id % 41 WHEN 8 THEN 'smoke-signal' ELSE mode END END AS mode,
          CASE WHEN NOT ({_NO_JOB}) AND event_id % 41 <> 10 THEN CASE event_id % 41 WHEN 7 THEN 999999 ELSE {_BYTES} END END AS size_bytes,
          CASE WHEN {_NO_JOB} THEN 1 WHEN event_id % 41 = 3 THEN 0 WHEN event_id % 41 <> 13 THEN attempt END AS attempt,
          CASE WHEN NOT ({_NO_JOB}) THEN CASE event_id % 41 WHEN 1 THEN '2026-12-06T10:00:00.000000' ELSE {stamp('received_at')} END END AS received_at FROM jobs""",
    "landing_fetch": f"""WITH {_JOBS} SELECT job_id, mode, CASE WHEN is_reference THEN landing_key END AS s3_key,
          CASE WHEN coalesce(reason, '') NOT IN ('fetch_failed', 'object_missing') THEN {_BYTES} END AS content_bytes,
          CASE WHEN coalesce(reason, '') NOT IN ('fetch_failed', 'object_missing') THEN sha256(encode(payload) || CASE WHEN {BAD_BYTES} THEN unhex('FF') ELSE ''::BLOB END) END AS content_sha256,
          CASE WHEN reason = 'fetch_failed' THEN 'fetch timed out' END AS fetch_error FROM jobs""",
    "integrity_check": f"""WITH {_JOBS} SELECT job_id, mode, reason, CASE WHEN coalesce(reason, '') NOT IN ('fetch_failed', 'object_missing') AND NOT {BAD_BYTES} THEN strlen(payload) END AS payload_bytes FROM jobs""",
    "bronze_rows": f"""{_BRONZE}, {_OUTCOMES.replace(READINGS + ',', '')}
        SELECT b.job_id, b.trace_id, {stamp('b.received_at')} AS received_at, {stamp('b.bronze_time')} AS event_time, b.tenant_id, b.device_id, 'http' AS source,
          b.pipeline_hint, b.schema_fp, b.payload FROM bronze b JOIN outcomes o USING (job_id) WHERE o.reason IS NULL""",
    "bronze_dead_letters": f"""WITH {PARSED}, {shapes('parsed', 'payload', 'valid')}, {_OUTCOMES.replace(READINGS + ',', '')}
        SELECT o.job_id, trace_id, 'bronze' AS stage, reason, {_BRONZE_DETAIL} AS detail, tenant_id, device_id, attempt, CASE WHEN is_reference THEN landing_key END AS s3_key,
          CASE WHEN {_FAILED_PAYLOAD} THEN h.schema_fp END AS schema_fp, CASE WHEN {_FAILED_PAYLOAD} THEN sha256(payload) END AS payload_sha256
        FROM outcomes o LEFT JOIN hashed h USING (job_id) WHERE reason IS NOT NULL AND NOT (reason = 'fetch_failed' AND attempt < 3)
        UNION ALL SELECT entry_id, '', 'bronze', 'unparseable_descriptor', 'descriptor failed validation: ' || violations, '', '', 1, NULL, NULL, NULL FROM jobs WHERE violations IS NOT NULL""",
    "bounded_retry": f"""WITH {_OUTCOMES} SELECT job_id || '/' || (attempt + 1) AS entry_id, job_id, landing_key AS s3_key,
          CASE event_id % 41 WHEN 7 THEN 999999 ELSE {_BYTES} END AS size_bytes, attempt + 1 AS attempt, NULL::VARCHAR AS violations
        FROM outcomes WHERE reason = 'fetch_failed' AND attempt < 3""",
    "redrive_dead_letters": f"""WITH {_OUTCOMES} SELECT job_id || '/' || (attempt + 1) AS entry_id, job_id, mode, landing_key AS s3_key, attempt + 1 AS attempt, NULL::VARCHAR AS violations
        FROM outcomes WHERE reason = 'fetch_failed' AND attempt < 3""",
    "event_time_extract": f"WITH {TIMED} SELECT job_id, {stamp('bronze_time')} AS event_time FROM timed",
    "json_kinds": f"WITH {PARSED} SELECT path, kind, count(*) AS n FROM ("
    + " UNION ALL ".join(
        f"SELECT '{p.replace('.', '_')}' AS path, CASE WHEN js IS NULL OR NOT json_exists(js, '$.{p}') THEN 'missing' ELSE {kind(f'''json_type(js, '$.{p}')''')} END AS kind FROM parsed"
        for p in _KIND_PATHS
    )
    + ") GROUP BY ALL",
    "fingerprint_groups": f"{_BRONZE} SELECT schema_fp, count(*) AS n, min(job_id) AS first_job_id FROM bronze GROUP BY ALL",
    "fingerprint_any_json": f"""WITH {PARSED}, {shapes('parsed', 'payload', 'valid')}
        SELECT job_id, h.schema_fp, js IS NOT NULL AS is_object FROM parsed LEFT JOIN hashed h USING (job_id)""",
    "props_shapes": f"""SELECT event_type, CASE WHEN json_type(props, '$.k') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN left(sha256('["k:number"]'), 12) END AS schema_fp, count(*) AS n, 0 AS n_empty FROM events GROUP BY ALL""",
    "resolve_counts": f"WITH {MAPPED} SELECT mapper_id, count(*) AS n FROM mapped GROUP BY ALL",
    "resolve_ambiguous": f"WITH {PARSED} SELECT matches, count(*) AS n FROM (SELECT {' + '.join(f'{test}::INT' for test in _MATCH.values())} AS matches FROM parsed) GROUP BY ALL",
    "mapped_verdicts": f"WITH {MAPPED} SELECT job_id, mapper_id, mapper_version, target_table, reason FROM mapped",
    **{target: f"WITH {MAPPED} {silver(target)}" for target in _MEASURES},
    "silver_dead_letters": f"""{_BRONZE.replace('WITH ' + TIMED, 'WITH ' + MAPPED)}
        SELECT m.job_id, 'silver' AS stage, m.reason, CASE m.reason WHEN 'unresolved' THEN 'nobody reads this shape (' || b.schema_fp || '), hinted at ' || coalesce(b.pipeline_hint, 'nobody')
          WHEN 'bad_payload' THEN 'expected a JSON object' ELSE m.detail END AS detail, m.tenant_id, m.bronze_device_id AS device_id, 1 AS attempt, b.schema_fp, {stamp('m.received_at')} AS received_at
        FROM mapped m JOIN bronze b USING (job_id) WHERE m.reason IS NOT NULL""",
    "typed_casts": _TYPED,
    "dedup_against_existing": f"""WITH {MAPPED}, air AS (SELECT * FROM mapped WHERE target_table = '{AIR}' AND reason IS NULL),
        early AS (SELECT * FROM air WHERE received_at < {_MIDDLE}),
        batch AS (SELECT job_id, device_id, event_time, received_at, temperature, humidity FROM air WHERE received_at >= {_MIDDLE}
          UNION ALL SELECT 'copy-' || job_id, device_id, event_time, received_at + INTERVAL 60 DAY, temperature, humidity FROM early),
        existing AS (SELECT * FROM (SELECT * FROM early QUALIFY row_number() OVER (PARTITION BY device_id, event_time ORDER BY received_at, job_id) = 1) WHERE substr(job_id, 26, 1) < '7'),
        firsts AS (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY device_id, event_time ORDER BY received_at, job_id) = 1)
        SELECT job_id, device_id, {stamp('event_time')} AS event_time, temperature, humidity FROM firsts ANTI JOIN existing USING (device_id, event_time)""",
    "dedup_counts": f"""WITH {MAPPED} SELECT target_table, count(*) AS mapped, count(DISTINCT (device_id, event_time)) AS written, count(*) - count(DISTINCT (device_id, event_time)) AS duplicates
        FROM mapped WHERE reason IS NULL GROUP BY ALL""",
    "dedup_last_per_tenant": f"""WITH {MAPPED} SELECT job_id, tenant_id, device_id, {stamp('event_time')} AS event_time, power, energy, current
        FROM ({kept(ENERGY, 'tenant_id, device_id, event_time', 'received_at DESC, job_id DESC')})""",
    "publish_slice": f"""WITH {MAPPED}, {_SLICE} SELECT job_id, trace_id, tenant_id, device_id, {stamp('event_time')} AS event_time, {stamp('received_at')} AS received_at, mapper_id, mapper_version, humidity, temperature FROM slice""",
    "publish_metadata": f"""WITH {MAPPED}, {_SLICE} SELECT '{AIR}' AS "table", 't1' AS tenant_id, NULL::VARCHAR AS device_id, '{_START}+00:00' AS "from", '{_END}+00:00' AS "to",
        {SLICE['limit']} AS "limit", count(*) AS count, 't1/{AIR}/slice-0001.json' AS key FROM slice""",
    "publish_rows_as_json": f"""WITH {MAPPED} SELECT tenant_id || '/{WATER}/' || job_id || '.json' AS key,
        'job_id,trace_id,tenant_id,device_id,event_time,received_at,mapper_id,mapper_version,flow,volume,nothing' AS fields, NULL::VARCHAR AS nothing,
        job_id, trace_id, tenant_id, device_id, {_text_of('event_time')} AS event_time, {_text_of('received_at')} AS received_at, mapper_id,
        mapper_version::DOUBLE AS mapper_version, flow, volume FROM ({kept(WATER)})""",
    "publish_tenant_check": """SELECT c_custkey, tenant_id, regexp_full_match(tenant_id, '[A-Za-z0-9_-]+') AS usable FROM
        (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN '../' ELSE '' END || CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE replace(c_name, '#', '-') END AS tenant_id FROM customer)""",
    "adhoc_device_day": f"""WITH {MAPPED} SELECT device_id, {stamp('event_time')} AS event_time, temperature, humidity FROM ({kept(AIR)})
        WHERE tenant_id = 't2' AND device_id = 'dev-2' AND event_time >= TIMESTAMP '2024-01-03' AND event_time < TIMESTAMP '2024-01-10'""",
    "dead_letter_reasons": f"""WITH {MAPPED}, {_OUTCOMES.replace(READINGS + ',', '')} SELECT stage, reason, count(*) AS n FROM
        (SELECT 'silver' AS stage, reason FROM mapped WHERE reason IS NOT NULL
         UNION ALL SELECT 'bronze', reason FROM outcomes WHERE reason IS NOT NULL AND NOT (reason = 'fetch_failed' AND attempt < 3)
         UNION ALL SELECT 'bronze', 'unparseable_descriptor' FROM jobs WHERE violations IS NOT NULL) GROUP BY ALL""",
    "adhoc_newest": f"{_BRONZE} SELECT {stamp('received_at')} AS received_at, device_id, schema_fp, payload FROM bronze ORDER BY bronze.received_at DESC, job_id LIMIT 5",
    "rows_per_mapper": f"WITH {MAPPED} SELECT mapper_id, count(*) AS n FROM ({kept(ENERGY)}) GROUP BY ALL",
    "adhoc_shapes": f"{_BRONZE} SELECT device_id, {stamp('bronze_time')} AS event_time, schema_fp FROM bronze",
    "reconcile_layers": f"""{_LAYERS} SELECT count(*) AS bronze_rows, count(*) FILTER (outcome = 'silver') AS silver_rows, count(*) FILTER (outcome = 'dead_letter') AS dead_letter_rows,
        count(*) FILTER (outcome = 'duplicate') AS duplicate_rows FROM layers""",
    "device_layers": f"{_LAYERS} SELECT device_id, outcome, count(*) AS n FROM layers GROUP BY ALL",
    "all_null_rows": f"WITH {MAPPED} SELECT mapper_id, count(*) AS silver_rows, count(*) FILTER (flow IS NULL AND volume IS NULL) AS all_null_rows FROM ({kept(WATER)}) GROUP BY ALL",
    "stream_silver_air_quality": f"""WITH {_STREAMED} SELECT job_id, trace_id, tenant_id, device_id, {stamp('event_time')} AS event_time, {stamp('received_at')} AS received_at,
        mapper_id, mapper_version, humidity, temperature FROM ({kept(AIR, source='arrived')})""",
    "stream_commits": f"""WITH {_STREAMED},
        failed AS (SELECT entry_id FROM outcomes WHERE reason IS NOT NULL AND NOT ({_AGAIN}) UNION ALL SELECT entry_id FROM jobs WHERE violations IS NOT NULL)
        SELECT 'bronze' AS stage, 'bronze.raw' AS table_name, (SELECT count(*) FROM readings) AS rows_in, count(*) AS added_records, 0 AS duplicates FROM arrived
        UNION ALL SELECT 'bronze', 'bronze.dead_letter', (SELECT count(*) FROM readings), count(*), 0 FROM failed
        UNION ALL SELECT 'bronze', 'retries', NULL, count(*), NULL FROM outcomes WHERE {_AGAIN}
        UNION ALL SELECT 'silver', 'bronze.dead_letter', (SELECT count(*) FROM arrived), count(*), 0 FROM arrived WHERE reason IS NOT NULL
        UNION ALL SELECT 'silver', replace(target_table, 'silver_', 'silver.'), (SELECT count(*) FROM arrived), count(DISTINCT (device_id, event_time)), count(*) - count(DISTINCT (device_id, event_time))
          FROM arrived WHERE reason IS NULL GROUP BY target_table""",
    "reprocess_versions": f"""WITH {MAPPED} SELECT job_id, device_id, {stamp('event_time')} AS event_time, mapper_id, CASE WHEN mapper_id = '{E}' THEN 2 ELSE 1 END AS mapper_version, power,
        CASE WHEN mapper_id = '{E}' THEN energy * 1000::DOUBLE ELSE energy END AS energy, current FROM ({kept(ENERGY)}) WHERE NOT ({_TOO_MUCH})""",
    "reprocess_counts": f"""WITH {MAPPED}, old AS (SELECT * FROM ({kept(ENERGY)}) WHERE mapper_id = '{E}')
        SELECT count(*) AS n_old, count(*) FILTER (NOT ({_TOO_MUCH})) AS n_written, count(*) FILTER ({_TOO_MUCH}) AS n_rejected, 0::BIGINT AS n_duplicates,
          count(*) FILTER ({_TOO_MUCH}) + (SELECT count(*) FROM mapped WHERE reason = 'out_of_range' AND detail LIKE 'power <- power=%') AS n_letters FROM old""",
    "dataset_observations": f"WITH {MAPPED}, {_LONG} SELECT job_id, tenant_id, device_id, {stamp('event_time')} AS event_time, table_name, name, value, property_iri, unit FROM long",
    "dataset_lines": f"""WITH {MAPPED}, {_LONG},
        said AS (SELECT '<{_BASE}/observation/' || job_id || '/' || name || '>' AS s, '<{_BASE}/device/' || tenant_id || '/' || replace(device_id, '+', '%2B') || '>' AS device,
          '"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime(event_time, '%f') <> '000000' THEN '.' || strftime(event_time, '%f') ELSE '' END || 'Z"^^<http://www.w3.org/2001/XMLSchema#dateTime>' AS moment, * FROM long)
        SELECT 'rdf:type' AS predicate, s || ' <http://www.w3.org/1999/02/22-rdf-syntax-ns#type> <http://www.w3.org/ns/sosa/Observation> .' AS line FROM said
        UNION ALL SELECT 'sosa:madeBySensor', s || ' <http://www.w3.org/ns/sosa/madeBySensor> ' || device || ' .' FROM said
        UNION ALL SELECT 'sosa:resultTime', s || ' <http://www.w3.org/ns/sosa/resultTime> ' || moment || ' .' FROM said
        UNION ALL SELECT 'sosa:observedProperty', s || ' <http://www.w3.org/ns/sosa/observedProperty> <http://qudt.org/vocab/quantitykind/' || substr(property_iri, 6) || '> .' FROM said
        UNION ALL SELECT 'schema:unit', s || ' <http://qudt.org/schema/qudt/unit> <http://qudt.org/vocab/unit/' || substr(unit, 6) || '> .' FROM said""",
    "dataset_record": f"""WITH {MAPPED}, {_ALL_KEPT} SELECT replace(target_table, 'silver_', 'silver.') AS table_name, tenant_id, count(*) AS n_rows, {stamp('min(event_time)')} AS first_time, {stamp('max(event_time)')} AS last_time,
        count(DISTINCT event_time::DATE) AS n_days, round(count(DISTINCT device_id), -1)::BIGINT AS n_devices FROM all_kept GROUP BY target_table, tenant_id""",
    "dataset_version": f"""WITH {MAPPED}, {_LONG} SELECT unnest(['<http://www.w3.org/1999/02/22-rdf-syntax-ns#type>', '<http://www.w3.org/ns/sosa/madeBySensor>', '<http://www.w3.org/ns/sosa/resultTime>',
        '<http://www.w3.org/ns/sosa/observedProperty>', '<http://www.w3.org/ns/sosa/hasSimpleResult>', '<http://qudt.org/schema/qudt/unit>']) AS predicate, count(*) AS n, count(*) AS n_distinct FROM long""",
}
