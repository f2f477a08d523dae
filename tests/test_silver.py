"""Mapping one bronze row: resolution, casts, checks, overrides."""

import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from lakegauge.mappers import Registry
from lakegauge.mappers.model import mapper_from_dict
from lakegauge.operators.resolve import with_match_count, with_payload
from lakegauge.operators.transform import map_readings, silver_dead_letters, silver_rows

RECEIVED = datetime(2026, 12, 1, 10, 0, tzinfo=UTC)
BRONZE = (
    "job_id string, trace_id string, received_at timestamp, event_time timestamp, tenant_id string, device_id string, "
    "source string, pipeline_hint string, schema_fp string, payload string"
)


def bronze(spark, cases):
    """(payload, hint) pairs -> bronze rows with job ids 0, 1, .."""
    rows = [
        (str(n), "t" * 32, RECEIVED, RECEIVED, "ten-blue", "envelope-device", "http", hint, "fp",
         payload if isinstance(payload, str) else json.dumps(payload))
        for n, (payload, hint) in enumerate(cases)
    ]
    return spark.createDataFrame(rows, BRONZE)


def verdicts(spark, cases, registry):
    rows = map_readings(bronze(spark, cases), registry).orderBy(F.col("job_id").cast("int")).collect()
    return [(r["mapper_id"], r["reason"]) for r in rows]


@pytest.fixture(scope="module")
def registry():
    return Registry.shipped()


AIR = {"temp": 21.4, "hum": 0.47}
NESTED = {"measurements": {"temperature_f": 70.5, "rh": 46.0}}
ENERGY = {"power": 100.0, "energy": 200.0}
KW = {"meter": "kwh-north-5", "readings": {"active_power_kw": 1.43, "total_kwh": 88.2}}
A, B, E, C, W = "indoor-air-quality", "vendor-b-airquality", "iot-energy", "vendor-c-energy", "water-meter"

CASES = [
    # resolution
    (AIR, None, A, None),
    (NESTED, None, B, None),
    (ENERGY, None, E, None),
    (KW, None, C, None),
    ({"flow_lpm": 12.4, "total_l": 48213.0}, None, W, None),
    (AIR, A, A, None),
    (AIR, "nobody-known", A, None),
    (AIR, "", A, None),
    (ENERGY, A, A, None),
    ({"dev": "x", "t": 19.8, "h": 51}, None, None, "unresolved"),
    (AIR | ENERGY, None, A, None),
    ({"temp": 21.0}, None, None, "unresolved"),
    ({"temp": None, "hum": None}, None, A, None),
    ({"measurements": [{"temperature_f": 1, "rh": 2}]}, None, None, "unresolved"),
    ({"measurements.temperature_f": 1, "measurements.rh": 2}, None, None, "unresolved"),
    ("plain words", None, None, "unresolved"),
    ("", None, None, "unresolved"),
    ("[4, 5]", None, None, "unresolved"),
    ("123", None, None, "unresolved"),
    ("null", None, None, "unresolved"),
    ('{"temp": 21.4, "hum": 0.47} trailing', None, None, "unresolved"),
    ("not json", A, A, "bad_payload"),
    ("[4, 5]", A, A, "bad_payload"),
    ('"text"', W, W, "bad_payload"),
    # values
    (AIR | {"temp": -40}, None, A, None),
    (AIR | {"temp": 85}, None, A, None),
    (AIR | {"temp": 85.1}, None, A, "out_of_range"),
    (AIR | {"temp": -40.1}, None, A, "out_of_range"),
    (AIR | {"hum": 1.5}, None, A, "out_of_range"),
    (AIR | {"temp": "21.4"}, None, A, None),
    (AIR | {"temp": "hot"}, None, A, "bad_value"),
    (AIR | {"temp": None}, None, A, None),
    (AIR | {"temp": True}, None, A, None),
    (AIR | {"temp": [1]}, None, A, "bad_value"),
    (AIR | {"temp": "nan"}, None, A, None),
    (AIR | {"temp": "inf"}, None, A, "out_of_range"),
    ({"temp": "hot", "hum": 9}, None, A, "bad_value"),
    ({"temp": 900, "hum": "wet"}, None, A, "out_of_range"),
    (AIR | {"build": "r7-b", "charge": 64, "site": {"floors": [0, 3]}}, None, A, None),
    ({"power": -1, "energy": 1}, None, E, "out_of_range"),
]


def test_case_table(spark, registry):
    got = verdicts(spark, [(p, h) for p, h, _, _ in CASES], registry)
    wrong = [(case, g) for case, g in zip(CASES, got) if g != case[2:]]
    assert wrong == []


def rows_of(spark, registry, target, *cases):
    out = silver_rows(map_readings(bronze(spark, cases), registry), registry, target)
    return [r.asDict() for r in out.orderBy(F.col("job_id").cast("int")).collect()]


def test_values_units_and_lineage(spark, registry):
    air = rows_of(
        spark, registry, "silver_air_quality",
        (AIR, None), (NESTED, None), (AIR | {"temp": "21.4"}, None), (AIR | {"temp": None}, None), (AIR | {"temp": True}, None), (ENERGY, A),
    )
    assert [r["temperature"] for r in air] == [21.4, (70.5 - 32) * 5 / 9, 21.4, None, 1.0, None]
    assert [r["humidity"] for r in air] == [0.47 * 100, 46.0, 47.0, 47.0, 47.0, None]
    assert air[0]["mapper_id"] == A and air[0]["mapper_version"] == 1
    assert air[0]["trace_id"] == "t" * 32 and air[0]["tenant_id"] == "ten-blue"
    assert list(air[0]) == registry.silver_schema("silver_air_quality").names


def test_missing_columns_are_null_and_device_is_taken_from_payload(spark, registry):
    numeric_meter = json.dumps(KW).replace('"kwh-north-5"', "21.0")
    energy = rows_of(spark, registry, "silver_energy", (KW, None), (ENERGY, None), ({"readings": KW["readings"]}, None), (numeric_meter, None), (KW | {"meter": None}, None))
    assert [r["device_id"] for r in energy] == ["kwh-north-5", "envelope-device", "envelope-device", "21.0", "envelope-device"]
    assert energy[0]["power"] == 1.43 * 1000 and energy[0]["energy"] == 88.2 * 1000 and energy[0]["current"] is None


def test_event_time_of_the_mapper_wins(spark, registry):
    good, bad, null = {"ts": "2026-11-19T19:26:41+02:00"}, {"ts": "yesterday"}, {"ts": None}
    df = silver_rows(map_readings(bronze(spark, [(AIR | x, None) for x in (good, bad, null, {})]), registry), registry, "silver_air_quality")
    got = [r["s"] for r in df.orderBy("job_id").select(F.col("event_time").cast("string").alias("s")).collect()]
    assert got == ["2026-11-19 17:26:41"] + ["2026-12-01 10:00:00"] * 3


def test_dead_letter_keeps_evidence(spark, registry):
    letters = silver_dead_letters(map_readings(bronze(spark, [(AIR | {"temp": "hot"}, None), ({"x": 1}, "typo"), (KW | {"readings": {"active_power_kw": -1, "total_kwh": 1}}, None)]), registry)).orderBy("job_id").collect()
    assert [(r["stage"], r["reason"], r["attempt"], r["schema_fp"], r["s3_key"]) for r in letters] == [
        ("silver", "bad_value", 1, "fp", None), ("silver", "unresolved", 1, "fp", None), ("silver", "out_of_range", 1, "fp", None)]
    assert "temperature" in letters[0]["detail"] and "temp" in letters[0]["detail"] and "hot" in letters[0]["detail"]
    assert "typo" in letters[1]["detail"]
    # the bronze device id, not the one the mapper reads
    assert letters[2]["device_id"] == "envelope-device" and "0" in letters[2]["detail"]
    assert letters[0]["payload"] == json.dumps(AIR | {"temp": "hot"})


def test_match_count_shows_ambiguous_rows(spark, registry):
    df = with_match_count(with_payload(bronze(spark, [(AIR, None), (AIR | ENERGY, None), ({}, None)])), registry)
    assert [r["matches"] for r in df.orderBy("job_id").collect()] == [1, 2, 0]


def typed_registry():
    def col(name, type_name, **extra):
        return {"name": name, "from": f"x.{name}", "type": type_name, "unit": "unit:ONE", "property_iri": "q:x"} | extra

    first = {
        "id": "typed", "version": 3, "target_table": "silver_typed", "match": {"required_keys": ["x"]},
        "columns": [col("n", "int", min=-5, max=1000), col("s", "string"), col("b", "bool"), col("t", "timestamp"), col("d", "double", required=True)],
    }
    second = {
        "id": "typed-other", "version": 1, "target_table": "typed_other", "match": {"required_keys": ["y"]},
        "columns": [dict(col("s", "string"), **{"from": "y"}), dict(col("n", "int", scale=0.5), **{"from": "z"})],
    }
    return Registry([mapper_from_dict(first), mapper_from_dict(second)])


def test_all_types_and_required(spark):
    registry = typed_registry()
    cases = [
        ({"x": {"n": 21.9, "s": 21.0, "b": "false", "t": "2026-11-19", "d": " 1_0.5 "}}, None),
        ({"x": {"n": "12", "s": True, "b": 0, "t": 20261119, "d": 1}}, None),
        ({"x": {"n": None, "s": None, "b": None, "t": None, "d": False}}, None),
        ({"x": {"d": None}}, None),
        ({"x": {"n": "21.9", "d": 1}}, None),
        ({"x": {"n": 1001, "d": 1}}, None),
        ({"x": {"t": "soon", "d": 1}}, None),
        ({"x": {"n": 99999999999999999999999, "d": 1}}, None),
        ({"y": "left", "z": 4}, None),
        ({"y": 1.50, "z": 3}, None),
    ]
    assert verdicts(spark, cases, registry) == [
        ("typed", None), ("typed", None), ("typed", None), ("typed", "missing_value"), ("typed", "bad_value"), ("typed", "out_of_range"),
        ("typed", "bad_value"), ("typed", "bad_value"), ("typed-other", None), ("typed-other", "bad_value"),
    ]
    df = silver_rows(map_readings(bronze(spark, cases), registry), registry, "silver_typed")
    got = [tuple(r) for r in df.orderBy("job_id").select("b", "d", "n", "s", F.col("t").cast("string")).collect()]
    assert got == [
        (True, 10.5, 21, "21.0", "2026-11-19 00:00:00"), (False, 1.0, 12, "True", "2026-11-19 00:00:00"), (None, 0.0, None, None, None)]
    other = silver_rows(map_readings(bronze(spark, cases), registry), registry, "typed_other").collect()
    assert [(r["n"], r["s"], r["mapper_version"]) for r in other] == [(2, "left", 1)]


def test_payload_is_parsed_once_per_row(spark, registry):
    plan = map_readings(bronze(spark, [(AIR, None)]), registry).filter("reason IS NULL")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
