"""Observations, N-Triples, the merged record and whole versions."""

import json
import re

import pytest
from pyspark.sql import functions as F

from lakegauge.mappers import Mapper, MapperColumn, Registry
from lakegauge.plans import dataset
from lakegauge.plans.dataset import current_version, dataset_record, iri, literal, observations, publish_dataset, read_dataset, triples
from lakegauge.sources.lake import BRONZE, Lake
from lakegauge.streaming.stages import SilverStage

BASE = "https://example.org/sensors"
# one statement of N-Triples: IRIs without blanks or angle brackets, literals with nothing bare that must be escaped
STATEMENT = re.compile(r'<[^\x00-\x20<>"{}|^`\\]+> <[^\x00-\x20<>"{}|^`\\]+> (<[^\x00-\x20<>"{}|^`\\]+>|"(?:[^"\\\n\r]|\\[nrt"\\])*"(?:\^\^<[^\x00-\x20<>"{}|^`\\]+>)?) \.')


def registry(version=1):
    columns = (
        MapperColumn("power", "p", "double", "unit:W", "qudt:Power"), MapperColumn("on", "on", "bool", "unit:ONE", "qudt:State"),
        MapperColumn("note", "note", "string", "unit:ONE", "http://example.org/a b|c"), MapperColumn("since", "since", "timestamp", "unit:ONE", "qudt:Time"),
    )
    count = (MapperColumn("power", "n", "int", "unit:NUM", "qudt:Count"),)  # the same name with another type
    return Registry([Mapper("plug", version, "silver_plug", ("p",), columns), Mapper("tally", 1, "silver_tally", ("n",), count)])


ROWS = [
    ("J1", "t 1", "dev/1", {"p": 1.5, "on": True, "note": 'a "quoted"\n\\ \tline\r', "since": "2026-01-02T03:04:05.5Z"}), ("J2", "t 1", "dev<2>", {"p": 1e300, "on": None}),
    ("J3", "t2", "dev+ü", {"p": "inf"}), ("J4", "t2", "d4", {"n": 7}), ("J5", "t2", "d5", {"p": "nan", "note": ""}),
]


def add(lake, rows, batch, day=1):
    made = [(j, "trace", t, d, None, "fp", json.dumps(p)) for j, t, d, p in rows]
    df = lake.spark.createDataFrame(made, "job_id string, trace_id string, tenant_id string, device_id string, pipeline_hint string, schema_fp string, payload string")
    time = F.lit(f"2026-03-0{day} 00:00:00").cast("timestamp")
    lake.write(BRONZE, df.withColumns({"event_time": time, "received_at": time, "source": F.lit("http")}), f"b{batch}")
    lake.commit(f"b{batch}", "bronze", batch, len(rows), [BRONZE])
    SilverStage(lake).run(lake.committed_rows(BRONZE, lake.commits().filter(f"written_in = 'b{batch}'")), batch)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")), registry()).ensure(register=False)
    add(lake, ROWS, 0)
    add(lake, [(f"K{i}", "t2", f"d{i}", {"n": i}) for i in range(40)], 1, day=2)
    add(lake, [(f"L{i}", "t2", f"d{i}", {"n": i}) for i in range(20, 60)], 2, day=2)  # twenty of them are copies
    return lake


def test_observations_are_the_values_in_long_form(lake):
    got = sorted((r["job_id"], r["name"], r["type"], r["value"], r["property_iri"], r["unit"]) for r in observations(lake).collect() if r["job_id"].startswith("J"))
    assert got == [
        ("J1", "note", "string", 'a "quoted"\n\\ \tline\r', "http://example.org/a b|c", "unit:ONE"), ("J1", "on", "boolean", "true", "qudt:State", "unit:ONE"),
        ("J1", "power", "double", "1.5", "qudt:Power", "unit:W"), ("J1", "since", "timestamp", "2026-01-02T03:04:05.500000Z", "qudt:Time", "unit:ONE"),
        ("J2", "power", "double", "1.0E300", "qudt:Power", "unit:W"), ("J3", "power", "double", "INF", "qudt:Power", "unit:W"),
        ("J4", "power", "bigint", "7", "qudt:Count", "unit:NUM"), ("J5", "note", "string", "", "http://example.org/a b|c", "unit:ONE"), ("J5", "power", "double", "NaN", "qudt:Power", "unit:W"),
    ]
    assert observations(lake, ["silver.tally"]).count() == 61


def test_many_descriptions_are_joined_without_a_broadcast(lake):
    few, many = observations(lake), observations(lake, broadcast=1)
    assert "ResolvedHint (strategy=broadcast)" not in many._jdf.queryExecution().analyzed().toString() and "broadcast" in few._jdf.queryExecution().analyzed().toString()
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))


def test_lines_are_statements(lake):
    long = observations(lake)
    lines = [r["line"] for r in triples(long, BASE).collect()]
    assert len(lines) == 6 * long.count() and all(STATEMENT.fullmatch(x) for x in lines)
    assert f'<{BASE}/observation/J1/note> <http://www.w3.org/ns/sosa/hasSimpleResult> "a \\"quoted\\"\\n\\\\ \\tline\\r"^^<http://www.w3.org/2001/XMLSchema#string> .' in lines
    assert f"<{BASE}/observation/J1/note> <http://www.w3.org/ns/sosa/observedProperty> <http://example.org/a%20b%7Cc> ." in lines
    assert f"<{BASE}/observation/J3/power> <http://www.w3.org/ns/sosa/madeBySensor> <{BASE}/device/t2/dev%2B%C3%BC> ." in lines


def test_escapes(spark):
    df = spark.createDataFrame([("unit:DEG_C", 'x"\\'), ("http://e/\t\x01é<>", "é\x01"), ("", "")], "i string, t string")
    got = [tuple(r) for r in df.select(iri(F.col("i")), literal(F.col("t")), literal(F.col("t"), "xsd:string")).collect()]
    assert got[0][:2] == ("<http://qudt.org/vocab/unit/DEG_C>", '"x\\"\\\\"') and got[1][:2] == ("<http://e/%09%01é%3C%3E>", '"é\x01"') and got[2][:2] == ("<>", '""')
    assert got[2][2] == '""^^<http://www.w3.org/2001/XMLSchema#string>'


def test_the_merged_record_is_what_a_scan_gives(lake):
    got = {(r["table_name"], r["tenant_id"]): r for r in dataset_record(lake).collect()}
    for name in lake.targets:
        rows = lake.read(name)
        for r in rows.groupBy("tenant_id").agg(F.count("*").alias("n"), F.min("event_time").alias("a"), F.max("event_time").alias("b"), F.count_distinct(F.to_date("event_time")).alias("d"), F.count_distinct("device_id").alias("k")).collect():
            record = got.pop((name, r["tenant_id"]))
            assert (record["n_rows"], record["first_time"], record["last_time"], record["n_days"]) == (r["n"], r["a"], r["b"], r["d"])
            assert abs(record["n_devices"] - r["k"]) <= 0.05 * r["k"]
    assert not got


def test_versions_are_whole(spark, tmp_path, monkeypatch):
    lake, root = Lake(spark, str(tmp_path / "lake"), registry()).ensure(register=False), str(tmp_path / "out")
    assert current_version(spark, root, "plugs") is None
    add(lake, ROWS[:2], 0)
    first = publish_dataset(lake, root, "plugs", BASE)
    n = read_dataset(spark, root, "plugs")[0].count()
    assert publish_dataset(lake, root, "plugs", BASE) == first  # the same content is the same version
    add(lake, ROWS[2:], 1)
    usual = dataset.dataset_record
    monkeypatch.setattr(dataset, "dataset_record", lambda lake: usual(lake).withColumn("n_rows", F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        publish_dataset(lake, root, "plugs", BASE)
    assert current_version(spark, root, "plugs") == first and read_dataset(spark, root, "plugs")[0].count() == n
    monkeypatch.setattr(dataset, "dataset_record", usual)
    second = publish_dataset(lake, root, "plugs", BASE)
    lines, record = read_dataset(spark, root, "plugs")
    assert second != first and current_version(spark, root, "plugs") == second
    assert lines.count() == 6 * observations(lake).count() > n and record.agg(F.sum("n_rows")).first()[0] == 5
