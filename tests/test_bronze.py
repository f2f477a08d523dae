"""Admission, descriptors, landing, integrity and bronze rows."""

import hashlib
import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from lakegauge.operators.admission import admit, landing_key, route, stamp, to_queue
from lakegauge.operators.bronze import bronze_outcomes, bronze_rows, dead_letters
from lakegauge.operators.descriptor import parse_jobs
from lakegauge.operators.redrive import redrive, retries
from lakegauge.schemas import BRONZE_RAW, DEAD_LETTER
from lakegauge.sources import landing

READING = '{"device_id": "cellar-probe-9", "ts": "2026-11-19T17:26:41Z", "temp": 19.7}'


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def job(data=READING, **changes):
    payload = {"mode": "inline", "data": data, "size_bytes": len(data.encode()), "sha256": sha(data)}
    return {
        "job_id": "01K9N3D5T7V8W0X1Y2Z4A6B8C9", "trace_id": "trace-77", "stage": "bronze", "tenant_id": "ten-blue",
        "device_id": "cellar-probe-9", "received_at": "2026-11-27T10:00:00Z", "payload": payload,
    } | changes


def reference(key="2026/11/27/01.json", digest=None, size=10, **changes):
    return job(payload={"mode": "reference", "s3_key": key, "size_bytes": size, "sha256": digest or sha(READING)}, **changes)


def entries(spark, jobs):
    rows = [(f"e{n:03}", j if j is None or isinstance(j, str) else json.dumps(j)) for n, j in enumerate(jobs)]
    return spark.createDataFrame(rows, "entry_id string, job string")


def without(j, *names):
    return {k: v for k, v in j.items() if k not in names}


def payload_with(**changes):
    return job(payload=job()["payload"] | changes)


# --- admission -------------------------------------------------------------


def test_admission(spark):
    cases = [
        (b"x", "d", "t", None), (b"", "d", "t", "empty_body"), (None, "d", "t", "empty_body"), (b"x", None, "t", "missing_device_id"),
        (b"x", "d", None, "missing_tenant_id"), (b"x" * (1024 * 1024), "d", "t", None), (b"x" * (1024 * 1024 + 1), "d", "t", "request_too_large"),
        (b"\xff\xfe\xfa", "d", "t", "not_utf8"), (b"x", "", "t", None), ("né".encode(), "d", "t", None),
    ]
    df = spark.createDataFrame([(n, *c[:3]) for n, c in enumerate(cases)], "i int, body binary, device_id string, tenant_id string")
    assert [r["admit_reason"] for r in admit(df).orderBy("i").collect()] == [c[3] for c in cases]


def test_routing_counts_bytes_and_the_limit_is_inline(spark):
    bodies = [b"x" * 65536, b"x" * 65537, ("é" * 32769).encode()]
    df = spark.createDataFrame([(n, b, f"J{n}", datetime(2026, 9, 8, 23, 59, tzinfo=UTC)) for n, b in enumerate(bodies)], "i int, body binary, job_id string, received_at timestamp")
    rows = route(df).orderBy("i").collect()
    assert [r["mode"] for r in rows] == ["inline", "reference", "reference"]
    assert [r["s3_key"] for r in rows] == [None, "2026/09/08/J1.json", "2026/09/08/J2.json"]
    assert [r["sha256"] for r in rows] == [sha(b) for b in bodies]
    assert rows[0]["data"] == "x" * 65536 and rows[1]["data"] is None


def test_stamp_is_repeatable_and_keeps_given_ids(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "KEEP"), ("b", 1, None)], "file string, pos int, job_id string")
    first = [r["job_id"] for r in stamp(df, "file", "pos").orderBy("file", "pos").collect()]
    again = [r["job_id"] for r in stamp(df.repartition(3), "file", "pos").orderBy("file", "pos").collect()]
    assert first == again and first[1] == "KEEP" and len(set(first)) == 3 and len(first[0]) == 26


def test_admitted_readings_become_valid_descriptors(spark):
    df = spark.createDataFrame([(1, READING.encode(), "dev", "ten", None), (2, ("y" * 70000).encode(), "dev", "ten", "hint")], "pos int, body binary, device_id string, tenant_id string, pipeline_hint string")
    jobs = parse_jobs(to_queue(route(stamp(df, "pos")))).orderBy("size_bytes").collect()
    assert [(r["violations"], r["mode"], r["pipeline_hint"], r["attempt"]) for r in jobs] == [(None, "inline", None, 1), (None, "reference", "hint", 1)]
    assert jobs[0]["data"] == READING


# --- descriptors -----------------------------------------------------------

DESCRIPTORS = [
    (job(), None),
    (reference(), None),
    (job(attempt=3, pipeline_hint=None, parent_job_id="p"), None),
    (job(received_at="2026-11-17T21:26:41+02:00"), None),
    (job(payload={"mode": "smoke-signal", "sha256": "x"}), "mode_unknown"),
    (job(received_at="2026-12-06T10:00:00"), "received_at_naive"),
    (job(received_at=1803456789), "received_at_invalid"),
    (payload_with(size_bytes=999), "size_mismatch"),
    (payload_with(size_bytes=-1), "size_bytes_invalid"),
    (payload_with(size_bytes="77"), "size_bytes_invalid"),
    (payload_with(s3_key="x"), "payload_extra_field"),
    (payload_with(sha256=None), "sha256_missing"),
    (job(undeclared="value"), "extra_field"),
    (job(stage="gold"), "stage_unknown"),
    (job(attempt=0), "attempt_invalid"),
    (job(attempt=None), "attempt_invalid"),
    (job(pipeline_hint=5), "pipeline_hint_type"),
    (without(job(), "tenant_id"), "tenant_id_missing"),
    (without(job(), "payload"), "mode_unknown"),
    (job(payload="text"), "mode_unknown"),
    ({"bad": "json"}, "job_id_missing"),
    ("[1]", "not_an_object"),
    ("{not json", "not_an_object"),
    (json.dumps(job()) + " tail", "not_an_object"),
    (None, "not_an_object"),
]


def test_descriptor_checks(spark):
    rows = parse_jobs(entries(spark, [d for d, _ in DESCRIPTORS])).orderBy("entry_id").collect()
    for (descriptor, want), row in zip(DESCRIPTORS, rows):
        got = row["violations"]
        assert (got is None) if want is None else want in (got or "").split(";"), (descriptor, got)
    assert [rows[0]["attempt"], rows[2]["attempt"], rows[2]["parent_job_id"]] == [1, 3, "p"]
    assert parse_jobs(entries(spark, [DESCRIPTORS[3][0]])).select(F.col("received_at").cast("string")).first()[0] == "2026-11-17 19:26:41"


# --- bronze ----------------------------------------------------------------


def outcomes(spark, jobs, objects=None):
    area = None if objects is None else spark.createDataFrame(objects, "key string, content binary, fetch_error string")
    return bronze_outcomes(entries(spark, jobs), area)


def test_event_time_and_payload_in_bronze(spark):
    payloads = [
        '{"ts": "2026-11-19T17:26:41Z"}', '{"timestamp": "2026-11-19T17:26:41Z"}', '{"time": "2026-11-19T19:26:41+02:00"}', '{"ts": "2026-11-19T17:26:41"}',
        '{"ts": "any-day-now", "time": "2026-11-19T17:26:41Z"}', '{"ts": null, "timestamp": "2026-11-19T17:26:41Z"}', '{"ts":"2026-11-19T17:26:41Z","timestamp":"2001-05-06T07:08:09Z"}',
        '{"recorded": "2026-11-19T17:26:41Z"}', '{"ts": "any-day-now"}', '{"ts": 1803456789}', '{"a": {"ts": "2026-11-19T17:26:41Z"}}',
        "this is not json", "[4, 5]", "123", '"plain words"', "true", "null", '{  "ts":"2026-11-19T17:26:41Z" ,   "temp"  : 19.7 }\n\n',
    ]
    out = bronze_rows(outcomes(spark, [job(p, job_id=f"{n:02}") for n, p in enumerate(payloads)]))
    assert out.columns == BRONZE_RAW.names
    rows = out.withColumn("at", F.col("event_time").cast("string")).orderBy("job_id").collect()
    assert [r["payload"] for r in rows] == payloads
    event, received = "2026-11-19 17:26:41", "2026-11-27 10:00:00"
    assert [r["at"] for r in rows] == [event] * 7 + [received] * 10 + [event]
    assert [r["schema_fp"] for r in rows[11:17]] == ["4f53cda18c2b"] * 6
    assert {r["source"] for r in rows} == {"http"}


def test_inline_and_reference_give_the_same_row(spark):
    out = outcomes(spark, [job(), reference("k.json")], [("k.json", READING.encode(), None)])
    rows = [r.asDict() for r in bronze_rows(out).collect()]
    assert rows[0] == rows[1] and rows[0]["payload"] == READING


def test_failures_become_dead_letters(spark):
    bad = json.dumps({"x": [1]})
    latin = "é".encode("latin-1")
    jobs = [
        job(bad, payload={"mode": "inline", "data": bad, "size_bytes": len(bad), "sha256": "0" * 64}),
        reference("nope.json"), reference("k.json", digest="0" * 64), reference("l.json", digest=sha(latin)), reference("l.json"),
        job("not json", payload={"mode": "inline", "data": "not json", "size_bytes": 8, "sha256": "0"}), None, '{"bad":"json"}', job(),
        reference("slow.json", attempt=2), reference("slow.json", attempt=3),
    ]
    out = outcomes(spark, jobs, [("k.json", b"[1,2]", None), ("l.json", latin, None), ("slow.json", None, "timed out")])
    letters = dead_letters(out)
    assert letters.columns == DEAD_LETTER.names
    got = sorted((r["reason"], r["s3_key"] or "", r["schema_fp"] or "", r["payload"] or "", r["attempt"]) for r in letters.collect())
    shape_of_array, shape_of_x = "957637e631a9", "".join(hashlib.sha256(b'["x[]:number"]').hexdigest()[:12])
    assert got == sorted([
        ("sha256_mismatch", "", shape_of_x, bad, 1), ("object_missing", "nope.json", "", "", 1), ("sha256_mismatch", "k.json", shape_of_array, "[1,2]", 1),
        ("invalid_utf8", "l.json", "", "", 1), ("sha256_mismatch", "l.json", "", "", 1), ("sha256_mismatch", "", "", "not json", 1),
        ("unparseable_descriptor", "", "", "", 1), ("unparseable_descriptor", "", "", '{"bad":"json"}', 1), ("fetch_failed", "slow.json", "", "", 3),
    ])
    unusable = letters.filter("reason = 'unparseable_descriptor'").orderBy("job_id").collect()
    assert [(r["job_id"], r["trace_id"], r["tenant_id"], r["device_id"]) for r in unusable] == [("e006", "", "", ""), ("e007", "", "", "")]
    assert bronze_rows(out).count() == 1
    again = parse_jobs(retries(out)).collect()
    assert [(r["violations"], r["s3_key"], r["attempt"]) for r in again] == [(None, "slow.json", 3)]


def test_redrive_rebuilds_descriptors(spark):
    jobs = [reference("a.json", job_id="A"), reference("a.json", job_id="A"), reference("b.json", job_id="B", attempt=3), job(job_id="C")]
    letters = spark.createDataFrame(
        [("A", "fetch_failed", 1), ("A", "fetch_failed", 1), ("B", "fetch_failed", 3), ("C", "sha256_mismatch", 1)], "job_id string, reason string, attempt int")
    again = parse_jobs(redrive(letters, parse_jobs(entries(spark, jobs)))).collect()
    assert [(r["violations"], r["job_id"], r["s3_key"], r["attempt"], r["entry_id"]) for r in again] == [(None, "A", "a.json", 2, "A/2")]


def test_landed_objects_by_key(spark, tmp_path):
    names = ["2026/10/05/a.json", "2026/10/05/_b.json", ".c", "odd {key}*?%20", "packed.gz", "déjà vu"]
    bodies = spark.createDataFrame([*(("reference", k, k.encode()) for k in names), ("inline", None, b"zzz")], "mode string, s3_key string, body binary")
    landing.land(bodies, f"file://{tmp_path}/area")
    (tmp_path / "secret").write_text("not landed")
    too_long = "x" * 300  # no store takes it: an object that cannot be read
    others = ["2026/10/05", "2026/10/05/a.json/deeper", "../secret", "/etc/hostname", "", "gone.json", None]
    jobs = spark.createDataFrame([("reference", k) for k in [*names, *names, *others, too_long]] + [("inline", ".c")], "mode string, s3_key string")
    found = {r["key"]: (r["content"] and bytes(r["content"]).decode(), r["fetch_error"]) for r in landing.objects_for(jobs, str(tmp_path / "area")).collect()}
    assert found.pop(too_long)[1] and found == {k: (k, None) for k in names}
    assert landing.objects_for(jobs, str(tmp_path / "area")).count() == len(names) + 1
    assert landing.objects_for(jobs.limit(0), str(tmp_path / "nowhere")).count() == 0


def test_keys_stay_within_the_area(spark, tmp_path):
    with pytest.raises(Exception, match="not a key within"):
        landing.land(spark.createDataFrame([("reference", "../x", b"")], "mode string, s3_key string, body binary"), str(tmp_path))


@pytest.mark.parametrize("stamped", ["2026-01-02 00:00:00"])
def test_landing_key(spark, stamped):
    df = spark.createDataFrame([(stamped, "J")], "s string, job_id string").select(landing_key(F.col("s").cast("timestamp"), "job_id").alias("k"))
    assert df.first()["k"] == "2026/01/02/J.json"
