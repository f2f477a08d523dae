"""Streams into a lake: one batch or many, restarts, repeats, schema growth, publishing, SQL."""

import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from lakegauge.mappers import Mapper, MapperColumn, Registry
from lakegauge.operators.audit import added_records, layer_balance, reconcile
from lakegauge.plans import adhoc
from lakegauge.plans.publish import InvalidRequest, as_json, export_key, first_rows, is_safe_tenant, publish, safe_tenant, slice_filter, take_slice
from lakegauge.sources import files
from lakegauge.sources.lake import AUDIT, BRONZE, DEAD, Lake, UnknownTable, list_tables
from lakegauge.sources.queue import read_queue, stream_queue
from lakegauge.streaming.stages import BronzeStage, SilverStage, catch_up
from test_bronze import job, reference

DAY = datetime(2026, 9, 10, tzinfo=UTC)


def reading(n, **changes):
    """Job n: air readings of five devices at twelve times, with repeats and a few that fail."""
    payload = {"ts": f"2026-09-{10 + n % 3:02}T{n % 4:02}:00:00Z", "temp": 20 + n % 7, "hum": 0.4}
    if n % 10 == 3:
        payload["temp"] = "hot"
    if n % 10 == 7:
        payload = {"t": 1}
    return job(json.dumps(payload | changes), job_id=f"J{n:04}", device_id=f"dev-{n % 5}", tenant_id=f"t{n % 2}", received_at=f"2026-09-22T10:{n // 60:02}:{n % 60:02}Z")


def enqueue(spark, path, jobs, files=1):
    rows = [(j["job_id"] if isinstance(j, dict) else f"x{i}", json.dumps(j) if isinstance(j, dict) else j) for i, j in enumerate(jobs)]
    spark.createDataFrame(rows, "entry_id string, job string").repartitionByRange(files, "entry_id").write.mode("append").parquet(path)


def run(lake, tmp_path, max_files=None, landing_root=None, retry=False):
    spark, queue = lake.spark, str(tmp_path / "queue")
    bronze = BronzeStage(lake, landing_root=landing_root, retry_path=queue if retry else None)
    catch_up(bronze, stream_queue(spark, queue, max_files), str(tmp_path / "cp-bronze"))
    catch_up(SilverStage(lake), lake.stream_commits(BRONZE, max_files), str(tmp_path / "cp-silver"))


def air(lake):
    return sorted((r["job_id"], r["device_id"], str(r["event_time"]), r["temperature"]) for r in lake.read("silver.air_quality").collect())


def letters(lake):
    return sorted((r["job_id"], r["stage"], r["reason"]) for r in lake.read(DEAD).collect())


JOBS = [reading(n) for n in range(120)] + ["not a job", None]


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    tmp = tmp_path_factory.mktemp("whole")
    lake = Lake(spark, str(tmp / "lake")).ensure(register=False)
    enqueue(spark, str(tmp / "queue"), JOBS)
    run(lake, tmp)
    return lake


def test_one_batch(whole):
    assert whole.read(BRONZE).count() == 120
    found = letters(whole)
    assert len([x for x in found if x[2] == "unparseable_descriptor"]) == 2
    assert len([x for x in found if x[2] == "bad_value"]) == 12 and len([x for x in found if x[2] == "unresolved"]) == 12
    keys = [(d, t) for _, d, t, _ in air(whole)]
    assert len(keys) == len(set(keys)) and len(keys) > 20
    # the first arrival of each key was kept
    first = {}
    for n in range(120):
        if n % 10 not in (3, 7):
            first.setdefault((n % 5, n % 3, n % 4), f"J{n:04}")
    assert sorted(first.values()) == [x[0] for x in air(whole)]


def test_many_batches_and_a_restart_give_the_same(spark, whole, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake")).ensure(register=False)
    enqueue(spark, str(tmp_path / "queue"), JOBS[:70], files=3)
    run(lake, tmp_path, max_files=1)
    enqueue(spark, str(tmp_path / "queue"), JOBS[70:], files=2)
    run(lake, tmp_path, max_files=1)
    # across batches the first one read wins, so only the keys can be compared
    assert sorted(x[1:3] for x in air(lake)) == sorted(x[1:3] for x in air(whole))
    assert [x[1:] for x in letters(lake)] == [x[1:] for x in letters(whole)]
    before = air(lake), lake.read(BRONZE).count()
    run(lake, tmp_path)  # nothing new
    assert (air(lake), lake.read(BRONZE).count()) == before


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake")).ensure(register=False)
    enqueue(spark, str(tmp_path / "queue"), JOBS)
    entries = spark.read.parquet(str(tmp_path / "queue"))
    BronzeStage(lake).run(entries, 0)
    BronzeStage(lake).run(entries, 0)
    assert lake.read(BRONZE).count() == 120 and len(letters(lake)) == 2
    SilverStage(lake).run(lake.read(BRONZE), 0)
    once = air(lake), letters(lake)
    SilverStage(lake).run(lake.read(BRONZE), 0)
    assert (air(lake), letters(lake)) == once


def test_a_later_copy_is_skipped_and_counted(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake")).ensure(register=False)
    queue = str(tmp_path / "queue")
    enqueue(spark, queue, [reading(0)])
    run(lake, tmp_path)
    enqueue(spark, queue, [reading(0) | {"job_id": "again"}, reading(1)])
    run(lake, tmp_path)
    assert [x[0] for x in air(lake)] == ["J0000", "J0001"] and lake.read(BRONZE).count() == 3
    commits = lake.read(AUDIT).filter("table_name = 'silver.air_quality'").orderBy("batch_id").collect()
    assert [(c["rows_in"], c["added_records"], c["duplicates"]) for c in commits] == [(1, 1, 0), (2, 1, 1)]
    assert added_records(lake.read(AUDIT)).filter("table_name = 'bronze.raw'").agg(F.sum("added_records")).first()[0] == 3


def test_tenant_is_not_part_of_the_key_unless_asked(spark, tmp_path):
    jobs = [reading(0, k=1) | {"tenant_id": t, "job_id": t} for t in ("A", "B")]
    for keys, kept in ((("device_id", "event_time"), ["A"]), (("tenant_id", "device_id", "event_time"), ["A", "B"])):
        lake = Lake(spark, str(tmp_path / f"lake{len(keys)}")).ensure(register=False)
        queue = str(tmp_path / f"queue{len(keys)}")
        enqueue(spark, queue, jobs)
        BronzeStage(lake).run(spark.read.parquet(queue), 0)
        SilverStage(lake, keys=keys).run(lake.read(BRONZE), 0)
        assert [x[0] for x in air(lake)] == kept
    lake = Lake(spark, str(tmp_path / "last")).ensure(register=False)
    BronzeStage(lake).run(spark.read.parquet(queue), 0)
    SilverStage(lake, keep="last").run(lake.read(BRONZE), 0)
    assert [x[0] for x in air(lake)] == ["B"]


def test_readings_without_time_stay_apart(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake")).ensure(register=False)
    enqueue(spark, str(tmp_path / "queue"), [reading(0, ts=None), reading(5, ts=None)])
    run(lake, tmp_path)
    assert len(air(lake)) == 2


def test_landed_payloads_and_missing_objects(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake")).ensure(register=False)
    body = json.dumps({"temp": 20, "hum": 0.5, "pad": "x" * 70000})
    (tmp_path / "landing/2026/09/22").mkdir(parents=True)
    (tmp_path / "landing/2026/09/22/big.json").write_text(body)
    import hashlib

    digest = hashlib.sha256(body.encode()).hexdigest()
    enqueue(spark, str(tmp_path / "queue"), [reference("2026/09/22/big.json", digest, job_id="big"), reference("2026/09/22/gone.json", digest, job_id="gone"), reading(0)])
    run(lake, tmp_path, landing_root=str(tmp_path / "landing"), retry=True)
    assert {r["job_id"]: len(r["payload"]) for r in lake.read(BRONZE).collect()}["big"] == len(body)
    assert letters(lake) == [("gone", "bronze", "object_missing")]


def failing(jobs):
    """Landed objects that cannot be read just now."""
    return jobs.filter("mode = 'reference'").select(F.col("s3_key").alias("key")).distinct().withColumns({"content": F.lit(None).cast("binary"), "fetch_error": F.lit("store busy")})


class Busy(BronzeStage):
    def objects(self, jobs):
        return failing(jobs)


TRANSIENT = [reading(0), reference("2026/09/22/slow.json", "0" * 64, job_id="slow")]


def test_a_transient_failure_is_retried_or_a_letter(spark, tmp_path):
    enqueue(spark, str(tmp_path / "queue"), TRANSIENT)
    entries = spark.read.parquet(str(tmp_path / "queue"))
    lake = Lake(spark, str(tmp_path / "without")).ensure(register=False)
    Busy(lake).run(entries, 0)
    assert letters(lake) == [("slow", "bronze", "fetch_failed")] and lake.read(BRONZE).count() == 1
    lake, retry = Lake(spark, str(tmp_path / "with")).ensure(register=False), str(tmp_path / "retry")
    for _ in range(2):  # the second time nothing is left to do
        Busy(lake, retry_path=retry).run(entries, 0)
    assert [r["entry_id"] for r in read_queue(spark, retry).collect()] == ["slow/2"]
    assert letters(lake) == [] and lake.read(BRONZE).count() == 1 and lake.read(AUDIT).count() == 2


def breaks_once(monkeypatch, owner, name, at=1):
    """``owner.name`` fails at its ``at``-th call and works again afterwards."""
    usual, calls = getattr(owner, name), []

    def wrapped(*args, **kwargs):
        calls.append(args)
        if len(calls) == at:
            raise OSError("lost")
        return usual(*args, **kwargs)

    monkeypatch.setattr(owner, name, wrapped)


@pytest.mark.parametrize("owner,name,at", [(Lake, "write", 2), (Lake, "commit", 1), (files, "rename", 1)])
def test_a_batch_goes_on_where_it_was_interrupted(spark, tmp_path, monkeypatch, owner, name, at):
    lake, retry = Lake(spark, str(tmp_path / "lake")).ensure(register=False), str(tmp_path / "retry")
    enqueue(spark, str(tmp_path / "queue"), TRANSIENT + ["not a job"])
    entries = spark.read.parquet(str(tmp_path / "queue"))
    breaks_once(monkeypatch, owner, name, at)
    with pytest.raises(OSError):
        Busy(lake, retry_path=retry).run(entries, 4)
    if owner is not files:
        assert lake.read(BRONZE).count() == 0 and letters(lake) == []  # all of a batch or nothing
    Busy(lake, retry_path=retry).run(entries, 4)
    assert lake.read(BRONZE).count() == 1 and letters(lake) == [("x2", "bronze", "unparseable_descriptor")]
    assert read_queue(spark, retry).count() == 1 and lake.read(AUDIT).count() == 2


class Full(Lake):
    """Bronze takes no rows; the other tables do."""

    def write(self, name, rows, batch):
        if name == BRONZE:
            raise OSError("no space left")
        super().write(name, rows, batch)


def test_a_failed_append_is_retried_then_a_letter(spark, tmp_path):
    queue, retry = str(tmp_path / "queue"), str(tmp_path / "retry")
    enqueue(spark, queue, [reading(0), reading(1) | {"attempt": 3}, "not a job"])
    lake = Full(spark, str(tmp_path / "lake")).ensure(register=False)
    BronzeStage(lake, retry_path=retry).run(spark.read.parquet(queue), 0)
    assert letters(lake) == [("J0001", "bronze", "append_failed"), ("x2", "bronze", "unparseable_descriptor")]
    letter = lake.read(DEAD).filter("reason = 'append_failed'").first()
    assert "no space left" in letter["detail"] and letter["attempt"] == 3 and json.loads(letter["payload"])["hum"] == 0.4
    assert lake.read(AUDIT).filter("table_name = 'bronze.raw'").first()["added_records"] == 0
    # the entry for the next try holds its payload and works once there is space
    again = read_queue(spark, retry)
    assert [r["entry_id"] for r in again.collect()] == ["J0000/2"]
    BronzeStage(Lake(spark, lake.root)).run(again, 1)
    assert [r["job_id"] for r in lake.read(BRONZE).collect()] == ["J0000"]


def test_an_attempt_beyond_any_number_is_a_letter(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake")).ensure(register=False)
    enqueue(spark, str(tmp_path / "queue"), [reading(0) | {"attempt": 3_000_000_000}, reading(1)])
    BronzeStage(lake).run(spark.read.parquet(str(tmp_path / "queue")), 0)
    assert [x[2] for x in letters(lake)] == ["unparseable_descriptor"] and lake.read(BRONZE).count() == 1


def test_layers_balance(whole):
    bronze, silver = whole.read(BRONZE), whole.read("silver.air_quality")
    balance = layer_balance(reconcile(bronze, silver, whole.read(DEAD).filter("stage = 'silver'"))).first()
    assert balance["bronze_rows"] == 120 and balance["dead_letter_rows"] == 24 and balance["silver_rows"] == silver.count()
    assert sum(balance[1:]) == balance["bronze_rows"]


def test_a_new_column_is_added_and_old_rows_have_null(spark, tmp_path):
    def registry(*columns):
        cols = tuple(MapperColumn(c, c, "double", "unit:ONE", "q:x") for c in columns)
        return Registry([Mapper("m", len(columns), "silver_grow", ("temp",), cols)])

    queue = str(tmp_path / "queue")
    enqueue(spark, queue, [reading(0), reading(1)])
    lake = Lake(spark, str(tmp_path / "lake"), registry("temp")).ensure(register=False)
    BronzeStage(lake).run(spark.read.parquet(queue).filter("entry_id = 'J0000'"), 0)
    SilverStage(lake).run(lake.read(BRONZE), 0)
    lake = Lake(spark, str(tmp_path / "lake"), registry("temp", "hum")).ensure(register=False)
    BronzeStage(lake).run(spark.read.parquet(queue).filter("entry_id = 'J0001'"), 1)
    SilverStage(lake).run(lake.read(BRONZE), 1)
    got = lake.read("silver.grow").orderBy("job_id").select("temp", "hum", "mapper_version").collect()
    assert [tuple(r) for r in got] == [(20.0, None, 1), (21.0, 0.4, 2)]


# --- tables and SQL --------------------------------------------------------


def test_registered_tables_and_documented_queries(spark, whole):
    lake = Lake(spark, whole.root).ensure()
    lake.ensure()
    lake.refresh()
    assert set(lake.tables) <= set(list_tables(spark))
    assert spark.table(BRONZE).count() == 120
    assert len(adhoc.query(spark.table("silver.air_quality")).collect()) == 20
    day = adhoc.query(lake.read("silver.air_quality"), adhoc.ONE_DEVICE_DAY, tenant="t0", device="dev-0", start="2026-09-10", end="2026-09-11").collect()
    assert day and all(r["device_id"] == "dev-0" for r in day) and [r["event_time"] for r in day] == sorted(r["event_time"] for r in day)
    failures = adhoc.query(spark.table(DEAD), adhoc.FAILURES).collect()
    assert [(r["stage"], r["n"]) for r in failures] == [("silver", 12), ("silver", 12), ("bronze", 2)]
    newest = adhoc.query(spark.table(BRONZE), adhoc.NEWEST).collect()
    assert len(newest) == 5 and newest[0]["device_id"] == "dev-4"
    assert adhoc.query(spark.table("silver.air_quality"), adhoc.PER_MAPPER).collect()[0]["mapper_id"] == "indoor-air-quality"
    assert adhoc.query(spark.table(BRONZE), adhoc.SHAPES).count() == 120


# --- publishing ------------------------------------------------------------


@pytest.mark.parametrize("tenant,good", [("plant9", True), ("north-wing-7", True), ("Wing_B2", True), ("..\\up", False), ("p/q", False), ("", False), ("p q", False), ("plant9.csv", False), ("plant9\n", False)])
def test_tenant_ids(spark, tenant, good):
    assert is_safe_tenant(tenant) == good
    assert spark.createDataFrame([(tenant,)], "t string").select(safe_tenant("t").alias("s")).first()["s"] == good


def test_slice_filter(spark):
    rows = [("demo", "a", "2026-09-09 23:59:59"), ("demo", "a", "2026-09-10 00:00:00"), ("demo", "b", "2026-09-10 12:00:00"), ("demo", "a", "2026-09-11 00:00:00"), ("other", "a", "2026-09-10 01:00:00")]
    df = spark.createDataFrame(rows, "tenant_id string, device_id string, t string").withColumn("event_time", F.col("t").cast("timestamp")).withColumn("day", F.to_date("event_time"))
    end = datetime(2026, 9, 11)

    def times(*args):
        plain, pruned = (df.filter(slice_filter(*args, day=d)).orderBy("t") for d in (None, "day"))
        assert plain.collect() == pruned.collect()
        return [r["t"][8:13] for r in plain.collect()]

    assert times("demo") == ["09 23", "10 00", "10 12", "11 00"]
    assert times("demo", "a") == ["09 23", "10 00", "11 00"] and times("demo", "") == times("demo")
    assert times("demo", None, DAY, end) == ["10 00", "10 12"]
    assert times("demo", None, DAY) == ["10 00", "10 12", "11 00"] and times("demo", None, None, end) == ["09 23", "10 00", "10 12"]


def test_publish_writes_one_object(whole, tmp_path):
    out = publish(whole, str(tmp_path), "silver_air_quality", "t0", start=DAY, end=datetime(2026, 9, 12, tzinfo=UTC), limit=3, export_id="slice-0001")
    assert out["count"] == 3 and out["key"] == "t0/silver_air_quality/slice-0001.json"
    assert [p.name for p in (tmp_path / "t0/silver_air_quality").iterdir()] == ["slice-0001.json"] and (tmp_path / out["key"]).is_file()
    document = json.loads((tmp_path / out["key"]).read_text())
    assert document["metadata"]["count"] == 3 and document["metadata"]["device_id"] is None and document["metadata"]["from"].startswith("2026-09-10")
    assert [r["event_time"] for r in document["rows"]] == ["2026-09-10 00:00:00+00:00"] * 3
    assert set(document["rows"][0]) == set(whole.schemas["silver.air_quality"].names)
    assert [(r["job_id"], r["temperature"]) for r in out["rows"]] == [(r["job_id"], r["temperature"]) for r in document["rows"]]
    again = publish(whole, str(tmp_path), "silver_air_quality", "t0", limit=1, export_id="slice-0001")
    assert json.loads((tmp_path / again["key"]).read_text())["metadata"]["count"] == 1  # the object is replaced
    empty = publish(whole, str(tmp_path), "silver_air_quality", "nobody", export_id="none")
    assert empty["count"] == 0 and empty["rows"] == [] and json.loads((tmp_path / empty["key"]).read_text())["rows"] == []


def test_a_failed_publish_leaves_no_object(spark, whole, tmp_path, monkeypatch):
    from lakegauge.plans import publish as plans
    from lakegauge.sources.objects import write_object

    monkeypatch.setattr(plans, "slice_document", lambda rows, **_: rows.select(F.raise_error(F.lit("broken")).alias("value")))
    with pytest.raises(Exception, match="broken"):
        publish(whole, str(tmp_path), "silver_air_quality", "t0", export_id="bad")
    with pytest.raises(Exception, match="one row"):
        write_object(spark.createDataFrame([("a",), ("b",)], "value string"), str(tmp_path / "two.json"))
    assert [p for p in tmp_path.rglob("*") if p.is_file()] == []


@pytest.mark.parametrize("start,end,limit", [(None, None, 3), (None, None, 1000), (DAY, None, 11), (datetime(2026, 9, 11, 1, tzinfo=UTC), datetime(2026, 9, 12, 1, tzinfo=UTC), 9), (None, datetime(2026, 9, 11), 1000)])
def test_a_slice_opens_the_days_it_needs(whole, monkeypatch, start, end, limit):
    opened, usual = [], Lake.rows

    def rows(lake, name, parts):
        parts = list(parts)
        opened.extend(d.day for _, d in parts)
        return usual(lake, name, parts)

    monkeypatch.setattr(Lake, "rows", rows)
    keep = slice_filter("t0", None, start, end)
    got = first_rows(whole, "silver.air_quality", keep, start, end, limit)
    read = list(opened)
    want = take_slice(whole.read("silver.air_quality"), limit, keep).select(*whole.schemas["silver.air_quality"].names).collect()
    assert got == want
    wanted = {(start or DAY).day, *(r["event_time"].day for r in want)}
    if limit == 3:
        assert read == [10]  # full after the first day
    assert len(read) == len(set(read)) and wanted >= {min(read)} and set(read) <= set(range((start or DAY).day, (end.day if end else 12) + 1))


def test_publish_refuses_in_order(whole, tmp_path):
    with pytest.raises(InvalidRequest):
        publish(whole, str(tmp_path), "no_such", "../x")
    with pytest.raises(UnknownTable):
        publish(whole, str(tmp_path), "no_such", "t0", start=DAY, end=DAY)
    with pytest.raises(InvalidRequest):
        publish(whole, str(tmp_path), "silver_air_quality", "t0", start=DAY, end=DAY)
    for limit in (0, 1001):
        with pytest.raises(InvalidRequest):
            publish(whole, str(tmp_path), "silver_air_quality", "t0", limit=limit)


def test_rows_as_json_keep_nulls(spark):
    df = spark.createDataFrame([("d", DAY, None, 21.4)], "device_id string, event_time timestamp, humidity double, temperature double")
    row = df.select(as_json(df).alias("j"), export_key("demo", "silver_air_quality", "slice-0001").alias("k")).first()
    assert json.loads(row["j"]) == {"device_id": "d", "event_time": "2026-09-10 00:00:00+00:00", "humidity": None, "temperature": 21.4}
    assert row["k"] == "demo/silver_air_quality/slice-0001.json"
