"""Rows of older mapper versions are made anew in place."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lakegauge.mappers import Mapper, MapperColumn, Registry
from lakegauge.mappers.shipped import SHIPPED
from lakegauge.plans.reprocess import old_parts, reprocess
from lakegauge.sources.lake import AUDIT, BRONZE, DEAD, Lake
from lakegauge.streaming.stages import SilverStage
from test_stages import breaks_once, letters, reading

AIR = SHIPPED[0]


def air(version, **changes):
    return replace(AIR, version=version, columns=(replace(AIR.columns[0], **changes), AIR.columns[1]))


def rows(lake):
    return sorted((r["job_id"], r["mapper_version"], str(r["event_time"])[:13], r["temperature"], r["device_id"]) for r in lake.read("silver.air_quality").collect())


def arrive(lake, jobs, batch):
    """Jobs as rows of bronze, without the way there."""
    made = [(j["job_id"], j["trace_id"], j["tenant_id"], j["device_id"], j.get("pipeline_hint"), "fp", j["payload"]["data"], j["received_at"], json.loads(j["payload"]["data"]).get("ts")) for j in jobs]
    columns = "job_id, trace_id, tenant_id, device_id, pipeline_hint, schema_fp, payload, received, ts".replace(",", " string,") + " string"
    rows = lake.spark.createDataFrame(made, columns).withColumns({"received_at": F.col("received").cast("timestamp"), "event_time": F.coalesce("ts", "received").cast("timestamp"), "source": F.lit("http")})
    lake.write(BRONZE, rows, f"bronze-{batch}")
    lake.commit(f"bronze-{batch}", "bronze", batch, len(jobs), [BRONZE])
    return lake.committed_rows(BRONZE, lake.commits().filter(F.col("written_in") == f"bronze-{batch}"))


@pytest.fixture
def lake(spark, tmp_path):
    """Two silver batches over the same days, of which the second has one job of another vendor."""
    lake = Lake(spark, str(tmp_path / "lake")).ensure(register=False)
    other = reading(8) | {"job_id": "other", "device_id": "dev-x", "pipeline_hint": "vendor-b-airquality"}
    for batch, jobs in enumerate(([reading(n) for n in range(0, 6)], [reading(n) for n in range(6, 13)] + [other])):
        SilverStage(lake).run(arrive(lake, jobs, batch), batch)
    return lake


def test_nothing_is_old(lake):
    before = lake.read(AUDIT).count()
    assert reprocess(lake)["old"] == 0 and lake.read(AUDIT).count() == before


def test_values_are_made_anew_and_other_rows_stay(spark, lake):
    before = rows(lake)
    newer = Lake(spark, lake.root, Registry([air(3, scale=10, max=255), *SHIPPED[1:]]))
    parts = old_parts(newer).collect()
    assert sum(r["n_old"] for r in parts) == len(before) - 1
    done = reprocess(newer)
    # 26 degrees are above the new bound then
    gone = [x for x in before if x[3] == 26.0]
    want = [(j, 1, t, v, d) if j == "other" else (j, 3, t, v * 10, d) for j, _, t, v, d in before if (j, v) not in {(x[0], x[3]) for x in gone}]
    assert rows(newer) == want and gone
    assert done["rejected"] == len(gone) and done["written"] == len(want) - 1 and done["duplicates"] == 0
    assert [x for x in letters(newer) if x[2] == "out_of_range"] == sorted((x[0], "silver", "out_of_range") for x in gone)
    # only folders with old rows were replaced, and there is nothing left to do
    record = newer.read(AUDIT).filter("stage = 'reprocess' AND table_name = 'silver.air_quality'").first()
    assert {(r["batch"], r["day"]) for r in record["replaces"]} == {(r["batch"], r["day"]) for r in parts}
    assert reprocess(newer)["old"] == 0 and rows(newer) == want
    # a later version starts from what this run wrote
    last = Lake(spark, lake.root, Registry([air(4, scale=1), *SHIPPED[1:]]))
    reprocess(last)
    assert [(j, v) for j, _, _, v, _ in rows(last)] == [(j, v) for j, _, _, v, _ in before if (j, v) not in {(x[0], x[3]) for x in gone}]


def test_times_and_keys_may_change(spark, lake):
    """All old rows fall on one device and on their arrival: other days, and none may meet a current row's key twice."""
    before = rows(lake)
    newer = Lake(spark, lake.root, Registry([replace(AIR, version=2, event_time_from=None, device_id_from="hum"), *SHIPPED[1:]]))
    done = reprocess(newer)
    after = rows(newer)
    assert {x[4] for x in after if x[0] != "other"} == {"0.4"} and [x for x in after if x[0] == "other"] == [x for x in before if x[0] == "other"]
    # bronze's own time stands in, so several jobs share a key; the first arrival stays
    keys = [(x[2], x[4]) for x in after]
    assert len(keys) == len(set(keys)) and done["duplicates"] == len(before) - len(after) > 0


@pytest.mark.parametrize("owner,name", [(Lake, "write"), (Lake, "commit")])
def test_an_interrupted_run_changes_nothing_and_can_be_repeated(spark, lake, monkeypatch, owner, name):
    before = rows(lake)
    newer = Lake(spark, lake.root, Registry([air(2, scale=2), *SHIPPED[1:]]))
    breaks_once(monkeypatch, owner, name)
    with pytest.raises(OSError):
        reprocess(newer)
    assert rows(newer) == before
    reprocess(newer)
    assert [(x[0], x[3]) for x in rows(newer)] == [(x[0], x[3] if x[0] == "other" else x[3] * 2) for x in before]


def test_a_batch_in_between_loses_nothing(spark, lake, monkeypatch):
    """A silver batch is committed while the run works: its rows of the same days stay."""
    newer = Lake(spark, lake.root, Registry([air(2, scale=2), *SHIPPED[1:]]))
    usual = Lake.write_silver

    def write(self, rows, batch):
        if batch.startswith("reprocess"):
            SilverStage(newer).run(arrive(newer, [reading(0) | {"job_id": "late", "device_id": "dev-late"}], 7), 7)
        usual(self, rows, batch)

    monkeypatch.setattr(Lake, "write_silver", write)
    n = len(rows(lake))
    reprocess(newer)
    assert len(rows(newer)) == n + 1 and [x for x in rows(newer) if x[0] == "late"][0][1] == 2


def test_a_job_that_bronze_has_lost_keeps_its_rows(spark, lake):
    newer = Lake(spark, lake.root, Registry([air(2, scale=2), *SHIPPED[1:]]))
    usual = newer.read
    newer.read = lambda name, days=None: usual(name, days).filter("job_id <> 'J0000'") if name == BRONZE else usual(name, days)
    before = [x for x in rows(lake) if x[0] == "J0000"]
    reprocess(newer)
    assert [x for x in rows(newer) if x[0] == "J0000"] == before and before
    assert newer.read(DEAD).filter(F.col("job_id") == "J0000").count() == 0


def test_rows_that_stay_keep_columns_that_are_gone(spark, tmp_path):
    def mapper(i, version, *names):
        return Mapper(i, version, "silver_room", tuple(names[:1]), tuple(MapperColumn(n, n, "double", "unit:ONE", "q:x") for n in names))

    both = Registry([mapper("a", 1, "x"), mapper("b", 1, "y", "z")])
    lake = Lake(spark, str(tmp_path), both).ensure(register=False)
    jobs = [reading(n, **p) | {"job_id": f"j{n}", "device_id": f"d{n}"} for n, p in ((0, {"x": 1}), (12, {"y": 2, "z": 3}))]
    SilverStage(lake).run(arrive(lake, jobs, 0), 0)
    newer = Lake(spark, lake.root, Registry([mapper("a", 2, "x", "w")]))
    assert reprocess(newer) == {"old": 1, "written": 1, "rejected": 0, "duplicates": 0, "kept": 1}
    got = {r["job_id"]: (r["mapper_version"], r["x"], r["y"], r["z"]) for r in lake.read("silver.room").collect()}
    assert got == {"j0": (2, 1.0, None, None), "j12": (1, None, 2.0, 3.0)}
    assert {r["job_id"]: r["w"] for r in newer.read("silver.room").collect()} == {"j0": None, "j12": None}
