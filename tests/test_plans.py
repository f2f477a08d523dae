"""What the plans look like, hot keys, and the registered queries against their SQL."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lakegauge.mappers import Mapper, MapperColumn, Registry
from lakegauge.operators.audit import silver_counts
from lakegauge.operators.dedup import days_of, not_in_table, not_known, one_per_key
from lakegauge.operators.resolve import resolve, with_match_count, with_payload
from lakegauge.operators.transform import map_readings, silver_rows
from lakegauge.plans.oracle import ORACLE
from lakegauge.plans.publish import slice_filter, take_slice
from lakegauge.plans.queries import QUERIES
from lakegauge.sources import files
from lakegauge.sources.lake import Lake
from lakegauge.streaming.stages import SilverStage, catch_up
from oracle_check import compare, connect

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="given tables are not here")


@pytest.fixture(scope="module")
def sql_tables():
    return connect(SMALL)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def readings(spark, rows):
    """Rows of which a third share one device and time."""
    return spark.range(rows).select(
        F.lpad(F.col("id").cast("string"), 8, "0").alias("job_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("d"), (F.col("id") % 50).cast("string"))).alias("device_id"),
        F.when(F.col("id") % 3 == 0, F.lit("2026-01-01 00:00:00").cast("timestamp"))
        .otherwise(F.timestamp_add("HOUR", (F.col("id") % 70).cast("int"), F.lit("2026-01-01 00:00:00").cast("timestamp"))).alias("event_time"),
        F.timestamp_add("SECOND", (F.lit(rows) - F.col("id")).cast("int"), F.lit("2026-02-01 00:00:00").cast("timestamp")).alias("received_at"),
    )


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    rows = readings(spark, 30000).repartition(6)
    kept = one_per_key(rows)
    text = plan(kept)
    # each task passes on one row per key; the rest never travels
    assert "Partial" in text.split("WindowGroupLimit")[-1] and text.count("WindowGroupLimit") == 2
    got = {(r["device_id"], r["event_time"]): r["job_id"] for r in kept.collect()}
    want = {}
    for r in sorted(rows.collect(), key=lambda r: (r["received_at"], r["job_id"])):
        want.setdefault((r["device_id"], r["event_time"]), r["job_id"])
    assert got == want


def test_dedup_and_lookup_share_one_exchange(spark):
    batch, table = readings(spark, 3000), readings(spark, 1000).select("device_id", "event_time")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = not_in_table(one_per_key(batch), one_per_key(table.withColumns({"received_at": F.lit(None).cast("timestamp"), "job_id": F.lit("x")})))
        assert plan(fresh).count("Exchange hashpartitioning") == 2  # one per side
        seen = {tuple(r) for r in table.collect()}
        assert {(r["device_id"], r["event_time"]) for r in fresh.collect()} == {
            (r["device_id"], r["event_time"]) for r in batch.collect() if (r["device_id"], r["event_time"]) not in seen}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_days_of_the_batch_are_read(spark, tmp_path):
    from datetime import date

    def at(*times):
        return spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("event_time"))

    lake = Lake(spark, str(tmp_path)).ensure(register=False)
    others = [F.lit(None).cast(f.dataType).alias(f.name) for f in lake.schemas["silver.water"] if f.name != "event_time"]
    rows = at("2026-01-01 05:00:00", "2026-01-02 06:00:00", "2026-01-03 07:00:00").select("*", *others)
    stored = [F.lit(None).cast(t).alias(c) for c, t in lake.silver_columns.items()]
    lake.write_silver(rows.select("*", *stored, F.lit("silver.water").alias("table_name")), "b1")
    assert lake.read("silver.water").count() == 0  # not recorded yet
    lake.commit("b1", "silver", 0, 3, ["silver.water"])
    days = sorted(r["day"] for r in days_of(at("2026-01-02 23:59:59", "1999-03-04 00:00:00", None)).collect())
    assert days == [date(1999, 3, 4), date(2026, 1, 2)]
    known = lake.read("silver.water", days)
    assert [str(r["event_time"]) for r in known.collect()] == ["2026-01-02 06:00:00"] and known.columns == lake.read("silver.water").columns
    assert known.inputFiles() and all("/event_time_day=2026-01-02/" in f for f in known.inputFiles())
    assert lake.read("silver.water", []).count() == 0


def test_the_table_is_not_shuffled_for_a_small_batch(spark, tmp_path):
    batch = readings(spark, 3000)
    path = str(tmp_path / "table")
    readings(spark, 1000).select("device_id", "event_time").write.parquet(path)
    table = spark.read.parquet(path)
    seen = {(r["device_id"], r["event_time"]) for r in table.collect()}
    want = {(r["device_id"], r["event_time"]) for r in batch.collect()} - seen
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, moved in ((3000, False), (2999, True)):
            fresh = not_known(one_per_key(batch), table, 3000, most=most)
            assert {(r["device_id"], r["event_time"]) for r in fresh.collect()} == want
            if moved:
                assert "LeftSemi" not in plan(fresh)
            else:
                # from its scan up to the lookup in the batch's keys the table meets no exchange
                lookup = plan(fresh).split("LeftSemi")[1]
                assert "BroadcastHashJoin" in plan(fresh) and "Exchange" not in lookup.split("FileScan")[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_queries_at_the_same_time_have_their_own_table(spark):
    from concurrent.futures import ThreadPoolExecutor

    from lakegauge.plans import adhoc

    spark.range(3).createOrReplaceTempView("t")  # somebody else's
    sqls = ("SELECT max(id) AS m FROM t", "with u AS (SELECT id FROM t WHERE id > :least) SELECT max(id) AS m FROM u")
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda n: adhoc.query(spark.range(n), sqls[n % 2], **({"least": "1"} if n % 2 else {})).first()["m"], range(5, 25)))
    assert got == list(range(4, 24)) and spark.table("t").count() == 3
    assert [v.name for v in spark.catalog.listTables() if v.isTemporary and v.name.startswith("t_")] == []
    spark.catalog.dropTempView("t")


def test_publishing_sorts_only_the_top(spark, tmp_path):
    path = str(tmp_path / "table")
    readings(spark, 100).withColumn("tenant_id", F.lit("t1")).write.parquet(path)
    text = plan(take_slice(spark.read.parquet(path), 10, slice_filter("t1")))
    assert "TakeOrderedAndProject" in text and "PushedFilters: [IsNotNull(tenant_id)" in text


BRONZE = (
    "job_id string, trace_id string, received_at timestamp, event_time timestamp, tenant_id string, device_id string, "
    "pipeline_hint string, schema_fp string, payload string"
)


def test_mapping_is_narrow_and_parses_once(spark):
    bronze = spark.createDataFrame([], BRONZE)
    df = silver_rows(map_readings(bronze, Registry.shipped()), Registry.shipped(), "silver_energy")
    assert optimized(df).count("parseJson") == 1
    assert "Exchange" not in plan(df)


def many_mappers(n):
    """Mappers of as many tables; of two neighbours one has a whole number where the other has a double."""
    columns = lambda i: (MapperColumn("x", f"a{i}", "double", "unit:ONE", "q:x", min=0), MapperColumn("y", f"b.c{i}", "int" if i % 2 else "double", "unit:ONE", "q:y"))
    return Registry([Mapper(f"m{i:03}", 1, f"silver_t{i:03}", (f"a{i}", f"b.c{i}"), columns(i)) for i in range(n)])


def test_the_plan_does_not_grow_with_the_mappers(spark):
    def nodes(df):
        """Operators and functions of a plan, not counting the constants' contents."""
        text = optimized(df)
        assert "from_json" not in text  # folded into one constant each
        return text.count("\n"), text.count("lambdafunction"), text.count("CASE WHEN")

    def resolved(n):
        return resolve(with_payload(spark.createDataFrame([], BRONZE)), many_mappers(n))

    assert nodes(resolved(5)) == nodes(resolved(500))
    assert nodes(map_readings(spark.createDataFrame([], BRONZE), many_mappers(5))) == nodes(map_readings(spark.createDataFrame([], BRONZE), many_mappers(500)))


def test_the_first_of_many_mappers_that_fits_is_picked(spark):
    """Against trying mapper by mapper, with shared paths, dots in keys, objects in place of values, and nulls."""
    registry = Registry([Mapper(f"m{i:02}", 1, "silver_t", tuple(keys), (MapperColumn("x", "a", "double", "u", "q"),)) for i, keys in enumerate(
        [("a", "b", "c.d"), ("a", "b"), ("c.d.e", "a"), ("c.d", "c.f"), ("c",), ("a", "a"), ("k.l",)])])
    payloads = [
        {}, {"a": 1}, {"a": None, "b": 2}, {"a": 1, "b": 2, "c": {"d": 0}}, {"a": 1, "c": {"d": {"e": None}}}, {"c": {"d": 1, "f": 2}}, {"c": [{"d": 1}]}, {"c.d": 1, "c.f": 2},
        {"k.l": 1}, {"k": {"l": {}}}, {"k": "l"}, {"b": 1}, [1], "text", {"c": {"d.e": 1}, "a": 1},
    ]

    def has(value, path):
        for key in path.split("."):
            if not isinstance(value, dict) or key not in value:
                return False
            value = value[key]
        return True

    want = [[m.id for m in registry if all(has(p, k) for k in m.required_keys)] for p in payloads]
    rows = spark.createDataFrame([(f"{i:02}", json.dumps(p), None) for i, p in enumerate(payloads)], "job_id string, payload string, pipeline_hint string")
    parsed = with_payload(rows)
    assert [r["mapper_id"] for r in resolve(parsed, registry).orderBy("job_id").collect()] == [w[0] if w else None for w in want]
    assert [r["matches"] for r in with_match_count(parsed, registry).orderBy("job_id").collect()] == [len(w) for w in want]


def test_many_tables_are_written_by_one_job(spark, tmp_path):
    registry = many_mappers(120)
    rows = [(f"J{k:04}", "t", "t0", f"d{k % 7}", None, "fp", json.dumps({f"a{k % 120}": k - 120, "b": {f"c{k % 120}": 2}})) for k in range(360)]
    bronze = spark.createDataFrame(rows, "job_id string, trace_id string, tenant_id string, device_id string, pipeline_hint string, schema_fp string, payload string")
    bronze = bronze.withColumns({"event_time": F.lit("2026-01-01 00:00:00").cast("timestamp"), "received_at": F.timestamp_add("SECOND", F.col("job_id").substr(2, 4).cast("int"), F.lit("2026-01-02 00:00:00").cast("timestamp"))})
    lake = Lake(spark, str(tmp_path), registry).ensure(register=False)
    written = []
    usual = lake.write_silver
    lake.write_silver = lambda *args: (written.append(args), usual(*args))
    for batch in (0, 1):  # the second batch only has copies
        SilverStage(lake).run(bronze.withColumn("job_id", F.concat("job_id", F.lit(str(batch)))), batch)
    assert len(written) == 2
    commits = lake.read("ops.commits").filter("table_name LIKE 'silver.%'").groupBy("batch_id").agg(F.sum("added_records"), F.sum("duplicates"), F.count("*")).orderBy("batch_id").collect()
    assert [tuple(r) for r in commits] == [(0, 240, 0, 120), (1, 0, 240, 120)]  # the first 120 are below the least value
    row = lake.read("silver.t007").orderBy("job_id").first()
    assert (row["job_id"], row["x"], row["y"]) == ("J01270", 7.0, 2) and dict(lake.read("silver.t007").dtypes)["y"] == "bigint" and dict(lake.read("silver.t008").dtypes)["y"] == "double"


def test_silver_opens_committed_folders_only(spark, tmp_path):
    """The stream lists the commit records; no other folder of bronze than the committed one is opened."""
    lake = Lake(spark, str(tmp_path / "lake")).ensure(register=False)
    bronze = spark.createDataFrame([("J1", "t", "t0", "d", None, "fp", '{"temp": 20, "hum": 0.5}')], "job_id string, trace_id string, tenant_id string, device_id string, pipeline_hint string, schema_fp string, payload string")
    bronze = bronze.withColumns({"event_time": F.lit("2026-01-01 00:00:00").cast("timestamp"), "received_at": F.lit("2026-01-02 00:00:00").cast("timestamp"), "source": F.lit("http")})
    for batch in ("b1", "b2", "gone", "torn"):
        lake.write("bronze.raw", bronze.withColumn("job_id", F.lit(batch)), batch)
        if batch != "torn":
            lake.commit(batch, "bronze", 0, 1, ["bronze.raw"])
    # a listing of the root would stumble over this
    (tmp_path / "lake/bronze/raw/written_in=torn/received_at_day=2026-01-02/part-broken.parquet").write_bytes(b"no parquet")
    files.delete(spark, lake.folder("bronze.raw", "gone"))
    catch_up(SilverStage(lake), lake.stream_commits("bronze.raw"), str(tmp_path / "cp"))
    got = lake.read("silver.air_quality").collect()
    assert [r["job_id"] for r in got] == ["b1"]
    silver = lake.read("ops.commits").filter("stage = 'silver' AND table_name = 'silver.air_quality'").first()
    assert (silver["rows_in"], silver["added_records"], silver["duplicates"]) == (2, 1, 1)
    read = lake.committed_rows("bronze.raw", lake.commits().filter("written_in = 'b2'")).inputFiles()
    assert read and all("/written_in=b2/" in f for f in read)
    before = lake.commits().count()
    catch_up(SilverStage(lake), lake.stream_commits("bronze.raw"), str(tmp_path / "cp"))  # its own records feed nothing
    assert lake.commits().count() == before


def test_counts_need_no_second_pass(spark):
    mapped = map_readings(spark.createDataFrame([], BRONZE), Registry.shipped())
    assert optimized(silver_counts(mapped)).count("parseJson") == 1


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sql_tables, name):
    kept = {}

    def query(session, folder):
        kept["df"] = QUERIES[name](session, folder)
        return kept["df"]

    assert compare(spark, sql_tables, name, query, ORACLE[name], SMALL) is None
    # nothing but the fetch of landed objects leaves the JVM, nothing is paired with everything
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert bad not in plan(kept["df"])
