"""Every operator as a query over the given tables.

Each takes a session and a table folder and gives a DataFrame; ``oracle`` holds
the same questions in plain SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.functions.fingerprint import EMPTY_SHAPE, with_fingerprint
from lakegauge.functions.strict_json import is_object_text, kind, path_value, with_json
from lakegauge.mappers import Mapper, MapperColumn, Registry
from lakegauge.operators import admission, audit, bronze, dedup, descriptor, redrive, resolve, transform
from lakegauge.plans import adhoc, dataset, publish, reprocess
from lakegauge.plans.readings import events, landing_area, queue_entries, readings
from lakegauge.session import configure, shared_dir
from lakegauge.sources import landing
from lakegauge.sources.lake import AUDIT, BRONZE, DEAD, Lake
from lakegauge.sources.queue import read_queue, stream_queue
from lakegauge.streaming.stages import BronzeStage, SilverStage, catch_up

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AIR, ENERGY, WATER = "silver_air_quality", "silver_energy", "silver_water"
SLICE_START, SLICE_END = datetime(2024, 1, 5, tzinfo=UTC), datetime(2024, 1, 20, tzinfo=UTC)
NEWER_POWER = 60.0  # the most that the second version of a mapper takes
SLICE = {"tenant_id": "t1", "device_id": None, "start": SLICE_START, "end": SLICE_END, "limit": 200}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def text(time: str | Column) -> Column:
    """A time as text, so that engines need not agree on time zones."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def with_times_as_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: text(n) for n in names})


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Worked out once: what several branches read is not worked out for each of them."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bronze_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as rows of bronze.raw."""
    rows = readings(spark, sf_dir).withColumns(
        {"stage": F.lit("bronze"), "reason": F.lit(None).cast("string"), "data": F.lit(None).cast("string")}
    )
    return bronze.bronze_rows(bronze.describe_payload(rows))


def mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with their verdicts. The bronze time is worked out, the fingerprint is not needed."""
    parsed = with_json(readings(spark, sf_dir), "payload", "_b")
    rows = parsed.withColumn("event_time", bronze.event_time("_b", "received_at")).drop("_b")
    return transform.map_readings(rows, Registry.shipped())


def silver_table(spark: SparkSession, sf_dir: str, target: str) -> DataFrame:
    return dedup.one_per_key(transform.silver_rows(mapped(spark, sf_dir), Registry.shipped(), target))


# --- admission -------------------------------------------------------------


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as request bodies; some are empty, not UTF-8, or lack a header."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text").cast("binary").alias("text"))
    every = lambda n: F.col("doc_id") % n == 0
    return docs.select(
        "doc_id",
        F.when(every(29), F.lit(b"")).when(every(31), F.concat("text", F.unhex(F.lit("FF")))).otherwise(F.col("text")).alias("body"),
        F.when(~every(37), F.when(every(43), "").otherwise(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")))).alias("device_id"),
        F.when(~every(41), "docs").alias("tenant_id"),
    )


@query
def admission_checks(spark, sf_dir):
    admitted = admission.admit(_requests(spark, sf_dir), max_bytes=65536)
    return admitted.select("doc_id", F.octet_length("body").cast("bigint").alias("size_bytes"), "admit_reason")


@query
def size_route(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.lpad(F.col("doc_id").cast("string"), 26, "0").alias("job_id"), "text", F.col("doc_id").alias("minute")
    )
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        F.concat_ws("-", F.lit("c"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("job_id"),
        "text",
        F.col("conv_id").alias("minute"),
    )
    base = F.lit("2026-01-01 00:00:00").cast("timestamp")
    bodies = docs.unionByName(turns).select(
        "job_id", F.col("text").cast("binary").alias("body"), F.timestamp_add("MINUTE", "minute", base).alias("received_at")
    )
    routed = admission.route(bodies, inline_max=1024)
    return routed.select("job_id", "size_bytes", "sha256", "mode", "s3_key", F.octet_length("data").cast("bigint").alias("inline_bytes"))


@query
def envelope_stamp(spark, sf_dir):
    source = readings(spark, sf_dir).select("event_id", "received_at")
    stamped = admission.stamp(source, F.lit("events"), "event_id")
    return stamped.select("event_id", "job_id", "trace_id", text("received_at").alias("received_at"), "stage", "attempt")


@query
def queue_round_trip(spark, sf_dir):
    """Readings written as descriptors and read back: nothing may change."""
    rows = readings(spark, sf_dir).withColumns(
        {"body": F.col("payload").cast("binary"), "stage": F.lit("bronze"), "attempt": F.lit(1)}
    )
    jobs = descriptor.parse_jobs(admission.to_queue(admission.route(rows, inline_max=100)))
    return jobs.select(
        "job_id", "device_id", "pipeline_hint", text("received_at").alias("received_at"), "mode", "s3_key", "sha256",
        F.sha2("data", 256).alias("data_sha256"), "violations",
    )


# --- descriptors and bronze ------------------------------------------------


@query
def descriptor_validate(spark, sf_dir):
    jobs = descriptor.parse_jobs(queue_entries(spark, sf_dir))
    return jobs.select(
        "entry_id", "violations", "job_id", "tenant_id", "mode", "size_bytes", "attempt", text("received_at").alias("received_at")
    )


def _landed(spark, sf_dir, jobs):
    """The objects that jobs name, from a landing area of files; those that time out have no file."""
    area, root = landing_area(spark, sf_dir), shared_dir(spark, "landing")
    bodies = area.filter("fetch_error IS NULL").select(F.lit("reference").alias("mode"), F.col("key").alias("s3_key"), F.col("content").alias("body"))
    landing.land(bodies, root)
    return landing.objects_for(jobs, root).unionByName(area.filter("fetch_error IS NOT NULL"))


def _jobs(spark, sf_dir, sent_again: bool = False) -> DataFrame:
    """Parsed entries, as the bronze stage stores them; with those ``sent_again``, each reading has a usable one."""
    entries = queue_entries(spark, sf_dir)
    if sent_again:
        entries = entries.unionByName(queue_entries(spark, sf_dir, mended=True))
    parsed = descriptor.parse_jobs(entries)
    return stored(parsed.withColumn("job", F.when(F.col("violations").isNotNull(), F.col("job"))), "jobs")


def _checked(spark, sf_dir, jobs: DataFrame) -> DataFrame:
    return bronze.check_integrity(bronze.attach_payload(jobs.filter("violations IS NULL"), landing_area(spark, sf_dir)))


def _outcomes(spark, sf_dir):
    return bronze.bronze_outcomes(queue_entries(spark, sf_dir), landing_area(spark, sf_dir), parsed=_jobs(spark, sf_dir))


@query
def landing_fetch(spark, sf_dir):
    jobs = _jobs(spark, sf_dir, sent_again=True).filter("violations IS NULL")
    return bronze.attach_payload(jobs, _landed(spark, sf_dir, jobs)).select(
        "job_id", "mode", "s3_key", F.octet_length("content").cast("bigint").alias("content_bytes"),
        F.sha2("content", 256).alias("content_sha256"), "fetch_error",
    )


@query
def integrity_check(spark, sf_dir):
    checked = _checked(spark, sf_dir, _jobs(spark, sf_dir, sent_again=True))
    return checked.select("job_id", "mode", "reason", F.octet_length("payload").cast("bigint").alias("payload_bytes"))


@query
def bronze_rows(spark, sf_dir):
    rows = bronze.bronze_rows(_outcomes(spark, sf_dir))
    return with_times_as_text(rows, "received_at", "event_time")


@query
def bronze_dead_letters(spark, sf_dir):
    letters = bronze.dead_letters(_outcomes(spark, sf_dir))
    return letters.select(
        "job_id", "trace_id", "stage", "reason", "detail", "tenant_id", "device_id", "attempt", "s3_key", "schema_fp",
        # the text of an unusable descriptor is checked by the tests
        F.when(F.col("reason") != "unparseable_descriptor", F.sha2("payload", 256)).alias("payload_sha256"),
    )


@query
def bounded_retry(spark, sf_dir):
    again = descriptor.parse_jobs(redrive.retries(_outcomes(spark, sf_dir)))
    return again.select("entry_id", "job_id", "s3_key", "size_bytes", "attempt", "violations")


@query
def redrive_dead_letters(spark, sf_dir):
    """Dead letters of a fetch, rebuilt from the jobs that failed."""
    jobs = _jobs(spark, sf_dir)
    checked = _checked(spark, sf_dir, jobs)
    letters = checked.filter("reason IS NOT NULL").select("job_id", "reason", "attempt")
    again = descriptor.parse_jobs(redrive.redrive(letters, jobs))
    return again.select("entry_id", "job_id", "mode", "s3_key", "attempt", "violations")


@query
def event_time_extract(spark, sf_dir):
    parsed = with_json(readings(spark, sf_dir), "payload", "_v")
    return parsed.select("job_id", text(bronze.event_time("_v", "received_at")).alias("event_time"))


@query
def json_kinds(spark, sf_dir):
    parsed = with_json(readings(spark, sf_dir), "payload", "_v")
    paths = ("ts", "time", "temp", "hum", "tags", "measurements", "measurements.rh", "current", "meter", "e")
    kinds = parsed.select(*[F.coalesce(kind(path_value("_v", p)), F.lit("missing")).alias(p.replace(".", "_")) for p in paths])
    long = kinds.unpivot([], [F.col(p.replace(".", "_")) for p in paths], "path", "kind")
    return long.groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n"))


@query
def fingerprint_groups(spark, sf_dir):
    return bronze_table(spark, sf_dir).groupBy("schema_fp").agg(F.count(F.lit(1)).alias("n"), F.min("job_id").alias("first_job_id"))


@query
def fingerprint_any_json(spark, sf_dir):
    """Shapes as dead letters describe them: any JSON value, NULL for other text."""
    parsed = with_json(readings(spark, sf_dir), "payload", "_v")
    return with_fingerprint(parsed, "_v", "payload", "schema_fp").select(
        "job_id", "schema_fp", (F.col("_v").isNotNull() & is_object_text("payload")).alias("is_object")
    )


@query
def props_shapes(spark, sf_dir):
    shaped = with_fingerprint(with_json(events(spark, sf_dir, "event_type", "props"), "props", "_v"), "_v", "props", "schema_fp")
    return shaped.groupBy("event_type", "schema_fp").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("schema_fp") == EMPTY_SHAPE).alias("n_empty"))


# --- mapping ---------------------------------------------------------------


@query
def resolve_counts(spark, sf_dir):
    resolved = resolve.resolve(resolve.with_payload(readings(spark, sf_dir)), Registry.shipped())
    return resolved.groupBy("mapper_id").agg(F.count(F.lit(1)).alias("n"))


@query
def resolve_ambiguous(spark, sf_dir):
    counted = resolve.with_match_count(resolve.with_payload(readings(spark, sf_dir)), Registry.shipped())
    return counted.groupBy("matches").agg(F.count(F.lit(1)).alias("n"))


@query
def mapped_verdicts(spark, sf_dir):
    return mapped(spark, sf_dir).select("job_id", "mapper_id", "mapper_version", "target_table", "reason")


def _silver_query(target: str) -> Query:
    def run(spark, sf_dir):
        return with_times_as_text(silver_table(spark, sf_dir, target), "event_time", "received_at")

    run.__name__ = target
    return query(run)


for _target in (AIR, ENERGY, WATER):
    _silver_query(_target)


@query
def silver_dead_letters(spark, sf_dir):
    letters = transform.silver_dead_letters(
        transform.map_readings(bronze_table(spark, sf_dir), Registry.shipped())
    )
    return letters.select("job_id", "stage", "reason", "detail", "tenant_id", "device_id", "attempt", "schema_fp", text("received_at").alias("received_at"))


def _typed_registry() -> Registry:
    def column(name: str, type_name: str, **more) -> MapperColumn:
        return MapperColumn(name, f"x.{name}", type_name, "unit:ONE", "qudt:Any", **more)

    columns = (
        column("n", "int", min=0, max=30000),
        column("s", "string"),
        column("b", "bool"),
        column("t", "timestamp"),
        column("d", "double", required=True),
    )
    return Registry([Mapper("typed", 7, "silver_typed", ("x",), columns)])


# The same value in many spellings: as a number, a text, a bool, nothing.
TYPED_PAYLOAD = """
'{"x": {"n": ' || CASE event_id % 8 WHEN 0 THEN c WHEN 1 THEN c || '.75' WHEN 2 THEN '"' || c || '"' WHEN 3 THEN '" ' || c || '_0 "'
    WHEN 4 THEN 'true' WHEN 5 THEN 'null' WHEN 6 THEN '"' || c || '.5"' ELSE '-' || c END ||
', "s": ' || CASE event_id % 5 WHEN 0 THEN '"' || c || '"' WHEN 1 THEN c WHEN 2 THEN c || '.50' WHEN 3 THEN 'false' ELSE 'null' END ||
', "b": ' || CASE event_id % 7 WHEN 0 THEN '"false"' WHEN 1 THEN '""' WHEN 2 THEN '0' WHEN 3 THEN c WHEN 4 THEN '[]' WHEN 5 THEN '{"k": 0}' ELSE 'true' END ||
', "t": ' || CASE event_id % 6 WHEN 0 THEN '"2026-11-19T17:26:41+02:00"' WHEN 1 THEN '20261119' WHEN 2 THEN '"2026-11-19"' WHEN 3 THEN 'null'
    WHEN 4 THEN '"20261119T1726"' ELSE '"2026-11-19T24:00:00"' END ||
CASE event_id % 9 WHEN 0 THEN '' WHEN 1 THEN ', "d": null' WHEN 2 THEN ', "d": "1e3"' WHEN 3 THEN ', "d": [1]' ELSE ', "d": ' || c END || '}}'
"""


@query
def typed_casts(spark, sf_dir):
    cents = F.round(F.col("value") * 100).cast("bigint").cast("string")
    rows = events(spark, sf_dir, "event_id", "ts", "value").withColumn("c", cents).select(
        F.lpad(F.col("event_id").cast("string"), 26, "0").alias("job_id"),
        F.lit("t").alias("trace_id"),
        F.lit("tenant").alias("tenant_id"),
        F.lit("device").alias("device_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("ts").cast("timestamp").alias("received_at"),
        F.lit(None).cast("string").alias("pipeline_hint"),
        F.expr(TYPED_PAYLOAD).alias("payload"),
    )
    registry = _typed_registry()
    verdicts = transform.map_readings(rows, registry)
    return verdicts.select(
        "job_id",
        "reason",
        *[
            F.when(F.col("reason").isNull(), text(c) if t == "timestamp" else c).alias(name)
            for n, (name, t) in enumerate((("n", "int"), ("s", "string"), ("b", "bool"), ("t", "timestamp"), ("d", "double")))
            for c in [F.col(transform.slot_column(n, t))]
        ],
    )


# --- deduplication ---------------------------------------------------------


def _halves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Accepted air readings that arrived before and after the middle of the month."""
    rows = stored(transform.silver_rows(mapped(spark, sf_dir), Registry.shipped(), AIR), "air")
    middle = F.lit("2024-01-16 00:00:00").cast("timestamp")
    return rows.filter(F.col("received_at") < middle), rows.filter(F.col("received_at") >= middle)


@query
def dedup_against_existing(spark, sf_dir):
    """A batch against a table that already holds an earlier batch and shares its times."""
    early, late = _halves(spark, sf_dir)
    # late copies of early readings, so that there is something to skip
    copies = early.withColumns({"job_id": F.concat(F.lit("copy-"), F.col("job_id")), "received_at": F.col("received_at") + F.expr("INTERVAL 60 DAYS")})
    table = dedup.one_per_key(early).filter("substring(job_id, 26, 1) IN ('0', '1', '2', '3', '4', '5', '6')")
    fresh = dedup.not_in_table(dedup.one_per_key(late.unionByName(copies)), table)
    return fresh.select("job_id", "device_id", text("event_time").alias("event_time"), "temperature", "humidity")


@query
def dedup_counts(spark, sf_dir):
    return audit.silver_counts(mapped(spark, sf_dir))


@query
def dedup_last_per_tenant(spark, sf_dir):
    rows = transform.silver_rows(mapped(spark, sf_dir), Registry.shipped(), ENERGY)
    kept = dedup.one_per_key(rows, keys=("tenant_id", "device_id", "event_time"), keep="last")
    return kept.select("job_id", "tenant_id", "device_id", text("event_time").alias("event_time"), "power", "energy", "current")


# --- publishing ------------------------------------------------------------


def _slice(spark, sf_dir) -> DataFrame:
    keep = publish.slice_filter(SLICE["tenant_id"], SLICE["device_id"], SLICE["start"], SLICE["end"])
    return publish.take_slice(silver_table(spark, sf_dir, AIR), SLICE["limit"], keep)


@query
def publish_slice(spark, sf_dir):
    return with_times_as_text(_slice(spark, sf_dir), "event_time", "received_at")


@query
def publish_metadata(spark, sf_dir):
    request = {**SLICE, "table": AIR, "key": f"t1/{AIR}/slice-0001.json"}
    return publish.slice_metadata(_slice(spark, sf_dir), **request)


@query
def publish_rows_as_json(spark, sf_dir):
    """Rows as exported, read back from their JSON; measurements as numbers, as engines spell doubles differently."""
    rows = silver_table(spark, sf_dir, WATER).withColumn("nothing", F.lit(None).cast("string"))
    exported = rows.select("job_id", publish.as_json(rows).alias("json"), publish.export_key(F.col("tenant_id"), WATER, F.col("job_id")).alias("key"))
    numbers = ("mapper_version", "flow", "volume")
    fields = F.json_object_keys("json")
    return exported.select(
        "key", F.array_join(fields, ",").alias("fields"), F.get_json_object("json", "$.nothing").alias("nothing"),
        *[F.get_json_object("json", f"$.{c}").alias(c) for c in rows.columns if c not in (*numbers, "nothing")],
        *[F.get_json_object("json", f"$.{c}").cast("double").alias(c) for c in numbers],
    )


@query
def publish_tenant_check(spark, sf_dir):
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    # one in three keeps its '#', one in five gets a slash
    name = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise(F.replace("c_name", F.lit("#"), F.lit("-")))
    names = customers.select("c_custkey", F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("../"), name)).otherwise(name).alias("tenant_id"))
    return names.select("c_custkey", "tenant_id", publish.safe_tenant("tenant_id").alias("usable"))


# --- SQL and counts --------------------------------------------------------


@query
def adhoc_device_day(spark, sf_dir):
    day = adhoc.query(
        silver_table(spark, sf_dir, AIR), adhoc.ONE_DEVICE_DAY, tenant="t2", device="dev-2", start="2024-01-03", end="2024-01-10"
    )
    return with_times_as_text(day, "event_time")


@query
def dead_letter_reasons(spark, sf_dir):
    """Letters of both stages: entries that never reached bronze, and readings that silver rejects."""
    unusable = bronze.dead_letters(_outcomes(spark, sf_dir)).select("stage", "reason")
    rejected = mapped(spark, sf_dir).filter("reason IS NOT NULL").select(F.lit("silver").alias("stage"), "reason")
    return adhoc.query(unusable.unionByName(rejected), adhoc.FAILURES)


@query
def adhoc_newest(spark, sf_dir):
    return with_times_as_text(adhoc.query(bronze_table(spark, sf_dir), adhoc.NEWEST), "received_at")


@query
def rows_per_mapper(spark, sf_dir):
    return adhoc.query(silver_table(spark, sf_dir, ENERGY), adhoc.PER_MAPPER)


@query
def adhoc_shapes(spark, sf_dir):
    return with_times_as_text(adhoc.query(bronze_table(spark, sf_dir), adhoc.SHAPES), "event_time")


def _layers(spark, sf_dir) -> DataFrame:
    columns = ("job_id", F.col("bronze_device_id"), "device_id", "event_time", "received_at", "target_table", "reason")
    rows = stored(mapped(spark, sf_dir).select(*columns), "mapped")
    kept = dedup.one_per_key(rows.filter("reason IS NULL"), ("target_table", *dedup.KEYS))
    return audit.reconcile(rows.select("job_id", F.col("bronze_device_id").alias("device_id")), kept, rows.filter("reason IS NOT NULL"))


@query
def reconcile_layers(spark, sf_dir):
    return audit.layer_balance(_layers(spark, sf_dir))


@query
def device_layers(spark, sf_dir):
    return _layers(spark, sf_dir).groupBy("device_id", "outcome").agg(F.count(F.lit(1)).alias("n"))


@query
def all_null_rows(spark, sf_dir):
    return audit.all_null_rows(silver_table(spark, sf_dir, WATER), Registry.shipped(), WATER)


# --- streams ---------------------------------------------------------------


def _streamed(spark, sf_dir) -> tuple[Lake, DataFrame]:
    """The whole way as streams, faults in the queue and all: queue files -> bronze -> silver, until caught up; and the retries."""
    home = shared_dir(spark, "streamed")
    lake = Lake(spark, f"{home}/lake").ensure(register=False)
    queue_entries(spark, sf_dir).write.parquet(f"{home}/queue")

    class Bronze(BronzeStage):
        def objects(self, jobs):
            return _landed(spark, sf_dir, jobs)

    catch_up(Bronze(lake, retry_path=f"{home}/retries"), stream_queue(spark, f"{home}/queue"), f"{home}/bronze-checkpoint")
    catch_up(SilverStage(lake), lake.stream_commits(BRONZE), f"{home}/silver-checkpoint")
    return lake, read_queue(spark, f"{home}/retries")


@query
def stream_silver_air_quality(spark, sf_dir):
    lake, _ = _streamed(spark, sf_dir)
    rows = lake.read("silver.air_quality").select(*lake.schemas["silver.air_quality"].names)
    return with_times_as_text(rows, "event_time", "received_at")


@query
def stream_commits(spark, sf_dir):
    """Every entry of the queue is a row of bronze, a letter or a retry; every row of bronze one of silver, a letter or a duplicate."""
    lake, again = _streamed(spark, sf_dir)
    commits = lake.read(AUDIT)
    added = audit.added_records(commits)
    skipped = commits.groupBy("stage", "table_name").agg(F.sum("duplicates").alias("duplicates"), F.max("rows_in").alias("rows_in"))
    tables = added.groupBy("stage", "table_name").agg(F.sum("added_records").alias("added_records")).join(skipped, ["stage", "table_name"])
    no_number = F.lit(None).cast("bigint")
    retried = again.agg(F.count("*").alias("added_records")).select(F.lit("bronze").alias("stage"), F.lit("retries").alias("table_name"), "added_records", no_number.alias("duplicates"), no_number.alias("rows_in"))
    return tables.unionByName(retried)


# --- a lake of two batches: versions of mappers, observations, the dataset record ---


def _filled(spark, sf_dir) -> Lake:
    """All readings in bronze, and in silver in two batches: those before and after the middle of the month."""
    lake = Lake(spark, f"{shared_dir(spark, 'filled')}/lake").ensure(register=False)
    lake.write(BRONZE, bronze_table(spark, sf_dir), "filled")
    lake.commit("filled", "bronze", 0, 0, [BRONZE])
    rows = lake.read(BRONZE)
    for n, part in enumerate(("received_at < TIMESTAMP '2024-01-16'", "received_at >= TIMESTAMP '2024-01-16'")):
        SilverStage(lake).run(rows.filter(part), n)
    return lake


def _newer() -> Registry:
    """The shipped mappers, of which ``iot-energy`` has a second version: energy in thousandths, less power allowed."""
    changes = {"power": {"max": NEWER_POWER}, "energy": {"scale": 1000}}
    mappers = [
        replace(m, version=2, columns=tuple(replace(c, **changes.get(c.name, {})) for c in m.columns)) if m.id == "iot-energy" else m
        for m in Registry.shipped()
    ]
    return Registry(mappers)


@query
def reprocess_versions(spark, sf_dir):
    """The energy table after rows of an older mapper version were made anew."""
    lake = _filled(spark, sf_dir)
    lake = Lake(spark, lake.root, _newer())
    reprocess.reprocess(lake)
    rows = lake.read("silver.energy").select("job_id", "device_id", "event_time", "mapper_id", "mapper_version", "power", "energy", "current")
    return with_times_as_text(rows, "event_time")


@query
def reprocess_counts(spark, sf_dir):
    """What a run over older versions did, and the letters that it left."""
    lake = _filled(spark, sf_dir)
    lake = Lake(spark, lake.root, _newer())
    done = reprocess.reprocess(lake)
    letters = lake.read(DEAD).filter("stage = 'silver' AND reason = 'out_of_range' AND detail LIKE 'power <- power=%'")
    columns = [F.lit(done[k]).cast("bigint").alias(f"n_{k}") for k in ("old", "written", "rejected", "duplicates")]
    return letters.agg(F.count_distinct("job_id").alias("n_letters")).select(*columns, "n_letters")


@query
def dataset_observations(spark, sf_dir):
    """Every measured value with what it measures and in which unit."""
    long = dataset.observations(_filled(spark, sf_dir))
    return long.select("job_id", "tenant_id", "device_id", text("event_time").alias("event_time"), "table_name", "name", F.col("value").cast("double").alias("value"), "property_iri", "unit")


@query
def dataset_lines(spark, sf_dir):
    """The same as N-Triples; values are left to the tests, as engines spell doubles differently."""
    lines = dataset.triples(dataset.observations(_filled(spark, sf_dir)), "https://example.org/sensors")
    return lines.filter("predicate <> 'sosa:hasSimpleResult'").select("predicate", "line")


@query
def dataset_record(spark, sf_dir):
    """Rows, time covered and devices per table and tenant, merged from what the commits left behind."""
    record = dataset.dataset_record(_filled(spark, sf_dir))
    # a sketch of as few devices is exact but for rounding
    return with_times_as_text(record, "first_time", "last_time").withColumn("n_devices", F.round(F.col("n_devices"), -1))


@query
def dataset_version(spark, sf_dir):
    """A published version as its readers get it: statements by predicate."""
    lake, home = _filled(spark, sf_dir), shared_dir(spark, "published")
    dataset.publish_dataset(lake, home, "readings", "https://example.org/sensors")
    lines, _ = dataset.read_dataset(spark, home, "readings")
    return lines.groupBy(F.split("value", " ")[1].alias("predicate")).agg(F.count("*").alias("n"), F.count_distinct("value").alias("n_distinct"))
