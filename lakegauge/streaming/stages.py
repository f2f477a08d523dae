"""The two stages, as one function per batch of input.

The same functions serve a one-off batch and a micro-batch of a stream. A batch
is worked out once into a table in the shared folder and then split, so payloads
are read once however many tables the batch feeds, and a lost executor costs a
few reads instead of the whole batch.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakegauge.mappers.registry import silver_table_name
from lakegauge.operators.bronze import bronze_outcomes, bronze_rows, dead_letters
from lakegauge.operators.dedup import KEYS, days_of, not_known, one_per_key
from lakegauge.operators.descriptor import parse_jobs
from lakegauge.operators.redrive import retries
from lakegauge.operators.transform import map_readings, silver_dead_letters, silver_union
from lakegauge.session import shared_dir
from lakegauge.sources import files, landing
from lakegauge.sources.lake import BRONZE, DEAD, TABLE, Lake
from lakegauge.sources.queue import BATCH_WINDOW


@dataclass
class Stage:
    """``run`` gives a batch's rows to the tables once, however often it is called for it.

    A batch is known by its stage, its stream and its number. Its rows and letters go to folders of its own and count
    once its commit is recorded, all together. After a failure before that point the batch is worked out anew over
    what it left; after it, only retries may still have to be handed out.
    """

    lake: Lake
    name = "stage"
    # the checkpoint of the stream that feeds the stage; its id is part of a batch's name
    checkpoint: str | None = None
    _scratch: list[str] = field(default_factory=list)
    _batch: str = ""

    def run(self, rows: DataFrame, batch_id: int) -> None:
        self._batch = f"{self.name}-{self._stream()}-{batch_id}"
        try:
            if not self.lake.is_done(self._batch):
                self.process(rows, batch_id)
            self.hand_out()
        finally:
            while self._scratch:
                files.delete(self.lake.spark, self._scratch.pop())

    def on_batch(self, rows: DataFrame, batch_id: int) -> None:
        """What a stream calls for each micro-batch."""
        self.run(rows, batch_id)

    def _stream(self) -> str:
        if not self.checkpoint:
            return "direct"
        return json.loads(self.lake.spark.read.text(f"{self.checkpoint}/metadata").first()["value"])["id"]

    def hand_out(self) -> None:
        """What follows a commit; called again if it was interrupted."""

    def process(self, rows: DataFrame, batch_id: int) -> None:
        """Work a batch out and commit it."""
        raise NotImplementedError

    def store(self, df: DataFrame, purpose: str, *by: str) -> DataFrame:
        path = shared_dir(self.lake.spark, purpose)
        self._scratch.append(path)
        df.write.partitionBy(*by).parquet(path)
        return self.lake.spark.read.schema(df.schema).parquet(path)


@dataclass
class BronzeStage(Stage):
    """Without a ``retry_path`` a transient failure is a dead letter at once.

    Retries wait in a hidden folder below ``retry_path``, which gets its name when the batch is committed.
    """

    name = "bronze"
    landing_root: str | None = None
    retry_path: str | None = None

    def _retries(self, hidden: bool) -> str:
        return f"{self.retry_path}/{'_' if hidden else ''}retries-{self._batch}"

    def hand_out(self) -> None:
        if self.retry_path and files.exists(self.lake.spark, self._retries(hidden=True)):
            files.rename(self.lake.spark, self._retries(hidden=True), self._retries(hidden=False))

    def objects(self, jobs: DataFrame) -> DataFrame | None:
        """The landed objects these jobs may need."""
        return landing.objects_for(jobs, self.landing_root) if self.landing_root else None

    def process(self, entries: DataFrame, batch_id: int) -> None:
        way = F.when(F.col("violations").isNull(), F.col("mode")).otherwise("unusable")
        # the descriptor text is evidence for unusable entries only
        text = F.when(F.col("violations").isNotNull(), F.col("job"))
        parsed = parse_jobs(entries).withColumns({"way": way, "job": text})
        jobs = self.store(parsed, "jobs", "way").drop("way")
        objects = self.objects(jobs.filter("violations IS NULL"))
        verdict = F.when(F.col("reason").isNull(), "good").otherwise("bad")
        outcomes = bronze_outcomes(entries, objects, parsed=jobs).withColumn("verdict", verdict)
        stored = self.store(outcomes, "outcomes", "verdict")
        good, bad = stored.filter("verdict = 'good'"), stored.filter("verdict = 'bad'")
        written = [DEAD]
        try:
            self.lake.write(BRONZE, bronze_rows(good), self._batch)
            written.append(BRONZE)
        except Exception as e:  # noqa: BLE001  whatever keeps rows out of the table
            files.delete(self.lake.spark, self.lake.folder(BRONZE, self._batch))
            bad = bad.unionByName(good.withColumns({"reason": F.lit("append_failed"), "detail": F.lit(f"{type(e).__name__}: {e}"[:500])}))
        if self.retry_path:
            retries(bad).write.mode("overwrite").parquet(self._retries(hidden=True))
        self.lake.write(DEAD, dead_letters(bad, retried=bool(self.retry_path)), self._batch)
        self.lake.commit(self._batch, "bronze", batch_id, jobs.count(), written, {} if BRONZE in written else {BRONZE: 0})


@dataclass
class SilverStage(Stage):
    """Fed by rows of bronze (``run``) or by the records of its commits (``on_batch``, ``Lake.stream_commits``)."""

    name = "silver"
    keys: tuple[str, ...] = KEYS
    keep: str = "first"

    def on_batch(self, records: DataFrame, batch_id: int) -> None:
        found = self.lake.spark.createDataFrame(records.collect(), records.schema)
        if not found.isEmpty():
            self.run(self.lake.committed_rows(BRONZE, found), batch_id)

    def process(self, bronze: DataFrame, batch_id: int) -> None:
        lane = F.when(F.col("reason").isNull(), "accepted").otherwise("rejected")
        # payloads stay in bronze; only rejected rows take theirs along
        evidence = F.when(F.col("reason").isNotNull(), F.col("payload"))
        verdicts = map_readings(bronze, self.lake.registry).withColumns({"lane": lane, "payload": evidence})
        mapped = self.store(verdicts, "mapped", "lane")
        self.lake.write(DEAD, dead_letters(silver_dead_letters(mapped.filter("lane = 'rejected'")), retried=False), self._batch)
        accepted = mapped.filter("lane = 'accepted'")
        sizes = {(r["lane"], r["target_table"]): r["count"] for r in mapped.groupBy("lane", "target_table").count().collect()}
        offered = {silver_table_name(t): n for (lane, t), n in sizes.items() if lane == "accepted"}
        if offered:
            self.lake.write_silver(self.fresh(silver_union(accepted, self.lake.registry), sum(offered.values())), self._batch)
        self.lake.commit(self._batch, "silver", batch_id, sum(sizes.values()), [DEAD, *offered], offered)

    def fresh(self, rows: DataFrame, size: int) -> DataFrame:
        """One row per table and key, and none that its table has already: one pass for all tables."""
        keys = (TABLE, *self.keys)
        days: dict[str, list] = {}
        for r in days_of(rows, TABLE).collect():
            days.setdefault(r[TABLE], []).append(r["day"])
        return not_known(one_per_key(rows, keys, self.keep), self.lake.known(days, without=self._batch), size, keys)


def start(stage: Stage, source: DataFrame, checkpoint: str, once: bool = False, window: str = BATCH_WINDOW) -> StreamingQuery:
    """Run a stage on a stream: until caught up if ``once``, else every ``window``."""
    stage.checkpoint = checkpoint
    writer = source.writeStream.foreachBatch(stage.on_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=window)).start()


def catch_up(stage: Stage, source: DataFrame, checkpoint: str) -> None:
    start(stage, source, checkpoint, once=True).awaitTermination()
