"""Rows made by an older version of their mapper, made again by the current one.

The summaries of the commits say which folders hold such rows, so nothing is searched for them. Their jobs are
looked up in the days of bronze that they arrived on and mapped anew, as if they had just come in: they may get other
values, another time, device or table, or be rejected. One batch then writes what came out, together with the rows
of the same folders that are up to date, and its record replaces exactly these folders. Other folders of the same days
are neither read nor written, and readers see the rows before or after, never both and never none.

A row that now has a key which another, current row of the table has already is skipped as a duplicate, and of two made
again the first arrival stays. Rows that were skipped as duplicates earlier are not looked at again. Silver batches add
rows that such a run does not see, so run it between them; none of their rows is lost otherwise, but a key may then
be there twice.

Defined results: a mapper that is not in the registry any more leaves its rows alone, and so does a table that no mapper
fills any more; a job that bronze no longer has keeps its old rows; rows that are carried over keep columns that are not
declared any more; without old rows nothing is written and no batch recorded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegauge.mappers import Registry
from lakegauge.mappers.registry import silver_table_name
from lakegauge.operators.bronze import dead_letters
from lakegauge.operators.dedup import KEYS, days_of, not_known, one_per_key
from lakegauge.operators.resolve import lookup
from lakegauge.operators.transform import map_readings, silver_dead_letters, silver_union
from lakegauge.session import shared_dir
from lakegauge.sources import files
from lakegauge.sources.lake import AUDIT, BATCH, BRONZE, DEAD, SUMMARY, TABLE, Lake

STAGE = "reprocess"


def is_old(registry: Registry) -> Column:
    """Whether the current version of a row's mapper is a later one."""
    current = lookup({m.id: m.version for m in registry}, "int", F.col("mapper_id"))
    return F.coalesce(F.col("mapper_version") < current, F.lit(False))


def old_parts(lake: Lake) -> DataFrame:
    """Table, batch and day of the folders with rows of older versions, and how many."""
    summaries = lake.read(SUMMARY).filter(is_old(lake.registry)).withColumnRenamed(BATCH, "batch")
    found = summaries.filter(F.col(TABLE).isin(list(lake.targets))).groupBy(TABLE, "batch", "day").agg(F.sum("n_rows").alias("n_old"))
    return found.join(lake.parts(), [TABLE, "batch", "day"], "left_semi")


class Reprocess:
    """One run; ``run`` may be called again after a failure and then goes on or has nothing to do."""

    def __init__(self, lake: Lake, keys: Sequence[str] = KEYS, keep: str = "first"):
        self.lake, self.keys, self.keep = lake, (TABLE, *keys), keep
        self._scratch: list[str] = []

    def _store(self, df: DataFrame, purpose: str) -> DataFrame:
        path = shared_dir(self.lake.spark, purpose)
        self._scratch.append(path)
        df.write.parquet(path)
        return self.lake.spark.read.schema(df.schema).parquet(path)

    def run(self) -> dict[str, int]:
        """Rows made anew, by what became of them; all zero if there were none."""
        lake = self.lake
        parts: dict[str, list] = {}
        for r in old_parts(lake).collect():
            parts.setdefault(r[TABLE], []).append((r["batch"], r["day"]))
        if not parts:
            return {"old": 0, "written": 0, "rejected": 0, "duplicates": 0, "kept": 0}
        number = lake.read(AUDIT).filter(F.col("stage") == STAGE).select(BATCH).distinct().count()
        try:
            return self._run(f"{STAGE}-{number}", number, parts)
        finally:
            while self._scratch:
                files.delete(lake.spark, self._scratch.pop())

    def _run(self, batch: str, number: int, parts: dict[str, list]) -> dict[str, int]:
        lake, registry = self.lake, self.lake.registry
        # rows that stay take along what they have, columns that no mapper fills any more included
        held = lake.open(parts, all_columns=True).drop(BATCH, "event_time_day").withColumn("old", is_old(registry))
        old = held.filter("old").select("job_id", "received_at")
        arrived = [r["day"] for r in days_of(old, time="received_at").collect()]
        bronze = one_per_key(lake.read(BRONZE, arrived).join(old, "job_id", "left_semi"), ("job_id",))
        evidence = F.when(F.col("reason").isNotNull(), F.col("payload"))
        mapped = self._store(map_readings(bronze, registry).withColumn("payload", evidence), "made-anew")
        # without its payload a row cannot be made anew
        kept = held.join(mapped.select("job_id", F.lit(True).alias("anew")), "job_id", "left").filter("NOT old OR anew IS NULL").drop("old", "anew")

        accepted = silver_union(mapped, registry)
        sizes = {r["t"]: r["n"] for r in mapped.groupBy(F.when(F.col("reason").isNull(), F.col("target_table")).alias("t")).agg(F.count("*").alias("n")).collect()}
        rejected = sizes.pop(None, 0)
        fresh = not_known(one_per_key(accepted, self.keys, self.keep), self._current(accepted, parts, kept), sum(sizes.values()), self.keys)
        lake.write_silver(kept.unionByName(fresh, allowMissingColumns=True), batch)
        lake.write(DEAD, dead_letters(silver_dead_letters(mapped.filter("reason IS NOT NULL")), retried=False), batch)

        n_kept = {r[TABLE]: r["n"] for r in kept.groupBy(TABLE).agg(F.count("*").alias("n")).collect()}
        tables = {silver_table_name(t): n for t, n in sizes.items()}
        offered = {t: tables.get(t, 0) + n_kept.get(t, 0) for t in {*tables, *n_kept, *parts}}
        added = lake.commit(batch, STAGE, number, sum(sizes.values()) + rejected, [DEAD, *offered], offered, replaces=parts)
        written = sum(added[t] for t in offered) - sum(n_kept.values())
        return {
            "old": sum(sizes.values()) + rejected, "written": written, "rejected": rejected,
            "duplicates": sum(sizes.values()) - written, "kept": sum(n_kept.values()),
        }

    def _current(self, accepted: DataFrame, parts: dict[str, list], kept: DataFrame) -> DataFrame:
        """Keys of the rows that stay, in the days that rows made anew fall on."""
        days: dict[str, list] = {}
        for r in days_of(accepted, TABLE).collect():
            days.setdefault(r[TABLE], []).append(r["day"])
        others = {n: [p for p in self.lake.live(n, own) if p not in set(parts.get(n, []))] for n, own in days.items()}
        rows = self.lake.open(others or {next(iter(self.lake.targets)): []})
        return rows.select(*self.keys).unionByName(kept.select(*self.keys))


def reprocess(lake: Lake, keys: Sequence[str] = KEYS, keep: str = "first") -> dict[str, int]:
    return Reprocess(lake, keys, keep).run()
