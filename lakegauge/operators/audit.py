"""Counts that show where readings went."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.mappers import Registry
from lakegauge.operators.dedup import KEYS


def silver_counts(mapped: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per table: rows mapped, rows one per key leaves, and those skipped as duplicates.

    Copies are counted per key before they are shuffled, so a hot key costs no more than a rare one.
    """
    per_key = mapped.filter("reason IS NULL").groupBy("target_table", *keys).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.groupBy("target_table").agg(
        F.sum("copies").alias("mapped"),
        F.count(F.lit(1)).alias("written"),
        F.sum(F.col("copies") - 1).alias("duplicates"),
    )


def reconcile(bronze: DataFrame, silver: DataFrame, letters: DataFrame) -> DataFrame:
    """Where each bronze job ended up: in silver, in dead letters, or skipped as a duplicate.

    ``silver`` and ``letters`` are the union of all silver tables and the silver
    dead letters. Copies of a job in bronze count once per copy.
    """
    found = silver.select("job_id", F.lit("silver").alias("found")).unionByName(
        letters.select("job_id", F.lit("dead_letter").alias("found"))
    )
    # one row per job on the right, so the join cannot multiply bronze rows
    placed = found.groupBy("job_id").agg(F.max("found").alias("found"))
    return bronze.select("job_id", "device_id").join(placed, "job_id", "left").select(
        "job_id", "device_id", F.coalesce("found", F.lit("duplicate")).alias("outcome")
    )


def layer_balance(reconciled: DataFrame) -> DataFrame:
    """bronze = silver + dead letters + duplicates, as one row."""
    n = {o: F.count_if(F.col("outcome") == o) for o in ("silver", "dead_letter", "duplicate")}
    return reconciled.agg(F.count(F.lit(1)).alias("bronze_rows"), *[c.alias(o + "_rows") for o, c in n.items()])


def all_null_rows(silver: DataFrame, registry: Registry, target: str) -> DataFrame:
    """Per mapper: rows whose every measurement is NULL, the mark of a wrong hint."""
    empty = F.coalesce(*[F.col(c).cast("string") for c in registry.measurements(target)]).isNull()
    return silver.groupBy("mapper_id").agg(
        F.count(F.lit(1)).alias("silver_rows"), F.count_if(empty).alias("all_null_rows")
    )


def added_records(commits: DataFrame) -> DataFrame:
    """Records each commit added, per stage and table."""
    return commits.groupBy("stage", "table_name", "batch_id").agg(F.sum("added_records").alias("added_records"))
