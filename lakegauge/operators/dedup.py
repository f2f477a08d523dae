"""One reading per device and event time, within a batch and against a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ("device_id", "event_time")
SMALL_BATCH = 1_000_000  # keys that are broadcast at most


def one_per_key(rows: DataFrame, keys: Sequence[str] = KEYS, keep: str = "first") -> DataFrame:
    """Keep the first (or last) arrival of each key; equal arrivals go by job id.

    Tenant and values do not count; add ``tenant_id`` to ``keys`` to keep tenants
    apart. Each map task passes on at most one row per key (a group limit ahead
    of the shuffle), so a key that holds much of the data stays cheap.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    order = [F.col(c).asc() if keep == "first" else F.col(c).desc() for c in ("received_at", "job_id")]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).filter("_place = 1").drop("_place")


def not_in_table(rows: DataFrame, table: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows whose key the table does not have yet. Both sides are partitioned by the key."""
    return rows.join(table.select(*keys), list(keys), "left_anti")


def not_known(rows: DataFrame, table: DataFrame, size: int, keys: Sequence[str] = KEYS, most: int = SMALL_BATCH) -> DataFrame:
    """As ``not_in_table``, for a batch of at most ``size`` rows against a much larger table.

    Up to ``most`` rows the batch's keys go to the table: each task looks them up in what it reads, and only those that
    the table has come back. No row of the table is shuffled then. Beyond ``most`` both sides meet by key.
    """
    if size > most:
        return not_in_table(rows, table, keys)
    asked = F.broadcast(rows.select(*keys))
    return not_in_table(rows, table.select(*keys).join(asked, list(keys), "left_semi").distinct(), keys)


def days_of(rows: DataFrame, *by: str, time: str = "event_time") -> DataFrame:
    """The days ``rows`` touch, as ``day``, by other columns: just these of a table have to be read (``Lake.read``).

    A duplicate has the same time, so no other day can hold one. Days are named
    one by one: a single very late reading must not widen the scan to all days
    between.
    """
    return rows.select(*by, F.to_date(time).alias("day")).filter("day IS NOT NULL").distinct()
