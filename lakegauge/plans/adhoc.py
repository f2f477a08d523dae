"""SQL over one table, which the query calls ``t``, and the reports people run most."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame

# What the reports select.
FIRST_ROWS = "SELECT * FROM t LIMIT 20"

ONE_DEVICE_DAY = """
SELECT device_id, event_time, temperature, humidity FROM t
WHERE tenant_id = :tenant AND device_id = :device
  AND event_time >= CAST(:start AS TIMESTAMP) AND event_time < CAST(:end AS TIMESTAMP)
ORDER BY event_time"""

FAILURES = "SELECT stage, reason, count(*) AS n FROM t GROUP BY ALL ORDER BY n DESC"
NEWEST = "SELECT received_at, device_id, schema_fp, payload FROM t ORDER BY received_at DESC, job_id LIMIT 5"
PER_MAPPER = "SELECT mapper_id, count(*) AS n FROM t GROUP BY 1"
SHAPES = "SELECT device_id, event_time, schema_fp FROM t"


def query(table: DataFrame, sql: str = FIRST_ROWS, **params: str) -> DataFrame:
    """Run Spark SQL with ``table`` as ``t``; ``:name`` takes its value from ``params``.

    The name holds for this query alone: others may run at the same time.
    """
    spark = table.sparkSession
    view = f"t_{uuid.uuid4().hex}"
    table.createOrReplaceTempView(view)
    try:
        own = f"t AS (SELECT * FROM {view})"
        begin = re.match(r"\s*WITH\b(\s+RECURSIVE\b)?", sql, re.IGNORECASE)
        text = f"{begin[0]} {own}, {sql[begin.end() :]}" if begin else f"WITH {own} {sql}"
        return spark.sql(text, args=params or None)
    finally:
        spark.catalog.dropTempView(view)
