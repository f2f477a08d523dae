"""Keep the optimizer from copying costly expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fence(df: DataFrame) -> DataFrame:
    """Compute the columns of ``df`` once, here.

    A filter on a computed column is otherwise pushed below the projections by
    copying their expressions into it: payloads would be parsed again for every
    condition, and the copied expressions multiply with each projection.
    """
    return df.select(F.inline(F.array(F.struct("*"))))
