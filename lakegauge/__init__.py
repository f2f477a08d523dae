"""lakegauge: sensor readings to typed, deduplicated lake tables, on Spark.

Every operator takes and returns DataFrames; nothing runs until a sink asks.
"""

from lakegauge.session import configure, shared_dir

__all__ = ["configure", "shared_dir"]
