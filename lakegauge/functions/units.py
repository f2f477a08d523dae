"""Named unit conversions a mapper column may ask for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column

# Names a mapper file may use. The order of operations matters for
# the last bit of the result.
CONVERSIONS: dict[str, Callable[[Column], Column]] = {
    "fahrenheit_to_celsius": lambda f: (f - 32.0) * 5.0 / 9.0,
}
