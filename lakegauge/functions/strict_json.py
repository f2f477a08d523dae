"""Strict JSON on top of the VARIANT type.

``try_parse_json`` stops at the end of the first value and ignores what follows.
A reading with a trailing comma or trailing words must count as "not JSON", so
the text is parsed as the first of two array elements, the second being an end
mark. Anything left over after the first value disturbs the mark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END_MARK = "~end-of-reading~"


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out a single time, however often it is used.

    It also keeps large bodies out of generated code. Spark fuses a stage into
    few Java methods, and the JVM never compiles methods beyond 8 KB: a handful
    of regular expressions per column is enough to make a whole stage crawl.
    """
    return F.transform(F.array(value), body)[0]


def with_json(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the VARIANT in column ``text``, or NULL if it is not JSON.

    Separate projections on purpose: what is read more than once stays apart, so
    each text is parsed once. The array is opened by a cast and not by position:
    asking a VARIANT for something it does not have is slow.
    """
    items, mark = f"__{out}_items", f"__{out}_mark"
    t, i = F.col(text), F.col(items)
    wrapped = F.try_parse_json(F.concat(F.lit("["), t, F.lit(',"'), F.col(mark), F.lit('"]')))
    whole = (F.size(i) == 2) & (F.try_variant_get(F.get(i, 1), "$", "string") == F.col(mark))
    return (
        # a text that holds the mark itself could fake the end of the array
        df.withColumn(mark, F.when(F.contains(t, F.lit(END_MARK)), F.sha2(t, 256)).otherwise(END_MARK))
        .withColumn(items, wrapped.try_cast("array<variant>"))
        .withColumn(out, F.when(whole, F.get(i, 0)))
        .drop(items, mark)
    )


def is_object_text(text: str | Column) -> Column:
    """True if valid JSON text holds an object; looks at one character only."""
    return F.ltrim(F.col(text) if isinstance(text, str) else text, F.lit(" \t\r\n")).startswith("{")


def json_path(dotted: str) -> str:
    """``a.b`` -> ``$['a']['b']``: object keys only, never array positions."""
    steps = []
    for key in dotted.split("."):
        if not key or ("'" in key and '"' in key):
            raise ValueError(f"unusable key in path {dotted!r}")
        quote = '"' if "'" in key else "'"
        steps.append(f"[{quote}{key}{quote}]")
    return "$" + "".join(steps)


def members(value: str | Column) -> Column:
    """The members of an object as a map, NULL for anything else."""
    return (F.col(value) if isinstance(value, str) else value).try_cast("map<string,variant>")


def path_value(value: str | Column, dotted: str) -> Column:
    """SQL NULL if the path is absent; a VARIANT null if it is there and null.

    Goes down objects only, never into arrays.
    """
    for key in dotted.split("."):
        value = members(value)[key]
    return value


def has_path(value: str | Column, dotted: str) -> Column:
    return path_value(value, dotted).isNotNull()


def kind(value: str | Column) -> Column:
    """JSON kind of a VARIANT: null, bool, number, string, array or object."""
    return once(F.schema_of_variant(value), _kind_of_schema)


def _kind_of_schema(schema: Column) -> Column:
    return (
        F.when(schema == "STRING", "string")
        .when(schema == "VOID", "null")
        .when(schema == "BOOLEAN", "bool")
        .when(schema.startswith("OBJECT"), "object")
        .when(schema.startswith("ARRAY"), "array")
        .when(schema.isNotNull(), "number")
    )
