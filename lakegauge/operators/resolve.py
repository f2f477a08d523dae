"""Which mapper reads which payload.

Mappers are data here and not code: an index from required path to the mappers that ask for it. A payload's own
paths are looked up in it, and a mapper fits if it is found as often as it has required paths. The plan is the same
for five mappers and for five hundred, and a row costs what its payload holds and not what the registry holds.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegauge.functions.strict_json import members, once, with_json
from lakegauge.mappers import Registry

VALUE = "_v"  # the parsed payload


def with_payload(bronze: DataFrame) -> DataFrame:
    """Parse the payload once."""
    return with_json(bronze, "payload", VALUE)


def constant(value: object, type_name: str) -> Column:
    """A Python value as one literal, however much it holds."""
    return F.from_json(F.lit(json.dumps(value)), type_name)


def lookup(table: Mapping[str, object], type_name: str, key: Column) -> Column:
    """The value of a text in a fixed table, else NULL. Maps are searched key by key, so keys are dealt to small ones by hash."""
    n = max(1, len(table) // 2)
    small: list[dict] = [{} for _ in range(n)]
    for k, v in table.items():
        small[zlib.crc32(k.encode()) % n][k] = v
    place = F.pmod(F.crc32(key.cast("binary")), F.lit(n)).cast("int")
    return F.try_element_at(F.get(constant(small, f"array<map<string,{type_name}>>"), place), key)


def _index(registry: Registry) -> dict[str, list[int]]:
    index: dict[str, list[int]] = {}
    for n, mapper in enumerate(registry):
        for path in set(mapper.required_keys):
            index.setdefault(path, []).append(n)
    return index


def present_paths(value: str, wanted: list[str]) -> Column:
    """Dotted paths of a payload's members, as deep as ``wanted`` ones go. Only objects on the way to these are opened."""
    above = {".".join(p.split(".")[:n]): True for p in wanted for n in range(1, p.count(".") + 1)}
    deepest = max((p.count(".") for p in wanted), default=0)

    def below(opened: Column, prefix: Column | None, depth: int) -> Column:
        def path(key: Column) -> Column:
            return key if prefix is None else F.concat(prefix, F.lit("."), key)

        # a key that holds a dot is not a path
        keys = F.filter(F.map_keys(opened), lambda k: ~F.contains(k, F.lit(".")))
        names = F.transform(keys, path)
        if depth == deepest:
            return names
        on_the_way = F.filter(keys, lambda k: lookup(above, "boolean", path(k)).isNotNull())
        deeper = F.transform(on_the_way, lambda k: once(members(opened[k]), lambda o: F.coalesce(below(o, path(k), depth + 1), _no("string"))))
        return F.concat(names, F.flatten(deeper))

    return F.coalesce(once(members(value), lambda o: below(o, None, 0)), _no("string"))


def _no(type_name: str) -> Column:
    return F.array().cast(f"array<{type_name}>")


def fitting(registry: Registry) -> Column:
    """Numbers of the mappers whose required keys are all there, in match order; a null value counts as there."""
    index = _index(registry)
    asked = constant([len(set(m.required_keys)) for m in registry], "array<int>")
    found = F.transform(present_paths(VALUE, list(index)), lambda p: F.coalesce(lookup(index, "array<int>", p), _no("int")))
    # sorted, a mapper that fits stands there once per required path
    return once(F.array_sort(F.flatten(found)), lambda s: F.filter(s, lambda n, i: F.get(s, i + F.get(asked, n) - 1) == n))


def with_mapper(parsed: DataFrame, registry: Registry) -> DataFrame:
    """Add ``mapper_number``, the place in match order: a known hint wins, else the first mapper that fits, else NULL."""
    by_hint = lookup({m: n for n, m in enumerate(registry.ids)}, "int", F.col("pipeline_hint"))
    return parsed.withColumn("mapper_number", F.coalesce(by_hint, F.get(fitting(registry), 0)))


def resolve(parsed: DataFrame, registry: Registry) -> DataFrame:
    """Add ``mapper_id``, as ``with_mapper`` picks it."""
    mapper_id = F.get(constant(registry.ids, "array<string>"), F.col("mapper_number"))
    return with_mapper(parsed, registry).withColumn("mapper_id", mapper_id).drop("mapper_number")


def with_match_count(parsed: DataFrame, registry: Registry) -> DataFrame:
    """Add ``matches``: how many mappers fit. Above one, later tables get nothing."""
    return parsed.withColumn("matches", F.size(fitting(registry)))
