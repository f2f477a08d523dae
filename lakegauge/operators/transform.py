"""Bronze rows -> typed measurements, or a reason why not.

All mappers are applied in one narrow pass. The n-th column of whichever mapper
a row has goes through "slot" n, and what that mapper asks of the column (path, type,
unit, bounds) is looked up by the mapper's number. So the plan holds as many cast
and check chains as the widest mapper has columns and types, however many mappers
there are. Slots get their column names when a table's rows are picked out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegauge.functions.casts import as_bool, as_double, as_long, as_text, as_timestamp
from lakegauge.functions.strict_json import is_object_text, kind, members, once
from lakegauge.functions.units import CONVERSIONS
from lakegauge.mappers import Mapper, MapperColumn, Registry
from lakegauge.mappers.model import COLUMN_TYPES
from lakegauge.mappers.registry import silver_table_name, stored_name
from lakegauge.operators.fence import fence
from lakegauge.operators.resolve import VALUE, constant, with_mapper, with_payload
from lakegauge.schemas import SILVER_ENVELOPE

Pair = tuple[Mapper, MapperColumn]
RULE = (
    "struct<source:array<string>,type:string,convert:string,scale:double,changes:boolean,min:double,max:double,"
    "required:boolean,told:string,bounds:string>"
)


def _slots(registry: Registry) -> list[list[Pair]]:
    widest = max(len(m.columns) for m in registry)
    return [[(m, m.columns[n]) for m in registry if len(m.columns) > n] for n in range(widest)]


def _rule(col: MapperColumn) -> dict:
    return {
        "source": col.source.split("."), "type": col.type, "convert": col.convert, "scale": float(col.scale), "changes": _changes(col),
        "min": _float(col.min), "max": _float(col.max), "required": col.required,
        "told": f"{col.name} <- {col.source}=", "bounds": f" not within [{_bound(col.min)}, {_bound(col.max)}]",
    }


def _rules(registry: Registry, n: int) -> Column:
    """What each mapper asks of its n-th column, by the mapper's number; NULL for those with fewer."""
    return constant([_rule(m.columns[n]) if len(m.columns) > n else None for m in registry], f"array<{RULE}>")


def _per_mapper(pairs: Iterable[tuple[Mapper, object]], pick: Callable) -> Column | None:
    """CASE mapper_id WHEN .. over the pairs for which ``pick`` gives a Column."""
    out = None
    for mapper, item in pairs:
        value = pick(item)
        if value is not None:
            out = (F if out is None else out).when(F.col("mapper_id") == mapper.id, value)
    return out


def slot_column(n: int, type_name: str) -> str:
    return f"slot{n}_{type_name}"


def map_readings(bronze: DataFrame, registry: Registry) -> DataFrame:
    """One row per bronze row: silver envelope, slots, ``target_table``, ``reason``.

    ``reason`` NULL means the row belongs in ``target_table``.
    """
    slots = _slots(registry)
    carried = list(bronze.columns)

    def of_mapper(values: list, type_name: str) -> Column:
        return F.get(constant(values, f"array<{type_name}>"), F.col("mapper_number"))

    # What the mapper asks for, and the raw values of its slots and of the two envelope overrides.
    overrides = {
        "device": [m.device_id_from.split(".") if m.device_id_from else None for m in registry],
        "time": [m.event_time_from.split(".") if m.event_time_from else None for m in registry],
    }
    used = {name: steps for name, steps in overrides.items() if any(steps)}
    deepest = max([len(c.source.split(".")) for m in registry for c in m.columns] + [len(x) for steps in used.values() for x in steps if x])
    is_object = F.coalesce(F.col(VALUE).isNotNull() & is_object_text("payload"), F.lit(False))
    df = with_mapper(with_payload(bronze), registry)
    df = df.select(*carried, "mapper_number", members(VALUE).alias("opened"), is_object.alias("is_object"))
    rules = {f"rule{n}": F.get(_rules(registry, n), F.col("mapper_number")) for n in range(len(slots))}
    df = df.select("*", *[v.alias(k) for k, v in rules.items()], *[of_mapper(steps, "array<string>").alias(f"steps_{name}") for name, steps in used.items()])
    raw = {f"raw{n}": _at(F.col(f"rule{n}.source"), deepest) for n in range(len(slots))}
    raw |= {f"raw_{name}": _at(F.col(f"steps_{name}"), deepest) for name in used}
    df = df.select(*carried, "mapper_number", "is_object", *rules, *[v.alias(k) for k, v in raw.items()])

    # Cast, convert, scale and check.
    device, time = F.col("device_id"), F.col("event_time")
    if "device" in used:
        device = F.coalesce(once(F.col("raw_device"), lambda x: once(kind(x), lambda k: as_text(x, k))), device)
    if "time" in used:
        time = F.coalesce(once(F.col("raw_time"), lambda x: as_timestamp(x, kind(x))), time)
    df = df.select(
        "*",
        device.alias("silver_device_id"),
        time.alias("silver_event_time"),
        *[_judged(n, pairs).alias(f"slot{n}") for n, pairs in enumerate(slots)],
    )

    # The first failing column, in mapper order, decides.
    known = F.col("mapper_number").isNotNull()
    reason = (
        F.when(~known, "unresolved")
        .when(~F.col("is_object"), "bad_payload")
        .otherwise(F.coalesce(*[F.col(f"slot{n}.reason") for n in range(len(slots))]))
    )
    out = [c for c in carried if c not in ("device_id", "event_time")]
    verdicts = df.select(
        *out,
        F.col("device_id").alias("bronze_device_id"),
        F.col("silver_device_id").alias("device_id"),
        F.col("silver_event_time").alias("event_time"),
        of_mapper(registry.ids, "string").alias("mapper_id"),
        of_mapper([m.version for m in registry], "int").alias("mapper_version"),
        of_mapper([m.target_table for m in registry], "string").alias("target_table"),
        *[
            F.col(f"slot{n}.{type_name}").alias(slot_column(n, type_name))
            for n, pairs in enumerate(slots)
            for type_name in _types(pairs)
        ],
        reason.alias("reason"),
        _detail(len(slots), "schema_fp" in carried).alias("detail"),
    )
    return fence(verdicts)


def _at(steps: Column, deepest: int) -> Column:
    """The value at a path of the payload, which is already opened; SQL NULL if it is absent."""
    value = F.col("opened")[F.get(steps, 0)]
    for n in range(1, deepest):
        inner = members(value)[F.get(steps, n)]
        value = F.when(F.size(steps) > n, inner).otherwise(value)
    return value


def _types(pairs: list[Pair]) -> list[str]:
    return sorted({c.type for _, c in pairs})


def _judged(n: int, pairs: list[Pair]) -> Column:
    """One slot: a value per column type in use, and the reason if it is no good."""
    types, rule = _types(pairs), F.col(f"rule{n}")
    conversions = sorted({c.convert for _, c in pairs if c.convert})

    def cast(x: Column, k: Column) -> Column:
        casts = {
            "double": lambda: as_double(x, k),
            "int": lambda: as_long(x, k),
            "string": lambda: as_text(x, k),
            "bool": lambda: as_bool(x, k),
            "timestamp": lambda: as_timestamp(x, k),
        }
        if len(types) == 1:
            return F.struct(casts[types[0]]().alias(types[0]))
        return F.struct(*[F.when(rule["type"] == t, casts[t]()).alias(t) for t in types])

    def canonical(c: Column) -> Column:
        return F.struct(*[_canonical(c[t], t, rule, conversions, any(_changes(col) for _, col in pairs if col.type == t)).alias(t) for t in types])

    def judge(x: Column) -> Column:
        return once(
            kind(x),
            lambda k: once(
                cast(x, k),
                lambda c: once(
                    canonical(c), lambda v: F.struct(*[v[t].alias(t) for t in types], _reason(types, rule, k, c, v).alias("reason"))
                ),
            ),
        )

    return once(F.col(f"raw{n}"), judge)


def _detail(n_slots: int, has_shape: bool) -> Column:
    """What was wrong, in words: column, path, value and bounds. NULL for good rows."""

    def told(n: int) -> Column:
        shown = F.coalesce(F.to_json(f"raw{n}"), F.lit("absent"))
        why = F.col(f"slot{n}.reason")
        bounds = F.when(why == "out_of_range", F.col(f"rule{n}.bounds")).otherwise("")
        return F.when(why.isNotNull(), F.concat(F.col(f"rule{n}.told"), shown, bounds))

    no_mapper = F.concat(
        F.lit("nobody reads this shape ("),
        F.col("schema_fp") if has_shape else F.lit("unknown"),
        F.lit("), hinted at "),
        F.coalesce("pipeline_hint", F.lit("nobody")),
    )
    # most rows are good and skip all of it
    return once(
        F.lit(0),
        lambda _: F.when(F.col("mapper_number").isNull(), no_mapper)
        .when(~F.col("is_object"), "expected a JSON object")
        .otherwise(F.coalesce(*[told(n) for n in range(n_slots)])),
    )


def _float(limit: float | None) -> float | None:
    return None if limit is None else float(limit)


def _bound(limit: float | None) -> str:
    return "" if limit is None else f"{limit:g}"


def _canonical(value: Column, type_name: str, rule: Column, conversions: list[str], any_changes: bool) -> Column:
    """Convert, then scale; columns that need neither pass through."""
    if type_name not in ("double", "int") or not any_changes:
        return value
    number = value.cast("double")
    out = number
    for name in conversions:
        out = F.when(rule["convert"] == name, CONVERSIONS[name](number)).otherwise(out)
    # a factor of one changes nothing
    return out * rule["scale"]


def _changes(col: MapperColumn) -> bool:
    return col.convert is not None or col.scale != 1


def _reason(types: list[str], rule: Column, k: Column, c: Column, v: Column) -> Column:
    """``k`` is the kind of the raw value, ``c`` its casts, ``v`` the final values."""

    def verdict(t: str) -> Column:
        value = v[t]
        out = F.when(c[t].isNull(), "bad_value")
        if t not in ("double", "int"):
            return out
        # NaN is not below and not above anything
        number = ~F.isnan(value) if t == "double" else F.lit(True)
        out = out.when(number & F.coalesce((value < rule["min"]) | (value > rule["max"]), value < rule["min"], value > rule["max"], F.lit(False)), "out_of_range")
        if t == "int":
            # a whole-number column cannot hold a fraction
            out = out.when(rule["changes"] & ((value != F.floor(value)) | (F.abs(value) >= 2.0**63)), "bad_value")
        return out

    absent = k.isNull() | (k == "null")
    out = F.when(rule.isNull(), F.lit(None).cast("string")).when(absent, F.when(rule["required"], "missing_value"))
    for t in types:
        out = out.when(rule["type"] == t, verdict(t))
    return out


def silver_rows(mapped: DataFrame, registry: Registry, target: str) -> DataFrame:
    """Accepted rows of one table, in its layout; columns a mapper lacks are NULL."""
    types = registry.measurements(target)
    mappers = registry.of_target(target)

    def measurement(name: str) -> Column:
        out = None
        for mapper in mappers:
            for n, col in enumerate(mapper.columns):
                if col.name == name:
                    out = (F if out is None else out).when(
                        F.col("mapper_id") == mapper.id, F.col(slot_column(n, col.type)).cast(types[name])
                    )
        return out.alias(name)

    accepted = mapped.filter((F.col("target_table") == target) & F.col("reason").isNull())
    return accepted.select(*SILVER_ENVELOPE.names, *[measurement(name) for name in types])


def silver_union(mapped: DataFrame, registry: Registry) -> DataFrame:
    """Accepted rows of all tables in one layout: ``table_name``, the envelope, and every column of every table as it is stored."""
    sources: dict[str, list[tuple[Mapper, str]]] = {}
    for mapper in registry:
        for n, col in enumerate(mapper.columns):
            type_name = COLUMN_TYPES[col.type]
            sources.setdefault(stored_name(col.name, type_name), []).append((mapper, F.col(slot_column(n, col.type)).cast(type_name)))
    columns = [_per_mapper(pairs, lambda c: c).alias(name) for name, pairs in sorted(sources.items())]
    tables = _per_mapper([(m, m) for m in registry], lambda m: F.lit(silver_table_name(m.target_table)))
    return mapped.filter(F.col("reason").isNull()).select(tables.alias("table_name"), *SILVER_ENVELOPE.names, *columns)


def silver_dead_letters(mapped: DataFrame) -> DataFrame:
    """Rejected rows as they left bronze, ready for ``dead_letters``."""
    return mapped.filter("reason IS NOT NULL").select(
        "job_id",
        "trace_id",
        F.lit("silver").alias("stage"),
        "reason",
        "detail",
        "received_at",
        "tenant_id",
        F.col("bronze_device_id").alias("device_id"),
        F.lit(1).alias("attempt"),
        F.lit(None).cast("string").alias("s3_key"),
        "schema_fp",
        "payload",
    )
