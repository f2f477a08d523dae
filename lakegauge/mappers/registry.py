"""An ordered, checked set of mappers and the table schemas that follow from it."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakegauge.mappers.model import COLUMN_TYPES, Mapper, MapperError, mapper_from_dict
from lakegauge.schemas import SILVER_ENVELOPE, SPARK_TYPES

_SUFFIXES = (".yml", ".yaml", ".json")


class Registry:
    """Mappers in match order. Order matters: the first one that fits wins."""

    def __init__(self, mappers: Iterable[Mapper]):
        self.mappers = tuple(mappers)
        seen: set[str] = set()
        for mapper in self.mappers:
            if mapper.id in seen:
                raise MapperError(f"duplicate mapper id {mapper.id!r}")
            seen.add(mapper.id)
        for target in self.targets:
            self.silver_schema(target)

    def __iter__(self) -> Iterator[Mapper]:
        return iter(self.mappers)

    def __getitem__(self, mapper_id: str) -> Mapper:
        return next(m for m in self.mappers if m.id == mapper_id)

    @classmethod
    def shipped(cls) -> Registry:
        from lakegauge.mappers.shipped import SHIPPED

        return cls(SHIPPED)

    @classmethod
    def from_dir(cls, folder: str | Path, with_shipped: bool = False) -> Registry:
        """One mapper per file, in file-name order; a bad file fails here, not on first use.

        Shipped mappers, if wanted, take the place their id would have as a file name.
        """
        found = [(p.name, _read(p)) for p in Path(folder).iterdir() if p.suffix in _SUFFIXES]
        if with_shipped:
            found += [(f"{m.id}.yml", m) for m in cls.shipped()]
        return cls(m for _, m in sorted(found, key=lambda pair: pair[0]))

    @property
    def ids(self) -> list[str]:
        return [m.id for m in self.mappers]

    @property
    def targets(self) -> list[str]:
        return sorted({m.target_table for m in self.mappers})

    def of_target(self, target: str) -> list[Mapper]:
        return [m for m in self.mappers if m.target_table == target]

    def measurements(self, target: str) -> dict[str, str]:
        """Measurement columns of a table, sorted by name, with their Spark types.

        All columns that mappers fill with more than one type or unit are reported at once.
        """
        declared: dict[str, dict[tuple[str, str], list[str]]] = {}
        for mapper in self.of_target(target):
            for col in mapper.columns:
                declared.setdefault(col.name, {}).setdefault((col.type, col.unit), []).append(mapper.id)
        if not declared:
            raise MapperError(f"{target} has no columns: it is nobody's target")
        mixed = [f"{name} ({'; '.join(f'{kind} {unit}: {', '.join(ids)}' for (kind, unit), ids in ways.items())})" for name, ways in sorted(declared.items()) if len(ways) > 1]
        if mixed:
            raise MapperError(f"{target} has columns of several types or units: {', '.join(mixed)}")
        return {name: COLUMN_TYPES[next(iter(ways))[0]] for name, ways in sorted(declared.items())}

    def silver_schema(self, target: str) -> T.StructType:
        schema = T.StructType(list(SILVER_ENVELOPE.fields))
        for name, type_name in self.measurements(target).items():
            schema = schema.add(name, SPARK_TYPES[type_name], nullable=True)
        return schema

    def mappers_df(self, spark: SparkSession) -> DataFrame:
        rows = [
            (n, m.id, m.version, m.target_table, list(m.required_keys), m.event_time_from, m.device_id_from)
            for n, m in enumerate(self.mappers)
        ]
        return spark.createDataFrame(
            rows,
            "match_order int, mapper_id string, mapper_version int, target_table string, "
            "required_keys array<string>, event_time_from string, device_id_from string",
        )

    def columns_df(self, spark: SparkSession) -> DataFrame:
        rows = [
            (m.id, m.version, m.target_table, n, c.name, c.source, c.type, c.unit, c.property_iri,
             float(c.scale), c.convert, _float(c.min), _float(c.max), c.required)
            for m in self.mappers
            for n, c in enumerate(m.columns)
        ]
        return spark.createDataFrame(
            rows,
            "mapper_id string, mapper_version int, target_table string, position int, name string, source string, "
            "type string, unit string, property_iri string, scale double, convert string, min double, max double, "
            "required boolean",
        )


def _float(value: float | None) -> float | None:
    return None if value is None else float(value)


def _read(path: Path) -> Mapper:
    text = path.read_text(encoding="utf-8")
    try:
        if path.suffix == ".json":
            data = json.loads(text)
        else:
            try:
                import yaml
            except ImportError:
                raise MapperError(f"{path.name}: reading YAML mappers needs PyYAML") from None
            try:
                data = yaml.safe_load(text)
            except yaml.YAMLError as e:
                raise MapperError(f"{path.name}: {e}") from None
    except json.JSONDecodeError as e:
        raise MapperError(f"{path.name}: {e}") from None
    return mapper_from_dict(data, path.name)


def silver_table_name(target: str) -> str:
    """silver_air_quality -> silver.air_quality"""
    return "silver." + target.removeprefix("silver_")


def stored_name(name: str, type_name: str) -> str:
    """The column that holds a measurement where all silver tables lie together: two tables may give a name different types."""
    return f"{name}__{type_name}"
