"""What a mapper says, and the checks a mapper file must pass."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from lakegauge.functions.strict_json import json_path
from lakegauge.functions.units import CONVERSIONS

# Column types a mapper may declare, and the Spark type of each.
COLUMN_TYPES = {
    "double": "double",
    "int": "bigint",
    "string": "string",
    "bool": "boolean",
    "timestamp": "timestamp",
}
NUMERIC = ("double", "int")


class MapperError(ValueError):
    """A mapper, or a set of mappers, that cannot be used."""


@dataclass(frozen=True)
class MapperColumn:
    name: str
    source: str
    type: str
    unit: str
    property_iri: str
    scale: float = 1.0
    convert: str | None = None
    min: float | None = None
    max: float | None = None
    required: bool = False

    def __post_init__(self) -> None:
        if self.type not in COLUMN_TYPES:
            raise MapperError(f"column {self.name!r}: unknown type {self.type!r}")
        if self.convert is not None and self.convert not in CONVERSIONS:
            raise MapperError(f"column {self.name!r}: unknown conversion {self.convert!r}")
        numeric_only = self.scale != 1 or any(x is not None for x in (self.convert, self.min, self.max))
        if numeric_only and self.type not in NUMERIC:
            raise MapperError(f"column {self.name!r}: scale, convert, min and max need a number, not {self.type}")
        _check_path(self.source)


@dataclass(frozen=True)
class Mapper:
    id: str
    version: int
    target_table: str
    required_keys: tuple[str, ...]
    columns: tuple[MapperColumn, ...]
    event_time_from: str | None = None
    device_id_from: str | None = None

    def __post_init__(self) -> None:
        if not self.required_keys:
            raise MapperError(f"mapper {self.id!r}: match.required_keys is empty, it would match anything")
        names = [c.name for c in self.columns]
        if len(set(names)) != len(names):
            raise MapperError(f"mapper {self.id!r}: a column is declared twice")
        for path in (*self.required_keys, self.event_time_from, self.device_id_from):
            if path is not None:
                _check_path(path)


def _check_path(path: str) -> None:
    try:
        json_path(path)
    except ValueError as e:
        raise MapperError(str(e)) from None


_MISSING = object()


def _take(data: Mapping[str, Any], where: str, spec: Mapping[str, tuple]) -> dict[str, Any]:
    """Fields of ``spec`` (name -> accepted types, default) and nothing else."""
    if not isinstance(data, Mapping):
        raise MapperError(f"{where}: expected a mapping")
    unknown = sorted(set(map(str, data)) - set(spec))
    if unknown:
        raise MapperError(f"{where}: unknown field(s) {', '.join(unknown)}")
    out = {}
    for name, (types, default) in spec.items():
        value = data.get(name, default)
        if value is _MISSING:
            raise MapperError(f"{where}: missing field {name}")
        # bool is an int in Python, but not a number in a mapper file
        if not isinstance(value, types) or (isinstance(value, bool) and bool not in types):
            raise MapperError(f"{where}: bad value for {name}: {value!r}")
        out[name] = value
    return out


_TEXT, _NUMBER, _NONE = (str,), (int, float), type(None)
_MAPPER_FIELDS = {
    "id": (_TEXT, _MISSING),
    "version": ((int,), _MISSING),
    "target_table": (_TEXT, _MISSING),
    "match": ((Mapping,), _MISSING),
    "columns": ((list,), _MISSING),
    "event_time_from": ((str, _NONE), None),
    "device_id_from": ((str, _NONE), None),
}
_COLUMN_FIELDS = {
    "name": (_TEXT, _MISSING),
    "from": (_TEXT, _MISSING),
    "type": (_TEXT, _MISSING),
    "unit": (_TEXT, _MISSING),
    "property_iri": (_TEXT, _MISSING),
    "scale": (_NUMBER, 1.0),
    "convert": ((str, _NONE), None),
    "min": ((*_NUMBER, _NONE), None),
    "max": ((*_NUMBER, _NONE), None),
    "required": ((bool,), False),
}


def mapper_from_dict(data: Mapping[str, Any], where: str = "mapper") -> Mapper:
    top = _take(data, where, _MAPPER_FIELDS)
    keys = _take(top.pop("match"), f"{where}: match", {"required_keys": ((list,), _MISSING)})["required_keys"]
    if not all(isinstance(k, str) for k in keys):
        raise MapperError(f"{where}: match.required_keys must be texts")
    columns = []
    for n, item in enumerate(top.pop("columns")):
        fields = _take(item, f"{where}: columns[{n}]", _COLUMN_FIELDS)
        columns.append(MapperColumn(source=fields.pop("from"), **fields))
    try:
        return Mapper(required_keys=tuple(keys), columns=tuple(columns), **top)
    except MapperError as e:
        raise MapperError(f"{where}: {e}") from None
