"""Vendor mappers: declarative recipes from payload shape to typed columns."""

from lakegauge.mappers.model import Mapper, MapperColumn, MapperError
from lakegauge.mappers.registry import Registry

__all__ = ["Mapper", "MapperColumn", "MapperError", "Registry"]
