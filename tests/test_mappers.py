"""Mapper files, their checks, and the table layouts that follow from them."""

import json

import pytest

from lakegauge.mappers import Mapper, MapperColumn, MapperError, Registry
from lakegauge.mappers.model import mapper_from_dict
from lakegauge.mappers.registry import silver_table_name

GOOD = {
    "id": "vendor-x",
    "version": 2,
    "target_table": "silver_air_quality",
    "match": {"required_keys": ["a.b"]},
    "event_time_from": "when",
    "columns": [{"name": "temperature", "from": "a.b", "type": "double", "unit": "unit:DEG_C", "property_iri": "qudt:Temperature", "min": -40}],
}


def changed(**top):
    return {k: v for k, v in (GOOD | top).items() if v is not None}


def column(**fields):
    return changed(columns=[{k: v for k, v in (GOOD["columns"][0] | fields).items() if v is not None}])


def test_a_good_mapper():
    m = mapper_from_dict(GOOD)
    assert (m.id, m.version, m.required_keys, m.event_time_from, m.device_id_from) == ("vendor-x", 2, ("a.b",), "when", None)
    assert (m.columns[0].source, m.columns[0].scale, m.columns[0].required, m.columns[0].max) == ("a.b", 1.0, False, None)


@pytest.mark.parametrize(
    "bad",
    [
        changed(extra=1), changed(id=None), changed(version="two"), changed(version=True), changed(match={"required_keys": []}),
        changed(match={"required_keys": ["a"], "any_keys": ["b"]}), changed(match={"required_keys": [1]}), changed(columns={}),
        column(type="float"), column(convert="kelvin_to_celsius"), column(shade="x"), column(unit=None), column(min="low"),
        column(type="string"), column(type="bool", min=None, scale=2), column(required="yes"), column(**{"from": "a..b"}),
        changed(columns=GOOD["columns"] * 2), [],
    ],
)
def test_bad_mappers_fail_at_load(bad):
    with pytest.raises(MapperError):
        mapper_from_dict(bad)


def test_files_are_read_in_name_order(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "b.json").write_text(json.dumps(GOOD | {"id": "second"}))
    (tmp_path / "a.yml").write_text("\n".join([
        "id: first", "version: 1", "target_table: silver_water", "match:", "  required_keys: [flow]",
        "columns:", "  - {name: flow, from: flow, type: double, unit: 'unit:L-PER-MIN', property_iri: 'qudt:Flow', scale: 0.5}",
    ]))
    (tmp_path / "notes.txt").write_text("not a mapper")
    registry = Registry.from_dir(tmp_path)
    assert registry.ids == ["first", "second"] and registry["first"].columns[0].scale == 0.5
    (tmp_path / "k.yml").write_text((tmp_path / "a.yml").read_text().replace("id: first", "id: kept"))
    everyone = Registry.from_dir(tmp_path, with_shipped=True)
    assert everyone.ids == ["first", "second", "indoor-air-quality", "iot-energy", "kept", "vendor-b-airquality", "vendor-c-energy", "water-meter"]


@pytest.mark.parametrize("name,text", [("x.json", "{"), ("x.yml", "id: ["), ("x.yml", "id: only")])
def test_unreadable_files_fail_at_load(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    with pytest.raises(MapperError):
        Registry.from_dir(tmp_path)


def test_duplicate_ids_fail():
    with pytest.raises(MapperError):
        Registry([mapper_from_dict(GOOD), mapper_from_dict(GOOD)])


def test_vendors_of_one_table_must_agree():
    other = column(unit="unit:DEG_F") | {"id": "other"}
    with pytest.raises(MapperError, match="DEG_F"):
        Registry([mapper_from_dict(GOOD), mapper_from_dict(other)])
    # another meaning alone is no conflict
    Registry([mapper_from_dict(GOOD), mapper_from_dict(column(property_iri="qudt:Other") | {"id": "other"})])


def test_silver_layout():
    registry = Registry.shipped()
    assert registry.targets == ["silver_air_quality", "silver_energy", "silver_water"]
    schema = registry.silver_schema("silver_energy")
    assert schema.names[:8] == ["job_id", "trace_id", "tenant_id", "device_id", "event_time", "received_at", "mapper_id", "mapper_version"]
    assert schema.names[8:] == ["current", "energy", "power"]
    assert [f.nullable for f in schema] == [False] * 8 + [True] * 3
    with pytest.raises(MapperError):
        registry.silver_schema("silver_nothing")
    assert silver_table_name("silver_air_quality") == "silver.air_quality" and silver_table_name("other") == "silver.other"


def test_types_follow_the_mapper():
    columns = tuple(MapperColumn(t, t, t, "unit:ONE", "q:x") for t in ("double", "int", "string", "bool", "timestamp"))
    types = Registry([Mapper("m", 1, "silver_t", ("x",), columns)]).measurements("silver_t")
    assert types == {"bool": "boolean", "double": "double", "int": "bigint", "string": "string", "timestamp": "timestamp"}


def test_mappers_as_tables(spark):
    registry = Registry.shipped()
    assert [r["mapper_id"] for r in registry.mappers_df(spark).orderBy("match_order").collect()] == registry.ids
    conflicts = registry.columns_df(spark).groupBy("target_table", "name").agg({"unit": "collect_set"}).filter("size(`collect_set(unit)`) > 1")
    assert registry.columns_df(spark).count() == 11 and conflicts.count() == 0
