"""The five recipes that come with the package.

Fixed values: ids, tables, keys, paths, units and bounds are what producers and
table readers rely on. Listed in file-name order, which decides the first match.
"""

from lakegauge.mappers.model import Mapper, MapperColumn

_DEGREES = {"unit": "unit:DEG_C", "property_iri": "qudt:Temperature", "min": -40, "max": 85}
_PERCENT = {"unit": "unit:PERCENT_RH", "property_iri": "qudt:RelativeHumidity", "min": 0, "max": 100}
_WATT = {"unit": "unit:W", "property_iri": "qudt:Power", "min": 0}
_WATT_HOUR = {"unit": "unit:W-HR", "property_iri": "qudt:Energy", "min": 0}
_AMPERE = {"unit": "unit:Amper", "property_iri": "qudt:current", "min": 0}
_FLOW = {"unit": "unit:L-PER-MIN", "property_iri": "qudt:VolumeFlowRate", "min": 0}
_VOLUME = {"unit": "unit:L", "property_iri": "qudt:Volume", "min": 0}

SHIPPED = (
    Mapper(
        "indoor-air-quality", 1, "silver_air_quality", ("temp", "hum"), event_time_from="ts",
        columns=(
            MapperColumn("temperature", "temp", "double", **_DEGREES),
            MapperColumn("humidity", "hum", "double", scale=100, **_PERCENT),
        ),
    ),
    Mapper(
        "iot-energy", 1, "silver_energy", ("power", "energy"), event_time_from="timestamp",
        columns=(
            MapperColumn("power", "power", "double", **_WATT),
            MapperColumn("energy", "energy", "double", **_WATT_HOUR),
            MapperColumn("current", "current", "double", **_AMPERE),
        ),
    ),
    Mapper(
        "vendor-b-airquality", 1, "silver_air_quality", ("measurements.temperature_f", "measurements.rh"),
        event_time_from="time",
        columns=(
            MapperColumn("temperature", "measurements.temperature_f", "double", convert="fahrenheit_to_celsius", **_DEGREES),
            MapperColumn("humidity", "measurements.rh", "double", **_PERCENT),
        ),
    ),
    Mapper(
        "vendor-c-energy", 1, "silver_energy", ("readings.active_power_kw", "readings.total_kwh"),
        event_time_from="ts", device_id_from="meter",
        columns=(
            MapperColumn("power", "readings.active_power_kw", "double", scale=1000, **_WATT),
            MapperColumn("energy", "readings.total_kwh", "double", scale=1000, **_WATT_HOUR),
        ),
    ),
    Mapper(
        "water-meter", 1, "silver_water", ("flow_lpm", "total_l"), event_time_from="ts",
        columns=(
            MapperColumn("flow", "flow_lpm", "double", **_FLOW),
            MapperColumn("volume", "total_l", "double", **_VOLUME),
        ),
    ),
)
