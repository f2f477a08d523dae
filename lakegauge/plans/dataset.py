"""Silver as a published dataset: observations, a record that describes them, and whole versions of both.

*Observations* are silver in long form, one row per measured value, over all tables at once, with the property and unit
that the mappers declare; ``triples`` spells them as N-Triples. The *record* (rows, time covered, devices) is merged
from the summaries that commits leave behind, so no reading is scanned for it. A *version* is a folder named by what it
was made of. A pointer, a single object, names the current one and is written last: readers get a whole version, and a
publication that was interrupted leaves the one before in place.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.mappers.registry import stored_name
from lakegauge.sources import files
from lakegauge.sources.lake import BATCH, SUMMARY, TABLE, Lake
from lakegauge.sources.objects import write_object

# The vocabularies that observations are told in, and the literal type of each column type.
PREFIXES = {
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "sosa": "http://www.w3.org/ns/sosa/",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
    "qudt": "http://qudt.org/vocab/quantitykind/",
    "unit": "http://qudt.org/vocab/unit/",
    "schema": "http://qudt.org/schema/qudt/",
}
LITERAL_TYPES = {"double": "xsd:double", "bigint": "xsd:long", "boolean": "xsd:boolean", "string": "xsd:string", "timestamp": "xsd:dateTime"}

BROADCAST = 10_000  # column descriptions that are sent to all tasks at most
OBSERVATION = ("job_id", "tenant_id", "device_id", "event_time", TABLE, "mapper_id", "name", "type", "value", "property_iri", "unit")


def _time(value: Column) -> Column:
    micros = F.date_format(value, "SSSSSS")
    return F.concat(F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss"), F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(""), F.lit("Z"))


def _text(value: Column, type_name: str) -> Column:
    """A measured value as the text of its literal."""
    if type_name == "timestamp":
        return _time(value)
    text = value.cast("string")
    if type_name == "double":
        return F.when(text == "Infinity", "INF").when(text == "-Infinity", "-INF").otherwise(text)
    return text


def observations(lake: Lake, tables: Iterable[str] | None = None, broadcast: int = BROADCAST) -> DataFrame:
    """One row per value of the silver tables that is not NULL. Nothing is shuffled while the descriptions are few."""
    registry = lake.registry
    names = sorted(tables or lake.targets)
    rows = lake.open({n: lake.live(n) for n in names})
    values = None
    for name in names:
        own = [
            F.struct(F.lit(c).alias("name"), F.lit(t).alias("type"), _text(F.col(stored_name(c, t)), t).alias("value"))
            for c, t in registry.measurements(lake.targets[name]).items()
        ]
        values = (F if values is None else values).when(F.col(TABLE) == name, F.array(*own))
    long = rows.select(*OBSERVATION[:6], F.explode(values).alias("x")).select(*OBSERVATION[:6], "x.*").filter("value IS NOT NULL")
    described = registry.columns_df(lake.spark).select("mapper_id", "name", "property_iri", "unit")
    if sum(len(m.columns) for m in registry) <= broadcast:
        described = F.broadcast(described)
    return long.join(described, ["mapper_id", "name"]).select(*OBSERVATION)


# --- N-Triples ---------------------------------------------------------------


def iri_part(value: Column) -> Column:
    """A text as one step of an IRI: all but letters, digits and ``*-._`` as %XX."""
    return F.replace(F.url_encode(value), F.lit("+"), F.lit("%20"))


def iri(value: Column, prefixes: Mapping[str, str] = PREFIXES) -> Column:
    """``prefix:name`` or a whole IRI in angle brackets; characters that may not stand there as %XX."""
    out = value
    for prefix, whole in prefixes.items():
        out = F.when(value.startswith(f"{prefix}:"), F.concat(F.lit(whole), F.substr(value, F.lit(len(prefix) + 2)))).otherwise(out)
    mended = out
    for bad in '<>"{}|^`\\':
        mended = F.replace(mended, F.lit(bad), F.lit(f"%{ord(bad):02X}"))
    # blanks and control characters
    mended = F.array_join(F.transform(F.split(mended, ""), lambda c: F.when(c.rlike(r"^[\x00-\x20]$"), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c)), "")
    # most hold none of these, and to go through their characters costs more than all else of a statement
    out = F.when(out.rlike(r'[\x00-\x20<>"{}|^`\\]'), mended).otherwise(out)
    return F.concat(F.lit("<"), out, F.lit(">"))


def _known(name: str) -> str:
    """The whole IRI of a name of ours, ``prefix:name``."""
    prefix, _, rest = name.partition(":")
    return f"<{PREFIXES[prefix]}{rest}>"


def literal(value: Column, type_iri: str | Column | None = None) -> Column:
    out = value
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(plain), F.lit(escaped))
    quoted = F.concat(F.lit('"'), out, F.lit('"'))
    if type_iri is None:
        return quoted
    return F.concat(quoted, F.lit("^^"), iri(F.lit(type_iri)) if isinstance(type_iri, str) else type_iri)


def triples(long: DataFrame, base: str) -> DataFrame:
    """``predicate`` and ``line`` of each statement about each observation; ``base`` is the IRI that names of ours start with."""
    home = base.rstrip("/")
    subject = F.concat(F.lit(f"<{home}/observation/"), iri_part(F.col("job_id")), F.lit("/"), iri_part(F.col("name")), F.lit(">"))
    sensor = F.concat(F.lit(f"<{home}/device/"), iri_part(F.col("tenant_id")), F.lit("/"), iri_part(F.col("device_id")), F.lit(">"))
    kind = None
    for type_name, type_iri in LITERAL_TYPES.items():
        kind = (F if kind is None else kind).when(F.col("type") == type_name, _known(type_iri))
    about = {
        "rdf:type": F.lit(_known("sosa:Observation")),
        "sosa:madeBySensor": sensor,
        "sosa:observedProperty": iri(F.col("property_iri")),
        "sosa:resultTime": literal(_time(F.col("event_time")), F.lit(_known("xsd:dateTime"))),
        "sosa:hasSimpleResult": literal(F.col("value"), kind),
        "schema:unit": iri(F.col("unit")),
    }
    lines = [F.struct(F.lit(p).alias("predicate"), F.concat_ws(" ", subject, F.lit(_known(p)), o, F.lit(".")).alias("line")) for p, o in about.items()]
    return long.select(F.explode(F.array(*lines)).alias("x")).select("x.*")


# --- the record ------------------------------------------------------------------


def dataset_record(lake: Lake) -> DataFrame:
    """Per silver table and tenant: rows, first and last event time, days, and about how many devices; out of the summaries alone."""
    live = lake.parts().filter(F.col(TABLE).isin(list(lake.targets)))
    kept = lake.read(SUMMARY).withColumnRenamed(BATCH, "batch").join(live, [TABLE, "batch", "day"], "left_semi")
    return kept.groupBy(TABLE, "tenant_id").agg(
        F.sum("n_rows").alias("n_rows"), F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"),
        F.count_distinct("day").alias("n_days"), F.hll_sketch_estimate(F.hll_union_agg("devices")).alias("n_devices"),
    )


# --- versions ------------------------------------------------------------------------


def _version(lake: Lake, base: str) -> str:
    """A name for what a version is made of: folders of the tables, and what the mappers say about their columns."""
    parts = {n: [(b, str(d)) for b, d in lake.live(n)] for n in sorted(lake.targets)}
    about = [(m.id, m.version, [(c.name, c.property_iri, c.unit) for c in m.columns]) for m in lake.registry]
    return hashlib.sha256(json.dumps([base, parts, about]).encode()).hexdigest()[:16]


def publish_dataset(lake: Lake, root: str, dataset: str, base: str) -> str:
    """Write the current version, unless it is there, and point to it. Gives its name."""
    home, version = f"{root.rstrip('/')}/{dataset}", _version(lake, base)
    if not files.exists(lake.spark, f"{home}/{version}/record/_SUCCESS"):
        triples(observations(lake), base).select("line").write.mode("overwrite").text(f"{home}/{version}/observations")
        dataset_record(lake).write.mode("overwrite").json(f"{home}/{version}/record")
    pointer = lake.spark.createDataFrame([(json.dumps({"dataset": dataset, "version": version}),)], "value string")
    write_object(pointer, f"{home}/latest.json")
    return version


def current_version(spark: SparkSession, root: str, dataset: str) -> str | None:
    """The version that the pointer names; None before the first one."""
    pointer = f"{root.rstrip('/')}/{dataset}/latest.json"
    if not files.exists(spark, pointer):
        return None
    return json.loads(spark.read.text(pointer, wholetext=True).first()[0])["version"]


def read_dataset(spark: SparkSession, root: str, dataset: str) -> tuple[DataFrame, DataFrame]:
    """Lines and record of the current version."""
    home = f"{root.rstrip('/')}/{dataset}/{current_version(spark, root, dataset)}"
    return spark.read.text(f"{home}/observations"), spark.read.json(f"{home}/record")
