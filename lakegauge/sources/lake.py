"""The lake: bronze, dead-letter, silver and audit tables as Parquet, one folder per batch.

    <root>/bronze/raw/written_in=<batch>/received_at_day=<day>/
    <root>/silver/written_in=<batch>/table_name=<table>/event_time_day=<day>/
    <root>/ops/summaries/written_in=<batch>/
    <root>/ops/commits/written_in=<batch>/

Spark writes a batch's folders in overwrite mode, so a batch that is worked out again after
a failure replaces what it had left. The last one is the record of the commit, a single file.
Readers open the day folders that records name and no others: what is not recorded is not
there yet, and all tables of a batch appear together. A record may also name day folders of
other batches that its own rows replace; nothing is ever changed in place.

All silver tables are written in one job, over the union of their columns. Stored columns are
named with their type (``power__double``), as two tables may give one name different types.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegauge.mappers import Registry
from lakegauge.mappers.registry import silver_table_name, stored_name
from lakegauge.schemas import BRONZE_RAW, COMMITS, DEAD_LETTER, SILVER_ENVELOPE, SPARK_TYPES, SUMMARIES
from lakegauge.sources import files

BRONZE = "bronze.raw"
DEAD = "bronze.dead_letter"
AUDIT = "ops.commits"
SUMMARY = "ops.summaries"

BATCH = "written_in"  # the batch that wrote a row
TABLE = "table_name"  # the silver table of a stored row
STORED = "stored"  # namespace of the tables under the views that SQL sees

Part = tuple[str, date]  # a batch and one of its days


class UnknownTable(LookupError):
    pass


class Lake:
    """Tables under one root folder, also registered as ``namespace.name`` for SQL."""

    def __init__(self, spark: SparkSession, root: str, registry: Registry | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.registry = registry or Registry.shipped()
        self.schemas: dict[str, T.StructType] = {BRONZE: BRONZE_RAW, DEAD: DEAD_LETTER, AUDIT: COMMITS, SUMMARY: SUMMARIES}
        self.days = {BRONZE: ("received_at_day", "received_at"), DEAD: ("failed_at_day", "failed_at")}
        self.targets = {silver_table_name(t): t for t in self.registry.targets}
        for name, target in self.targets.items():
            self.schemas[name] = self.registry.silver_schema(target)
            self.days[name] = ("event_time_day", "event_time")

    @property
    def tables(self) -> list[str]:
        return sorted(self.schemas)

    def _check(self, name: str) -> None:
        if name not in self.schemas:
            raise UnknownTable(f"unknown table: {name}")

    def home(self, name: str) -> str:
        """The folder of a table's batches; silver tables share one."""
        self._check(name)
        return f"{self.root}/silver" if name in self.targets else f"{self.root}/{name.replace('.', '/')}"

    def folder(self, name: str, batch: str) -> str:
        path = f"{self.home(name)}/{BATCH}={batch}"
        return f"{path}/{TABLE}={name}" if name in self.targets else path

    # --- layouts -------------------------------------------------------------

    @property
    def silver_columns(self) -> dict[str, str]:
        """Measurement columns of all silver tables as they are stored, with their Spark types."""
        found = {stored_name(n, t): t for target in self.registry.targets for n, t in self.registry.measurements(target).items()}
        return dict(sorted(found.items()))

    def stored_schema(self, name: str) -> T.StructType:
        """What lies in the folders of a table: its columns, and those that the folders' names hold."""
        if name in self.targets:
            schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in SILVER_ENVELOPE])
            for column, type_name in self.silver_columns.items():
                schema = schema.add(column, SPARK_TYPES[type_name])
            schema = schema.add(TABLE, T.StringType())
        else:
            schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in self.schemas[name]])
        schema = schema.add(BATCH, T.StringType())
        return schema.add(self.days[name][0], T.DateType()) if name in self.days else schema

    def _columns(self, name: str) -> list[Column]:
        """The columns of a table out of the stored ones."""
        if name not in self.targets:
            return [F.col(c) for c in self.schemas[name].names]
        types = self.registry.measurements(self.targets[name])
        return [*map(F.col, SILVER_ENVELOPE.names), *[F.col(stored_name(n, t)).alias(n) for n, t in types.items()]]

    def ensure(self, register: bool = True) -> Lake:
        """Create what is missing; a table that exists only ever gains columns.

        SQL sees views over the stored tables: recorded batches only, in each table's own columns.
        """
        for name in self.tables:
            files.make_dir(self.spark, self.home(name))
        if not register:
            return self
        for namespace in sorted({STORED, *(n.split(".")[0] for n in self.tables)}):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace} LOCATION '{self.root}/_{namespace}'")
        for name, stored in self._stored_tables().items():
            schema = self.stored_schema(name)
            by = [BATCH, *([TABLE] if name in self.targets else []), *self.days.get(name, ())[:1]]
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {stored} ({columns}) USING parquet PARTITIONED BY ({', '.join(by)}) LOCATION '{self.home(name)}'")
            have = set(self.spark.table(stored).columns)
            new = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name not in have]
            if new:
                self.spark.sql(f"ALTER TABLE {stored} ADD COLUMNS ({', '.join(new)})")
        self._create_views()
        return self

    def _stored_tables(self) -> dict[str, str]:
        """One table per stored table, and the name it is registered by; one for all silver tables."""
        tables = {n: f"{STORED}.{n.replace('.', '_')}" for n in self.tables if n not in self.targets}
        return tables | {n: f"{STORED}.silver" for n in list(self.targets)[:1]}

    def _create_views(self) -> None:
        """A view per table. A row counts if its batch and day are recorded and not replaced."""
        stored = self._stored_tables()
        log = stored[AUDIT]
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {STORED}.live AS SELECT {TABLE}, {BATCH}, day FROM {log} LATERAL VIEW explode(days) AS day "
            f"EXCEPT SELECT {TABLE}, r.batch, r.day FROM {log} LATERAL VIEW explode(replaces) AS r"
        )
        for name in self.tables:
            if name not in self.days:
                self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(self.schemas[name].names)}, {BATCH} FROM {stored[name]}")
                continue
            table = stored.get(name, f"{STORED}.silver")
            own = f"s.{TABLE} = '{name}' AND " if name in self.targets else ""
            columns = ", ".join(self.schemas[name].names)
            if own:
                types = self.registry.measurements(self.targets[name])
                columns = ", ".join([*SILVER_ENVELOPE.names, *[f"`{stored_name(n, t)}` AS `{n}`" for n, t in types.items()]])
            day = self.days[name][0]
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {name} AS SELECT {columns}, {day} FROM {table} s LEFT SEMI JOIN {STORED}.live l "
                f"ON {own}l.{TABLE} = '{name}' AND l.{BATCH} = s.{BATCH} AND l.day = s.{day}"
            )

    # --- reading -------------------------------------------------------------

    def commits(self) -> DataFrame:
        """The records of all commits."""
        return self.spark.read.schema(self.stored_schema(AUDIT)).parquet(self.home(AUDIT))

    def parts(self) -> DataFrame:
        """Table, batch and day of the folders that hold rows now, out of the records."""
        commits = self.commits()
        written = commits.select(TABLE, F.col(BATCH).alias("batch"), F.explode("days").alias("day"))
        replaced = commits.select(TABLE, F.explode("replaces").alias("r")).select(TABLE, "r.batch", "r.day")
        return written.join(replaced, [TABLE, "batch", "day"], "left_anti")

    def live(self, name: str, days: Iterable[date] | None = None, first: date | None = None, last: date | None = None) -> list[Part]:
        """The folders of a table: all, those of some ``days``, or those of a range."""
        self._check(name)
        own = self.parts().filter(F.col(TABLE) == name)
        if days is not None:
            own = own.filter(F.col("day").isin(list(days)))
        for limit, keep in ((first, F.col("day") >= F.lit(first)), (last, F.col("day") <= F.lit(last))):
            own = own if limit is None else own.filter(keep)
        return sorted((r["batch"], r["day"]) for r in own.select("batch", "day").collect())

    def open(self, parts: dict[str, Iterable[Part]], all_columns: bool = False) -> DataFrame:
        """The stored rows of some folders of tables that share a home; no other folder is listed.

        ``all_columns`` also gives those that were stored once and that no mapper fills any more.
        """
        name = next(iter(parts))
        schema = self.stored_schema(name)
        folders = [f"{self.folder(n, batch)}/{self.days[n][0]}={day}" for n, own in parts.items() for batch, day in own]  # of one home
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.option("basePath", self.home(name))
        if all_columns:
            known = set(schema.names)
            for field in reader.option("mergeSchema", "true").parquet(*folders).schema:
                schema = schema if field.name in known else schema.add(field)
        return reader.schema(schema).parquet(*folders)

    def read(self, name: str, days: Iterable[date] | None = None) -> DataFrame:
        """The recorded rows of a table, or of some ``days`` of it. Columns added after a file was written are NULL there."""
        if name not in self.days:
            self._check(name)
            return self.spark.read.schema(self.stored_schema(name)).parquet(self.home(name)).select(*self.schemas[name].names, BATCH)
        return self.rows(name, self.live(name, days))

    def rows(self, name: str, parts: Iterable[Part]) -> DataFrame:
        """The rows in some folders of a table."""
        return self.open({name: parts}).select(*self._columns(name), self.days[name][0])

    def known(self, days: dict[str, list[date]], without: str) -> DataFrame:
        """Table, device and event time of the rows that silver tables hold in some days, but for those of a batch itself."""
        wanted = {(n, d) for n, own in days.items() for d in own}
        touched = self.parts().filter(F.col(TABLE).isin(list(days)) & (F.col("batch") != without) & F.col("day").isin(sorted({d for _, d in wanted}))).collect()
        parts: dict[str, list[Part]] = {}
        for r in touched:
            if (r[TABLE], r["day"]) in wanted:
                parts.setdefault(r[TABLE], []).append((r["batch"], r["day"]))
        return self.open(parts or {next(iter(days), next(iter(self.targets))): []})

    def stream_commits(self, name: str, max_commits: int | None = None) -> DataFrame:
        """Records of commits to a table, as they are added. Only the folder of the records is listed, none of the table's."""
        reader = self.spark.readStream.schema(self.stored_schema(AUDIT))
        if max_commits:
            reader = reader.option("maxFilesPerTrigger", max_commits)
        return reader.parquet(self.home(AUDIT)).filter((F.col(TABLE) == name) & (F.col("added_records") > 0))

    def committed_rows(self, name: str, records: DataFrame) -> DataFrame:
        """The rows that some commits added. Folders that have been removed since are passed over."""
        day, there = self.days[name][0], set()
        for r in records.select(BATCH, "days").collect():
            held = files.names(self.spark, self.folder(name, r[BATCH]))
            there |= {(r[BATCH], d) for d in r["days"] if f"{day}={d}" in held}
        return self.rows(name, sorted(there))

    # --- writing -------------------------------------------------------------

    def write(self, name: str, rows: DataFrame, batch: str) -> None:
        """Rows of a batch; they count once the batch is committed.

        Laid out by day with sizes evened out: neither one file per task and day, nor all of a busy day in one task.
        """
        day, time = self.days[name]
        rows = rows.select(*self.schemas[name].names).withColumn(day, F.to_date(time)).hint("rebalance", day)
        rows.write.mode("overwrite").partitionBy(day).parquet(f"{self.home(name)}/{BATCH}={batch}")

    def write_silver(self, rows: DataFrame, batch: str) -> None:
        """Rows of all silver tables at once: ``table_name``, the envelope and the stored columns, all of which are kept."""
        rows = rows.withColumn("event_time_day", F.to_date("event_time"))
        rows.hint("rebalance", TABLE, "event_time_day").write.mode("overwrite").partitionBy(TABLE, "event_time_day").parquet(f"{self.root}/silver/{BATCH}={batch}")

    def is_done(self, batch: str) -> bool:
        return files.has_parts(self.spark, f"{self.home(AUDIT)}/{BATCH}={batch}")

    def _written(self, name: str, batch: str, silver: bool) -> DataFrame:
        path = f"{self.root}/silver/{BATCH}={batch}" if silver else f"{self.home(name)}/{BATCH}={batch}"
        day, time = self.days[name]
        rows = self.spark.read.schema(self.stored_schema(name)).option("basePath", self.home(name)).parquet(path)
        table = F.col(TABLE) if silver else F.lit(name)
        mapper = [F.col(c) if silver else F.lit(None).cast(SUMMARIES[c].dataType).alias(c) for c in ("mapper_id", "mapper_version")]
        return rows.groupBy(table.alias(TABLE), F.col(day).alias("day"), "tenant_id", *mapper).agg(
            F.count(F.lit(1)).alias("n_rows"), F.min(time).alias("first_time"), F.max(time).alias("last_time"), F.hll_sketch_agg("device_id").alias("devices")
        )

    def commit(
        self, batch: str, stage: str, batch_id: int, rows_in: int, tables: Iterable[str],
        offered: dict[str, int] | None = None, replaces: dict[str, list[Part]] | None = None,
    ) -> dict[str, int]:
        """Record a batch: what is in its folders counts from now on. Gives the number of rows added per table.

        ``tables`` are those that the batch has written; counts and summaries are taken from what is stored.
        ``offered`` says how many rows there were for a table, of which those not added are duplicates.
        """
        tables, offered, replaces = list(tables), offered or {}, replaces or {}
        silver = [t for t in tables if t in self.targets]
        found = [self._written(t, batch, False) for t in tables if t not in silver] + [self._written(t, batch, True) for t in silver[:1]]
        summaries = f"{self.home(SUMMARY)}/{BATCH}={batch}"
        every = found[0]
        for more in found[1:]:
            every = every.unionByName(more)
        every.select(*SUMMARIES.names).write.mode("overwrite").parquet(summaries)
        kept = self.spark.read.schema(SUMMARIES).parquet(summaries)
        counts = {r[TABLE]: r for r in kept.groupBy(TABLE).agg(F.sum("n_rows").alias("n"), F.sort_array(F.collect_set("day")).alias("days")).collect()}
        added = {t: counts[t]["n"] if t in counts else 0 for t in dict.fromkeys([*tables, *offered, *counts])}
        rows = [
            (stage, batch_id, t, rows_in, n, offered.get(t, n) - n, counts[t]["days"] if t in counts else [], replaces.get(t, []))
            for t, n in added.items()
        ]
        record = self.spark.createDataFrame(rows, T.StructType([f for f in COMMITS if f.name != "committed_at"]))
        record.coalesce(1).withColumn("committed_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{self.home(AUDIT)}/{BATCH}={batch}")
        return added

    def refresh(self) -> None:
        """Let SQL over the registered tables see the newest files."""
        for stored in self._stored_tables().values():
            if self.spark.catalog.tableExists(stored):
                self.spark.catalog.recoverPartitions(stored)  # folders added since
                self.spark.catalog.refreshTable(stored)


def list_tables(spark: SparkSession) -> list[str]:
    """namespace.name of every registered table."""
    return sorted(
        f"{db.name}.{t.name}"
        for db in spark.catalog.listDatabases()
        for t in spark.catalog.listTables(db.name)
        if not t.isTemporary
    )
