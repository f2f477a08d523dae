"""One object at an exact key: Spark's own writers make folders of parts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from lakegauge.sources.landing import store_of


@dataclass
class Written(WriterCommitMessage):
    path: str | None


class ObjectWriter(DataSourceWriter):
    """The task that has the row writes it beside the target, the driver gives it its name once all tasks have ended.

    So a task that runs twice, or a job that fails, leaves no object, and an object is there whole or not at all.
    """

    def __init__(self, target: str):
        self.target = target

    def write(self, rows: Iterator[Row]) -> WriterCommitMessage:
        texts = [r[0] for r in rows]
        if len(texts) > 1:
            raise ValueError("one object has one row")
        if not texts:
            return Written(None)
        store, path = store_of(self.target)
        folder, _, name = path.rpartition("/")
        store.create_dir(folder, recursive=True)
        aside = f"{folder}/.{name}-{uuid.uuid4().hex}"
        with store.open_output_stream(aside, compression=None) as out:
            out.write(texts[0].encode())
        return Written(aside)

    def commit(self, messages: list) -> None:
        found = [m.path for m in messages if m and m.path]
        if len(found) != 1:
            self.abort(messages)
            raise ValueError(f"one object has one row, not {len(found)}")
        store, path = store_of(self.target)
        store.move(found[0], path)

    def abort(self, messages: list) -> None:
        store, _ = store_of(self.target)
        for m in messages:
            if m and m.path:
                store.delete_file(m.path)


class ObjectSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "lakegauge_object"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return ObjectWriter(self.options["target"])


def write_object(document: DataFrame, target: str) -> None:
    """A DataFrame of one row and one text column as the object at ``target``, which is replaced if it is there."""
    document.sparkSession.dataSource.register(ObjectSource)
    document.select(document.columns[0]).coalesce(1).write.format("lakegauge_object").mode("append").option("target", target).save()
