"""Objects too large for the queue, by their key in the landing area.

Tasks open exactly the named objects, each once however many jobs name it. Spark's
own file source is of no use here: it lists folders and hides names that begin
with ``_`` or ``.``, and one object it cannot read ends the job.
"""

from __future__ import annotations

import re
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRIES = 3
PAUSE = 0.2  # seconds before the second try, twice as long before the third


def store_of(root: str):
    """The file system of a landing area or an object and its place there. Takes the addresses that Spark takes."""
    from pyarrow import fs

    local = re.sub(r"^file:/+", "/", root)
    if "://" not in local:
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", local))


def _inside(key: str) -> bool:
    """Producers choose keys; none may lead out of the landing area."""
    return bool(key) and not key.startswith("/") and ".." not in key.split("/")


def _fetch(store, folder: str, key: str) -> tuple[bytes | None, str | None]:
    """Content, or why it cannot be had after ``TRIES`` tries; neither if there is no such object."""
    from pyarrow import ArrowException
    from pyarrow.fs import FileType

    if not _inside(key):
        return None, None
    for turn in range(1, TRIES + 1):
        try:
            path = f"{folder}/{key}"
            if store.get_file_info(path).type in (FileType.NotFound, FileType.Directory):
                return None, None
            with store.open_input_stream(path, compression=None) as stream:
                return stream.read(), None
        except (OSError, ArrowException, ValueError) as e:
            if turn == TRIES:
                return None, f"{type(e).__name__}: {e}"
            time.sleep(PAUSE * turn)
    return None, None


def objects_for(jobs: DataFrame, root: str) -> DataFrame:
    """``key``, ``content`` and ``fetch_error`` of the landed objects that reference jobs name; no row where there is none.

    Null keys, keys of folders and keys that lead out of ``root`` name no object.
    Contents come one to a batch, so a task holds one object at a time.
    """
    base = root.rstrip("/")
    tasks = int(jobs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # keys are small, what they name is not: their number of tasks must not be made smaller
    keys = jobs.filter("mode = 'reference' AND s3_key IS NOT NULL").select("s3_key").distinct().repartition(tasks, "s3_key")

    def read(batches):
        import pyarrow as pa

        store, folder = store_of(base)
        schema = pa.schema([("key", pa.string()), ("content", pa.binary()), ("fetch_error", pa.string())])
        for batch in batches:
            for key in batch.column(0).to_pylist():
                content, error = _fetch(store, folder, key)
                if content is not None or error is not None:
                    yield pa.RecordBatch.from_pydict({"key": [key], "content": [content], "fetch_error": [error]}, schema=schema)

    return keys.mapInArrow(read, "key string, content binary, fetch_error string")


def land(routed: DataFrame, root: str) -> None:
    """Write the bodies of reference readings under their keys, ahead of their queue entries.

    Each task writes its own objects; a task that runs again writes the same bytes to the same keys.
    """
    base = root.rstrip("/")

    def write(rows) -> None:
        store, folder = store_of(base)
        made = set()
        for row in rows:
            if not _inside(row["s3_key"]):
                raise ValueError(f"not a key within the landing area: {row['s3_key']!r}")
            target = f"{folder}/{row['s3_key']}"
            above = target.rpartition("/")[0]
            if above not in made:
                store.create_dir(above, recursive=True)
                made.add(above)
            with store.open_output_stream(target, compression=None) as out:
                out.write(bytes(row["body"]))

    routed.filter("mode = 'reference'").select("s3_key", "body").foreachPartition(write)
