"""Exact dedup by deterministic block naming.

Texts are cut into blocks of ``BLOCK`` bytes. All blocks are sorted, and equal ones get one integer, their *name*. Then
adjacent names of a document are paired, the pairs are sorted and named likewise, and so on: after as many rounds as its
number of blocks has binary digits a document has a single name. Blocks and pairs are compared in full, so documents
with the same number of rounds have the same name exactly if their texts are equal; no digest takes part.

Hot groups. Rows are sorted by (key, row, place), cut into ranges, so equal blocks of however many documents lie in as
many tasks as their rows fill. A task names the runs of its range; a key that goes on in the next range has a name in
each, of which the smallest becomes its name everywhere (at most two such keys a range, aggregated by key; their new
names, two pairs of integers a range at most, are broadcast). Groups with more than a ``HOT``-th of all rows, of which there are ``HOT`` at most, are broadcast to their members; all others meet
their members in a join. Nothing is collected but counts. Spark draws at most 3,000,000 sort keys, of ``BLOCK`` bytes
at most, to choose the ranges, whatever the size of the input.

Names are (number of the range, number of the run) and are written down before they are used, so a task that runs again
after a loss never mixes with other names.

Defined results: null counts as empty, and the empty text is one empty block; only A-Z are lower-cased; of equal texts
the row with the largest ``doc_id`` stays, an id being larger than none; of rows repeated with that id one stays; empty
tables give no rows; other columns are ignored. A task holds one Arrow batch of texts and its blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.llm.common import stored

BLOCK = 256
HOT = 1000
SENT = 16_000  # blocks in an Arrow batch

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def blocks(documents: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """row, at, left (number of blocks), body; the first block of a row also has its doc_id and the digest of its text."""
    schema = pa.schema([("row", pa.int64()), ("at", pa.int64()), ("left", pa.int64()), ("body", pa.binary()), ("doc_id", pa.int64()), ("text_sha256", pa.string())])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[list] = [[] for _ in schema]
            for i, body in enumerate(batch.column(2)):
                body = (body.as_py() or b"").translate(_LOWER)
                digest = hashlib.sha256(body).hexdigest()
                n = max(1, -(-len(body) // block))
                for at in range(n):
                    first = at == 0
                    for column, value in zip(out, (rows[i], at, n, body[at * block : (at + 1) * block], ids[i] if first else None, digest if first else None), strict=True):
                        column.append(value)
                    if len(out[0]) == SENT:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)
                        out = [[] for _ in schema]
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    rows = documents.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(cut, "row long, at long, left long, body binary, doc_id long, text_sha256 string")


def _name_runs(n_keys: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted rows, keys in the first columns -> the other columns, name and edge: whether the first or last run of the range begins here."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        last, held, name = None, None, -1
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(j) for j in range(n_keys)]
            new = np.zeros(batch.num_rows, bool)
            for k in keys:
                new[1:] |= pc.not_equal(k[1:], k[:-1]).to_numpy(zero_copy_only=False)
            now = tuple(k[0].as_py() for k in keys)
            new[0] = now != last
            last = tuple(k[-1].as_py() for k in keys)
            names = name + np.cumsum(new)
            edge = new & (names == 0)
            if held is not None:
                yield _told(held, n_keys, base, False)
            held = (batch, names, edge)
            name = int(names[-1])
        if held is not None:
            yield _told(held, n_keys, base, True)

    return run


def _told(held: tuple, n_keys: int, base: int, final: bool) -> pa.RecordBatch:
    batch, names, edge = held
    edge = edge.copy()
    edge[-1] |= final
    keys = [pc.if_else(pa.array(edge), batch.column(j), pa.scalar(None, batch.schema.types[j])) for j in range(n_keys)]
    rest = batch.columns[n_keys:]
    return pa.RecordBatch.from_arrays([*keys, *rest, pa.array(base + names)], names=[*batch.schema.names, "name"])


def named(rows: DataFrame, keys: list[str], purpose: str) -> DataFrame:
    """The other columns of ``rows`` with the name of each row's key; rows are told apart by row and at, keys are not null."""
    rest = [c for c in rows.columns if c not in keys]
    order = [*keys, "row", "at"]
    ranges = rows.select(*keys, *rest).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranges.schema)
    runs = stored(ranges.mapInArrow(_name_runs(len(keys)), f"{schema}, name long"), purpose)
    # a key at the edge of a range may have a name in the next one as well
    edges = runs.where(F.col(keys[0]).isNotNull()).groupBy(*keys, "name").agg(F.lit(1).alias("one"))
    several = edges.groupBy(*keys).agg(F.min("name").alias("new"), F.collect_set("name").alias("names")).where(F.size("names") > 1)
    moved = stored(several.select(F.explode("names").alias("name"), "new").where("name <> new"), f"{purpose}-edges")
    return runs.select(*rest, "name").join(F.broadcast(moved), "name", "left").select(*rest, F.coalesce("new", "name").alias("name"))


def identities(documents: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(row, level, name) of every row, and (row, doc_id, text_sha256)."""
    first = named(blocks(documents, key, text, block), ["body"], "names-0")
    about = first.where(F.col("at") == 0).select("row", "doc_id", "text_sha256")
    now, level, done = first.select("row", "at", "left", "name"), 0, []
    while True:
        done.append(now.where(F.col("left") == 1).select("row", F.lit(level).alias("level"), "name"))
        more = now.where(F.col("left") > 1)
        if not more.limit(1).count():
            break
        side = [F.max(F.when(F.col("at") % 2 == s, F.col("name"))).alias(n) for s, n in ((0, "a"), (1, "b"))]
        half = F.shiftright("at", 1)
        pairs = more.groupBy("row", half.alias("at")).agg(F.max(F.shiftright(F.col("left") + 1, 1)).alias("left"), *side)
        level += 1
        now = named(pairs.withColumn("b", F.coalesce("b", F.lit(-1))), ["a", "b"], f"names-{level}")
    every = done[0]
    for x in done[1:]:
        every = every.unionByName(x)
    return every, about


def exact_groups(documents: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK, hot: int = HOT) -> DataFrame:
    """One row per row of ``documents``: doc_id, keep_id, group_size, kept and text_sha256."""
    every, about = identities(documents, key, text, block)
    rows = stored(every.join(about, "row"), "named-rows")
    # null ids come first in the order of structs
    groups = stored(rows.groupBy("level", "name").agg(F.max(F.struct("doc_id", "row")).alias("stays"), F.count("*").alias("group_size")), "groups")
    many = rows.count() // hot
    large = F.broadcast(groups.where(F.col("group_size") > many))
    small = groups.where(F.col("group_size") <= many)
    same = ["level", "name"]
    joined = rows.join(large, same).unionByName(rows.join(large, same, "left_anti").join(small, same))
    return joined.select("doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("stays.row")).alias("kept"), "text_sha256")
