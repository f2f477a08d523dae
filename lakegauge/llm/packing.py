"""Best-fit packing by hierarchical residual packing.

Rows are dealt into nodes of about ``NODE_ITEMS`` items. Every node packs its
items best-fit, longest first, and emits its nearly full bins. Underfull bins go
up a tree of ``FAN_IN`` nodes a step, where they are items themselves and are
packed best-fit again, until one node is left.

What goes up is bounded without loss: after best fit any two bins of a node
together exceed the capacity, so a node has one bin at most that is half full or
less, only such bins can still be moved into others, and a parent therefore
never needs more than its children's ``FAN_IN`` emptiest bins as hosts.

Defined results: null texts are empty; every document has a separator, so none
is empty; ties are broken by row number; no rows give no sequences; a length
beyond the capacity is an error; repeated rows are packed as often as they come;
null lengths count as 0. Columns named like the outputs are replaced.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegauge.llm.common import stored, text_batches
from lakegauge.llm.wordbpe import encoder

CAPACITY = 2048
NODE_ITEMS = 50_000
FAN_IN = 8
NEARLY_FULL = 0.99


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, separator: int = 0, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Every document's ids and a separator, cut into pieces only where they exceed the capacity."""
    kind = docs.schema[doc_id].dataType
    fields = [("doc_id", kind), ("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(("ids", T.ArrayType(T.IntegerType())))
    arrow = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]

    def run(batches):
        for part, texts in text_batches(batches):
            flat, counts = encoder(vocabulary).encode(texts)
            of, cells = [], [[] for _ in fields[1:]]
            end = 0
            for k, count in enumerate(counts.tolist()):
                ids = np.append(flat[end : end + count], separator).astype("<u4")
                end += count
                for n, at in enumerate(range(0, len(ids), capacity)):
                    own = ids[at : at + capacity]
                    of.append(k)
                    for cell, value in zip(cells, (n, at, len(own), zlib.crc32(own.tobytes()), own.astype(np.int32)), strict=False):
                        cell.append(value)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(of, pa.int64())), *(pa.array(c, a) for c, a in zip(cells, arrow, strict=False))], names=[f[0] for f in fields])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, T.StructType([T.StructField(*f) for f in fields]))


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of every item, in the order given, and the fill of every bin; the fullest bin that still has room is taken."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, bins, offsets, fills = 0, [], [], []
    for length in lengths:
        if length > capacity:
            raise ValueError(f"an item of length {length} exceeds the capacity {capacity}")
        fitting = open_rooms >> length
        if fitting:
            left = length + (fitting & -fitting).bit_length() - 1
            place = room[left].pop()
            if not room[left]:
                open_rooms ^= 1 << left
        else:
            left, place = capacity, len(fills)
            fills.append(0)
        bins.append(place)
        offsets.append(capacity - left)
        fills[place] += length
        room[left - length].append(place)
        open_rooms |= 1 << left - length
    return bins, offsets, fills


def _goes_up(fills: np.ndarray, capacity: int) -> np.ndarray:
    """The bins a node passes to its parent: of its underfull ones the emptiest, at most as many as can be of use there."""
    order = np.argsort(fills, kind="stable")
    up = np.zeros(len(fills), bool)
    up[order[: FAN_IN + 1]] = True
    return up & (fills < NEARLY_FULL * capacity)


def _local(capacity: int):
    def run(key, items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["length", "row"], ascending=[False, True])
        bins, offsets, fills = best_fit(items["length"].tolist(), capacity)
        bins, fills = np.array(bins, np.int64), np.array(fills, np.int64)
        base = int(key[0]) << 32
        first = np.zeros(len(bins), bool)
        first[np.unique(bins, return_index=True)[1]] = True
        return pd.DataFrame({"row": items["row"].to_numpy(), "bin": base + bins, "offset": offsets, "fill": fills[bins], "up": _goes_up(fills, capacity)[bins] & first, "node": key[0]})

    return run


def _merge(capacity: int):
    def run(key, items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["fill", "bin"], ascending=[False, True])
        into, offsets, fills = best_fit(items["fill"].tolist(), capacity)
        up = _goes_up(np.array(fills, np.int64), capacity)
        out: list[dict] = []
        for name, members, shifts, place, offset in zip(items["bin"], items["bins"], items["shifts"], into, offsets, strict=True):
            if place == len(out):
                out.append({"node": key[0], "bin": name, "fill": fills[place], "bins": [], "shifts": [], "up": bool(up[place])})
            out[place]["bins"] += list(members)
            out[place]["shifts"] += [int(s) + offset for s in shifts]
        return pd.DataFrame(out, columns=["node", "bin", "fill", "bins", "shifts", "up"])

    return run


def pack(items: DataFrame, length: str = "length", capacity: int = CAPACITY, node_items: int = NODE_ITEMS) -> DataFrame:
    """``items`` with a ``sequence_id`` and an ``offset`` in it; sequences hold at most ``capacity`` and have no gaps."""
    rows = stored(items.drop("sequence_id", "offset", "__row").withColumn("__row", F.monotonically_increasing_id()), "pack-items")
    nodes = max(1, math.ceil(rows.count() / node_items))
    dealt = rows.select(F.col("__row").alias("row"), F.coalesce(F.col(length), F.lit(0)).cast("long").alias("length"), F.pmod(F.xxhash64("__row"), F.lit(nodes)).alias("node"))
    placed = stored(dealt.groupBy("node").applyInPandas(_local(capacity), "row long, bin long, offset long, fill long, up boolean, node long"), "pack-local")
    level = placed.where("up").select("node", "bin", "fill", F.array("bin").alias("bins"), F.array(F.lit(0).cast("long")).alias("shifts"))
    schema = "node long, bin long, fill long, bins array<long>, shifts array<long>, up boolean"
    final = []
    while nodes > 1:
        nodes = math.ceil(nodes / FAN_IN)
        merged = stored(level.withColumn("node", F.expr(f"node div {FAN_IN}")).groupBy("node").applyInPandas(_merge(capacity), schema), "pack-merge")
        final.append(merged.where("NOT up" if nodes > 1 else "true"))
        level = merged.where("up").drop("up")
    joined = placed.withColumn("sequence_id", F.col("bin"))
    if final:
        moved = final[0]
        for more in final[1:]:
            moved = moved.unionByName(more)
        moved = moved.select(F.col("bin").alias("sequence"), F.inline(F.arrays_zip("bins", "shifts"))).where("bins <> sequence")
        joined = placed.join(moved, placed["bin"] == moved["bins"], "left").select(
            "row", F.coalesce("sequence", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("shifts", F.lit(0))).alias("offset"))
    return rows.join(joined.select(F.col("row").alias("__row"), "sequence_id", "offset"), "__row").drop("__row")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids themselves, for pieces cut ``with_ids``: one row per sequence."""
    in_order = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(in_order, lambda x: x["ids"])).alias("ids"))
