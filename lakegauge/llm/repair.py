"""Token-id files compressed by a Re-Pair grammar per shard, with random access.

Documents are sorted by id into shards of about ``SHARD_IDS`` ids. In every shard
frequent pairs of neighbouring ids are replaced by new symbols, again and again:
a pair is frequent if its uses outweigh its rule (``LEAST_USES``), a round replaces
up to ``RULES_A_ROUND`` kinds of pairs, and the last round is the first that shortens
the shard by less than ``LEAST_SAVED``. Pairs never cross a document. A shard is one row of a Parquet table:

    part, seq       place of the shard: its partition in id order, its number there
    doc_ids         ids of its documents, in order (null ids first)
    doc_symbols     first symbol of every document, and the number of all symbols
    base            ids below are tokens; ``base + k`` stands for rule k
    rules           two symbols per rule, little-endian 32 bit
    expansions      tokens that each rule stands for, little-endian 32 bit
    symbols, width  the grammar's start sequence, ``width`` bytes each

Expansion lengths make it possible to find and decode any stretch of tokens
without decoding what lies before it. Parquet through Spark's writer makes the
files whole or absent when executors are lost, on any store Spark can write.

Defined results: null texts are empty and have the end id only; repeated ids keep
all their rows, ordered by a hash of the text; no documents give no shards.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakegauge.llm.common import text_batches
from lakegauge.llm.wordbpe import encoder

SHARD_IDS = 1_000_000
PART_BYTES = 32 << 20
LEAST_SAVED = 0.02
RULES_A_ROUND = 2048
LEAST_USES = 8
_NO = np.int64(1) << 62
_SLOT_BITS = 18


def grammar(symbols: np.ndarray, last: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start sequence, which of its symbols end a document, rules and their expansion lengths."""
    symbols, last = symbols.astype(np.int64), last.copy()
    rules, sizes = np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
    before = math.inf
    while before - len(symbols) >= LEAST_SAVED * len(symbols):
        before = len(symbols)
        pairs = symbols[:-1] << 31
        pairs |= symbols[1:]
        pairs[last[:-1]] = _NO
        ordered = np.sort(pairs)
        begins = np.append(0, np.flatnonzero(ordered[1:] != ordered[:-1]) + 1)[: len(ordered)]
        uses, kinds = np.diff(np.append(begins, len(ordered))), ordered[begins]
        frequent = np.flatnonzero((uses >= LEAST_USES) & (kinds != _NO))
        # ties by a hash: along a copied passage every third pair or so comes before both its neighbours, in whatever order its ids are
        frequent = frequent[np.lexsort((_mixed(kinds[frequent]), -uses[frequent]))[:RULES_A_ROUND]]
        if not len(frequent):
            break
        keys, none = kinds[frequent], len(frequent)  # in the order of their ranks: 0 is used most
        table = np.full(1 << _SLOT_BITS, none, np.int32)
        table[_slots(keys)[::-1]] = np.arange(none, dtype=np.int32)[::-1]  # of two keys for a slot the one used less waits for another round
        rank = table.take(_slots(pairs))
        hits = np.flatnonzero(rank < none)
        rank[hits[keys[rank[hits]] != pairs[hits]]] = none
        # of overlapping pairs the more frequent one is replaced, of equal ones the first
        taken = rank < none
        taken[1:] &= rank[1:] < rank[:-1]
        taken[:-1] &= rank[:-1] <= rank[1:]
        at = np.flatnonzero(taken)
        used = np.bincount(rank[at], minlength=none)
        number = base + len(rules) + np.cumsum(used > 0) - 1
        made = keys[used > 0]
        new = np.stack([made >> 31, made & (1 << 31) - 1], axis=1)
        rules, sizes = np.concatenate([rules, new]), np.append(sizes, _sizes(new, sizes, base))
        symbols[at] = number[rank[at]]
        last[at] = last[at + 1]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, last = symbols[keep], last[keep]
    return symbols, last, rules, sizes


def _mixed(pairs: np.ndarray) -> np.ndarray:
    return pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _slots(pairs: np.ndarray) -> np.ndarray:
    mixed = _mixed(pairs)
    mixed >>= np.uint64(64 - _SLOT_BITS)
    return mixed.view(np.int64)  # numpy would make a copy of an unsigned index


def _sizes(symbols: np.ndarray, sizes: np.ndarray, base: int) -> np.ndarray:
    """Tokens behind symbols, or behind rows of symbols."""
    known = np.append(sizes, 1)
    each = known[np.where(symbols >= base, symbols - base, len(sizes))]
    return each.sum(axis=1) if each.ndim == 2 else each


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The tokens that symbols stand for."""
    while len(symbols) and symbols.max() >= base:
        whole = symbols >= base
        count = 1 + whole
        end = np.cumsum(count)
        out = np.empty(int(end[-1]), np.int64)
        out[end - 1] = np.where(whole, rules[np.where(whole, symbols - base, 0), 1] if len(rules) else 0, symbols)
        out[end[whole] - 2] = rules[symbols[whole] - base, 0]
        symbols = out
    return symbols


def expand_all(symbols: np.ndarray, rules: np.ndarray, sizes: np.ndarray, base: int) -> np.ndarray:
    """As ``expand``, for many symbols: every rule is expanded once, and copied to wherever it is used."""
    spelled = np.concatenate([np.arange(base), expand(np.arange(base, base + len(rules)), rules, base)])
    begins = np.concatenate([np.arange(base), base + np.cumsum(sizes) - sizes])[symbols]
    counts = _sizes(symbols, sizes, base)
    return spelled[np.repeat(begins - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())]


def window(symbols: np.ndarray, rules: np.ndarray, sizes: np.ndarray, base: int, start: int, count: int) -> np.ndarray:
    """``count`` tokens from token ``start`` on; only the symbols that cover them are expanded."""
    ends = np.cumsum(_sizes(symbols, sizes, base))
    first, after = np.searchsorted(ends, start, "right"), np.searchsorted(ends, start + count, "left") + 1
    skipped = start - (int(ends[first - 1]) if first else 0)
    return expand(symbols[first:after], rules, base)[skipped : skipped + count]


def _schema(kind: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("seq", T.IntegerType()), T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("doc_symbols", T.ArrayType(T.LongType())),
        T.StructField("n_tokens", T.LongType()), T.StructField("base", T.IntegerType()), T.StructField("rules", T.BinaryType()), T.StructField("expansions", T.BinaryType()),
        T.StructField("symbols", T.BinaryType()), T.StructField("width", T.IntegerType()),
    ])


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Encode every text, append ``end_id`` and write the shards in ascending order of ids."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = _schema(rows.schema["doc_id"].dataType)
    parts = max(1, math.ceil((rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / PART_BYTES))

    def run(batches):
        part, seq, ids, flat, lengths = TaskContext.get().partitionId(), 0, [], [], []

        def shard() -> pa.RecordBatch:
            bpe = encoder(vocabulary)
            base = len(bpe.tokens) + 1
            tokens, counts = np.concatenate(flat), np.concatenate(lengths)
            last = np.zeros(len(tokens), bool)
            last[np.cumsum(counts) - 1] = True
            symbols, last, rules, sizes = grammar(tokens, last, base)
            width = 2 if base + len(rules) < 1 << 16 else 4
            row = {"part": part, "seq": seq, "doc_ids": pa.concat_arrays(ids).to_pylist(), "doc_symbols": [0, *(np.flatnonzero(last) + 1).tolist()], "n_tokens": len(tokens), "base": base,
                   "rules": rules.astype("<u4").tobytes(), "expansions": sizes.astype("<u4").tobytes(), "symbols": symbols.astype(f"<u{width}").tobytes(), "width": width}
            return pa.RecordBatch.from_pylist([row], to_arrow_schema(schema))

        size = 0
        for batch, texts in text_batches(batches):
            own, counts = encoder(vocabulary).encode(texts)
            ends = np.cumsum(counts)
            ids.append(batch.column(0))
            flat.append(np.insert(own, ends, end_id))
            lengths.append(counts + 1)
            size += len(flat[-1])
            if size >= shard_ids:
                yield shard()
                seq, size, ids, flat, lengths = seq + 1, 0, [], [], []
        if size:
            yield shard()

    in_order = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    in_order.mapInArrow(run, schema).write.parquet(path)


def _numbers(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{width}").astype(np.int64)


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of the files at ``path``: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids.

    ``start`` counts the ids of all documents before. It is summed up in two steps, in
    every part and over the parts, from the shards' sizes alone.
    """
    shards = spark.read.parquet(path)
    kind = shards.schema["doc_ids"].dataType.elementType
    fields = [("part", T.IntegerType()), ("seq", T.IntegerType()), ("doc_id", kind), ("local", T.LongType()), ("n_tokens", T.LongType()), ("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(("ids", T.ArrayType(T.IntegerType())))

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                rules, sizes, symbols = _numbers(row["rules"], 4).reshape(-1, 2), _numbers(row["expansions"], 4), _numbers(row["symbols"], row["width"])
                ends = np.append(0, np.cumsum(_sizes(symbols, sizes, row["base"])))[row["doc_symbols"]]
                tokens = expand_all(symbols, rules, sizes, row["base"]).astype("<u4")
                starts, counts = ends[:-1], np.diff(ends)
                crc = [zlib.crc32(tokens[a:b].tobytes()) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                n = len(crc)
                cells = [pa.array([row["part"]] * n, pa.int32()), pa.array([row["seq"]] * n, pa.int32()), batch.column(batch.schema.get_field_index("doc_ids")).slice(k, 1).flatten(), pa.array(starts), pa.array(counts), pa.array(crc, pa.int64())]
                if with_ids:
                    cells.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cells, names=[f[0] for f in fields])

    sizes = shards.select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    before = sizes.select("part", "seq", (F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")).alias("shard_start")).join(parts, "part")
    docs = shards.select("part", "seq", "doc_ids", "doc_symbols", "base", "rules", "expansions", "symbols", "width").mapInArrow(run, T.StructType([T.StructField(*f) for f in fields]))
    return docs.join(before, ["part", "seq"]).select("doc_id", (F.col("part_start") + F.col("shard_start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def lookup(spark: SparkSession, path: str, doc_id, start: int, count: int) -> list[int]:
    """``count`` ids of one document from its ``start``-th on, decoded from its shard's grammar without the rest."""
    shard = spark.read.parquet(path).where(F.array_contains("doc_ids", doc_id)).first()
    if shard is None:
        return []
    k = shard["doc_ids"].index(doc_id)
    symbols = _numbers(shard["symbols"], shard["width"])[shard["doc_symbols"][k] : shard["doc_symbols"][k + 1]]
    return window(symbols, _numbers(shard["rules"], 4).reshape(-1, 2), _numbers(shard["expansions"], 4), shard["base"], start, count).tolist()
