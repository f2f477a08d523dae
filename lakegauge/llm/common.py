"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every (start, count), one behind the other."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(total, dtype=np.int64)


def give_back() -> None:
    """Return memory that Arrow and the C library hold for later to the system: a Python worker outlives its tasks, and an executor pays for all of its workers."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def text_batches(batches: Iterable[pa.RecordBatch], column: str = "text", chars: int = 2_000_000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of Arrow batches of about ``chars`` characters with their texts (null: empty); a longer text is a slice of its own.

    Only one slice's texts are Python strings at a time, and memory no longer used is given back after each batch.
    """
    for batch in batches:
        held = batch.column(batch.schema.get_field_index(column))

        def part(begin: int, end: int, batch=batch, held=held) -> tuple[pa.RecordBatch, list[str]]:
            return batch.slice(begin, end - begin), ["" if t is None else t for t in held.slice(begin, end - begin).to_pylist()]

        begin = size = 0
        sizes = np.zeros(len(held), np.int64) if pa.types.is_null(held.type) else pc.fill_null(pc.utf8_length(held), 0).to_numpy(zero_copy_only=False)
        for i, length in enumerate(sizes.tolist()):
            if size and size + length > chars:
                yield part(begin, i)
                begin, size = i, 0
            size += length
        if begin < len(held):
            yield part(begin, len(held))
        give_back()


_BLANK_BYTES = np.zeros(256, bool)
_BLANK_BYTES[[9, 10, 11, 12, 13, 32]] = True
_SALT = np.random.default_rng(3).integers(1, 2**63, 256, np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


LONG_WORD = 32


def digest(data: bytes, key: bytes = b"") -> int:
    """64 bits of a cryptographic hash."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=8, key=key).digest(), "little")


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (runs without ``[\\t-\\r ]``) of all texts, and the number of words of each text."""
    encoded = [t.encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"\n".join(encoded) + b"\n", np.uint8)
    ends = np.cumsum([len(e) + 1 for e in encoded], dtype=np.int64)
    blank = _BLANK_BYTES[data]
    body = np.flatnonzero(~blank)
    if not len(body):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    first = np.flatnonzero(np.append(True, blank[:-1])[body])
    lengths = np.diff(np.append(first, len(body)))
    place = np.arange(len(body)) - np.repeat(first, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64))
    words = mixed(np.add.reduceat(_SALT[data[body]] * powers[place], first))
    at = body[first]
    for i in np.flatnonzero(lengths > LONG_WORD).tolist():  # sums of this kind can be led to the same value by patterns in long words
        words[i] = digest(data[at[i] : at[i] + lengths[i]].tobytes())
    return words, np.bincount(np.searchsorted(ends, body[first], "right"), minlength=len(texts))


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): the smallest node it is connected with.

    In every round a vertex joins the first, in the order of a hash, of itself and its neighbours, and then
    what that one joined. Edges are drawn between what was joined, so those inside a component soon are gone;
    the hash breaks up long paths whatever their ids, and the rounds grow with the logarithm of the nodes.
    """
    left = stored(_drawn(edges.select("a", "b")), f"{purpose}-edges")
    roots = None
    while True:
        ends = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = ends.groupBy("a").agg(F.min(_place("b")).alias("near")).select(F.col("a").alias("vertex"), F.least("near", _place("a"))["name"].alias("next"))
        joined = stored(first.join(first.select(F.col("vertex").alias("next"), F.col("next").alias("to")), "next").select("vertex", "to"), f"{purpose}-joined")
        if roots is None:
            roots = joined.select(F.col("vertex").alias("node"), F.col("to").alias("root"))
        else:
            roots = stored(roots.join(joined.withColumnRenamed("vertex", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root")), f"{purpose}-roots")
        for end in ("a", "b"):
            left = left.join(joined.select(F.col("vertex").alias(end), F.col("to").alias(f"to_{end}")), end)
        left = stored(_drawn(left.select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))), f"{purpose}-edges")
        if not left.limit(1).count():
            return roots.join(roots.groupBy("root").agg(F.min("node").alias("least")), "root").select("node", F.col("least").alias("root"))


def _drawn(edges: DataFrame) -> DataFrame:
    """Each edge once, whichever way it was given."""
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _place(vertex: str):
    return F.struct(F.xxhash64(vertex).alias("hash"), F.col(vertex).alias("name"))
