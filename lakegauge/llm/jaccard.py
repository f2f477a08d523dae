"""Similarity join on word n-grams by MinHash banding.

Every text gets ``PERMUTATIONS`` minimum hashes of its n-grams. They are cut into
bands; the rows of a band are as many as still give the target recall at the
threshold. Identical texts are one node. Nodes that share a band are candidates;
candidates are joined into components, and inside a component all pairs are
verified on their full sets of n-grams. A large component is dealt out as pairs
of blocks of ``BLOCK`` nodes, so no task ever holds more than two blocks, and
tasks hand on counts and spanning edges instead of pairs.

Defined results: words are runs without ASCII white space; a text with fewer words
than an n-gram has one n-gram of all its words; texts without words (null, empty)
are alike only as copies; repeated rows are copies of each other; a null id never
names a class unless all ids of the class are null.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.llm.common import components, mixed, stored, text_batches, word_hashes

WORDS = 5
THRESHOLD = 0.8
PERMUTATIONS = 128
RECALL = 0.9999
BLOCK = 256
_STEPS = np.random.default_rng(5).integers(1, 2**63, 64, np.uint64) | np.uint64(1)


def banding(threshold: float = THRESHOLD, permutations: int = PERMUTATIONS, recall: float = RECALL) -> tuple[int, int]:
    """Bands and rows: the most rows with which a pair at the threshold shares a band with probability ``recall``."""
    fit = [(permutations // rows, rows) for rows in range(1, permutations + 1) if 1 - (1 - threshold**rows) ** (permutations // rows) >= recall]
    return max(fit, key=lambda x: x[1], default=(permutations, 1))


def ngrams(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all texts, with repetitions, and their number per text."""
    hashes, counts = word_hashes(texts)
    grams = np.maximum(counts - words + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(texts)), grams)
    begin = np.cumsum(counts) - counts
    at = begin[text] + np.arange(len(text)) - (np.cumsum(grams) - grams)[text]
    padded = np.append(hashes, np.zeros(words, np.uint64))
    out = np.zeros(len(at), np.uint64)
    for k in range(words):
        out += np.where(k < counts[text], padded[at + k], np.uint64(0)) * _STEPS[k]
    return mixed(out), grams


def _bands(texts: list[str], bands: int, rows: int, words: int) -> list[np.ndarray | None]:
    grams, counts = ngrams(texts, words)
    short = (grams >> np.uint64(32)).astype(np.uint32)
    full = np.flatnonzero(counts)
    starts = (np.cumsum(counts) - counts)[full]
    turn = np.random.default_rng(9).integers(0, 2**32, (bands * rows, 2), np.uint32) | np.uint32(1)
    keys = np.zeros((len(full), bands), np.uint64)
    for k, (times, plus) in enumerate(turn):
        if len(full):
            least = np.minimum.reduceat(short * times + plus, starts)
            keys[:, k // rows] += least.astype(np.uint64) * _STEPS[k % rows + 8]
    keys = mixed(keys + np.arange(1, bands + 1, dtype=np.uint64) * _STEPS[40]).view(np.int64)
    out: list[np.ndarray | None] = [None] * len(texts)
    for row, place in enumerate(full.tolist()):
        out[place] = keys[row]
    return out


def _text_key(text: str):
    return F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, bands: int | None = None, rows: int | None = None) -> DataFrame:
    """doc_id, text_key and band hashes (null without n-grams) of every row."""
    if bands is None or rows is None:
        bands, rows = banding()

    def run(batches):
        for part, texts in text_batches(batches, chars=400_000):
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(_bands(texts, bands, rows, words), pa.list_(pa.int64()))], names=["doc_id", "text_key", "bands"])

    own = docs.select(F.col(key).alias("doc_id"), _text_key(text).alias("text_key"), F.col(text).alias("text"))
    return own.mapInArrow(run, f"doc_id {docs.schema[key].dataType.simpleString()}, text_key string, bands array<long>")


def _sets(words: int):
    def run(batches):
        for part, texts in text_batches(batches, chars=400_000):
            grams, counts = ngrams(texts, words)
            ends = np.cumsum(counts)
            sets = [np.unique(grams[e - c : e]).tobytes() for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
            rest = part.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(sets, pa.binary())], names=[*rest.schema.names, "grams"])

    return run


def shared_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of each set at ``left`` with each at ``right``; common elements are multiplied in slices."""
    sizes = np.array([len(s) for s in sets], np.int64)
    row = np.repeat(np.arange(len(sets)), sizes)
    _, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = uses[column] > 1
    row, column = row[keep], (np.cumsum(uses > 1) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    width = 4096
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [at, at + width])
        part = np.zeros((len(sets), width), np.float32)
        part[row[a:b], column[a:b] - at] = 1
        out += part[left] @ part[right].T
    return out


def _verify(threshold: float):
    def run(key, nodes: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.drop_duplicates("node").sort_values("node")
        sets = [np.frombuffer(g, np.uint64) for g in nodes["grams"]]
        name, block, copies = (nodes[c].to_numpy() for c in ("node", "block", "copies"))
        left, right = np.flatnonzero(block == key[1]), np.flatnonzero(block == key[2])
        if not len(left) or not len(right):
            return pd.DataFrame({"node": [], "links": [], "parent": []})
        sizes = np.array([len(s) for s in sets], np.float64)
        both = shared_counts(sets, left, right).astype(np.float64)
        linked = both >= threshold * (sizes[left][:, None] + sizes[right][None, :] - both) - 1e-9
        linked &= left[:, None] < right[None, :] if key[1] == key[2] else True
        a, b = np.nonzero(linked)
        a, b = left[a], right[b]
        links = np.bincount(a, copies[b], len(name)) + np.bincount(b, copies[a], len(name))
        parent = np.arange(len(name))
        while True:  # the smallest neighbour's parent, until nothing changes
            before = parent.copy()
            np.minimum.at(parent, a, before[b])
            np.minimum.at(parent, b, before[a])
            parent = parent[parent]
            if (parent == before).all():
                break
        used = links > 0
        return pd.DataFrame({"node": name[used], "links": links[used].astype(np.int64), "parent": name[parent[used]]})

    return run


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_key, class_id, n_links) of all documents, and the one (doc_id, text_key) of each class that stays.

    Documents are linked if the Jaccard similarity of their n-grams reaches the threshold; a class holds
    what links connect, is named by its smallest id, and keeps that document.
    """
    bands, rows = banding(threshold, PERMUTATIONS, recall)
    marked = stored(signatures(docs, key, text, words, bands, rows), "jaccard-signatures")
    texts = marked.groupBy("text_key").agg(F.min("doc_id").alias("doc"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
    nodes = stored(texts.withColumn("node", F.monotonically_increasing_id()), "jaccard-nodes")
    banded = nodes.select("node", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    candidates = banded.join(hubs, "band").where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    groups = components(candidates, "jaccard-candidates")
    sizes = groups.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = groups.join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    members = stored(nodes.select("text_key", "doc", "copies", "node").join(dealt, "node"), "jaccard-members")
    own = docs.select(F.col(key).alias("doc_id"), _text_key(text).alias("text_key"), F.col(text).alias("text"))
    fetched = own.join(members, "text_key").where(F.col("doc_id").eqNullSafe(F.col("doc"))).select("root", "node", "copies", "block", "blocks", "text")
    sets = fetched.mapInArrow(_sets(words), "root long, node long, copies long, block long, blocks long, grams binary")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    pairs = sets.withColumn("other", other).select("root", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "node", "copies", "block", "grams", "blocks")
    verified = stored(pairs.groupBy("root", "first", "second").applyInPandas(_verify(threshold), "node long, links long, parent long"), "jaccard-verified")
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    # a component of several blocks is connected over them
    whole = components(verified.select(F.col("parent").alias("a"), F.col("node").alias("b")), "jaccard-classes")
    named = nodes.join(links.select("node", "links"), "node", "left").join(whole, "node", "left").select("text_key", "doc", "copies", "node", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"))
    named = stored(named, "jaccard-named")
    ids = named.groupBy("root").agg(F.min("doc").alias("class_id"), F.min_by("node", F.struct(F.col("doc").isNull(), "doc", "node")).alias("kept"))
    told = named.join(ids, "root")
    every = marked.select("doc_id", "text_key").join(told.select("text_key", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links")), "text_key")
    return every.select("doc_id", "text_key", "class_id", "n_links"), told.where("node = kept").select(F.col("doc").alias("doc_id"), "text_key")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each class: that with the smallest id; rows repeated in full stay once."""
    columns = docs.columns
    _, kept = classes(docs, key, text, **options)
    chosen = kept.select(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key"))
    rows = docs.withColumn("__text_key", _text_key(text))
    same = (rows["__text_key"] == chosen["__key"]) & rows[key].eqNullSafe(chosen["__doc"])
    return rows.join(chosen, same).dropDuplicates(["__text_key", key]).select(*columns)
