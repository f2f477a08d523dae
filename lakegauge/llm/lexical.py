"""Ranked lexical search: a hybrid of term-at-a-time and document-at-a-time scoring.

A *shard* is the inverted index of some neighbouring documents (about ``SHARD_BYTES`` of text), held in one row. It has
the postings of the query terms only, and for each list its largest count and its shortest document, which bound what a
posting can add. An item is scored in a shard in two steps. Its short lists are summed term at a time into accumulators,
which from then on are one more iterator with a bound, its largest sum. The iterator and the long lists are then walked
document at a time, in windows of ``WINDOW`` documents: lists whose bounds together stay below the score to beat yield no
candidates; they are only probed, by binary search, for candidates of the others that can still reach that score.

The score to beat is the ``k``-th best so far in the shard, or the ``k``-th best in about ``FIRST_SHARDS`` shards
that are searched ahead: the best of a part of the documents never beat the best of all, so no result is lost.

Shards are scored where they are stored; only their best rows are shuffled. A word in all documents makes a long list in
each shard and no large group. The terms of the items are broadcast, about ``PASS_TERMS`` pairs of item and term at a
time (items are dealt by hash, an item's terms stay together); more items take more passes over the documents.

Defined results: null and empty texts hold no terms and are never found; a repeated document is found as often as it is
there; documents without an id come after those with one of the same score; rows of one item are one item with the
terms of all of them, null being an item as any other; items without terms and empty tables give no rows. Terms are
compared byte by byte. A text is cut into slices of ``SLICE`` bytes at blanks, so beside the text itself a task holds the
words of one slice and the distinct query terms of a shard. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakegauge.llm.common import stored

SHARD_BYTES = 8_000_000
SHARD_DOCS = 16_384
SLICE = 1_000_000
WINDOW = 1024
SHORT = 64  # lists with fewer than one in so many of a shard's documents are summed ahead
FIRST_SHARDS = 16
PASS_TERMS = 1_000_000
PART = 1_000_000_000

_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, slice by slice."""
    text = text.translate(_TERM_BYTES)
    begin = 0
    while begin < len(text):
        end = text.find(b" ", begin + SLICE) if begin + SLICE < len(text) else -1
        end = len(text) if end < 0 else end
        yield text[begin:end].split()
        begin = end


SHARD = (
    "docs array<long>, sizes array<long>, terms array<binary>, counts array<long>, most array<long>, shortest array<long>, "
    "places array<int>, times array<long>"
)


def _shard(ids: list, sizes: list[int], found: list[Counter]) -> pa.RecordBatch:
    """One row: documents in the order of their ids, and for each query term its documents there and its occurrences in them."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
    lists: dict[bytes, tuple[list[int], list[int]]] = {}
    for place, i in enumerate(order):
        for term, times in found[i].items():
            places, counts = lists.setdefault(term, ([], []))
            places.append(place)
            counts.append(times)
    terms = sorted(lists)
    lengths = np.array([sizes[i] for i in order], np.int64)
    columns = {
        "docs": [ids[i] for i in order],
        "sizes": lengths,
        "terms": terms,
        "counts": [len(lists[t][0]) for t in terms],
        "most": [max(lists[t][1]) for t in terms],
        "shortest": [int(lengths[lists[t][0]].min()) for t in terms],
        "places": [p for t in terms for p in lists[t][0]],
        "times": [c for t in terms for c in lists[t][1]],
    }
    kinds = {"terms": pa.binary(), "places": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array([v], pa.list_(kinds.get(k, pa.int64()))) for k, v in columns.items()], names=list(columns))


def index(documents: DataFrame, terms: set[bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per shard; only documents with a term are in it."""
    shared = documents.sparkSession.sparkContext.broadcast(frozenset(terms))

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        ids, sizes, found, held = [], [], [], 0
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for i, body in enumerate(batch.column(1)):
                body = body.as_py() or b""
                size, own = 0, Counter()
                for words in terms_of(body):
                    size += len(words)
                    times = Counter(words)
                    for term in times.keys() & wanted:
                        own[term] += times[term]
                if not size:
                    continue
                ids.append(keys[i])
                sizes.append(size)
                found.append(own)
                held += len(body)
                if held >= SHARD_BYTES or len(ids) >= SHARD_DOCS:
                    yield _shard(ids, sizes, found)
                    ids, sizes, found, held = [], [], [], 0
        if ids:
            yield _shard(ids, sizes, found)

    return documents.select(F.col(key).cast("long"), F.col(text).cast("binary")).mapInArrow(build, SHARD)


def items_of(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, term) of all items, each pair once."""

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for i, body in enumerate(batch.column(1)):
                for words in terms_of(body.as_py() or b""):
                    own = list(set(words))
                    yield pa.RecordBatch.from_arrays([pa.array([keys[i]] * len(own), pa.int64()), pa.array(own, pa.binary())], names=["item_id", "term"])

    return items.select(F.col(key).cast("long"), F.col(text).cast("binary")).mapInArrow(split, "item_id long, term binary").distinct()


@dataclass
class Scoring:
    """What all shards share: sizes of the whole collection, weights of the terms, items, and scores to beat by item."""

    documents: int
    words: int
    weights: dict[bytes, int]
    items: dict[int | None, list[bytes]]
    least: dict[int | None, int]

    def parts(self, times: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """What postings add for a weight of one."""
        m = 50 + 50 * sizes * self.documents // self.words
        return PART * times // (1000 * times + 20 * m)


class _List:
    """Documents in ascending order, what each adds, and the most that one can add."""

    def __init__(self, places: np.ndarray, adds: np.ndarray, bound: int):
        self.places, self.adds, self.bound = places, adds, bound

    def within(self, begin: int, end: int) -> slice:
        return slice(*np.searchsorted(self.places, (begin, end)))

    def of(self, places: np.ndarray) -> np.ndarray:
        """What the list adds to each of some documents."""
        at = np.minimum(np.searchsorted(self.places, places), len(self.places) - 1)
        return np.where(self.places[at] == places, self.adds[at], 0)


class Shard:
    def __init__(self, row: dict, scoring: Scoring):
        self.scoring, self.docs, self.sizes = scoring, row["docs"], row["sizes"]
        self.n = len(self.sizes)
        self.row = row
        self.slots = {t: i for i, t in enumerate(row["terms"])}
        self.ends = np.cumsum(row["counts"], dtype=np.int64)
        bounds = scoring.parts(row["most"], row["shortest"]) if len(self.ends) else np.zeros(0, np.int64)
        self.bounds = [int(b) * scoring.weights[t] for t, b in zip(row["terms"], bounds, strict=True)]
        self.read: dict[int, _List] = {}

    def list_of(self, slot: int) -> _List:
        """A term's list; items share it."""
        if slot not in self.read:
            own = slice(self.ends[slot] - self.row["counts"][slot], self.ends[slot])
            places = self.row["places"][own]
            adds = self.scoring.parts(self.row["times"][own], self.sizes[places]) * self.scoring.weights[self.row["terms"][slot]]
            self.read[slot] = _List(places, adds, self.bounds[slot])
        return self.read[slot]

    def best(self, item: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of an item's best documents here, best first, of those that reach the score to beat."""
        least = max(1, self.scoring.least.get(item, 1))
        slots = [self.slots[t] for t in self.scoring.items[item] if t in self.slots]
        if not slots or sum(self.bounds[s] for s in slots) < least:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        short = [s for s in slots if self.row["counts"][s] * SHORT < self.n]
        lists = [self.list_of(s) for s in slots if self.row["counts"][s] * SHORT >= self.n]
        if short:  # term at a time
            own = [self.list_of(s) for s in short]
            places, back = np.unique(np.concatenate([x.places for x in own]), return_inverse=True)
            sums = np.zeros(len(places), np.int64)
            np.add.at(sums, back, np.concatenate([x.adds for x in own]))
            lists.append(_List(places, sums, int(sums.max())))
        lists.sort(key=lambda x: x.bound)
        reach = np.cumsum([x.bound for x in lists])  # what a list and all smaller ones can add together
        top, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for begin in range(0, self.n, WINDOW):  # document at a time
            weak = int(np.searchsorted(reach, least))  # lists that cannot yield a result alone
            if weak == len(lists):
                break
            sums, seen = np.zeros(WINDOW, np.int64), np.zeros(WINDOW, bool)
            for x in lists[weak:]:
                own = x.within(begin, begin + WINDOW)
                at = x.places[own] - begin
                sums[at] += x.adds[own]
                seen[at] = True
            for j in range(weak - 1, -1, -1):
                seen &= sums + reach[j] >= least
                at = np.flatnonzero(seen)
                if not len(at):
                    break
                sums[at] += lists[j].of(at + begin)
            at = np.flatnonzero(seen & (sums >= least))
            if not len(at):
                continue
            top, scores = np.concatenate([top, at + begin]), np.concatenate([scores, sums[at]])
            order = np.lexsort((top, -scores))[:k]
            top, scores = top[order], scores[order]
            if len(top) == k:
                least = max(least, int(scores[-1]))
        return top, scores


def _shards(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        row = {name: batch.column(j)[i].values for j, name in enumerate(batch.schema.names)}
        yield {k: v.to_pylist() if k in ("terms", "docs") else v.to_numpy(zero_copy_only=False) for k, v in row.items()}


def best_rows(shards: DataFrame, scoring: Scoring, k: int) -> DataFrame:
    """item_id, doc_id and score of each item's best documents in each shard."""
    shared = shards.sparkSession.sparkContext.broadcast(scoring)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _shards(batch):
                shard, out = Shard(row, shared.value), ([], [], [])
                for item in shared.value.items:
                    places, scores = shard.best(item, k)
                    out[0].extend([item] * len(places))
                    out[1].extend(shard.docs[p] for p in places)
                    out[2].extend(scores.tolist())
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["item_id", "doc_id", "score"])

    return shards.mapInArrow(score, "item_id long, doc_id long, score long")


def ranked(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def search(documents: DataFrame, items: DataFrame, k: int = 50, pass_terms: int = PASS_TERMS, first_shards: int = FIRST_SHARDS) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of each item."""
    spark = documents.sparkSession
    pairs = stored(items_of(items), "search-items")
    passes = max(1, math.ceil(pairs.count() / pass_terms))
    found = [_one_pass(documents, pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == p), k, first_shards) for p in range(passes)]
    found = [x for x in found if x is not None] or [spark.createDataFrame([], "item_id long, doc_id long, score long")]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return ranked(every, k)


def _one_pass(documents: DataFrame, pairs: DataFrame, k: int, first_shards: int) -> DataFrame | None:
    items: dict[int | None, list[bytes]] = {}
    for row in pairs.collect():
        items.setdefault(row["item_id"], []).append(bytes(row["term"]))
    if not items:
        return None
    shards = stored(index(documents, {t for own in items.values() for t in own}), "search-shards")
    total = F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))
    n, words, n_shards = shards.agg(F.sum(F.size("docs")), total, F.count("*")).first()
    if not n:
        return None
    df = shards.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(F.sum("x.counts").alias("df")).collect()
    weights = {bytes(r["terms"]): math.floor(1000 * math.log((2 * n + 2) / (2 * r["df"] + 1))) for r in df}
    scoring = Scoring(n, words, weights, items, {})
    if first_shards:
        some = F.pmod(F.xxhash64("sizes", "docs"), F.lit(max(1, n_shards // first_shards))) == 0
        ahead = best_rows(shards.where(some), scoring, k)
        last = ranked(ahead, k).where(F.col("rank") == k).select("item_id", "score").collect()
        scoring.least = {r["item_id"]: r["score"] for r in last}
    return best_rows(shards, scoring, k)
