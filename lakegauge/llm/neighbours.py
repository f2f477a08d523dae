"""Approximate nearest neighbours by learned partitions, for the largest inner product.

A neighbour graph over a bounded sample (``SAMPLE`` vectors, the first by a hash)
is cut into ``PARTS`` parts of equal size by repeated spectral bisection. A small
classifier learns from it which parts a vector and its neighbours are in. Every
row is indexed in its most probable part; a query goes to the several most
probable ones, whose rows are reranked exactly. How many is measured: of
``TRIALS`` sampled vectors that the classifier has not seen (a quarter of a small
sample; all parts are searched if that is none) the true neighbours among all rows are found by blocked
products, and as many parts are searched as reach the recall ``RECALL`` on them.

Vectors are scaled by the longest one and given a last component that makes them
unit vectors, so that a larger inner product means a smaller angle.

Hot content. Of identical vectors only the ``k + 1`` smallest ids can be among
anybody's ``k`` nearest, so no more are indexed; repeats of an id with its vector
are one row there, and identical queries are searched once, but for queries whose
id has several vectors: these leave out their own id inside the search. Parts are searched in blocks of ``BLOCK`` rows and ``QUERIES`` queries.

Defined results: vectors that are null, zero, hold null or non-finite components,
or are not of the most frequent length (of equally frequent ones the longest)
take no part; null ids take none either; a repeated id keeps each of its vectors,
and rows with the query's id are never its candidates; ties go to the smaller id;
no vectors give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakegauge.llm.common import stored

SAMPLE = 4096
GRAPH_NEIGHBOURS = 16
PARTS = 32
HIDDEN = 128
EPOCHS = 40
TRIALS = 200
RECALL = 0.96
BLOCK = 8192
QUERIES = 2048


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, v (doubles) and digest of the vectors that take part."""
    v = F.col(vector).cast("array<double>")
    fine = F.col(key).isNotNull() & F.col(vector).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.coalesce(fine, F.lit(False))).select(F.col(key).cast("long").alias("vec_id"), F.transform(v, lambda x: x + 0.0).alias("v"))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (sizes["n"] if sizes else 0)).withColumn("digest", F.md5(F.concat_ws(",", F.col("v").cast("array<string>"))))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass
class Router:
    """The classifier: one hidden layer; ``longest`` scales the vectors."""

    longest: float
    layers: list[np.ndarray]
    probes: int = PARTS

    def unit(self, v: np.ndarray, query: bool) -> np.ndarray:
        if query:
            return np.hstack([v / np.linalg.norm(v, axis=1, keepdims=True), np.zeros((len(v), 1))])
        v = v / self.longest
        return np.hstack([v, np.sqrt(np.maximum(0, 1 - (v * v).sum(axis=1, keepdims=True)))])

    def odds(self, v: np.ndarray, query: bool) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum(self.unit(v, query) @ w1 + b1, 0) @ w2 + b2

    def part(self, v: np.ndarray) -> np.ndarray:
        return self.odds(v, False).argmax(axis=1)

    def parts(self, v: np.ndarray) -> np.ndarray:
        """Parts in the order of their probability for each query."""
        return np.argsort(-self.odds(v, True), axis=1, kind="stable")


def _halves(graph: np.ndarray, members: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Two equal parts of a graph's members, cut at the median of the second eigenvector."""
    own = graph[np.ix_(members, members)]
    own += np.float32(1e-3)
    root = np.sqrt(own.sum(axis=1))
    own /= root[:, None]
    own /= root[None, :]
    own[np.arange(len(members)), np.arange(len(members))] += 1
    own = own.astype(np.float64)
    x = rng.standard_normal(len(members))
    first = root / np.linalg.norm(root)
    for _ in range(60):
        x -= first * (first @ x)
        x = own @ (x / np.linalg.norm(x))
    order = members[np.argsort(x / root, kind="stable")]
    return order[: len(order) // 2], order[len(order) // 2 :]


def balanced_parts(unit: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Part of every sampled vector, and its neighbours in the graph."""
    near = min(GRAPH_NEIGHBOURS, len(unit) - 1)
    neighbours = np.zeros((len(unit), near), np.int64)
    for at in range(0, len(unit) if near else 0, 256):
        far = -(unit[at : at + 256] @ unit.T).astype(np.float32)
        far[np.arange(len(far)), np.arange(at, at + len(far))] = np.inf
        neighbours[at : at + 256] = np.argpartition(far, near - 1, axis=1)[:, :near]
    graph = np.zeros((len(unit), len(unit)), np.float32)
    graph[np.arange(len(unit))[:, None], neighbours] = 1
    graph[neighbours, np.arange(len(unit))[:, None]] = 1
    rng, groups = np.random.default_rng(17), [np.arange(len(unit))]
    while len(groups) < parts:
        groups = [half for members in groups for half in (_halves(graph, members, rng) if len(members) > 1 else (members, members[:0]))]
    part = np.zeros(len(unit), np.int64)
    for k, members in enumerate(groups):
        part[members] = k
    return part, neighbours


def _classifier(inputs: np.ndarray, targets: np.ndarray) -> list[np.ndarray]:
    """Softmax classifier with one hidden layer, by gradient steps with momentum on both moments."""
    rng = np.random.default_rng(19)
    layers = [rng.standard_normal((inputs.shape[1], HIDDEN)) * np.sqrt(2 / inputs.shape[1]), np.zeros(HIDDEN), rng.standard_normal((HIDDEN, targets.shape[1])) * np.sqrt(1 / HIDDEN), np.zeros(targets.shape[1])]
    first, second = [np.zeros_like(x) for x in layers], [np.zeros_like(x) for x in layers]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(inputs))
        for at in range(0, len(order), 256):
            x, y = inputs[order[at : at + 256]], targets[order[at : at + 256]]
            hidden = np.maximum(x @ layers[0] + layers[1], 0)
            out = hidden @ layers[2] + layers[3]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            error = (out / out.sum(axis=1, keepdims=True) - y) / len(x)
            back = (error @ layers[2].T) * (hidden > 0)
            step += 1
            for k, g in enumerate((x.T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0))):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                layers[k] -= 0.004 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return layers


def best(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the ids and scores of its ``k`` best rows, without rows of its own id (``own``; -1 without one).

    Products pick the candidates; their scores are summed once more in a fixed order, so equal vectors tie exactly.
    """
    out = []
    size = np.linalg.norm(rows, axis=1)
    for at in range(0, len(queries), 256):
        q = queries[at : at + 256]
        products = q @ rows.T
        for i, line in enumerate(products):
            line[ids == own[at + i]] = -np.inf
            if len(line) > k:
                least = np.partition(line, len(line) - k - 1)[len(line) - k - 1]
                chosen = np.flatnonzero(line >= least - 1e-9 * np.linalg.norm(q[i]) * size.max())
            else:
                chosen = np.arange(len(line))
            chosen = chosen[ids[chosen] != own[at + i]]
            scores = (rows[chosen] * q[i]).sum(axis=1)
            order = np.lexsort((ids[chosen], -scores))[:k]
            out.append((ids[chosen][order], scores[order]))
    return out


def fit(rows: DataFrame, k: int, parts: int = PARTS, sample: int = SAMPLE, recall: float = RECALL) -> Router | None:
    """A router for usable rows (stored, as they are read several times); None without any."""
    longest = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()[0]
    if longest is None:
        return None
    drawn = rows.groupBy("digest").agg(F.min("vec_id").alias("vec_id"), F.first("v").alias("v")).orderBy(F.xxhash64("digest"), "digest").limit(sample + TRIALS).collect()
    vectors, ids = np.array([r["v"] for r in drawn]), np.array([r["vec_id"] for r in drawn], np.int64)
    router = Router(float(np.sqrt(longest)), [])
    held, router.probes = min(TRIALS, len(vectors) // 4), parts
    unit = router.unit(vectors[held:], False)
    part, neighbours = balanced_parts(unit, parts)
    targets = np.eye(parts)[part]
    if neighbours.shape[1]:
        targets = 0.5 * targets + 0.5 * targets[neighbours].mean(axis=1)
    router.layers = _classifier(unit, targets)
    if not held:
        return router
    trial, own = vectors[:held], ids[:held]
    shared = rows.sparkSession.sparkContext.broadcast((trial, own, router))

    def exact(batches):
        trial, own, router = shared.value
        for batch in batches:
            v, n = _matrix(batch.column(1)), batch.column(0).to_numpy()
            for at in range(0, len(v), BLOCK):
                place = router.part(v[at : at + BLOCK])
                number = np.arange(at, min(at + BLOCK, len(v)))
                found = best(trial, np.full(len(trial), -1), v[at : at + BLOCK], number, k + 1)
                for q, (rows_of, scores) in enumerate(found):
                    keep = n[rows_of] != own[q]
                    rows_of, scores = rows_of[keep], scores[keep]
                    if len(rows_of):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows_of), q), pa.int32()), pa.array(n[rows_of]), pa.array(scores), pa.array(place[rows_of - at], pa.int32())], names=["q", "vec_id", "score", "part"])

    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    truth = rows.select("vec_id", "v").mapInArrow(exact, "q int, vec_id long, score double, part int").withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).select("q", "part").collect()
    rank = np.argsort(router.parts(trial), axis=1)  # the place of each part in a query's order
    places = np.sort([rank[r["q"], r["part"]] for r in truth])
    router.probes = min(parts, 1 + int(places[int(np.ceil(recall * len(places))) - 1])) if len(places) else parts
    return router


def _near(k: int):
    schema = pa.schema([("digest", pa.string()), ("own", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(key, queries, rows):
        if not queries.num_rows or not rows.num_rows:
            return schema.empty_table()
        ids = rows.column("vec_id").to_numpy()
        out = []
        for some in (queries.filter(pc.is_null(queries.column("own"))), queries.filter(pc.is_valid(queries.column("own")))):
            if not some.num_rows:
                continue
            own = some.column("own")
            # without an own id to leave out: one that no row has
            left_out = own.to_numpy() if not own.null_count else np.full(len(own), next(x for x in range(-1, -len(ids) - 2, -1) if x not in ids))
            found = best(_matrix(some.column("v")), left_out, _matrix(rows.column("v")), ids, k)
            which = np.repeat(np.arange(len(found)), [len(x) for x, _ in found])
            told = some.select(["digest", "own"]).take(pa.array(which))
            told = told.append_column("vec_id", pa.array(np.concatenate([x for x, _ in found])))
            out.append(told.append_column("score", pa.array(np.concatenate([x for _, x in found]))).cast(schema))
        return pa.concat_tables(out)

    return run


def search(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS, sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found to each row that ``is_query`` (over vec_id), itself left out."""
    rows = stored(usable(vectors, key, vector), "ann-vectors")
    few = F.row_number().over(Window.partitionBy("digest").orderBy("vec_id"))
    # a repeat would push other ids out of the limits
    once = rows.groupBy("digest", "vec_id").agg(F.first("v").alias("v")).select("vec_id", "v", "digest")
    indexed = stored(once.withColumn("n", few).where(F.col("n") <= k + 1).drop("n"), "ann-indexed")
    several = once.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").select("vec_id", F.col("vec_id").alias("own"))
    asked = stored(rows.where(is_query).join(several, "vec_id", "left"), "ann-queries")
    queries = asked.select(F.col("vec_id").alias("query_id"), "digest", "own")
    router = fit(indexed, k, parts, sample, recall)
    if router is None:
        return queries.select("query_id", F.lit(0).alias("rank"), F.col("query_id").alias("vec_id"), F.lit(0.0).alias("score"))
    shared = rows.sparkSession.sparkContext.broadcast(router)

    def place(batches):
        for batch in batches:
            part = shared.value.part(_matrix(batch.column(1))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int32())], names=["vec_id", "v", "part"])

    def route(batches):
        for batch in batches:
            order = shared.value.parts(_matrix(batch.column(1)))[:, : shared.value.probes] if batch.num_rows else np.zeros((0, 0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(order.astype(np.int32)), pa.list_(pa.int32()))], names=["digest", "v", "own", "parts"])

    placed = stored(indexed.select("vec_id", "v").mapInArrow(place, "vec_id long, v array<double>, part int"), "ann-placed")
    distinct = asked.groupBy("digest", "own").agg(F.first("v").alias("v")).select("digest", "v", "own")
    routed = stored(distinct.mapInArrow(route, "digest string, v array<double>, own long, parts array<int>").select("digest", "v", "own", F.explode("parts").alias("part")), "ann-routed")
    blocks = placed.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).alias("row_blocks"))
    sizes = routed.groupBy("part").agg(F.ceil(F.count("*") / QUERIES).alias("query_blocks")).join(blocks, "part")

    def every(blocks_of: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks_of) - 1))

    left = routed.join(sizes, "part").select("part", every("row_blocks").alias("row_block"), F.pmod(F.xxhash64("digest"), F.col("query_blocks")).alias("query_block"), "digest", "own", "v")
    right = placed.join(sizes, "part").select("part", F.pmod(F.xxhash64("vec_id"), F.col("row_blocks")).alias("row_block"), every("query_blocks").alias("query_block"), "vec_id", "v")
    keys = ["part", "row_block", "query_block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_near(k + 1), "digest string, own long, vec_id long, score double")
    nearest = Window.partitionBy("digest", "own").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= k + 1).groupBy("digest", "own").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near"))
    found = found.withColumnRenamed("digest", "d").withColumnRenamed("own", "o")
    own = queries.join(found, (F.col("digest") == F.col("d")) & F.col("own").eqNullSafe(F.col("o"))).select("query_id", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near"))
    return own.select("query_id", F.posexplode("near").alias("at", "x")).select("query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", "x.score")
