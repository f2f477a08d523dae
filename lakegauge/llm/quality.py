"""Quality by nearest-neighbour voting in a latent semantic space.

Terms are pairs of neighbouring byte classes, counted over whole texts, and steps
of a text's repetition of words and of lines. They are weighted by log frequency
and by inverse document frequency over the whole corpus, and projected on the
leading singular vectors of a bounded sample of labelled texts. The sample's
vectors are broadcast (``SAMPLE`` rows of ``DIMENSIONS`` floats, 3 MB); every
document is multiplied with all of them in blocks, and its nearest neighbours
vote with weights that grow with their cosine.

Defined results: a text without terms (null, empty) has no neighbours and gets
the sample's share of good labels, as does every text if no text is labelled
(0.5). Null labels teach nothing; a text labelled twice counts once, by its
higher label; repeated rows are scored alike. Columns named ``score`` or
``predicted`` are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegauge.llm.common import text_batches

SAMPLE = 12_000
DIMENSIONS = 48
NEIGHBOURS = 32
SHARPNESS = 8
STEPS = 12
_SIGNS = " \n#*$%&|!.,;:?\"'()<>=-_/@0aA"


def _byte_classes() -> np.ndarray:
    """Signs apart, digits, small and large letters and bytes beyond ASCII as one class each."""
    of = np.full(256, len(_SIGNS), np.int64)
    for c in range(128):
        one = chr(c)
        kind = "0" if one.isdigit() else "a" if one.islower() else "A" if one.isupper() else " " if one in "\t\r\v\f" else one
        if kind in _SIGNS:
            of[c] = _SIGNS.index(kind)
    of[128:] = len(_SIGNS) + 1
    return of


_CLASS = _byte_classes()
_CLASSES = len(_SIGNS) + 2
TERMS = _CLASSES**2 + 2 * STEPS


def _step(share: float) -> int:
    return min(STEPS - 1, int(share * STEPS))


def counts(text: str) -> np.ndarray:
    """How often each term occurs in a text; zero everywhere if it has no word."""
    words = text.split()
    out = np.zeros(TERMS, np.float32)
    if not words:
        return out
    classes = _CLASS[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    pairs = _CLASSES**2
    out[:pairs] = np.bincount(classes[:-1] * _CLASSES + classes[1:], minlength=pairs)
    lines = [x for x in text.split("\n") if x]
    # the repetition terms weigh as much as a fair part of the text's pairs
    weight = 1 + len(classes) / 8
    out[pairs + _step(1 - len(set(words)) / len(words))] = weight
    out[pairs + STEPS + _step(1 - len(set(lines)) / max(1, len(lines)))] = weight
    return out


def _rows(texts: list[str]) -> np.ndarray:
    """Log frequencies per thousand terms."""
    found = np.stack([counts(t) for t in texts]) if texts else np.zeros((0, TERMS), np.float32)
    return np.log1p(found * (1000 / np.maximum(found.sum(axis=1, keepdims=True), 1)))


@dataclass
class Neighbours:
    weights: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    @property
    def prior(self) -> float:
        return float(self.labels.mean()) if len(self.labels) else 0.5

    def project(self, rows: np.ndarray) -> np.ndarray:
        out = (rows * self.weights) @ self.basis
        size = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, size, out=np.zeros_like(out), where=size > 1e-12)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Votes of the nearest neighbours of each text."""
        out = np.full(len(texts), self.prior)
        if not len(self.labels):
            return out
        near = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(texts), 256):
            vectors = self.project(_rows(texts[at : at + 256]))
            cosines = vectors @ self.vectors.T
            best = np.argpartition(-cosines, near - 1, axis=1)[:, :near]
            votes = np.maximum(np.take_along_axis(cosines, best, axis=1), 0).astype(np.float64) ** SHARPNESS
            total = votes.sum(axis=1)
            known = total > 0
            out[at : at + 256][known] = (votes * self.labels[best]).sum(axis=1)[known] / total[known]
        return np.clip(out, 0.0, 1.0)


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", sample: int = SAMPLE) -> Neighbours:
    """Fit on the labelled rows that come first in the order of a hash of the key, ``sample`` at most; document frequencies cover all of ``docs``."""
    own = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("double").alias("label")).where("key IS NOT NULL AND label IS NOT NULL")
    chosen = known.groupBy("key").agg(F.max("label").alias("label")).orderBy(F.xxhash64("key"), "key").limit(sample)

    def terms(batches):
        for part, texts in text_batches(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([r.tobytes() for r in _rows(texts)], pa.binary())], names=["key", "label", "terms"])

    def frequencies(batches):
        total, rows = np.zeros(TERMS, np.int64), 0
        for _, texts in text_batches(batches):
            for t in texts:
                total += counts(t) > 0
            rows += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64()), pa.array([total], pa.list_(pa.int64()))], names=["n", "df"])

    parts = own.select("text").mapInArrow(frequencies, "n long, df array<long>").select("n", F.posexplode("df").alias("term", "df"))
    held = parts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")).collect()
    frequency, total = np.zeros(TERMS), max([0, *(r["n"] for r in held)])
    for r in held:
        frequency[r["term"]] = r["df"]
    weights = (np.log((1 + total) / (1 + frequency)) + 1).astype(np.float32)
    # a key that many rows share is drawn once
    texts = own.join(F.broadcast(chosen), "key").groupBy("key", "label").agg(F.min("text").alias("text"))
    found = texts.select("key", "label", "text").mapInArrow(terms, f"key {docs.schema[key].dataType.simpleString()}, label double, terms binary").select("label", "terms", F.xxhash64("key").alias("place"), "key").collect()
    found = [r for r in sorted(found, key=lambda r: (r["place"], r["key"])) if any(r["terms"])]  # a text with terms has a byte that is not 0
    if not found:
        return Neighbours(weights, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    rows, labels_of = np.frombuffer(b"".join([bytes(r["terms"]) for r in found]), np.float32).reshape(len(found), -1), np.array([r["label"] for r in found])
    del found
    weighted = rows * weights
    _, vectors = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
    model = Neighbours(weights, vectors[:, ::-1][:, :DIMENSIONS].astype(np.float32), np.zeros((0, 1), np.float32), labels_of)
    model.vectors = model.project(rows)
    return model


def score(docs: DataFrame, model: Neighbours, text: str = "text", keep_text: bool = False, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``docs`` with a score (0 to 1) and whether it is 0.5 or more, by these names; its text goes unless it is kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.drop(*names)
    schema = T.StructType([*(rows if keep_text else rows.drop(text)).schema.fields, T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())])

    def run(batches):
        model = shared.value
        for part, texts in text_batches(batches, text):
            values = model.scores(texts)
            rest = part if keep_text else part.drop_columns([text])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(values, pa.float64()), pa.array((values >= 0.5).astype(np.int32), pa.int32())], names=schema.names)

    return rows.mapInArrow(run, schema)
