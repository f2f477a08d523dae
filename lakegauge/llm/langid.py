"""Language identification by prediction by partial matching.

For every language a byte context tree of variable order (up to ``ORDER`` bytes)
is counted on lower-cased UTF-8. Its statistics are frozen; a byte seen in its
context costs the logarithm of (count / (total + kinds)), another one the escape
(kinds / (total + kinds)) plus its cost in the next shorter context, down to a
uniform order -1. A text goes to the language that codes all its bytes shortest.

The trees of all languages are kept in one sorted table per order, over the strings
of bytes that any of them has seen, so one walk over a text's bytes yields the exact
code lengths of all languages at once, whatever bytes their scripts use. The counts
come from a bounded sample: of each language the ``SAMPLE`` documents that come first
in the order of a hash, and of each of these at most ``SAMPLE_CHARS`` characters.

Defined results: texts that are null or hold no letter are ``und`` with score 0;
so is every text if nothing can be learned. Null languages teach nothing; ties go
to the language that sorts first; the score is the share of the chosen language
in the texts' probabilities, at equal odds before.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegauge.llm.common import stored, text_batches

ORDER = 3
SAMPLE = 400
SAMPLE_CHARS = 1 << 20
ROOM = 4  # a cut of the hash ahead of the choice leaves this many samples, however many rows there are
_LETTER = regex.compile(r"\p{L}")  # numbers that are written as signs or letters, such as ½ and Ⅷ, are none
_START = 32  # what stands in front of a text


def coded(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)


def _grams(data: np.ndarray) -> np.ndarray:
    """The number of every byte with the ORDER bytes before it."""
    n = len(data) - ORDER
    out = np.zeros(n, np.uint32)
    for k in range(ORDER + 1):
        out = out << np.uint32(8) | data[k : k + n]
    return out


def _last(grams: np.ndarray, n: int) -> np.ndarray:
    """The last ``n`` bytes."""
    return grams & np.uint32(256**n - 1)


def _context(grams: np.ndarray) -> np.ndarray:
    return grams >> np.uint32(8)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in sorted ``keys`` of those that are there, and which these are."""
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    there = keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)
    return at[there], there


@dataclass
class Level:
    """One order: the grams (context and byte) and contexts that occur, sorted; ``bits`` costs a gram, ``escape`` leaves a context, per language."""

    grams: np.ndarray
    bits: np.ndarray
    contexts: np.ndarray
    escape: np.ndarray


@dataclass
class Trees:
    """``levels`` are those of the orders from 0 to ORDER."""

    languages: list[str]
    levels: list[Level]

    def lengths(self, text: str) -> np.ndarray:
        """Code length in bits of the whole text, per language."""
        total = np.zeros(len(self.languages))
        data = np.concatenate([np.full(ORDER, _START, np.uint8), coded(text)])
        for begin in range(ORDER, len(data), 1 << 18):
            left = _grams(data[begin - ORDER : begin + (1 << 18)])
            for order in range(ORDER, -1, -1):
                level, left = self.levels[order], _last(left, order + 1)
                at, there = _find(level.grams, left)
                total += level.bits[at].sum(axis=0, dtype=np.float64)
                left = left[~there]
                at, _ = _find(level.contexts, _context(left))
                total += level.escape[at].sum(axis=0, dtype=np.float64)
            total += np.log2(256) * len(left)  # order -1: any byte
        return total


def count_trees(texts: dict[str, list[str]]) -> Trees:
    """Trees from texts per language."""
    languages = sorted(texts)
    counted = []
    for name in languages:
        found = [_grams(np.concatenate([np.full(ORDER, _START, np.uint8), coded(t)])) for t in texts[name]]
        counted.append(np.unique(np.concatenate([np.zeros(0, np.uint32), *found]), return_counts=True))
    levels: list[Level] = []
    for order in range(ORDER + 1):
        own = []
        for grams, counts in counted:
            seen, where = np.unique(_last(grams, order + 1), return_inverse=True)
            own.append((seen, np.bincount(where, counts, len(seen))))
        every = np.unique(np.concatenate([np.zeros(0, np.uint32), *(seen for seen, _ in own)]))
        contexts = np.unique(_context(every))
        level = Level(every, np.empty((len(every), len(languages)), np.float32), contexts, np.empty((len(contexts), len(languages)), np.float32))
        for column, (seen, uses) in enumerate(own):
            at = np.searchsorted(contexts, _context(seen))
            total, different = np.bincount(at, uses, len(contexts)), np.bincount(at, minlength=len(contexts))
            both = total + different
            escape = np.where(both > 0, -np.log2(np.maximum(different, 1) / np.maximum(both, 1)), 0.0)
            shorter = levels[-1].bits[np.searchsorted(levels[-1].grams, _last(every, order)), column] if levels else np.full(len(every), np.log2(256))
            bits = escape[np.searchsorted(contexts, _context(every))] + shorter
            bits[np.searchsorted(every, seen)] = -np.log2(uses / both[at])
            level.bits[:, column], level.escape[:, column] = bits, escape
        levels.append(level)
    return Trees(languages, levels)


def _cut(uses: dict[str, int], sample: int) -> Column:
    """Which places lie in the first part of the hash's range, in which ``ROOM`` times the sample of a language is expected; all of a rare one's."""
    limits = {name: int(-(2**63) + 2**64 * ROOM * sample / n) for name, n in uses.items() if n > ROOM * sample}
    out = F.lit(True)
    for name, limit in limits.items():
        out = out & ((F.col("language") != name) | (F.col("place") < limit))
    return out


def learn(docs: DataFrame, text: str = "text", language: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> Trees:
    """Trees from a bounded sample of labelled texts: per language the ``sample`` first by hash, of whose text at most ``SAMPLE_CHARS`` characters teach."""
    known = docs.where(F.col(language).isNotNull() & F.col(text).isNotNull())
    known = known.select(F.col(language).alias("language"), F.xxhash64(key).alias("place"), F.col(key).cast("string").alias("key"), F.substring(text, 1, SAMPLE_CHARS).alias("text"))
    # the keys are chosen first; only the chosen texts reach the driver
    keys = stored(known.drop("text"), "language-keys")
    uses = keys.groupBy("language").agg(F.approx_count_distinct("key").alias("n")).collect()
    first = keys.where(_cut({r["language"]: r["n"] for r in uses}, sample))
    place = F.row_number().over(Window.partitionBy("language").orderBy("place", "key"))
    chosen = first.groupBy("language", "place").agg(F.min("key").alias("key")).withColumn("n", place).where(F.col("n") <= sample)
    rows = known.join(F.broadcast(chosen.select("language", "place")), ["language", "place"])
    texts: dict[str, list[str]] = {}
    for row in rows.groupBy("language", "place").agg(F.min("text").alias("text")).collect():
        texts.setdefault(row["language"], []).append(row["text"])
    return count_trees({name: sorted(own) for name, own in texts.items()})


def predict(docs: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``lang_pred`` and ``score``; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    rows = docs.drop("lang_pred", "score")
    schema = T.StructType([*rows.drop(text).schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        trees = shared.value
        for part, texts in text_batches(batches, text):
            best, score = [], []
            for t in texts:
                if not trees.languages or not _LETTER.search(t):
                    best.append("und")
                    score.append(0.0)
                    continue
                bits = trees.lengths(t)
                k = int(bits.argmin())
                best.append(trees.languages[k])
                score.append(float(1 / np.exp2(np.maximum(bits[k] - bits, -1000)).sum()))
            rest = part.drop_columns([text])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(best, pa.string()), pa.array(score, pa.float64())], names=schema.names)

    return rows.mapInArrow(run, schema)
