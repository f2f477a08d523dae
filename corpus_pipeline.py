"""A training corpus from raw documents: good ones only, near duplicates and repeated passages out, secrets masked, packed.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and, but for
the last, returns the columns of documents; ``run`` writes each stage's rows to the
shared folder and reads them again for the next one.

Defined results: null texts stay null up to the last stage, where they count as
empty; extra columns are carried along whatever their names; empty tables give
empty results; the operators' docstrings say what else holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.llm import jaccard, packing, quality, secrets, suffixes
from lakegauge.llm.common import stored, table
from lakegauge.llm.queries import vocabulary

_OWN = ("doc_id", "text", "source")


def _apart(docs: DataFrame) -> DataFrame:
    """The columns the operators look at, and all others under one name, so that no name can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in _OWN]
    return docs.select(*_OWN, F.struct(F.col("text").isNull().alias("__null"), *rest).alias("__rest"))


def _together(rows: DataFrame, columns: list[str]) -> DataFrame:
    """All columns again, in their order; n_chars follows the text."""
    text = F.when(~F.col("__rest.__null"), F.col("text"))
    of = {"text": text, "n_chars": F.length(text).cast("long")}
    return rows.select(*(of[c].alias(c) if c in of else F.col(c) if c in _OWN else F.col(f"__rest.`{c}`").alias(c) for c in columns))


def good_only(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    judged = quality.score(_apart(docs), model, keep_text=True, names=("__score", "__good"))
    return _together(judged.where(F.col("__good") == 1), docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return jaccard.deduplicate(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings that a document with a smaller id holds as well go; a letter cut in two is replaced."""
    left = suffixes.remove_repeats(_apart(docs))
    return _together(left.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))), docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts."""
    rows = _apart(docs)
    return _together(secrets.redact(rows, secrets.train(rows)), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    pieces = packing.pack(packing.pieces(docs, vocabulary()))
    return pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_only),
    ("n-gram jaccard join", without_near_duplicates),
    ("suffix-array dedup", without_repeats),
    ("secret scan", without_secrets),
    ("best-fit packing", packed),
]

# no stage is within SQL's reach; tests/llm compares them with plain versions
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
