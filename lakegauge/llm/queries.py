"""One query per operator, with production parameters, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegauge.llm import bpe, hardneg, jaccard, langid, lexical, naming, neighbours, packing, quality, repair, rules, secrets, suffixes
from lakegauge.llm.common import stored, table
from lakegauge.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def fold(parts: int):
    """The fold of a row: crc32 of its doc_id as text, by remainder; null without an id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, their sequence and their place in it."""
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), vocabulary())).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's ids and of what they decode to."""
    docs = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary()).select("doc_id", "ids")
    digest = F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256)
    return bpe.decode(docs, vocabulary()).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written to grammar-compressed token files, as read back from them."""
    path = shared_dir(spark, "token-files")
    repair.write(table(spark, sf_dir, "documents"), path, vocabulary())
    return repair.read(spark, path, with_ids=False)


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learned from the other folds."""
    docs = table(spark, sf_dir, "documents")
    trees = langid.learn(docs.where(fold(4) != 2))
    return langid.predict(docs.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "text"), trees)


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every whole text, learned from the labels of the other folds."""
    docs = table(spark, sf_dir, "documents")
    model = quality.learn(docs, table(spark, sf_dir, "labels").where(fold(3) != 1))
    return quality.score(docs.select("doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"), "text"), model)


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every whole text, the base rules, and the verdict of a decision list learned from the labels."""
    stats = stored(rules.statistics(table(spark, sf_dir, "documents").select("doc_id", "text")), "rule-statistics")
    learned = rules.learn(stats, table(spark, sf_dir, "labels"))
    judged = stats.withColumn("base_failed", rules.base_failed()).withColumn("rule", rules.verdict(learned))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule")


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate for a secret in the whole texts, with its span and the forest's verdict."""
    docs = table(spark, sf_dir, "documents")
    return secrets.findings(docs, secrets.train(docs)).select("doc_id", "number", "start", "length", F.sha2("candidate", 256).alias("candidate_sha256"), "score", "secret")


@query
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near duplicates and the number of documents that it is linked with."""
    every, _ = jaccard.classes(table(spark, sf_dir, "documents"))
    return every.select("doc_id", "class_id", "n_links")


@query
def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each whole text loses to strings that documents with smaller ids hold as well."""
    left = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found to every vector whose id is divisible by 20, among all others."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For the anchors, every hundredth id, and each of their five nearest of their label the first five of other labels in the window."""
    other = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(table(spark, sf_dir, "embeddings").withColumn("label", other), F.col("vec_id") % 100 == 0)


ORACLE["op11_hard_negatives"] = """
WITH rows_in AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
    FROM rows_in a JOIN rows_in b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negatives AS (
    SELECT p.*, n.vec_id AS negative_id, n.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
    FROM positives p JOIN scores n ON p.anchor_id = n.anchor_id
    WHERE NOT n.same AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
"""


@query
def op12_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of equal texts and the row of it that stays."""
    return naming.exact_groups(table(spark, sf_dir, "documents"))


ORACLE["op12_block_naming"] = """
WITH texts AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY t)
"""


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for each benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op13_ranked_search"] = r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS l FROM sizes),
postings AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM postings, whole GROUP BY term),
parts AS (
    SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // l))) AS part
    FROM postings JOIN weights USING (term) JOIN sizes USING (doc_id), whole),
scores AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM asked JOIN parts USING (term) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 50
"""
