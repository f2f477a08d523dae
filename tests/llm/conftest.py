import public_tokenizers
import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def vocabulary():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture
def edge(spark: SparkSession):
    """Nulls, empty texts, ties, repeated rows, a long text and columns whose names the operators use."""
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "src0", 9, "x"), (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "src0", 9, "x"), (2, "", None, None, None, None),
        (3, None, "en", "src1", 0, "y"), (None, "one two", None, "src1", 7, "z"), (5, "lang " * 30_000, "de", "src0", 5, "x"), (6, " \n\t ", "en", "src0", 4, "x"), (7, "12 34 !!", "en", "src0", 8, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string").selectExpr("*", "score AS ids", "score AS sequence_id", "score AS offset", "score AS kept", "score AS findings", "score AS bands", "score AS node", "score AS lang_pred", "score AS n_words")


@pytest.fixture
def nothing(edge):
    return edge.where("false")
