"""BPE encoding and decoding of text columns, by forced-boundary splitting (see ``wordbpe``).

Defined results: a null text is an empty one and has no ids; a null list of ids
decodes to the empty string; a column that already has the output's name is
replaced; all other columns and repeated rows pass through. Whole texts are
encoded, in blocks that end at certain cuts, so memory follows the longest text.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakegauge.llm.common import text_batches
from lakegauge.llm.wordbpe import encoder

IDS = T.ArrayType(T.IntegerType())


def _with(df: DataFrame, name: str, kind: T.DataType) -> tuple[DataFrame, T.StructType]:
    rest = df.drop(name)
    return rest, T.StructType([*rest.schema.fields, T.StructField(name, kind)])


def encode(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of every text."""
    rows, schema = _with(df.withColumn(text, df[text]), ids, IDS)

    def run(batches):
        for part, texts in text_batches(batches, text):
            flat, counts = encoder(vocabulary).encode(texts)
            ends = pa.array([0, *counts.cumsum().tolist()], pa.int32())
            yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(ends, pa.array(flat, pa.int32()))], names=[*part.schema.names, ids])

    return rows.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the text that its ids stand for, special tokens included."""
    rows, schema = _with(df, decoded, T.StringType())

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [encoder(vocabulary).decode(x or []) for x in part.column(part.schema.get_field_index(ids)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, decoded])

    return rows.mapInArrow(run, schema)
