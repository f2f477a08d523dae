"""Removal of repeats against a plain version, with many chunks, and suffix ranks against sorted strings."""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from lakegauge.llm import suffixes

WORDS = "amber birch cedar dune ember fjord grove heath islet jetty knoll larch mesa".split()


def plain(rows):
    first, out = {}, {}
    keyed = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    size = suffixes.LENGTH
    for doc, text in keyed:
        own = (text or "").encode()
        for i in range(len(own) - size + 1):
            first.setdefault(own[i : i + size], doc)
    for doc, text in keyed:
        own = (text or "").encode()
        gone = [False] * len(own)
        for i in range(len(own) - size + 1):
            owner = first[own[i : i + size]]
            if owner is not None and (doc is None or owner < doc):
                gone[i : i + size] = [True] * size
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.setdefault(doc, []).append((len(own), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(own, gone, strict=True) if not g)).hexdigest()))
    return {k: sorted(v) for k, v in out.items()}


def sentence(rng, n):
    return " ".join(rng.choice(WORDS, n))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    shared = [sentence(rng, 14) for _ in range(4)]
    out = [(k, sentence(rng, 20) + (" " + shared[k % 4] + " " if k % 3 else " ") + sentence(rng, 9)) for k in range(90)]
    out += [(200 + k, out[k % 5][1]) for k in range(30)]
    out += [(300, "é" * 60), (301, "x" + "é" * 45 + "y"), (302, "ab" * 400), (303, "b" + "ab" * 90), (304, ""), (305, None), (306, "short"), (7, out[7][1]), (None, out[3][1]), (None, "tiny")]
    return out


@pytest.mark.parametrize("chunk_bytes", [500, 1 << 20])
def test_same_as_plain(spark, rows, chunk_bytes):
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, kept string").repartition(5)
    left = suffixes.remove_repeats(docs, chunk_bytes=chunk_bytes)
    got = {}
    for r in left.select("doc_id", "n_bytes", "n_removed", F.size("spans").alias("n"), F.sha2("kept", 256).alias("h")).collect():
        got.setdefault(r[0], []).append((r[1], r[2], r[3], r[4]))
    assert {k: sorted(v) for k, v in got.items()} == plain(rows)


def test_empty_table(spark):
    assert suffixes.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_ranks_follow_the_order_of_strings():
    rng = np.random.default_rng(2)
    parts = [bytes(rng.choice(list(b"ab"), 30).tolist()) * 3 for _ in range(12)] + [b"a" * 120, b"a" * 90]
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    room = np.repeat(ends, [len(p) for p in parts]) - np.arange(len(data))
    starts = np.flatnonzero(room >= suffixes.LENGTH)
    strings = [data[s : s + suffixes.LENGTH].tobytes() for s in starts]
    ordered = sorted(strings)
    assert suffixes.suffix_ranks(data, starts, room).tolist() == [ordered.index(s) for s in strings]


@pytest.mark.parametrize("chunk_bytes", [500, 4000])
def test_hot_minimizers_cut_into_strings_give_the_same(spark, rows, chunk_bytes):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {}
    for r in suffixes.remove_repeats(docs, chunk_bytes=chunk_bytes, hot=2).select("doc_id", "n_bytes", "n_removed", F.size("spans").alias("n"), F.sha2("kept", 256).alias("h")).collect():
        got.setdefault(r[0], []).append((r[1], r[2], r[3], r[4]))
    assert {k: sorted(v) for k, v in got.items()} == plain(rows)


def test_no_bucket_holds_all_surroundings_of_a_hot_passage():
    """A passage in every document, each with a neighbourhood of its own: the edges' runs are spread over the buckets."""
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    passage = "".join(rng.choice(letters, 80))
    texts = ["".join(rng.choice(letters, 60)) + passage + "".join(rng.choice(letters, 60)) for _ in range(1600)]
    bits = 7
    chunks = [pa.table({"__chunk": pa.array([c] * 16, pa.int64()), "__id": pa.array(range(16 * c, 16 * c + 16), pa.int64()), "__text": texts[16 * c : 16 * c + 16]}) for c in range(100)]
    told = pa.concat_tables([suffixes._tell_values(bits)((pa.scalar(c),), t) for c, t in enumerate(chunks)])
    inboxes = {c: [] for c in range(100)}
    for bucket in told.column("bucket").unique():
        for row in suffixes._shared_values(200)((bucket,), told.filter(pc.equal(told.column("bucket"), bucket))).to_pylist():
            inboxes[row["__chunk"]].append(row)
    contents, size = {}, {}
    for c, t in enumerate(chunks):
        inbox = pa.Table.from_pylist(inboxes[c], pa.schema([("__chunk", pa.int64()), ("values", pa.binary()), ("hot", pa.binary())]))
        for row in suffixes._send_runs(bits)((pa.scalar(c),), t, inbox).to_pylist():
            lengths = suffixes._unpack(row["size"], "<u4")
            contents[row["bucket"]] = contents.get(row["bucket"], 0) + len(lengths)
            size[row["bucket"]] = size.get(row["bucket"], 0) + int((lengths - suffixes.LENGTH + 1).sum())
    assert max(size.values()) < 0.05 * sum(size.values()) and max(contents.values()) < 0.05 * sum(contents.values())
