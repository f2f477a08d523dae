"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

Every byte covered by a string of ``LENGTH`` bytes that also starts in a document
with a smaller id goes; strings are judged on the input.

Suffix buckets. The strings of a text are cut into runs with the same minimizer,
the smallest hash of their ``GRAM``-byte parts: equal strings have equal ones. A
first pass finds the minimizers that more than one document has; only strings
with such a one can repeat. Their suffixes go, run by run, to the bucket of their
minimizer, and one bucket at a time is sorted.

Sorting. Suffixes are ordered by their first 16 bytes. Longer ties are resolved
with ranks computed beforehand for a cover sample: positions whose remainder by
``PERIOD`` is in a difference cover, so for any two suffixes there is a step below
``PERIOD`` after which both are in the sample. A tie costs one look at two ranks
and at the last bytes, however long it is. Ties are split around a pivot each, all
at once; the order is that of the first ``LENGTH`` bytes.

Hot content. Texts are dealt into chunks of about ``CHUNK_BYTES``; a chunk sends a
minimizer and a run's content once, however many of its documents hold them, with
the smallest id, and copies of a whole text take no part. So a bucket sees hot
content as often as there are chunks, and the answers go back to chunks. What
surrounds a shared passage differs from text to text; so the runs of a minimizer
of which all chunks have more than ``HOT`` contents are cut into their strings, which are dealt by
their own hash into as many buckets again, each once a chunk with the smallest id.

Defined results: null texts are empty; texts shorter than the length lose
nothing; documents with equal ids remove nothing from each other; a null id is
larger than all others; all other columns and repeated rows are kept. Ids are
integers. Columns named like the outputs are replaced.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegauge.llm.common import give_back, mixed, ragged

LENGTH = 50
GRAM = 24
CHUNK_BYTES = 4 << 20
HOT = 50_000
PERIOD = 13
COVER = (0, 1, 3, 9)  # differences of two of these reach every remainder by 13
SAMPLE_LENGTH = LENGTH - PERIOD + 1
_BLOCK = 1 << 19
_LAST = np.iinfo(np.int64).max
_STEP = np.array([[next(s for s in range(PERIOD) if (i + s) % PERIOD in COVER and (j + s) % PERIOD in COVER) for j in range(PERIOD)] for i in range(PERIOD)], np.int64)


def _words(data: np.ndarray) -> np.ndarray:
    """Big-endian number of the 8 bytes at every position; zeros follow the data."""
    w = np.append(data, np.zeros(7, np.uint8)).astype(np.uint64)
    for bits in (8, 16, 32):
        w = w[: -bits // 8] << np.uint64(bits) | w[bits // 8 :]
    return w


def _minimizers(data: np.ndarray) -> np.ndarray:
    """The smallest gram hash of every string of LENGTH bytes."""
    w = _words(data)
    n = len(data) - GRAM + 1
    h = w[:n] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h += w[8 : n + 8]
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h += w[16 : n + 16]
    h = mixed(h)
    width, span = LENGTH - GRAM + 1, 1
    while span * 2 <= width:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    return np.minimum(h[: len(h) - (width - span)], h[width - span :])


def runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings with one minimizer: text, first and last string, and the minimizer, spread evenly."""
    out: list[tuple[np.ndarray, ...]] = []
    k = 0
    while k < len(texts):
        first, size = k, 0
        while k < len(texts) and (size == 0 or size + len(texts[k]) <= _BLOCK):
            size += len(texts[k])
            k += 1
        data = np.frombuffer(b"".join(texts[first:k]), np.uint8)
        ends = np.cumsum([len(t) for t in texts[first:k]], dtype=np.int64)
        for at in range(0, max(1, len(data) - LENGTH + 1), _BLOCK):
            part = data[at : at + _BLOCK + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            least = _minimizers(part)
            own = np.searchsorted(ends, np.arange(at, at + len(least)), "right")
            same = own == np.searchsorted(ends, np.arange(at + LENGTH - 1, at + LENGTH - 1 + len(least)), "right")
            change = np.append(True, (least[1:] != least[:-1]) | (own[1:] != own[:-1]) | (same[1:] != same[:-1]))
            begin = np.flatnonzero(change)
            stop = np.append(begin[1:], len(least))
            begin, stop = begin[same[begin]], stop[same[begin]]
            text = own[begin]
            offset = at - (ends[text] - np.array([len(t) for t in texts[first:k]], np.int64)[text])
            out.append((text + first, begin + offset, stop + offset, mixed(least[begin] ^ np.uint64(0x5DEECE66D))))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _sent(values: np.ndarray, bits: int) -> np.ndarray:
    """Minimizers as they are sent: the bucket's bits and the last 40."""
    top = values >> np.uint64(64 - bits) if bits else np.zeros_like(values)
    return top << np.uint64(40) | values & np.uint64((1 << 40) - 1)


class Chunk:
    """The documents of a chunk: which of them are copies of one with a smaller id, and the runs of the others."""

    def __init__(self, docs: pa.Table) -> None:
        # rows arrive in any order; the passes number a chunk's contents alike only in a fixed one
        docs = self.docs = docs.sort_by([("__id", "ascending"), ("__text", "ascending")])
        self.texts = ["".encode() if t is None else t.encode("utf-8", "surrogatepass") for t in docs.column("__text").to_pylist()]
        self.ids = np.array([_LAST if d is None else d for d in docs.column("__id").to_pylist()], np.int64)
        smallest: dict[bytes, int] = {}
        for text, own in zip(self.texts, self.ids.tolist(), strict=True):
            if own < smallest.get(text, own + 1):
                smallest[text] = own
        self.copy = np.array([own > smallest[text] for text, own in zip(self.texts, self.ids.tolist(), strict=True)], bool)
        alive = np.flatnonzero(~self.copy)
        text, self.begin, self.stop, self.value = runs([self.texts[k] for k in alive])
        self.text = alive[text]

    def keep_shared(self, elsewhere: np.ndarray, bits: int) -> None:
        """Keep the runs whose minimizer, as it is sent, other chunks have or another document here has."""
        values, which = np.unique(_sent(self.value, bits), return_inverse=True)
        low, high = np.full(len(values), _LAST), np.full(len(values), -1)
        np.minimum.at(low, which, self.text)
        np.maximum.at(high, which, self.text)
        keep = ((low < high) | np.isin(values, elsewhere))[which]
        self.text, self.begin, self.stop, self.value = (x[keep] for x in (self.text, self.begin, self.stop, self.value))

    def contents(self, hot: np.ndarray, bits: int) -> None:
        """Distinct run contents: their bytes, smallest id and minimizer, and the number of each run's content; the strings of those with a hot minimizer."""
        known: dict[bytes, int] = {}
        texts = self.texts
        self.content = np.array([known.setdefault(texts[t][a : b + LENGTH - 1], len(known)) for t, a, b in zip(self.text.tolist(), self.begin.tolist(), self.stop.tolist(), strict=True)], np.int64)
        self.bytes = list(known)
        self.smallest = np.full(len(known), _LAST)
        np.minimum.at(self.smallest, self.content, self.ids[self.text])
        self.of = np.zeros(len(known), np.uint64)
        self.of[self.content] = self.value
        self.suffixes = np.array([len(b) for b in self.bytes], np.int64) - LENGTH + 1
        self.base = np.cumsum(self.suffixes) - self.suffixes
        self.hot = np.isin(_sent(self.of, bits), hot)
        cut = np.flatnonzero(self.hot)
        owner, at = np.repeat(cut, self.suffixes[cut]), ragged(np.zeros(len(cut), np.int64), self.suffixes[cut])
        strings: dict[bytes, int] = {}
        self.string = np.array([strings.setdefault(self.bytes[c][a : a + LENGTH], len(strings)) for c, a in zip(owner.tolist(), at.tolist(), strict=True)], np.int64)
        self.string_at = self.base[owner] + at
        self.strings = list(strings)
        self.string_smallest = np.full(len(strings), _LAST)
        np.minimum.at(self.string_smallest, self.string, self.smallest[owner])

    def dealt(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the contents and, after all contents, of the strings that are sent, and their buckets."""
        whole = np.flatnonzero(~self.hot)
        own = (self.of[whole] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(whole), np.int64)
        of_strings = np.array([zlib.crc32(x) for x in self.strings], np.int64) % (1 << bits) + (1 << bits)
        return np.append(whole, len(self.bytes) + np.arange(len(self.strings))), np.append(own, of_strings)


def _by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order by bucket, and (bucket, first, end) in it."""
    order = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    return order, list(zip(names.tolist(), first.tolist(), np.append(first[1:], len(order))[: len(first)].tolist(), strict=True))


def _pack(x: np.ndarray, kind: str) -> bytes:
    return zlib.compress(x.astype(kind).tobytes(), 1)


def _unpack(x: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(x), kind)


def _tell_values(bits: int):
    schema = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("found", pa.binary())])

    def run(key, docs):
        give_back()
        own = Chunk(docs)
        values, which, uses = np.unique(own.value, return_inverse=True, return_counts=True)
        # distinct contents of each value, as the next power of two
        many = np.flatnonzero(uses[which] > 1)
        texts = own.texts
        distinct = {(v, texts[t][a : b + LENGTH - 1]) for v, t, a, b in zip(which[many].tolist(), own.text[many].tolist(), own.begin[many].tolist(), own.stop[many].tolist(), strict=True)}
        uses = np.maximum(np.bincount(np.array([v for v, _ in distinct], np.int64), minlength=len(values)), 1)
        power = np.ceil(np.log2(uses)).astype(np.uint8)
        order, buckets = _by_bucket((values >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(values), np.int64))
        raw = values[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].copy()  # the bucket stands for the first bits
        raw[:, 5] = power[order]
        rows = [{"bucket": b, "chunk": key[0].as_py(), "found": raw[i:j].tobytes()} for b, i, j in buckets]
        return pa.Table.from_pylist(rows, schema)

    return run


def _shared_values(hot: int):
    schema = pa.schema([("__chunk", pa.int64()), ("values", pa.binary()), ("hot", pa.binary())])

    def run(key, told):
        parts = [np.frombuffer(x, np.uint8).reshape(-1, 6) for x in told.column("found").to_pylist()]
        chunk = np.repeat(np.array(told.column("chunk").to_pylist(), np.int64), [len(p) for p in parts])
        raw = np.zeros((len(chunk), 8), np.uint8)
        parts = np.concatenate(parts)
        raw[:, :5] = parts[:, :5]
        values = raw.view("<u8").ravel()
        _, which, uses = np.unique(values, return_inverse=True, return_counts=True)
        keep = uses[which] > 1
        contents = np.bincount(which, np.exp2(parts[:, 5].astype(np.float64)))
        values, chunk, often = values[keep], chunk[keep], contents[which][keep] > hot
        order = np.argsort(chunk, kind="stable")
        names, first = np.unique(chunk[order], return_index=True)
        stops = np.append(first[1:], len(order))[: len(first)]
        top = key[0].as_py()
        values, often = (values[order] | np.uint64(top << 40)).astype("<u8"), often[order]
        rows = [{"__chunk": int(c), "values": values[a:b].tobytes(), "hot": values[a:b][often[a:b]].tobytes()} for c, a, b in zip(names, first, stops, strict=True)]
        return pa.Table.from_pylist(rows, schema)

    return run


def _marked(docs: pa.Table, shared: pa.Table, bits: int) -> Chunk:
    chunk = Chunk(docs)
    told, hot = (np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(v, "<u8") for v in shared.column(c).to_pylist())]) for c in ("values", "hot"))
    chunk.keep_shared(told, bits)
    chunk.contents(hot, bits)
    return chunk


def _send_runs(bits: int):
    schema = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("content", pa.binary()), ("size", pa.binary()), ("doc", pa.binary()), ("data", pa.binary())])

    def run(key, docs, shared):
        give_back()
        if not docs.num_rows:
            return schema.empty_table()
        chunk = _marked(docs, shared, bits)
        number, bucket = chunk.dealt(bits)
        order, buckets = _by_bucket(bucket)
        order, data = number[order], chunk.bytes + chunk.strings
        sizes, smallest = np.array([len(b) for b in data], np.int64), np.append(chunk.smallest, chunk.string_smallest)
        name = docs.column("__chunk")[0].as_py()
        rows = [{"bucket": b, "chunk": name, "content": _pack(order[i:j], "<u4"), "size": _pack(sizes[order[i:j]], "<u4"), "doc": _pack(smallest[order[i:j]], "<i8"), "data": zlib.compress(b"".join([data[k] for k in order[i:j].tolist()]), 1)} for b, i, j in buckets]
        return pa.Table.from_pylist(rows, schema)

    return run


def _groups(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and sizes of the groups of equal neighbours."""
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)])
    return first, np.diff(np.append(first, len(ordered)))


def _refined(n: int, keys: list[np.ndarray]) -> np.ndarray:
    """Ranks of ``n`` items by keys, one after the other where they still tie; a rank is the number of smaller items."""
    rank, tied = np.zeros(n, np.int64), np.arange(n)
    for key in keys:
        own = key[tied]
        order = np.argsort(own)
        first, size = _groups(own[order])
        among = np.empty(len(tied), np.int64)
        among[order] = np.repeat(np.arange(len(first)), size)
        both = rank[tied] << 32 | among
        order = np.argsort(both)
        first, size = _groups(both[order])
        tied = tied[order]
        old, width = _groups(rank[tied])
        rank[tied] += np.repeat(first, size) - np.repeat(old, width)
        tied = tied[np.repeat(size, size) > 1]
    return rank


def suffix_ranks(data: np.ndarray, starts: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Rank of each suffix by its first LENGTH bytes; ``room`` tells for every position how many bytes of its run follow."""
    w = _words(data)
    nearby = np.zeros(len(data) + PERIOD, bool)
    for step in range(PERIOD):
        nearby[starts + step] = True
    sample = np.flatnonzero(nearby[: len(data)] & np.isin(np.arange(len(data)) % PERIOD, COVER) & (room >= SAMPLE_LENGTH))
    offsets = [*range(0, SAMPLE_LENGTH - 7, 8), SAMPLE_LENGTH - 8]
    cover = np.full(len(data), -1, np.int64)
    cover[sample] = _refined(len(sample), [w[sample + o] for o in dict.fromkeys(offsets)])
    rank = _refined(len(starts), [w[starts], w[starts + 8]])
    order = np.argsort(rank)
    _, alike = _groups(rank[order])
    tied = order[np.repeat(alike, alike) > 1]
    while len(tied):  # members of a tie are neighbours; each is compared with the middle one of its tie
        group = rank[tied]
        first, size = _groups(group)
        p, q = starts[tied], np.repeat(starts[tied[first + size // 2]], size)
        step = _STEP[p % PERIOD, q % PERIOD]
        sign = np.sign(cover[p + step] - cover[q + step])
        for tail in (SAMPLE_LENGTH, LENGTH - 8):
            a, b = w[p + tail], w[q + tail]
            sign = np.where(sign != 0, sign, (a > b).astype(np.int64) - (a < b))
        which = np.repeat(np.arange(len(first)), size)
        less = np.bincount(which, sign < 0, len(first)).astype(np.int64)
        alike = np.bincount(which, sign == 0, len(first)).astype(np.int64)
        rank[tied] = group + np.where(sign < 0, 0, np.where(sign == 0, less[which], (less + alike)[which]))
        left = np.where(sign < 0, less[which], np.where(sign > 0, (size - less - alike)[which], 1)) > 1
        tied = tied[left]
        tied = tied[np.argsort(rank[tied])]
    return rank


def _sort_bucket():
    schema = pa.schema([("__chunk", pa.int64()), ("content", pa.binary()), ("begin", pa.binary()), ("stop", pa.binary()), ("doc", pa.binary())])

    def run(key, sent):
        give_back()
        rows = sent.sort_by("chunk").to_pylist()
        content, size, doc = (np.concatenate([_unpack(r[c], kind) for r in rows]).astype(np.int64) for c, kind in (("content", "<u4"), ("size", "<u4"), ("doc", "<i8")))
        counts = [len(_unpack(r["content"], "<u4")) for r in rows]
        chunk = np.repeat(np.array([r["chunk"] for r in rows], np.int64), counts)
        raw = b"".join([zlib.decompress(r["data"]) for r in rows])
        ends = np.cumsum(size)
        # what several chunks sent is sorted once, with the smallest of its ids
        known: dict[bytes, int] = {}
        same = np.array([known.setdefault(raw[b - n : b], len(known)) for b, n in zip(ends.tolist(), size.tolist(), strict=True)], np.int64)
        owner = np.full(len(known), _LAST)
        np.minimum.at(owner, same, doc)
        data = np.frombuffer(b"".join(known), np.uint8)
        lengths = np.array([len(x) for x in known], np.int64)
        stops = np.cumsum(lengths)
        inside = lengths - LENGTH + 1
        starts = ragged(stops - lengths, inside)
        rank = suffix_ranks(data, starts, np.repeat(stops, lengths) - np.arange(len(data)))
        order = np.argsort(rank)
        first, alike = _groups(rank[order])
        least = np.empty(len(starts), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(np.repeat(owner, inside)[order], first), alike)
        suffixes = size - LENGTH + 1
        of = np.repeat(np.arange(len(size)), suffixes)
        smallest = least[ragged((np.cumsum(inside) - inside)[same], suffixes)]
        # stretches of a run that some other chunk has in a smaller document
        begin = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (smallest[1:] != smallest[:-1])))
        stop = np.append(begin[1:], len(of))
        told = smallest[begin] < doc[of[begin]]
        begin, stop = begin[told], stop[told]
        run_of = of[begin]
        base = (np.cumsum(suffixes) - suffixes)[run_of]
        out = []
        where = chunk[run_of]
        for name in np.unique(where).tolist():
            a, b = np.searchsorted(where, [name, name + 1])
            out.append({"__chunk": name, "content": _pack(content[run_of[a:b]], "<u4"), "begin": _pack((begin - base)[a:b], "<u4"), "stop": _pack((stop - base)[a:b], "<u4"), "doc": _pack(smallest[begin[a:b]], "<i8")})
        return pa.Table.from_pylist(out, schema)

    return run


def _remove(bits: int, names: list[str]):
    def run(key, docs, inbox):
        give_back()
        told = inbox.filter(pc.is_valid(inbox.column("content")))
        chunk = _marked(docs, inbox.filter(pc.is_valid(inbox.column("values"))), bits)
        # all strings of all contents, followed by the distinct ones that were sent one by one
        base = np.append(chunk.base, int(chunk.suffixes.sum()) + np.arange(len(chunk.strings)))
        smallest = np.append(np.repeat(chunk.smallest, chunk.suffixes), chunk.string_smallest)
        for row in told.to_pylist():
            content, begin, stop, doc = (_unpack(row[c], kind).astype(np.int64) for c, kind in (("content", "<u4"), ("begin", "<u4"), ("stop", "<u4"), ("doc", "<i8")))
            at = ragged(base[content] + begin, stop - begin)
            smallest[at] = np.minimum(smallest[at], np.repeat(doc, stop - begin))
        smallest[chunk.string_at] = smallest[int(chunk.suffixes.sum()) + chunk.string]
        size = chunk.stop - chunk.begin
        repeated = smallest[ragged(base[chunk.content], size)] < np.repeat(chunk.ids[chunk.text], size)
        lengths = np.array([len(t) for t in chunk.texts], np.int64)
        origin = np.cumsum(lengths) - lengths
        hits = ragged(origin[chunk.text] + chunk.begin, size)[repeated]
        total = int(lengths.sum())
        covered = np.cumsum(np.bincount(hits, minlength=total + 1) - np.bincount(hits + LENGTH, minlength=total + 1)[: total + 1])[:total] > 0
        whole = chunk.copy & (lengths >= LENGTH)
        covered[ragged(origin[whole], lengths[whole])] = True
        n_removed, spans, kept = [], [], []
        for text, at in zip(chunk.texts, origin.tolist(), strict=True):
            gone = covered[at : at + len(text)]
            removed = int(gone.sum())
            n_removed.append(removed)
            edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            spans.append([{"start": int(a), "stop": int(b)} for a, b in edge.reshape(-1, 2)] if removed else [])
            kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes() if removed else text)
        rest = chunk.docs.select(names)
        for name, values in (("n_bytes", pa.array(lengths)), ("n_removed", pa.array(n_removed, pa.int64())), ("spans", pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))), ("kept", pa.array(kept, pa.binary()))):
            rest = rest.append_column(name, values)
        return rest

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES, hot: int = HOT) -> DataFrame:
    """``docs`` without its text, with n_bytes, n_removed, spans (removed runs of bytes) and kept (the bytes left)."""
    rows = docs.drop("n_bytes", "n_removed", "spans", "kept", "__chunk", "__id", "__text")
    names = [c for c in rows.columns if c != text]
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = max(1, math.ceil(size / chunk_bytes))
    bits = min(24, (chunks - 1).bit_length())
    rows = rows.withColumns({"__id": F.col(key).cast("long"), "__text": F.col(text), "__chunk": F.pmod(F.xxhash64(F.col(key).cast("long"), F.col(text)), F.lit(chunks))}).drop(text)
    # the three passes over the chunks share one shuffle of the texts
    by_chunk = rows.groupBy("__chunk")
    values = by_chunk.applyInArrow(_tell_values(bits), "bucket long, chunk long, found binary")
    shared = values.groupBy("bucket").applyInArrow(_shared_values(hot), "__chunk long, values binary, hot binary")
    sent = by_chunk.cogroup(shared.groupBy("__chunk")).applyInArrow(_send_runs(bits), "bucket long, chunk long, content binary, size binary, doc binary, data binary")
    told = sent.groupBy("bucket").applyInArrow(_sort_bucket(), "__chunk long, content binary, begin binary, stop binary, doc binary")
    none = F.lit(None).cast("binary")
    inbox = told.withColumns({"values": none, "hot": none}).unionByName(shared.select("__chunk", *(none.alias(c) for c in ("content", "begin", "stop", "doc")), "values", "hot"))
    schema = T.StructType([*rows.select(*names).schema.fields, *T.StructType.fromDDL("n_bytes long, n_removed long, spans array<struct<start: long, stop: long>>, kept binary").fields])
    return by_chunk.cogroup(inbox.groupBy("__chunk")).applyInArrow(_remove(bits, names), schema)
