"""Hard negatives, block naming and ranked search against plain versions, and on odd rows and empty tables."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakegauge.llm import hardneg, lexical, naming
from lakegauge.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# --- hard negatives ----------------------------------------------------------


def plain_negatives(rows, positives=5, negatives=5):
    """rows: distinct (vec_id, label, integer vector)."""
    out = []
    for a, la, qa in rows:
        if a % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(qa, q, strict=True)), i, lab) for i, lab, q in rows if i != a]
        for ps, p, _ in sorted(x for x in scored if x[2] == la)[:positives]:
            window = sorted(x for x in scored if x[2] != la and 80 * -ps <= 100 * -x[0] <= 100 * -ps)[:negatives]
            out += [(a, p, r, n, -ps, -ns) for r, (ns, n, _) in enumerate(window, 1)]
    return sorted(out)


def mined(df, **more):
    return sorted(tuple(r) for r in hardneg.mine(df, F.col("vec_id") % 100 == 0, **more).collect())


SCHEMA = "vec_id long, label int, embedding array<double>"


@pytest.mark.parametrize("more", [{}, {"cell_rows": 2, "quota": 3, "block": 7}, {"cell_rows": 10_000, "quota": 40}])
def test_hard_negatives_are_exact(spark, more):
    rng = np.random.default_rng(1)
    middle = rng.standard_normal((6, 8))
    v = middle[rng.integers(0, 6, 400)] + 0.3 * rng.standard_normal((400, 8))
    v[100:180] = v[100]  # one vector holds a fifth of the rows
    v[300] = -v[301]
    rows = [(i, int(rng.integers(0, 3)), x.tolist()) for i, x in enumerate(v)]
    want = plain_negatives([(i, lab, [math.floor(256 * c) for c in x]) for i, lab, x in rows])
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(5), **more) == want and len(want) > 30


def test_hard_negatives_of_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    good = [(0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.4]), (2, 2, [0.9, 0.5]), (3, 2, [0.9, 0.5]), (4, 3, [0.0, 0.0]), (100, 2, [0.9, 0.5]), (200, 1, [-1.0, 0.0]), (-100, 3, [0.0, 1.0])]
    odd = [(5, None, [1.0, 1.0]), (6, 1, None), (7, 2, [1.0, None]), (8, 2, [nan, 1.0]), (9, 2, [inf, 1.0]), (None, 2, [1.0, 1.0]), (10, 2, [1.0, 1.0, 1.0]), (11, 2, []), (12, 2, [1e300, 1.0])]
    want = plain_negatives([(i, lab, [math.floor(256 * c) for c in x]) for i, lab, x in good])
    df = spark.createDataFrame(good + odd + good, SCHEMA).selectExpr("*", "label AS aid", "label AS windows", "label AS q", "label AS n", "label AS score")
    assert mined(df) == want and want
    assert mined(df.where("false")) == [] and mined(df.where("vec_id = 0")) == [] and mined(df.where("label = 2")) == []


def test_hard_negatives_with_large_numbers(spark):
    """Products beyond 2**53 are exact: the same pair of large numbers, one apart."""
    big = 1_000_003.0
    rows = [(0, 0, [big, 1.0]), (1, 0, [big, 2.0]), (2, 1, [big, 1.0]), (3, 1, [big, 1.0 - 1 / 256]), (4, 1, [big * 0.9, 0.0])]
    want = plain_negatives([(i, lab, [math.floor(256 * c) for c in x]) for i, lab, x in rows])
    assert mined(spark.createDataFrame(rows, SCHEMA)) == want


def test_cells_come_in_the_order_of_their_bounds():
    rng = np.random.default_rng(2)
    q = rng.integers(-300, 300, (500, 8))
    cells = hardneg.Cells((rng.standard_normal((9, 4)) * 200, rng.standard_normal((7, 4)) * 200))
    told = [hardneg._nearest(h, c) for h, c in zip(cells.halves(q), cells.codes, strict=True)]
    cells.radii = tuple(np.array([d[c == k].max(initial=0) for k in range(n)]) for (c, d), n in zip(told, (9, 7), strict=True))
    cells.rows = np.zeros((9, 7), int)
    np.add.at(cells.rows, (told[0][0], told[1][0]), 1)
    visits = list(cells.visits(q[0]))
    assert [v[0] for v in visits] == sorted((v[0] for v in visits), reverse=True) and len({v[2:] for v in visits}) == len(visits) == (cells.rows > 0).sum()
    for most, least, a, b in visits:
        scores = (q @ q[0])[(told[0][0] == a) & (told[1][0] == b)]
        assert least <= scores.min() and scores.max() <= most


@pytest.mark.parametrize("copies", [1, 30])
def test_the_sample_of_vectors_is_put_together_by_a_task(spark, monkeypatch, copies):
    """The first distinct vectors by a hash, whether few or many tasks hold them; the cut is raised where copies leave too few."""
    monkeypatch.setattr(hardneg, "SAMPLE", 40)
    rows = spark.range(900 * copies).selectExpr("id AS vec_id", "array(id % 900, -(id % 900) * 7) AS q").repartition(9).cache()
    want = [r["q"] for r in rows.select("q").distinct().orderBy(F.xxhash64("q"), "q").limit(40).collect()]
    assert hardneg._drawn(rows, 900 * copies).column("q").to_pylist() == want
    assert hardneg._drawn(rows.limit(0), 1).num_rows == 0 and hardneg._drawn(rows.where("vec_id < 9"), 9).num_rows == 9


def test_no_task_sends_the_driver_a_sample_of_its_own(spark, monkeypatch):
    """What is collected to choose the codes comes from one task, not a whole sample from each."""
    sent, kind = [], type(spark.range(1))
    monkeypatch.setattr(kind, "collect", lambda self: sent.append(self.columns))
    rows = spark.range(400).selectExpr("id AS vec_id", "id % 3 AS label", "array(id, id * 7 % 400) AS q").repartition(7)
    cells, placed = hardneg.fit(rows)
    assert placed.count() == 400 == cells.rows.sum() and ["q"] not in sent


# --- block naming --------------------------------------------------------------


def plain_groups(rows):
    norm = lambda t: (t or "").translate({c: c + 32 for c in range(65, 91)})
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, keep[norm(t)], len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows), key=str)


def grouped(df, **more):
    rows = naming.exact_groups(df, **more).collect()
    # one of each group stays, with the largest id
    stays = Counter(r["text_sha256"] for r in rows if r["kept"])
    assert set(stays.values()) <= {1} and set(stays) == {r["text_sha256"] for r in rows} and all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows), key=str)


@pytest.mark.parametrize("block", [3, 256])
def test_equal_texts_are_named_equal(spark, block):
    rng = np.random.default_rng(3)
    words = ["ab", "AB", "aB", "é", "É", "abc", "abcabc", "abcabcabc", "c", ""]
    rows = [(i, "".join(rng.choice(words, rng.integers(0, 6)))) for i in range(600)]
    rows += [(1000 + i, "abc" * 85) for i in range(400)]  # one group and one block over several ranges
    rows += [(2000 + i, "abc" * 85 + "abd" * i) for i in range(9)] + [(3000, "abc" * 200_000), (3001, "abc" * 200_000), (3002, "abc" * 199_999 + "abd")]
    rows += [(None, "ab"), (None, None), (5, "ab"), (5, "ab"), (7, None), (8, ""), (None, "lonely"), (None, "lonely"), (-4, "LONELY")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "text AS name", "text AS row", "text AS at", "text AS level").repartition(7)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # names are made in several ranges
    try:
        assert grouped(df, block=block, hot=20) == plain_groups(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_a_key_over_many_ranges_has_one_name(spark):
    rows = spark.range(5000).select(F.col("id").alias("row"), F.lit(0).cast("long").alias("at"), F.when(F.col("id") < 4500, 7).otherwise(F.col("id") % 5).cast("long").alias("a"), F.lit(1).cast("long").alias("b"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = naming.named(rows, ["a", "b"], "test-names").join(rows.select("row", "a"), "row").groupBy("a").agg(F.count_distinct("name").alias("n"), F.min("name").alias("name")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r["n"] for r in out] == [1] * 6 and len({r["name"] for r in out}) == 6


def test_naming_of_no_rows(spark):
    assert naming.exact_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_naming_of_edge_rows(edge, nothing):
    assert grouped(edge) == plain_groups([(r["doc_id"], r["text"]) for r in edge.collect()]) and naming.exact_groups(nothing).count() == 0


# --- ranked search ---------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_search(docs, items, k):
    words = lambda t: TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    held = [(i, Counter(words(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for doc, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def found(df, items, k, **more):
    return sorted((tuple(r) for r in lexical.search(df, items, k, **more).collect()), key=str)


@pytest.fixture
def small(monkeypatch):
    """Many shards, windows and slices for few documents."""
    for name, value in (("SHARD_DOCS", 50), ("WINDOW", 8), ("SLICE", 40), ("SHORT", 4)):
        monkeypatch.setattr(lexical, name, value)


@pytest.mark.parametrize("k,more", [(5, {}), (50, {"first_shards": 0}), (3, {"first_shards": 2, "pass_terms": 15})])
def test_search_ranks_as_a_scan(spark, k, more):
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "é", "x9", "漢字"]
    weight = 1 / np.arange(1, len(vocabulary) + 1)
    text = lambda n: "".join(w + str(rng.choice([" ", "-", ".\n", "'"])) for w in rng.choice(vocabulary, n, p=weight / weight.sum()))
    docs = [(i, text(int(rng.integers(1, 60)))) for i in range(500)]
    docs += [(1000 + i, docs[0][1]) for i in range(150)] + [(5, docs[5][1]), (None, docs[7][1]), (2000, ""), (2001, None), (2002, " ..! "), (2003, "W1 w1 W2 " * 20_000), (2004, "common " + docs[3][1])]
    items = [(i, text(int(rng.integers(1, 12)))) for i in range(9)] + [(9, docs[0][1]), (9, "w3 extra"), (10, ""), (11, None), (12, "unheard"), (None, "w1 É")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "text AS terms", "text AS score", "text AS docs").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "text AS term", "text AS rank")
    assert found(df, asked, k, **more) == plain_search(docs, items, k)


def test_small_windows_change_nothing(small):
    """Skipping, shard by shard: rows of one shard, scored in windows of eight."""
    rng = np.random.default_rng(5)
    docs = [[f"t{int(x)}" for x in rng.zipf(1.3, int(rng.integers(1, 40))) if x < 40] or ["t1"] for _ in range(300)]
    held = [Counter(w.encode() for w in d) for d in docs]
    sizes = [len(d) for d in docs]
    row = next(lexical._shards(lexical._shard(list(range(300)), sizes, held)))
    df = Counter(t for c in held for t in c)
    weights = {t: math.floor(1000 * math.log(602 / (2 * n + 1))) for t, n in df.items()}
    for terms in ([b"t1"], [b"t1", b"t2", b"t3", b"t9"], [b"t17", b"t1"], sorted(df), [b"none"]):
        terms = [t for t in terms]
        scoring = lexical.Scoring(300, sum(sizes), weights, {0: terms}, {})
        every = {}
        for i, c in enumerate(held):
            m = 50 + 50 * sizes[i] * 300 // sum(sizes)
            every[i] = sum(weights[t] * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
        want = sorted(((-s, i) for i, s in every.items() if s > 0))[:10]
        for least in (1, max(1, -want[-1][0] if want else 1)):
            scoring.least = {0: least}
            places, scores = lexical.Shard(row, scoring).best(0, 10)
            assert [(-s, p) for s, p in zip(scores.tolist(), places.tolist(), strict=True)] == want


def test_search_of_edge_rows(edge, nothing, spark):
    items = spark.createDataFrame([(1, "gamma LANG one"), (2, "alpha")], "item_id long, text string")
    assert found(edge, items, 3) == plain_search([(r["doc_id"], r["text"]) for r in edge.collect()], [(1, "gamma LANG one"), (2, "alpha")], 3)
    assert found(nothing, items, 3) == [] and found(edge, items.where("false"), 3) == []


# --- the queries ---------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_block_naming", "op13_ranked_search"])
def test_queries_equal_their_sql(spark, name):
    from lakegauge.llm.queries import ORACLE
    from oracle_check import compare, connect

    assert compare(spark, connect(SF), name, QUERIES[name], ORACLE[name], SF) is None
