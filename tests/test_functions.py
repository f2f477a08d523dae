"""Column expressions against plain-Python restatements of the rules."""

import hashlib
import json
import math
import random
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from lakegauge.functions.casts import as_bool, as_double, as_long, as_text, as_timestamp
from lakegauge.functions.fingerprint import EMPTY_SHAPE, fingerprint, with_fingerprint
from lakegauge.functions.isotime import has_zone, iso_ts
from lakegauge.functions.strict_json import END_MARK, has_path, json_path, kind, path_value, with_json


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def column(df, name):
    return [r[name] for r in df.orderBy("i").collect()]


# --- strict JSON -----------------------------------------------------------

JSON_CASES = [
    '{"t":1}', '{"t":1} junk', '{"t":1} {"u":2}', "1]", "1,2", "", " ", "null", "true", "123", '"plain words"',
    "[4, 5]", '{"t":1}\n', '  {"t" : 1 }\n\n', '{"t":1,}', "[1,]", "{'t':1}", "not json", '"open', "01", "1.", ".5",
    "1e5", "-0", '{"a":1,"a":2}', '{"a":"\\u00e9"}', "﻿{}", "// c\n1", f'1,"{END_MARK}"] tail', f'"{END_MARK}"', "[[[[]]]]",
    '{"a":{"b":[1,{"c":null}]}}', "tru", "nul", '"tab\there"', '{"k":"[{"}', "{}", "[]", '"a","b"',
]


def python_json(text):
    try:
        return True, json.loads(text)
    except ValueError:
        return False, None


def test_strict_json_agrees_with_python(spark):
    df = with_json(texts(spark, JSON_CASES), "t", "v").select("i", "t", F.to_json("v").alias("out"), kind("v").alias("kind"))
    names = {type(None): "null", bool: "bool", int: "number", float: "number", str: "string", list: "array", dict: "object"}
    for row in df.collect():
        ok, value = python_json(row["t"])
        assert (row["kind"] is not None) == ok, row["t"]
        if ok:
            assert row["kind"] == names[type(value)], row["t"]
            assert json.loads(row["out"]) == value, row["t"]


def test_path_lookup_tells_missing_from_null(spark):
    cases = ['{"a":{"b":1}}', '{"a":{"b":null}}', '{"a":{}}', '{"a":[{"b":1}]}', '{"a.b":1}', '{"a":1}', "[1]", "null", "x"]
    df = with_json(texts(spark, cases), "t", "v").select("i", has_path("v", "a.b").alias("there"), kind(path_value("v", "a.b")).alias("k"))
    assert column(df, "there") == [True, True, False, False, False, False, False, False, False]
    assert column(df, "k")[:3] == ["number", "null", None]


def test_path_keys_with_spaces_and_quotes(spark):
    df = with_json(texts(spark, ['{"a b":{"it\'s":1}}']), "t", "v").select("i", has_path("v", "a b.it's").alias("there"))
    assert column(df, "there") == [True]
    with pytest.raises(ValueError):
        json_path("a..b")


# --- ISO timestamps --------------------------------------------------------

ISO_CASES = [
    "2026-11-19T17:26:41Z", "2026-11-19T19:26:41+02:00", "2026-11-19T17:26:41", "2026-11-19 17:26:41", "2026-11-19",
    "2026-11-19T17", "2026-11-19T17:26", "2026-11-19T17:26Z", "20261119", "20261119T172641Z", "20261119T1726", "2026-11-19x17:26:41",
    "2026-11-19T17:26:41.5", "2026-11-19T17:26:41,123456789Z", "2026-11-19T17:26:41.123456+05:30", "2026-11-19T17:26:41+0530",
    "2026-11-19T17:26:41+05", "2026-11-19T17:26:41+23:59", "2026-11-19T17:26:41-18:30", "2026-11-19T17:26:41+24:00",
    "2026-11-19T17:26:41+05:30:15", "2026-11-19T17:26:41-053015", "2026-W37-4", "2026-W37", "2026W374", "2026W37", "2026-W53-1", "2020-W53-7",
    "2026-W00-1", "2026-W37-4T10:00:00+01:00", "2026W374T1000", "2026-W374", "0000-01-01", "0001-01-01", "9999-12-31T23:59:59.999999Z",
    "2026-02-30", "2024-02-29", "2026-13-01", "2026-11-19T25:00:00", "2026-11-19T17:60:00", "2026-11-19T17:26:60", "2026-11-19T",
    "17:26:41", "2026", "2026-9-1", " 2026-11-19", "2026-11-19 ", "2026-11-19T17:26:41Z\n", "2026-11-19T17:26:41 Europe/Berlin",
    "2026-11-19T17:2641", "any-day-now", "", "now", "epoch", "2026-1119", "202611-19", "2026-11-19T17:26:41z", "2026-11-19T17:26:41+2:00",
    "2026-11-19T1726:41", "2026-11-19T17:26:41-00:00", "1999-12-31T23:59:59.9999999-01:00", "2026-11-19T172641.25+0100", "+2026-11-19",
]


def python_iso(text):
    try:
        parsed = datetime.fromisoformat(text)
        return parsed.astimezone(UTC) if parsed.tzinfo else parsed.replace(tzinfo=UTC)
    except (ValueError, OverflowError):
        return None


def micros(value):
    if value is None:
        return None
    delta = value - datetime(1970, 1, 1, tzinfo=UTC)
    return (delta.days * 86400 + delta.seconds) * 1_000_000 + delta.microseconds


def check_iso(spark, cases):
    got = column(texts(spark, cases).select("i", F.unix_micros(iso_ts(F.col("t"))).alias("us")), "us")
    return [(c, g, micros(python_iso(c))) for c, g in zip(cases, got) if g != micros(python_iso(c))]


def test_iso_agrees_with_python(spark):
    assert check_iso(spark, ISO_CASES) == []


def test_iso_on_random_text(spark):
    rng = random.Random(7)

    def clock():
        h, m, s = rng.randint(0, 23), rng.randint(0, 61), rng.randint(0, 59)
        frac = rng.choice(["", "", ".5", ",123", ".1234567"])
        return rng.choice([f"{h:02}:{m:02}:{s:02}{frac}", f"{h:02}{m:02}{s:02}{frac}", f"{h:02}:{m:02}", f"{h:02}{m:02}", f"{h:02}"])

    def date():
        y, m, d = rng.choice([1, 1969, 2000, 2024, 2026, 9999]), rng.randint(1, 13), rng.randint(1, 31)
        w, wd = rng.randint(0, 54), rng.randint(0, 8)
        return rng.choice([f"{y:04}-{m:02}-{d:02}", f"{y:04}{m:02}{d:02}", f"{y:04}-W{w:02}-{wd}", f"{y:04}W{w:02}{wd}", f"{y:04}-W{w:02}"])

    def zone():
        h, m = rng.randint(0, 25), rng.randint(0, 59)
        return rng.choice(["", "Z", f"+{h:02}:{m:02}", f"-{h:02}{m:02}", f"+{h:02}", f"-{h:02}:{m:02}:30"])

    cases = [date() + rng.choice(["T", " ", "T", "_"]) + clock() + zone() for _ in range(4000)]
    assert check_iso(spark, cases) == []


def test_end_of_day_midnight(spark):
    df = texts(spark, ["2026-11-19T24:00:00Z", "20261119T2400", "2026-11-19T24:00:01Z"]).select("i", iso_ts(F.col("t")).cast("string").alias("s"))
    assert column(df, "s") == ["2026-11-20 00:00:00", "2026-11-20 00:00:00", None]


def test_long_digit_runs_are_not_dates(spark):
    df = texts(spark, ["1803456789", "1710012340512", "20261119"]).select("i", iso_ts(F.col("t")).cast("string").alias("s"))
    assert column(df, "s") == [None, None, "2026-11-19 00:00:00"]


def test_zone_presence(spark):
    cases = ["2026-12-06T10:00:00", "2026-12-06T10:00:00Z", "2026-12-06T10:00:00+02:00", "2026-12-06T10:00:00-0200", "2026-12-06", "2026-12-06T10+02"]
    assert column(texts(spark, cases).select("i", has_zone(F.col("t")).alias("z")), "z") == [False, True, True, True, False, True]


# --- casts -----------------------------------------------------------------

VALUES = [
    "21.4", "21", "-3.99", "3.99", "1e3", "1E-7", "21.0", "0.0001", "0.00001", "123456789012345678", "1e16", "12345678.5", "-0", "-0.0", "0", "true", "false",
    '"21.4"', '" 7 "', '"1_000"', '"1__0"', '"+5"', '"1e3"', '"1.0d"', '"0x10"', '"hot"', '""', '"nan"', '"-inf"', '"Infinity"', '"+nan"', '"."', '"5."', '".5"',
    "[]", "[1]", "{}", '{"a":1}', "null", '"false"', "99999999999999999999", '"99999999999999999999"', "1e300", "2.5E+20", '"2026-11-19T17:26:41Z"', "20261119", "1803456789", '"true"',
    "9223372036854775807", "-9223372036854775808.5", "0.1", "100.50", "1.5e-10", "1234567890123456.7", '"\\u00a07"', '"7\\n"',
]


def python_number(value, cast):
    if value is None or isinstance(value, (list, dict)):
        return None
    try:
        out = cast(value)
    except (ValueError, OverflowError):
        return None
    return out if not isinstance(out, int) or abs(out) < 2**63 or out == -(2**63) else None


@pytest.fixture(scope="module")
def cast_rows(spark):
    rows = ['{"x":' + v + "}" for v in VALUES]
    df = with_json(texts(spark, rows), "t", "v").withColumn("x", path_value("v", "x")).withColumn("k", kind("x"))
    x, k = F.col("x"), F.col("k")
    out = df.select(
        "i", "k", as_double(x, k).alias("d"), as_long(x, k).alias("n"), as_bool(x, k).alias("b"), as_text(x, k).alias("s"),
        F.unix_micros(as_timestamp(x, k)).alias("ts"),
    )
    return [(json.loads(v), v, r) for v, r in zip(VALUES, out.orderBy("i").collect())]


def test_double_cast(cast_rows):
    for value, text, row in cast_rows:
        want = python_number(value, float)
        if want is not None and math.isnan(want):
            assert math.isnan(row["d"]), text
        else:
            assert row["d"] == want, text


def test_int_cast(cast_rows):
    for value, text, row in cast_rows:
        assert row["n"] == python_number(value, int), text


def test_bool_cast_is_truthiness(cast_rows):
    for value, text, row in cast_rows:
        assert row["b"] == (None if value is None else bool(value)), text


def test_text_cast(cast_rows):
    for value, text, row in cast_rows:
        if value is None:
            assert row["s"] is None
        elif isinstance(value, (list, dict)):
            assert json.loads(row["s"]) == value
        else:
            # a VARIANT does not keep the sign of zero
            assert row["s"] == ("0.0" if text == "-0.0" else str(value)), text


def test_timestamp_cast(cast_rows):
    for value, text, row in cast_rows:
        want = None if value is None or isinstance(value, (bool, list, dict)) else python_iso(str(value))
        assert row["ts"] == micros(want), text


# --- fingerprint -----------------------------------------------------------


def spark_fingerprints(spark, cases):
    df = with_json(texts(spark, cases), "t", "v")
    df = with_fingerprint(df.withColumn("general", fingerprint(F.col("v"), F.col("t"))), "v", "t", "fp")
    rows = df.select("i", "t", "general", "fp").orderBy("i").collect()
    # the shortcut for plain payloads and the general way must never differ
    assert [r["t"] for r in rows if r["general"] != r["fp"]] == []
    return [r["fp"] for r in rows]


# Shapes and their fingerprints.
GOLDENS = {
    "{}": "4f53cda18c2b",
    '{"temp":1,"hum":2}': "bc8816243459",
    '{"temp":21.4}': "2f481d4198bc",
    '{"temp":"x"}': "7eea81e1f785",
    '{"readings":[1]}': "8f26c92fc71d",
    '{"a":{"b":1,"c":[1,"x",null,{"q":true},[2.5]]},"z":[],"e":{}}': "447ff8aa846a",
    '{"k":{"l":[{"m":1},{"m":"s"},{"m":2}]}}': "80ec99f405b9",
    '{"a.b":1,"a":{"b":2}}': "dd46c66c6c25",
    '{"x":[[1],[2],[]],"y":[{},{"r":[{"s":null}]}]}': "d8565c42e233",
    "[1,2]": "957637e631a9",
    "5": "22e899821d80",
}


def test_fingerprint_goldens(spark):
    assert spark_fingerprints(spark, list(GOLDENS)) == list(GOLDENS.values())
    assert GOLDENS["{}"] == EMPTY_SHAPE


def digest(*leaves):
    """The fingerprint of these leaves, as the format states it."""
    return hashlib.sha256(json.dumps(sorted(leaves), separators=(",", ":")).encode()).hexdigest()[:12]


LEAVES = {
    '{"é":1}': ["é:number"],
    '{"a\\tb":1}': ["a\tb:number"],
    '{"":{"a":1}}': ["a:number"],
    '{"a":{"":1}}': ["a.:number"],
    '{"$1":2,"a|b":3}': ["$1:number", "a|b:number"],
    '{"a":{"b":{"c":1}}}': ["a.b.c:number"],
    '{"b":{"x":1},"a":{"x":1}}': ["a.x:number", "b.x:number"],
    '{"OBJECT":{"x":1e300},"VOID":"VOID","number":{"string":null}}': ["OBJECT.x:number", "VOID:string", "number.string:null"],
    '{"a":1,"a":"x"}': ["a:string"],
    '{"Z":1,"a":2,"0":3}': ["0:number", "Z:number", "a:number"],
    '{"a: STRING, b":1}': ["a: STRING, b:number"],
    '{"a b":1}': ["a b:number"],
    '{"k":99999999999999999999999999}': ["k:number"],
}


def test_fingerprint_of_listed_leaves(spark):
    assert spark_fingerprints(spark, list(LEAVES)) == [digest(*leaves) for leaves in LEAVES.values()]


def nested(rng, depth):
    roll = rng.random()
    if depth > 0 and roll < 0.3:
        return {rng.choice(["p", "q", "r s", "t.u", "ж"]): nested(rng, depth - 1) for _ in range(rng.randint(0, 4))}
    if depth > 0 and roll < 0.6:
        return [nested(rng, depth - 1) for _ in range(rng.randint(0, 4))]
    return rng.choice([None, True, 1, 2.5, "x{[", ""])


def other_values(value, rng):
    """The same shape with other values, keys and list items in another order."""
    if isinstance(value, dict):
        keys = list(value)
        rng.shuffle(keys)
        return {k: other_values(value[k], rng) for k in keys}
    if isinstance(value, list):
        items = [other_values(v, rng) for v in value]
        rng.shuffle(items)
        return items + items[:1]
    return value if value is None else rng.random() < 0.5 if isinstance(value, bool) else rng.randint(0, 99) if isinstance(value, (int, float)) else value + "y"


def test_fingerprint_follows_the_shape_only(spark):
    rng = random.Random(23)
    values = [{"top": nested(rng, 7)} for _ in range(200)]
    before = spark_fingerprints(spark, [json.dumps(v) for v in values])
    assert spark_fingerprints(spark, [json.dumps(other_values(v, rng), ensure_ascii=False, indent=1) for v in values]) == before
    wrapped = spark_fingerprints(spark, [json.dumps({"top": v["top"], "extra": 1}) for v in values])
    assert all(a != b for a, b in zip(before, wrapped, strict=True)) and len(set(before)) > 50


def test_fingerprint_of_a_wide_payload(spark):
    wide = {f"key{i:05}": {"v": [i, str(i)], "w": None} for i in range(3000)}
    leaves = [leaf for k in wide for leaf in (f"{k}.v[]:number|string", f"{k}.w:null")]
    many = {"batch": [{"i": i, "pad": "x" * 60} for i in range(5000)]}
    flat = {f"k{i:05}": "y" * 20 for i in range(2000)}
    assert spark_fingerprints(spark, [json.dumps(x) for x in (wide, many, flat)]) == [digest(*leaves), digest("batch[]:object", "batch[].i:number", "batch[].pad:string"), digest(*(f"{k}:string" for k in flat))]
