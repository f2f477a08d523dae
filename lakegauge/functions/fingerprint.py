"""Shape fingerprint of a JSON value, without a UDF.

A shape is the sorted list of its leaves, ``path:kind`` each. Its fingerprint is
the first 12 hex digits of the sha256 of that list written as a JSON array.
Values, key order and array lengths do not count; kinds do.

The tree is opened one level per step by ``aggregate``, which is a loop inside
one expression: work grows with the payload, the plan does not grow with depth,
and no intermediate VARIANT leaves the expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegauge.functions.strict_json import once

LENGTH = 12
EMPTY_SHAPE = "4f53cda18c2b"  # fixed value: the fingerprint of {}
_MAX_DEPTH = 1001  # the JSON reader refuses deeper nesting

# done: leaves found so far, each with the id of the outermost array around it
# (NULL outside arrays). open: containers still to look into.
_DONE = "array<struct<owner:bigint,leaf:string>>"
_OPEN = "array<struct<path:string,owner:bigint,node:variant>>"
_NODE = "struct<path:string,owner:bigint,leaf:string,node:variant>"
_STATE = f"struct<done:{_DONE},open:{_OPEN}>"


def _quick_kind(value: Column) -> Column:
    """Like ``kind``, but looks one level deep, so repeated use stays linear."""
    schema = F.schema_of_variant(value)
    return (
        F.when(value.try_cast("map<string,variant>").isNotNull(), "object")
        .when(value.try_cast("array<variant>").isNotNull(), "array")
        .when(schema == "STRING", "string")
        .when(schema == "BOOLEAN", "bool")
        .when(schema == "VOID", "null")
        .otherwise("number")
    )


def _node(path: Column, owner: Column, leaf: Column, value: Column) -> Column:
    return F.struct(path.alias("path"), owner.alias("owner"), leaf.alias("leaf"), value.alias("node"))


def _visit(path: Column, owner: Column, value: Column) -> Column:
    """A child: finished if it is a scalar, to be opened otherwise."""
    found = _quick_kind(value)
    return F.transform(
        F.array(found),
        lambda k: _node(path, owner, F.when(~k.isin("object", "array"), F.concat(path, F.lit(":"), k)), value),
    )[0]


def _children(x: Column, fresh_owner: Column) -> Column:
    """Everything directly below one open container."""
    path, owner, value = x["path"], x["owner"], x["node"]

    def member(entry: Column) -> Column:
        child = F.when(path == "", entry["key"]).otherwise(F.concat(path, F.lit("."), entry["key"]))
        return _visit(child, owner, entry["value"])

    def elements(items: Column) -> Column:
        below = F.concat(path, F.lit("[]"))
        group = F.coalesce(owner, fresh_owner)
        kinds = F.sort_array(F.array_distinct(F.transform(items, _quick_kind)))
        label = F.when(F.size(items) == 0, "empty").otherwise(F.array_join(kinds, "|"))
        own = _node(below, group, F.concat(below, F.lit(":"), label), F.lit(None).cast("variant"))
        inner = F.filter(items, lambda i: _quick_kind(i).isin("object", "array"))
        return F.concat(F.array(own), F.transform(inner, lambda i: _node(below, group, F.lit(None).cast("string"), i)))

    members = F.transform(F.map_entries(value.try_cast("map<string,variant>")), member)
    return F.coalesce(members, F.transform(F.array(value.try_cast("array<variant>")), elements)[0])


def leaves(value: Column, text: Column) -> Column:
    """Sorted leaves of a VARIANT; ``text`` is its JSON, which bounds the depth."""
    openers = F.char_length(text) - F.char_length(F.translate(text, "{[", ""))
    rounds = F.sequence(F.lit(1), F.least(openers, F.lit(_MAX_DEPTH)))
    no_owner = F.lit(None).cast("bigint")

    def sort_out(nodes: Column, done: Column) -> Column:
        leaf = F.transform(
            F.filter(nodes, lambda n: n["leaf"].isNotNull()),
            lambda n: F.struct(n["owner"].alias("owner"), n["leaf"].alias("leaf")),
        )
        to_open = F.transform(
            F.filter(nodes, lambda n: n["leaf"].isNull()),
            lambda n: F.struct(n["path"].alias("path"), n["owner"].alias("owner"), n["node"].alias("node")),
        )
        return F.struct(F.concat(done, leaf).alias("done"), to_open.alias("open"))

    def step(state: Column, level: Column) -> Column:
        found = F.flatten(F.transform(state["open"], lambda x, i: _children(x, level.cast("bigint") * (1 << 32) + i)))
        opened = F.transform(F.array(found), lambda nodes: sort_out(nodes, state["done"]))[0]
        return F.when(F.size(state["open"]) == 0, state).otherwise(opened)

    def collect(state: Column) -> Column:
        plain = F.transform(F.filter(state["done"], lambda x: x["owner"].isNull()), lambda x: x["leaf"])
        # inside one outermost array equal leaves count once
        # (as text, which array_distinct hashes; structs it would compare pairwise)
        owned = F.transform(
            F.filter(state["done"], lambda x: x["owner"].isNotNull()),
            lambda x: F.concat(x["owner"].cast("string"), F.lit(" "), x["leaf"]),
        )
        owned = F.transform(F.array_distinct(owned), lambda x: F.substr(x, F.instr(x, " ") + 1))
        return F.sort_array(F.concat(plain, owned))

    root = F.array(_visit(F.lit(""), no_owner, value))
    start = sort_out(root, F.array().cast(_DONE))
    # texts without an opening bracket are scalars: no round to run
    return F.aggregate(F.when(openers > 0, rounds).otherwise(F.array().cast("array<int>")), start, step, collect)


def _escaped(leaf: Column) -> Column:
    """Every character outside printable ASCII as \\uXXXX, quotes and backslashes escaped."""
    body = F.regexp_replace(leaf, r'(["\\])', r"\\$1")

    def escape(ch: Column) -> Column:
        code = F.ascii(ch)
        hex4 = lambda n: F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(n)), 4, "0"))
        offset = code - 0x10000
        pair = F.concat(
            hex4(F.shiftright(offset, 10) + 0xD800), hex4(offset.bitwiseAND(F.lit(0x3FF)) + 0xDC00)
        )
        short = {8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r"}
        out = F.when(code.between(32, 126), ch)
        for value, text in short.items():
            out = out.when(code == value, text)
        return out.when(code < 0x10000, hex4(code)).otherwise(pair)

    chars = F.transform(F.sequence(F.lit(1), F.char_length(body)), lambda i: body.substr(i, F.lit(1)))
    odd = F.array_join(F.transform(chars, escape), "")
    return F.when(body.rlike(r"[^ -~]"), odd).otherwise(body)


def signature(sorted_leaves: Column) -> Column:
    """The leaves as a compact JSON array, in ASCII."""
    plain = F.array_join(sorted_leaves, '","')
    odd = F.array_join(sorted_leaves, "").rlike(r'[^ -~]|["\\]')
    text = F.when(odd, F.array_join(F.transform(sorted_leaves, _escaped), '","')).otherwise(plain)
    return F.when(F.size(sorted_leaves) == 0, "[]").otherwise(F.concat(F.lit('["'), text, F.lit('"]')))


def _digest(signed: Column) -> Column:
    return F.substring(F.sha2(signed, 256), 1, LENGTH)


def fingerprint(value: Column, text: Column) -> Column:
    # bind the leaves once: the signature reads them several times
    return _digest(once(leaves(value, text), signature))


# Most sensor payloads hold no arrays and have plain keys. Their shape
# is fully told by schema_of_variant, which runs compiled; flattening its text is
# several times cheaper than opening the value.
_PLAIN_SHAPE = r"^OBJECT<[A-Za-z0-9_,:<> ]*>\z"
_TOKEN = r"[A-Za-z0-9_]+:(?:[a-z]+|OBJECT<)|>"


def _kinds_for_types(schema: Column) -> Column:
    for types, name in (
        (r"BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,-?\d+\)", "number"),
        ("STRING", "string"),
        ("BOOLEAN", "bool"),
        ("VOID", "null"),
    ):
        schema = F.regexp_replace(schema, rf": (?:{types})(?=[,>])", f":{name}")
    return F.replace(schema, F.lit(": OBJECT<"), F.lit(":OBJECT<"))


def _flattened(shape: Column) -> Column:
    """OBJECT<a:number, b:OBJECT<c:string>> -> sorted [a:number, b.c:string]."""
    body = F.substring(shape, 8, 1 << 30)  # after the opening OBJECT<

    def take(state: Column, token: Column) -> Column:
        prefix, found = state["prefix"], state["found"]
        deeper = F.concat(prefix, F.substring_index(token, ":", 1), F.lit("."))
        return (
            F.when(token == ">", F.struct(F.regexp_replace(prefix, r"[^.]+\.\z", "").alias("prefix"), found.alias("found")))
            .when(token.endswith("<"), F.struct(deeper.alias("prefix"), found.alias("found")))
            .otherwise(F.struct(prefix.alias("prefix"), F.concat(found, F.lit(" "), prefix, token).alias("found")))
        )

    nested = F.aggregate(
        F.regexp_extract_all(body, F.lit(_TOKEN), F.lit(0)),
        F.struct(F.lit("").alias("prefix"), F.lit("").alias("found")),
        take,
        lambda s: F.substring(s["found"], 2, 1 << 30),
    )
    flat = F.replace(F.rtrim(body, F.lit(">")), F.lit(", "), F.lit(" "))
    return F.sort_array(F.split(F.when(body.contains("<"), nested).otherwise(flat), " "))


def with_fingerprint(df: DataFrame, value: str, text: str, out: str) -> DataFrame:
    """Add ``out``, the fingerprint of the VARIANT in ``value`` parsed from ``text``."""
    shape = f"__{out}_shape"
    v, t, s = F.col(value), F.col(text), F.col(shape)
    flat = ~t.contains("[")
    plain = s.rlike(_PLAIN_SHAPE) & ~s.contains("OBJECT<>")
    signed = F.concat(F.lit('["'), F.array_join(_flattened(s), '","'), F.lit('"]'))
    return (
        df.withColumn(shape, F.when(flat, _kinds_for_types(F.schema_of_variant(value))))
        .withColumn(out, F.when(v.isNull(), None).when(plain, _digest(signed)).otherwise(fingerprint(v, t)))
        .drop(shape)
    )
