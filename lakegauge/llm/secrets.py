"""Secret scans with a random forest against false positives, in Spark expressions only.

Candidates are tokens of a known shape (``SHAPES``), passwords in URLs, values of any
length and signs that are assigned to a name for credentials, and runs of 16 or more
letters, digits and ``+/_-`` with a digit among them. Each is described by its length, its character classes and the changes
between them, the share that dictionary words cover, its path and the words next
to it. A random forest is trained on labelled findings and turned into nested
conditional expressions, so scoring and redaction run inside each row: nothing is
exploded, joined or shuffled. The dictionary holds the ``WORDS`` most frequent
words of the corpus, counted over all of it.

Where no labelled findings are given, ``weak_labels`` derives them: known shapes are
secrets wherever they stand, and so are values that are assigned to a name for
credentials; digests, identifiers, plain numbers, references to other values and
candidates made of dictionary words are not; all others teach nothing. A forest
from such labels leaves known shapes to their shape: they score 1.

Defined results: null and empty texts have no findings; a null path is an empty
one; without labelled findings of both kinds every candidate gets their mean
label, 0 without any; repeated rows are scanned alike. Columns named ``findings``
or ``text`` (the redacted text) are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakegauge.llm.common import stored
from lakegauge.operators.fence import fence

_RUN = r"A-Za-z0-9+/_\-"
_PLAIN = rf"(?<![{_RUN}])(?=[A-Za-z+/_\-]*[0-9])[{_RUN}]{{16,}}"
SHAPES = (
    r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----[A-Za-z0-9+/=\s\\:,]*+(?:-[A-Za-z0-9+/=\s\\:,]++){0,4}-----END [A-Z0-9 ]*PRIVATE KEY-----"
    r"|(?<![A-Za-z0-9])(?:(?:AKIA|ASIA|AGPA|AIDA|AROA|ANPA|ANVA|AIPA)[A-Z0-9]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,}|glpat-[A-Za-z0-9_\-]{20,}"
    r"|[srp]k_(?:live|test)_[A-Za-z0-9]{10,}|whsec_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9_\-]{20,}|xox[abeoprs]-[A-Za-z0-9\-]{10,}|AIza[A-Za-z0-9_\-]{35}|npm_[A-Za-z0-9]{36}|pypi-[A-Za-z0-9_\-]{20,}|hf_[A-Za-z0-9]{30,}"
    r"|SG\.[A-Za-z0-9_\-]{16,}\.[A-Za-z0-9_\-]{16,}|eyJ[A-Za-z0-9_\-]{8,}\.eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]*)"
)
_NAME = r"(?:secret|token|passw|passphrase|pwd|api[_\-. ]?key|access[_\-. ]?key|auth(?!or(?!i))|credential|private[_\-. ]?key|signing[_\-]?key|encryption[_\-]?key|bearer)"
_SCHEME = r"(?:(?:bearer|basic|token)[ \t]{1,4})?"
_IS = r"""(?:[ \t]*+:=?[ \t]*+|[ \t]++=[=>]?[ \t]*+|=(?![=\s])(?!["'`](?:[\s,;:.)\]}>]|$))|(?<=token|secret|password|passwd|pwd|key)=[ \t]{1,4}+|>)"""
# what stands in front of an assigned value: the name, the sign and the opening quote
_ASSIGNED = rf"""(?i:(?<![{_RUN}.])(?=[{_RUN}.]++(?: key)?+["'`\])]{{0,2}}+[ \t]*+[:=>])(?>[{_RUN}.]*?{_NAME})[{_RUN}.]*+["'`\])]{{0,2}}+{_IS}["'`]?+{_SCHEME}+)"""
_IN_URL = r"""://[^\s/:@"'<>?#]*+:"""
_QUOTED = "|".join(
    rf"(?<={q}(?i:{_SCHEME}))(?!\s*{q})(?:[^\s{q}\\]*+(?:\\\S[^\s{q}\\]*+)*+(?={q})|(?![^{q}\n]*{_PLAIN})[^{q}\n]++(?={q})|[^\s{q}]++)"
    for q in "\"'`"
)
_BARE = rf"""(?<!["'`](?i:{_SCHEME}))[^\s"'`<>,;=][^\s"'`<>]*(?<![,;.])"""
_ANY = rf"""{SHAPES}|{_IN_URL}[^\s/"'<>?#]+(?=@)|{_ASSIGNED}(?:{_QUOTED}|{_BARE})|{_PLAIN}={{0,2}}"""
# where no candidate can begin: inside a run of letters and digits, and at a short word that a sign or another word (no "key") ends
_NOT_INSIDE = r"(?:(?<![A-Za-z0-9])|(?=-----|://))"
_NO_PROSE = r"(?![A-Za-z]{1,15}+(?:[,;!?\n]|\.?(?: (?![Kk])[A-Za-z]|\n)))"
CANDIDATE = rf"{_NOT_INSIDE}{_NO_PROSE}(?:{_ANY})"
# stretches in which no candidate begins: other signs, and whole runs too short for one, or without a digit, that hold no known shape and are not assigned to or hold no name
_DULL = (
    rf"""(?<![{_RUN}.])(?:[A-Za-z]{{1,14}}+[.,]?+ (?=[A-JL-Za-jl-z]))++|[^{_RUN}.:]++|:(?!//[^\s/:@"'<>?#]*+:)|(?<![{_RUN}.])(?:[A-Za-z0-9+/_.]{{1,14}}+(?![{_RUN}.]|(?i: key)?+["'`\])]{{0,2}}+[ \t]*+[:=>])"""
    rf"|(?!(?i:[{_RUN}.]*?{_NAME}))(?![{_RUN}.]*?(?:{SHAPES}))(?:[{_RUN}.]{{1,14}}+|[A-Za-z+/_\-.]++)(?![{_RUN}.]))"
)
# all of a text in pieces, with what CANDIDATE finds as group 1: dull stretches are passed at a run, not tried at every character
PIECES = rf"(?:{_DULL})++|({_ANY})|[A-Za-z0-9]++|(?s:.)"
LEAD = rf"^(?:{_IN_URL}|{_ASSIGNED})(?=[^=])"
REFERENCE = r"^(?:\$[{(].*|\$?[A-Z]+(?:_[A-Z]+)+|\$[A-Z]+|%[A-Z_]+%|\{\{.*|<[A-Za-z_ \-]+>|[A-Za-z_][\w.]*[(\[].*|[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)+|(?i:none|null|true|false|undefined|str|string|int|bool))$"
CREDENTIAL = r"(?i)(secret|token|passw|pwd|api.?key|access.?key|auth|credential|private|bearer)[^\s]*(\s+\S{1,2})?\s*\S{0,2}$"
NO_SECRET = r"(?i)(sha-?\d*|md5|hash|digest|checksum|commit|revision|uuid|guid|isbn|example|sample|dummy|card)[^\s]*(\s+\S{1,2})?\s*\S{0,2}$"
TEST_PATH = r"(?i)(test|example|sample|fixture|mock|doc)"
MASK = "[secret]"
WORDS = 1000
SAMPLE = 20_000
ROOM = 4  # a cut of the hash ahead of the choice leaves this many samples
TREES, DEPTH = 15, 5
BEFORE, AFTER = 80, 20
FEATURES = ("length", "digits", "capitals", "letter_digit_changes", "case_changes", "separators", "hex", "distinct", "dictionary", "test_path", "credential_word", "assigned", "quoted", "no_secret_word", "neighbours_known", "known_shape", "reference", "other_signs")


def dictionary(docs: DataFrame, text: str = "text", words: int = WORDS) -> list[str]:
    """The most frequent words of 4 to 12 letters in all texts; of equally frequent ones those that sort first."""
    every = docs.select(F.explode(F.split(F.lower(text), "[^a-z]+")).alias("word")).where("length(word) BETWEEN 4 AND 12")
    counted = every.groupBy("word").agg(F.count("*").alias("n"))
    return sorted(r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(words).collect())


def _features(c: Column, before: Column, after: Column, named: Column, path: Column, known: list[str]) -> Column:
    size = F.length(c).cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count(c, F.lit(pattern)) / size

    words = F.array(*map(F.lit, known)) if known else F.array().cast("array<string>")
    runs = F.regexp_extract_all(F.lower(c), F.lit("[a-z]{4,}"), 0)
    near = F.filter(F.slice(F.reverse(F.split(F.lower(before), "[^a-z]+")), 1, 4), lambda w: F.length(w) >= 4)
    covered = F.aggregate(F.filter(runs, lambda w: F.array_contains(words, w)), F.lit(0), lambda a, w: a + F.length(w))
    return F.array(
        size, share("[0-9]"), share("[A-Z]"), share("(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]"), share("(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]"), share(r"[+/_\-]"), share("[0-9a-fA-F]"),
        F.size(F.array_distinct(F.split(c, ""))) / size, covered / size, path.rlike(TEST_PATH).cast("double"), (named | before.rlike(CREDENTIAL)).cast("double"), (named | before.rlike(r"[=:]\s*[\"'`]?$")).cast("double"),
        (before.rlike("[\"'`]$") & after.rlike("^[\"'`]")).cast("double"), before.rlike(NO_SECRET).cast("double"),
        F.when(F.size(near) > 0, F.size(F.array_intersect(near, words)) / F.size(near)).otherwise(F.lit(0.0)).cast("double"),
        c.rlike(SHAPES).cast("double"), c.rlike(REFERENCE).cast("double"), share(r"[^A-Za-z0-9+/_=\-]"),
    )


def candidates(docs: DataFrame, known: list[str], text: str = "text", path: str = "source") -> DataFrame:
    """``docs`` with ``__parts`` (the text around its candidates) and ``__found`` (candidates with context and features)."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumn("__m", F.filter(F.regexp_extract_all(t, F.lit(PIECES), 1), lambda m: m != ""))
    rows = rows.withColumn("__lead", F.transform("__m", lambda m: F.regexp_extract(m, LEAD, 0)))
    rows = rows.withColumn("__c", F.transform("__m", lambda m, i: F.substring(m, F.length(F.get("__lead", i)) + 1, F.length(m))))
    # the names in front of assigned values are part of the text around
    around = F.transform(F.split(t, CANDIDATE, -1), lambda p, i: F.concat(p, F.coalesce(F.get("__lead", i), F.lit(""))))
    rows = rows.withColumn("__parts", F.when(F.size("__c") > 0, around).otherwise(F.array(t)))
    place = F.coalesce(F.col(path), F.lit("")) if path in docs.columns else F.lit("")
    parts = F.col("__parts")

    def described(c: Column, i: Column) -> Column:
        return F.struct(c.alias("candidate"), F.right(F.get(parts, i), F.lit(BEFORE)).alias("before"), F.left(F.get(parts, i + 1), F.lit(AFTER)).alias("after"), (F.get("__lead", i) != "").alias("named"))

    context = F.transform("__c", described)
    found = F.transform(context, lambda x: F.struct(x["candidate"].alias("candidate"), x["before"].alias("before"), x["after"].alias("after"), _features(x["candidate"], x["before"], x["after"], x["named"], place, known).alias("features")))
    return rows.withColumn("__found", F.when(F.size("__c") > 0, found)).drop("__c", "__m", "__lead")


@dataclass(frozen=True)
class Forest:
    """Trees as nested (feature, threshold, at most, above) with 0 or 1 as leaves; ``prior`` scores candidates if there are none. With ``shapes`` known shapes score 1."""

    words: list[str]
    trees: list = field(default_factory=list)
    prior: float = 0.0
    shapes: bool = False

    def score(self, features: Column) -> Column:
        """The share of trees that vote for a secret."""

        def vote(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, threshold, at_most, above = node
            return F.when(features[feature] <= threshold, vote(at_most)).otherwise(vote(above))

        total = vote(self.trees[0]) if self.trees else F.lit(self.prior)
        for tree in self.trees[1:]:
            total = total + vote(tree)
        total = total / float(max(1, len(self.trees)))
        return F.when(features[FEATURES.index("known_shape")] > 0, F.lit(1.0)).otherwise(total) if self.shapes else total


def _tree(lines: list[str]):
    """A tree from its printed form, taking the lines it consists of."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return float(line.split(":")[1])
    feature, threshold = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    at_most = _tree(lines)
    lines.pop(0)  # Else
    return int(feature), float(threshold), at_most, _tree(lines)


def weak_labels(found: DataFrame) -> DataFrame:
    """Labelled findings (features, label) from findings with features, by the rules named above."""
    f = {name: F.col("features")[k] for k, name in enumerate(FEATURES)}
    harmless = (f["no_secret_word"] > 0) | (f["reference"] > 0) | (f["dictionary"] >= 0.5) | (f["digits"] >= 1) | ((f["credential_word"] == 0) & (f["assigned"] == 0))
    word = (f["quoted"] == 0) & (f["digits"] == 0) & (f["separators"] == 0) & (f["other_signs"] == 0)
    secret = (f["credential_word"] > 0) & (f["assigned"] > 0) & (f["distinct"] > 0.1) & ~word
    return found.select("features", F.when(f["known_shape"] > 0, 1.0).when(harmless, 0.0).when(secret, 1.0).alias("label")).where("label IS NOT NULL")


def _bounded(labelled: DataFrame, sample: int) -> DataFrame:
    """features, label and weight of at most ``sample`` distinct (features, label), as many of each label, the first by hash; a label's weights add up to the number of its findings."""
    counted = stored(labelled.groupBy("features", "label").agg(F.count("*").alias("n")).withColumn("place", F.xxhash64("features")), "finding-counts")
    uses = counted.groupBy("label").agg(F.count("*").alias("vectors"), F.sum("n").alias("n")).orderBy("label").collect()
    chosen = counted.where("false")
    for r in uses:
        own, each = counted.where(F.col("label") == r["label"]), sample // len(uses)
        if r["vectors"] > ROOM * each:
            own = own.where(F.col("place") < int(-(2**63) + 2**64 * ROOM * each / r["vectors"]))
        chosen = chosen.unionByName(own.orderBy("place", "features").limit(each))
    chosen = stored(chosen, "labelled-findings")
    share = F.lit(1.0)
    for r in chosen.groupBy("label").agg(F.sum("n").alias("n")).collect():
        share = F.when(F.col("label") == r["label"], next(u["n"] for u in uses if u["label"] == r["label"]) / r["n"]).otherwise(share)
    return chosen.select("features", "label", (F.col("n") * share).alias("weight"))


def train(docs: DataFrame, labelled: DataFrame | None = None, text: str = "text", path: str = "source", sample: int = SAMPLE) -> Forest:
    """A forest from labelled findings (features, label), of which ``sample`` distinct ones are used, both labels alike; from weak labels if none are given."""
    words, shapes = dictionary(docs, text), labelled is None
    if labelled is None:
        # without the fence the filters of inline() hold copies of the whole search
        labelled = weak_labels(fence(candidates(docs, words, text, path).select("__found")).select(F.inline("__found")))
    rows = _bounded(labelled, sample).select(array_to_vector("features").alias("features"), "label", "weight")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return Forest(words, prior=float(next(iter(counts), 0.0)), shapes=shapes)
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11, featureSubsetStrategy="onethird", weightCol="weight").fit(rows)
    trees = re.split(r"\n\s*Tree \d+ \(weight [\d.]+\):\n", model.toDebugString)[1:]
    return Forest(words, [_tree(tree.rstrip().split("\n")) for tree in trees], shapes=shapes)


def scan(docs: DataFrame, forest: Forest, text: str = "text", path: str = "source") -> DataFrame:
    """``docs`` without its text, with ``__parts`` and ``findings``: an array of candidate, before, after, score and secret (score of 0.5 or more)."""
    rows = candidates(docs.drop("findings", "__parts", "__found", "__c", "__m", "__lead"), forest.words, text, path)

    def judged(x: Column) -> Column:
        return F.struct(x["candidate"].alias("candidate"), x["before"].alias("before"), x["after"].alias("after"), forest.score(x["features"]).alias("score"))

    findings = F.transform(F.transform("__found", judged), lambda x: F.struct(x["candidate"].alias("candidate"), x["before"].alias("before"), x["after"].alias("after"), x["score"].alias("score"), (x["score"] >= 0.5).alias("secret")))
    return rows.withColumn("findings", findings).drop("__found", text)


def findings(docs: DataFrame, forest: Forest, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """One row per candidate: its document, its number there, its span in characters, score and verdict."""
    found = scan(docs, forest, text, path).select(F.col(key).alias("doc_id"), F.monotonically_increasing_id().alias("row"), "__parts", "findings").where(F.size("findings") > 0)
    rows = found.select("doc_id", "row", F.posexplode(F.arrays_zip(F.transform("__parts", lambda p: F.length(p)).alias("gap"), "findings")).alias("number", "x")).where("x.findings IS NOT NULL")
    rows = rows.select("doc_id", "row", "number", F.col("x.gap").alias("gap"), "x.findings.*")
    length = F.length("candidate")
    start = F.sum(F.col("gap") + length).over(Window.partitionBy("row").orderBy("number")) - length
    return rows.select("doc_id", "number", start.alias("start"), length.cast("long").alias("length"), "candidate", "score", "secret")


def redact(docs: DataFrame, forest: Forest, text: str = "text", path: str = "source", mask: str = MASK) -> DataFrame:
    """``docs`` with every secret in its text replaced by ``mask``; null texts stay null."""
    looked_at = [c for c in (text, path) if c in docs.columns]
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in looked_at]
    rows = scan(docs.select(*looked_at, F.struct(F.col(text).isNull().alias("__null"), *rest).alias("__rest")), forest, text, path)
    parts = F.col("__parts")
    pieces = F.transform("findings", lambda x, i: F.concat(F.get(parts, i), F.when(x["secret"], F.lit(mask)).otherwise(x["candidate"])))
    whole = F.when(F.size("findings") > 0, F.concat(F.array_join(pieces, ""), F.element_at(parts, -1))).otherwise(parts[0])
    masked = F.when(~F.col("__rest.__null"), whole).alias(text)
    return rows.select(*(masked if c == text else F.col(c) if c in looked_at else F.col(f"__rest.`{c}`").alias(c) for c in docs.columns))
