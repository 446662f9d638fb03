"""Secret scans: candidates by character runs, false positives removed by a random forest.

A candidate is a run of 16 or more key characters, a value of any length that is assigned to
something named like a key (``=`` parts name and value) or follows Bearer or Basic, or a PEM
private key as a whole. The forest alone decides which candidates are secrets. It sees the length,
the classes of characters and how often they change, how likely the letter transitions are in the
corpus, how much of the candidate dictionary words cover, whether it is part of a path, and the
words next to it. Transitions and dictionary are counted over all documents; the dictionary is
every word of the corpus that is not rare, a table that candidates' pieces are joined with.

Tables rarely come with labelled findings. The forest learns from MADE_LINES lines that are made
from a seed, half of them with a random secret in one of its usual forms, half with something that
looks alike (digests, identifiers, paths, code, placeholders, prose); and from at most FIT_ROWS
findings of the corpus itself for each label, which weak signs label: a known prefix, a private
key, or letters and digits assigned to a strong name are secrets, other findings without any sign
are not, and the rest teaches nothing. Signs label, but have no vote. Trees are trained by Spark ML
and become arrays that column expressions walk.

Candidates are found in one pass over the texts and stored with place, value and neighbours; study,
training and judgement read that table. Everything is DataFrame functions. Null and empty texts
have no candidates. Repeated rows give repeated findings, and rows keep their number in ``redact``.
A candidate has no upper length. Names may have 40 more characters behind the word that makes them
a key's name, and parameter names 80 in all. A score of just THRESHOLD counts as a secret. Two
noncharacters that part the pieces, U+FDD0 and U+FDD1, are read as U+FFFD where a text has them.
``redact`` keeps all columns and only changes the text, and its length where a column holds it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import once, whole
from millrace.llm.made_findings import labelled_lines
from millrace.operators.joins import join_with_heavy_keys
from millrace.workspace import materialize

KEY_CHARACTERS = r"A-Za-z0-9+/_\-"
LEAST_LENGTH = 16
#: Least length of an assigned value that signs may label a secret.
LEAST_ASSIGNED = 6
#: Mean log chance of transitions below which a run is too unlikely to teach "no secret".
UNLIKELY = -4.0
#: Characters looked at before and behind a candidate.
NEAR = 48
#: Letters and occurrences that a word of the dictionary has at least.
DICTIONARY_LETTERS, DICTIONARY_TIMES = 3, 5
FIT_ROWS, MADE_LINES, MADE_WORDS = 10_000, 8_000, 200
TREES, DEPTH, BINS, SEED = 30, 10, 16, 42
THRESHOLD = 0.5
MARK = "[SECRET]"

# How names, assignments and known keys look.
STRONG = (
    "tokens?|secrets?|passwords?|passwd|passphrase|pwd|credentials?|api[_-]?key|access[_-]?key|secret[_-]?key"
    "|private[_-]?key|auth[_-]?token|bearer"
)
WEAK = "keys?|auth"
#: Words of their own, or humps of a name in camel case.
STRONG_NAME = rf"(?:(?<![A-Za-z])(?i:{STRONG})|(?<=[a-z0-9])(?:Token|Secret|Password|Passwd|Pwd|Credential|ApiKey|SecretKey))(?![a-z])"
NAMES = rf"(?:(?<![A-Za-z])(?i:{STRONG}|{WEAK})|(?<=[a-z0-9])(?:Token|Secret|Password|Passwd|Pwd|Credential|Key|Auth))(?![a-z])"
SCHEME = r"(?i:\b(?:bearer|basic)[ \t]{1,4})"
JOINT = r"[A-Za-z0-9_-]{0,40}[\"'`\]]{0,2}[ \t]{0,4}(?:=>|:=|[:=])[ \t]{0,4}"
NAMED = NAMES + JOINT
ASSIGNED = r"[:=]\W{0,4}$"
DIGEST = r"(?i:sha-?\d*|md5|commit|checksum|digest|etag|hash|revision|integrity|uuid|guid|\bid|base64)\W{0,4}$"
KNOWN = (
    r"^(?:(?:AKIA|ASIA)[A-Z0-9]{16}$|gh[pousr]_[A-Za-z0-9]{20}|github_pat_\w{20}|glpat-[\w-]{20}|sk-[\w-]{20}"
    r"|[sr]k_live_\w{16}|xox[abprs]-[A-Za-z0-9-]{10}|AIza[\w-]{35}|eyJ[\w-]{10,}\.eyJ)"
)
PEM = r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"
PEM_END = r"-----END [A-Z ]{0,30}PRIVATE KEY-----"

KEY_RUN = f"[{KEY_CHARACTERS}]{{{LEAST_LENGTH}}}"
#: Where a candidate begins, behind the text before it.
BEGIN = (
    rf"(?=[tspakbcTSPAKBC])(?:{NAMED}[\"'`]?{SCHEME}?(?=[^\s\"'`&])|{SCHEME}(?=[\w.~+/-]{{6}}))"
    rf"|(?<![{KEY_CHARACTERS}])(?={KEY_RUN})(?![{KEY_CHARACTERS}]*?{NAMED}[^\s&])|(?={PEM})|\z"
)
VALUE = "|".join([
    # Possessive loops, which Java runs without recursion however long the key is.
    rf"{PEM}(?:[A-Za-z0-9+/=\s\\:,]++|-(?!----))*+{PEM_END}",
    rf"{PEM}(?:\s{{1,4}}[A-Za-z0-9+/=]{{16,}}+)*+(?:\s{{1,4}}[A-Za-z0-9+/]{{1,15}}={{1,2}})?",
    *[rf"(?<={NAMED}{quote})[^{quote}\s]+(?={quote})" for quote in "\"'`"],
    r"eyJ[\w-]{10,}\.eyJ[\w-]{10,}\.[\w-]*",
    rf"(?<=[?&][\w.-]{{1,80}}=)(?<={NAMED})[^\s&#\"'<>]+",
    rf"(?<={NAMED}[\"'`]?|{SCHEME})[^\s\"'`<>,;]*[^\s\"'`<>,;.)\]}}]",
    rf"[{KEY_CHARACTERS}]{{{LEAST_LENGTH},}}+(?:={{1,2}}(?![{KEY_CHARACTERS}=]))?",
])
#: Text before a candidate and the candidate; both end to end are the text. No candidate begins inside
#: a run of small letters, so runs are passed at once.
PIECE = rf"(?s)((?:(?!{BEGIN})(?:[a-z]++|.))*+(?:{BEGIN}))({VALUE}|)"
#: Stand between the two, and behind them.
PART, END = "\uFDD0", "\uFDD1"
#: Letters a-z, then digits, then all else.
CODES = 28


@dataclass
class Corpus:
    """Log chances of transitions, the dictionary, and some frequent words."""

    transitions: list[float] = field(default_factory=list)
    dictionary: DataFrame | None = None
    frequent: list[str] = field(default_factory=list)


def code(character: Column) -> Column:
    point = F.ascii(character)
    return (
        F.when((point >= 97) & (point <= 122), point - 97)
        .when((point >= 48) & (point <= 57), F.lit(26)).otherwise(F.lit(27))
    )


def study(docs: DataFrame, text: str = "text") -> Corpus:
    """Count words and their letter transitions over all documents.

    The driver gets MADE_WORDS frequent words and one number for each pair of codes.
    """
    parts = F.explode(F.split(F.lower(whole(F.col(text).cast("string"))), r"[^\p{L}0-9]+"))
    words = materialize(docs.select(parts.alias("word")).groupBy("word").count(), "words")
    dictionary = words.where(F.col("word").rlike(f"^\\p{{L}}{{{DICTIONARY_LETTERS},}}$")).where(
        F.col("count") >= DICTIONARY_TIMES
    )
    frequent = dictionary.where(F.col("word").rlike("^[a-z]+$")).orderBy(F.desc("count"), "word").limit(MADE_WORDS)

    codes = F.transform(F.split("word", ""), code)
    pairs = (
        words.where("length(word) > 1")
        .select("count", once(codes=codes).alias("p")).select("count", F.col("p.codes").alias("codes"))
        .select("count", F.explode(F.zip_with(
            F.slice("codes", F.lit(1), F.size("codes") - 1), F.slice("codes", F.lit(2), F.size("codes") - 1),
            lambda a, b: a * CODES + b,
        )).alias("pair"))
        .groupBy("pair").agg(F.sum("count").alias("times")).collect()
    )
    times = [1.0] * (CODES * CODES)
    for row in pairs:
        times[row["pair"]] += row["times"]
    chances = []
    for first in range(CODES):
        line = times[first * CODES : (first + 1) * CODES]
        chances += [round(math.log(x / sum(line)), 6) for x in line]
    return Corpus(chances, dictionary.select("word"), [row["word"] for row in frequent.collect()])


FEATURES = [
    "length", "digits", "capitals", "small", "not_hex", "marks", "dashes", "class_changes", "different", "transition",
    "dictionary", "slashes", "behind_slash", "assigned", "strong", "weak", "scheme", "quoted", "digest", "prefix", "pem",
]


def features(corpus: Corpus) -> Column:
    """Numbers of a candidate (columns ``value``, ``before``, ``after``, ``covered``), as in FEATURES."""
    value, before, after = F.col("value"), F.col("before"), F.col("after")
    size = F.length(value).cast("double")
    classes = value
    for pattern, letter in (("[a-z]+", "a"), ("[A-Z]+", "B"), ("[0-9]+", "1"), ("[^aB1]+", "-")):
        classes = F.regexp_replace(classes, pattern, letter)
    share = {
        name: F.length(F.regexp_replace(value, pattern, "")) / size
        for name, pattern in (
            ("digits", "[^0-9]+"), ("capitals", "[^A-Z]+"), ("small", "[^a-z]+"), ("not_hex", "[0-9A-Fa-f]+"),
            ("marks", "[A-Za-z0-9+/=_-]+"), ("dashes", "[^_-]+"), ("slashes", "[^/]+"),
        )
    }
    characters = F.split(F.lower(value), "")
    matrix = F.lit(corpus.transitions)

    def step(state: Column, at: Column) -> Column:
        chance = F.when(state["last"] >= 0, F.get(matrix, state["last"] * CODES + at)).otherwise(0.0)
        return F.struct(at.alias("last"), (state["total"] + chance).alias("total"))

    likely = F.aggregate(
        F.transform(characters, code), F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("total")),
        step, lambda state: state["total"],
    )
    flag = {
        "behind_slash": F.endswith(before, F.lit("/")),
        "assigned": before.rlike(ASSIGNED),
        "strong": before.rlike(rf"{STRONG_NAME}{JOINT}[\"'`]?{SCHEME}?$"),
        "weak": before.rlike(rf"{NAMED}[\"'`]?{SCHEME}?$"),
        "scheme": before.rlike(f"{SCHEME}$"),
        "quoted": before.rlike("[\"'`]$") & after.rlike("^[\"'`]"),
        "digest": before.rlike(DIGEST),
        "prefix": value.rlike(KNOWN),
        "pem": value.rlike(f"^{PEM}"),
    }
    made = {
        "length": F.log(size), "class_changes": (F.length(classes) - 1) / size,
        "different": F.size(F.array_distinct(characters)) / size, "transition": likely / size,
        "dictionary": F.col("covered") / size, **share, **{name: test.cast("double") for name, test in flag.items()},
    }
    return F.array(*[made[name] for name in FEATURES])


def candidates(docs: DataFrame, keys: list[Column], text: Column) -> DataFrame:
    """The keys, ``start``, ``value``, ``before``, ``after`` and ``copies`` of each candidate; rows that
    agree in all keys are copies of one text."""
    names = [f"key_{i}" for i in range(len(keys))]
    given = F.contains(text, F.lit(PART)) | F.contains(text, F.lit(END))
    readable = F.when(given, F.translate(text, PART + END, "\uFFFD\uFFFD")).otherwise(whole(text))
    # One pass of the pattern: it marks where candidates begin and end, and the marks are cut at.
    marked = F.split(F.regexp_replace(readable, PIECE, f"$1{PART}$2{END}"), END)
    pieces = docs.select(*[key.alias(name) for key, name in zip(keys, names)], once(all=marked).alias("p")).select(
        *names, F.col("p.all").alias("pieces")
    )
    # The last piece is what stands behind the last mark: nothing. The one before it has no value.
    halves = F.transform("pieces", lambda piece: F.struct(
        F.substring_index(piece, PART, 1).alias("gap"), F.substring_index(piece, PART, -1).alias("value")
    ))
    parts = pieces.where(F.size("pieces") > 2).select(*names, once(all=halves).alias("p")).select(
        *names, F.col("p.all").alias("parts")
    )

    def candidate(part: Column, at: Column) -> Column:
        last = F.when(at > 0, F.get("parts", at - 1))
        return F.struct(
            F.length(part["gap"]).alias("skip"),
            part["value"].alias("value"),
            F.substring(F.concat_ws(
                "", F.substring(last["gap"], -NEAR, NEAR), F.substring(last["value"], -NEAR, NEAR),
                F.substring(part["gap"], -NEAR, NEAR),
            ), -NEAR, NEAR).alias("before"),
            F.substring(F.coalesce(F.get("parts", at + 1)["gap"], F.lit("")), 1, NEAR).alias("after"),
        )

    # Outer, as Spark would else test the array first by making it twice; each row has an item.
    listed = parts.select(
        *names, F.posexplode_outer(F.slice(F.transform("parts", candidate), F.lit(1), F.size("parts") - 2)).alias("at", "c")
    )
    single = listed.where("c.value <> ''").groupBy(*names, "at").agg(F.first("c").alias("c"), F.count("*").alias("copies"))
    order = Window.partitionBy(*names).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("c.skip") + F.length("c.value")).over(order)
    return single.select(
        *names, (end - F.length("c.value")).cast("int").alias("start"), "c.value", "c.before", "c.after", "copies"
    )


def covered(values: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``value`` and ``covered``: how many of its letters are in dictionary words."""
    humps = F.lower(F.regexp_replace("value", r"(?<=\p{Ll})(?=\p{Lu})", " "))
    words = F.array_distinct(F.split(humps, r"[^\p{L}]+"))
    distinct = materialize(values.select("value").distinct(), "values")
    pieces = distinct.select("value", F.explode(words).alias("word")).where(F.length("word") >= DICTIONARY_LETTERS)
    # A piece like https may stand in most values.
    met = join_with_heavy_keys(materialize(pieces, "pieces"), dictionary, ["word"], spread=["value"])
    # Each word counts as often as it stands in the value.
    times = (F.length(humps) - F.length(F.replace(humps, F.col("word"), F.lit("")))).cast("long")
    return met.groupBy("value").agg(F.least(F.sum(times), F.max(F.length("value"))).alias("covered"))


def numbered(listed: DataFrame, corpus: Corpus) -> DataFrame:
    """Candidates with ``numbers`` instead of their neighbours."""
    stored = materialize(listed, "candidates")
    cover = covered(stored, corpus.dictionary)
    # One value, as a notice in every page, may be most of the candidates.
    joined = join_with_heavy_keys(stored, cover, ["value"], "left")
    kept = [name for name in listed.columns if name not in ("before", "after")]
    return joined.withColumn("covered", F.coalesce("covered", F.lit(0))).select(*kept, features(corpus).alias("numbers"))


def label_findings(numbers: Column) -> Column:
    """Weak labels of corpus findings: 1 for what has a sign of a secret, 0 for what has none, else null."""
    at = {name: F.get(numbers, F.lit(i)) for i, name in enumerate(FEATURES)}
    mixed = (at["digits"] > 0) & (at["capitals"] + at["small"] > 0)
    long = at["length"] >= math.log(LEAST_ASSIGNED) - 1e-9
    placed = (at["strong"] > 0) & (at["marks"] == 0) & (at["dictionary"] < 0.5) & long
    sign = (at["pem"] > 0) | (mixed & ((at["prefix"] > 0) | placed))
    unsure = (mixed & (at["transition"] < UNLIKELY)) | (at["strong"] > 0) | (at["scheme"] > 0)
    return F.when(sign, 1.0).when(unsure & (at["digest"] == 0), None).otherwise(0.0)


def made_findings(docs: DataFrame, corpus: Corpus) -> DataFrame:
    """``(numbers, label)`` of the candidates in made lines."""
    lines = labelled_lines(MADE_LINES, corpus.frequent)
    made = docs.sparkSession.createDataFrame(lines, "line string, secret string")
    found = numbered(candidates(made, [F.col("line"), F.col("secret")], F.col("line")), corpus)
    label = F.when(F.col("key_1").isNull(), 0.0).when(F.col("value") == F.col("key_1"), 1.0)
    return found.select("numbers", label.alias("label")).where("label is not null")


@dataclass
class Forest:
    """Trees as arrays over all their nodes. A leaf leads to itself and has a vote."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    below: list[int] = field(default_factory=list)
    above: list[int] = field(default_factory=list)
    vote: list[float] = field(default_factory=list)
    roots: list[int] = field(default_factory=list)

    def add(self, node) -> int:
        """Take a node of Spark's tree in, and what is below it; gives its number."""
        own = len(self.feature)
        for column, start in ((self.feature, 0), (self.threshold, 0.0), (self.below, own), (self.above, own)):
            column.append(start)
        self.vote.append(float(node.prediction()))
        if node.numDescendants():
            split = node.split()
            self.feature[own], self.threshold[own] = split.featureIndex(), split.threshold()
            self.below[own], self.above[own] = self.add(node.leftChild()), self.add(node.rightChild())
        return own

    def score(self, numbers: Column) -> Column:
        """Share of trees that call a candidate a secret."""
        feature, threshold, below, above, votes = map(
            F.lit, (self.feature, self.threshold, self.below, self.above, self.vote)
        )
        steps = F.sequence(F.lit(1), F.lit(DEPTH))

        def leaf(root: Column) -> Column:
            return F.aggregate(steps, root, lambda node, _: F.when(
                F.get(numbers, F.get(feature, node)) <= F.get(threshold, node), F.get(below, node)
            ).otherwise(F.get(above, node)))

        total = F.aggregate(F.lit(self.roots), F.lit(0.0), lambda total, root: total + F.get(votes, leaf(root)))
        return total / len(self.roots)


def train(labelled: DataFrame, made: DataFrame) -> Forest:
    """A forest from findings of the corpus, at most FIT_ROWS of each label, and made ones."""
    sample = made
    for label in (0.0, 1.0):
        sample = sample.unionByName(
            labelled.where(F.col("label") == label).orderBy(F.xxhash64("numbers"), "numbers").limit(FIT_ROWS)
        )
    # Stored in one order, so that the trees come out the same again.
    sample = materialize(sample.orderBy("label", "numbers").coalesce(1), "findings")
    classifier = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, maxBins=BINS, seed=SEED, featureSubsetStrategy="onethird"
    )
    model = classifier.fit(sample.select("label", array_to_vector("numbers").alias("features")))
    forest = Forest()
    forest.roots = [forest.add(tree._call_java("rootNode")) for tree in model.trees]
    return forest


@dataclass
class Scanner:
    """Corpus counts and trees."""

    corpus: Corpus
    forest: Forest

    def judged(self, findings: DataFrame) -> DataFrame:
        """Findings with their ``score``."""
        return findings.withColumn("score", self.forest.score(F.col("numbers"))).drop("numbers")


def text_findings(docs: DataFrame, corpus: Corpus, text: str, key: str) -> DataFrame:
    """Stored findings ``(key_0, key_1, start, value, copies, numbers)``: key and text hash of their row."""
    own = F.col(text).cast("string")
    return materialize(numbered(candidates(docs, [F.col(key), F.xxhash64(own)], own), corpus), "numbered")


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id") -> tuple[Scanner, DataFrame]:
    """A scanner, and the stored findings of ``docs`` that it learned from."""
    corpus = study(docs, text)
    findings = text_findings(docs, corpus, text, key)
    # Equal findings teach once; a copied text must not outvote the others.
    labelled = findings.select("numbers").distinct().withColumn("label", label_findings(F.col("numbers")))
    return Scanner(corpus, train(labelled.select("numbers", "label"), made_findings(docs, corpus))), findings


def scan(docs: DataFrame, scanner: Scanner, text: str = "text", key: str = "doc_id", findings: DataFrame | None = None) -> DataFrame:
    """``(key, start, length, masked, sha256, score)`` for each secret; start counts characters from 0.

    ``findings``: those of ``docs``, where :func:`fit` has stored them already.
    """
    if findings is None:
        findings = text_findings(docs, scanner.corpus, text, key)
    found = scanner.judged(findings).where(F.col("score") >= THRESHOLD)
    # Of a short secret nothing is shown.
    shown = F.when(F.length("value") < LEAST_LENGTH, "").otherwise(F.left("value", F.lit(4)))
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        F.col("key_0").alias(key), "start", F.length("value").alias("length"), F.rpad(shown, 8, "*").alias("masked"),
        F.sha2("value", 256).alias("sha256"), "score",
    )


def redact(
    docs: DataFrame, scanner: Scanner, text: str = "text", length: str | None = "n_chars", key: str = "doc_id",
    findings: DataFrame | None = None,
) -> DataFrame:
    """``docs`` with each secret replaced by a mark; null texts stay null."""
    if findings is None:
        findings = text_findings(docs, scanner.corpus, text, key)
    found = scanner.judged(findings).where(F.col("score") >= THRESHOLD)
    spans = found.groupBy("key_0", "key_1").agg(
        F.array_sort(F.collect_list(F.struct("start", F.length("value").alias("size")))).alias("__spans")
    )
    own = F.col(text).cast("string")
    marked = docs.withColumn("__hash", F.xxhash64(own))
    match = F.col(key).eqNullSafe(F.col("key_0")) & (F.col("__hash") == F.col("key_1"))
    met = marked.join(spans, match, "left")

    def kept(span: Column, at: Column) -> Column:
        """What stands before a secret, from the end of the one before it."""
        last = F.get("__spans", at - 1)
        begin = F.when(at > 0, last["start"] + last["size"]).otherwise(0)
        return F.substring(own, begin + 1, span["start"] - begin)

    end = F.element_at("__spans", -1)
    rest = F.substring(own, end["start"] + end["size"] + 1, F.length(own))
    clean = F.concat(F.concat_ws(MARK, F.transform("__spans", kept)), F.lit(MARK), rest)
    fresh = F.when(F.col("__spans").isNull(), own).otherwise(clean)
    out = []
    for name, kind in docs.dtypes:
        column = F.col(f"`{name}`")
        if name == text:
            column = F.col("__clean")
        elif name == length:
            column = F.coalesce(F.length("__clean").cast(kind), column)
        out.append(column.alias(name))
    return met.withColumn("__clean", fresh).select(*out)
