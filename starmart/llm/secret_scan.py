"""Secret scan: candidates, and a random forest that takes false positives out.

A candidate is a run of at least ``MIN_LENGTH`` characters of
``[A-Za-z0-9_+/=.-]`` with a letter and a digit. Its features are

* its length;
* character transitions: the mean log probability of each character after the
  one before, from the corpus's own words (a table of 28 by 28), and the share
  of changes between letters, digits and other characters;
* dictionary coverage: the share of its letters in runs that are words of the
  corpus (seen ``MIN_SEEN`` times or more);
* its path: depth, and whether it looks like tests, documentation or settings;
* the neighbouring words: three before and one after;
* its value, what stands after the ``=`` in ``name=value``: whether it has the
  format of a known issuer, and whether a word of it is a placeholder.

The forest (Spark ML) is trained from labelled findings. ``weak_labels`` gives
labels where no reviewed findings are at hand, by a rule: a value of a known
format, or one without structure that is assigned to a credential's name or
follows ``Bearer``, is a finding unless a word of the value is a placeholder;
all else is a false positive. The forest then mostly restates that rule.
Training takes at most ``MAX_TRAINING`` findings, those with the smallest hash, half
of each label; everything else covers all data.
DataFrame functions and Spark ML only.

Defined results: a null or empty text has no candidates; equal candidates are
rows of their own, told apart by ``word_no``, the number of the
white-space-separated word they stand in; repeated rows give
repeated findings; an empty table, or labels of one kind only, give the
label's share as probability (no forest); columns other than those named
are not read.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import stage, text_of

MIN_LENGTH = 16
MIN_SEEN = 5
MAX_TRAINING = 20_000
CANDIDATE = r"[A-Za-z0-9_+/=.\-]{%d,}" % MIN_LENGTH
_SPACE = r"[\x20\x09-\x0D]+"
_LETTERS = r"\p{L}{2,30}"
CREDENTIAL = r"token|secret|passw|pwd|api.?key|auth|bearer|credential|private.?key|access.?key"
PLACEHOLDER = r"example|sample|dummy|test|placeholder|changeme|your|xxxx+"
FEATURES = (
    "length",
    "transition_logp",
    "kind_changes",
    "digit_share",
    "dictionary_share",
    "path_depth",
    "path_docs",
    "path_settings",
    "credential_before",
    "assigned",
    "quoted",
    "placeholder_near",
    "hex_only",
    "placeholder_value",
    "known_format",
)
#: Tokens that tell their issuer: AWS, GitHub, GitLab, Slack, Stripe, Google, npm, PyPI, Hugging Face, SendGrid, JWT.
KNOWN = (
    r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{36}|github_pat_[A-Za-z0-9_]{22}"
    r"|glpat-[A-Za-z0-9_-]{20}|xox[abeoprs]-[A-Za-z0-9-]{10}|[rs]k_live_[A-Za-z0-9]{16}|AIza[A-Za-z0-9_-]{35}"
    r"|npm_[A-Za-z0-9]{36}|pypi-[A-Za-z0-9_-]{16}|hf_[A-Za-z0-9]{30}|SG\.[A-Za-z0-9_-]{22}\.[A-Za-z0-9_-]{43}"
    r"|eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.)"
)
_NAME = "^(.*=)(?=[^=])"  # of ``name=value`` in one run; what pads a value is no name's
#: Of the transition table: a to z, digits, the rest.
_SYMBOLS = "abcdefghijklmnopqrstuvwxyz0-"


def candidates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source"
) -> DataFrame:
    """``doc_id, path, word_no, candidate, before, word, after``: one row a candidate."""
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(path_col).cast("string").alias("path"), text_of(text_col).alias("t")
    )
    # Most texts have none: one pass of the pattern spares them the rest.
    words = base.where(F.col("t").rlike(CANDIDATE)).withColumn("w", F.split("t", _SPACE))
    hits = F.filter(F.sequence(F.lit(1), F.size("w")), lambda i: F.element_at("w", i).rlike(CANDIDATE))
    rows = words.withColumn("i", F.explode(hits))
    i = F.col("i")
    near = rows.select(
        "doc_id",
        "path",
        i.cast("long").alias("word_no"),
        F.element_at("w", i).alias("word"),
        F.lower(F.array_join(F.slice("w", F.greatest(i - 3, F.lit(1)), F.least(i - 1, F.lit(3))), " ")).alias("before"),
        F.lower(F.coalesce(F.try_element_at("w", i + 1), F.lit(""))).alias("after"),
    )
    found = near.withColumn("candidate", F.explode(F.regexp_extract_all("word", F.lit(f"({CANDIDATE})"), 1)))
    return found.where(F.col("candidate").rlike("[0-9]") & F.col("candidate").rlike("[A-Za-z]"))


def dictionary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(piece, seen)``: words of letters, in lower case, with their counts over all texts."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(text_of(text_col)), F.lit(f"({_LETTERS})"), 1)).alias("piece"))
    return words.groupBy("piece").agg(F.count(F.lit(1)).alias("seen")).where(F.col("seen") >= MIN_SEEN)


def _symbols(text: Column) -> Column:
    lower = F.regexp_replace(F.lower(text), "[0-9]", "0")
    return F.regexp_replace(lower, "[^a-z0]", "-")


def transition_table(words: DataFrame) -> list[float]:
    """Log probabilities, row by row, of a symbol after a symbol: 28 by 28 numbers."""
    seq = words.select(_symbols(F.col("piece")).alias("s"), "seen")
    pairs = seq.select(
        F.explode(F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substring(F.col("s"), i, 2))).alias("p"),
        "seen",
    )
    counted = {r[0]: int(r[1]) for r in pairs.groupBy("p").agg(F.sum("seen")).collect()}  # 784 rows at most
    table = []
    for a in _SYMBOLS:
        total = sum(counted.get(a + b, 0) for b in _SYMBOLS)
        table += [round(math.log((counted.get(a + b, 0) + 1) / (total + len(_SYMBOLS))), 6) for b in _SYMBOLS]
    return table


def _name(candidate: Column) -> Column:
    """``name=`` of a candidate ``name=value``, else nothing."""
    return F.regexp_extract(candidate, _NAME, 1)


def _value(candidate: Column) -> Column:
    return F.regexp_replace(candidate, _NAME, "")


def features(found: DataFrame, words: DataFrame, table: list[float]) -> DataFrame:
    """Adds the columns of ``FEATURES`` to ``candidates``."""
    key = ["doc_id", "path", "word_no", "candidate", "before", "word", "after"]
    # Equal rows have equal features: one of each is worked out.
    found = stage(found.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")))
    # Dictionary coverage, once for each different candidate.
    c = F.col("candidate")
    runs = found.select("candidate").distinct().withColumn(
        "piece", F.explode(F.regexp_extract_all(F.regexp_replace(c, "([a-z])([A-Z])", "$1 $2"), F.lit("([A-Za-z]{2,})"), 1))
    )
    runs = runs.withColumn("piece", F.lower("piece")).where(F.length("piece") >= 3)
    known = runs.join(words.select("piece"), "piece", "left_semi")
    cover = stage(known.groupBy("candidate").agg(F.sum(F.length("piece")).alias("covered")))
    rows = found.join(cover, "candidate", "left")
    length = F.length(c)
    letters = F.length(F.regexp_replace(c, "[^A-Za-z]", ""))
    sym = F.col("__symbols")
    table_col = F.array(*[F.lit(x) for x in table])
    size = len(_SYMBOLS)

    symbol_no = lambda x: F.when(x == "0", 26).when(x == "-", 27).otherwise(F.ascii(x) - 97)
    numbers = F.transform(F.split(sym, ""), symbol_no)
    logs = F.transform(
        F.sequence(F.lit(1), F.length(sym) - 1),
        lambda i: F.element_at(table_col, (F.element_at("__numbers", i) * size + F.element_at("__numbers", i + 1) + 1).cast("int")),
    )
    total = F.aggregate(logs, F.lit(0.0), lambda acc, x: acc + x)
    path = F.lower(F.coalesce("path", F.lit("")))
    near = F.concat_ws(" ", "before", F.lower("word"), "after")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[A-Za-z]+", "a"), "[0-9]+", "0"), "[^a0]+", "-")
    flag = lambda cond: F.when(cond, 1.0).otherwise(0.0)
    lead = F.concat(F.expr("substring_index(word, candidate, 1)"), _name(c))
    # Words of letters: cut at other characters and where lower case turns to upper.
    value_words = F.lower(F.regexp_replace(_value(c), "([a-z])([A-Z])", "$1 $2"))
    rows = rows.withColumn("__symbols", _symbols(c)).withColumn("__numbers", numbers)
    return rows.withColumns(
        {
            "length": length.cast("double"),
            "transition_logp": total / (length - 1),
            "kind_changes": (F.length(kinds) - 1) / (length - 1),
            "digit_share": F.length(F.regexp_replace(c, "[^0-9]", "")) / length,
            "dictionary_share": F.least(F.coalesce("covered", F.lit(0)) / F.greatest(letters, F.lit(1)), F.lit(1.0)),
            "path_depth": (F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))).cast("double"),
            "path_docs": flag(path.rlike("test|example|doc|sample|fixture|mock")),
            "path_settings": flag(path.rlike(r"\.(env|ya?ml|json|ini|cfg|conf|pem|toml|properties)$")),
            "credential_before": flag(F.concat_ws(" ", "before", F.lower(lead)).rlike(CREDENTIAL)),
            "assigned": flag(F.col("before").rlike("(?:[=:]|\\bbearer)$") | lead.rlike("[=:][\"']?$")),
            "quoted": flag(lead.rlike("[\"'`]$")),
            "placeholder_near": flag(near.rlike(PLACEHOLDER)),
            "hex_only": flag(c.rlike("^[0-9A-Fa-f]+$")),
            "placeholder_value": flag(value_words.rlike(f"(?<![a-z])(?:{PLACEHOLDER})(?![a-z])")),
            "known_format": flag(c.rlike(KNOWN)),
        }
    ).drop("__symbols", "__numbers", "covered")


def weak_labels(rows: DataFrame) -> DataFrame:
    """Adds ``label``: 1 for a known format, or a value without structure after a credential's name, else 0.

    A value with dots is without structure if less than half of its letters
    are words of the corpus, which tells it from names of hosts and files.
    """
    value = _value(F.col("candidate"))
    digits = F.length(F.regexp_replace(value, "[^0-9]", "")) / F.length(value)
    dense = (F.length(value) >= MIN_LENGTH) & (digits > 0.1) & (~value.contains(".") | (F.col("dictionary_share") < 0.5))
    named = (F.col("credential_before") == 1) & (F.col("assigned") == 1) & dense
    good = (F.col("placeholder_value") == 0) & ((F.col("known_format") == 1) | named)
    return rows.withColumn("label", F.when(good, 1.0).otherwise(0.0))


def train(labelled: DataFrame, max_training: int = MAX_TRAINING, trees: int = 30, depth: int = 6, seed: int = 7):
    """A forest, or the share of label 1 where there is one kind of label only.

    At most ``max_training`` findings, half of each label, in the order of a
    hash of their features: a bounded sample that a rerun draws again.
    """
    key = F.xxhash64(F.lit(seed), "candidate", "before", "after", "word_no", "doc_id")
    parts = [
        labelled.where(F.col("label") == y).select(*FEATURES, "label", key.alias("k")).orderBy("k", *FEATURES).limit(max_training // 2)
        for y in (0.0, 1.0)
    ]
    sample = stage(parts[0].unionByName(parts[1]).coalesce(1).sortWithinPartitions("k", "label", *FEATURES))
    kinds = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    if len(kinds) < 2:
        return float(next(iter(kinds), 0.0))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="v").transform(sample.coalesce(1))
    return RandomForestClassifier(
        featuresCol="v", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, maxBins=64
    ).fit(vectors)


def score(rows: DataFrame, model) -> DataFrame:
    """Adds ``probability`` and ``is_secret`` (0.5 or more)."""
    if isinstance(model, float):
        scored = rows.withColumn("probability", F.lit(model))
    else:
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="__v").transform(rows)
        model = model.setFeaturesCol("__v").setProbabilityCol("__p").setRawPredictionCol("").setPredictionCol("")
        scored = model.transform(vectors).withColumn("probability", vector_to_array("__p")[1]).drop("__v", "__p")
    return scored.withColumn("is_secret", F.col("probability") >= 0.5)


def scan(
    docs: DataFrame,
    findings: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str = "source",
    max_training: int = MAX_TRAINING,
) -> DataFrame:
    """One row a candidate with its features, ``probability`` and ``is_secret``.

    ``findings(doc_id, word_no, candidate, label)``: reviewed findings to
    train from; without it, ``weak_labels``.
    """
    words = stage(dictionary(docs, text_col))
    rows = stage(features(candidates(docs, id_col, text_col, path_col), words, transition_table(words)))
    if findings is None:
        labelled = weak_labels(rows)
    else:
        given = findings.select("doc_id", "word_no", "candidate", F.col("label").cast("double").alias("label"))
        labelled = rows.join(given.distinct(), ["doc_id", "word_no", "candidate"])
    scored = score(rows, train(labelled, max_training))
    out = scored.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.select("doc_id", "path", "word_no", "candidate", *FEATURES, F.round("probability", 6).alias("probability"), "is_secret")
