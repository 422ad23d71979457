"""Secret scans: candidate strings, and a random forest that removes false findings.

Candidates are long runs of letters, digits and a few signs that hold a digit or begin like a
well-known credential, and any value that an announcing word and ``=`` or ``:`` stand before,
whatever its length and signs: in quotes up to the closing one on its line, else up to a space, without
closing commas, quotes and brackets. Each is described
by its length and runs of character classes, by how often one class follows the other and how common its pairs of letters are in the
words beside values, by how much of it words of a dictionary cover, by path signs and by the words around it: whether these announce
and assign it, how long they are and what they consist of. The forest is trained on labelled findings;
``labelled`` makes such labels from the forms of well-known credentials and of harmless
numbers. Of such labels the forest learns by the value and does not see the words around it, as secrets are known
by these there, and a number that is announced would pass for one; findings labelled by others are learned from with these
features too. Everything is DataFrame functions and Spark's own forest; no Python runs over rows.

The dictionary holds the words of all documents that occur in ``MIN_DOCS`` of them. Training
uses at most about ``TRAIN_ROWS`` different labelled findings, chosen by a hash, and of each label a
tenth of that where there are so many; copies count once, so they change neither sample nor model.

Nulls and edge cases: a null or empty text has no finding. Repeated rows give their findings
each. A null ``doc_id`` is passed through. Without labels of both kinds in the sample the score is the
one label there is, or 1. Empty tables give an empty result. Other columns are not read by ``scan`` and are
passed through by ``redact``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.exchange import free_name, text_hash, written

MIN_DOCS = 5
TRAIN_ROWS = 20_000
TREES, DEPTH = 20, 6
THRESHOLD = 0.5
# Different parts of values that are sent to all tasks at most, and what a pair of letters counts that no neighbour has.
MOST_SENT = 200_000
RARE_PAIR = -6.0
MASK = "[secret]"

# What a candidate is, credential forms, harmless forms, and words that announce a credential.
# The shortest of SECRET_FORMS has 15 characters.
CANDIDATE = r"(?=[A-Za-z0-9+/_\-]{15})(?:(?=[A-Za-z+/_\-]*[0-9])|(?=AKIA|gh[pousr]_|sk_live_|xox[baprs]-))[A-Za-z0-9+/_\-]{15,}+"
SECRET_FORMS = r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk_live_[A-Za-z0-9]{24,}|xox[baprs]-[A-Za-z0-9-]{10,})$"
HARMLESS_FORMS = r"^(?:[0-9+/_\-]+|[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})$"
ANNOUNCING = r"(?i)(?:pass(?:word|wd)?|secret|token|api_?key|credential|auth|access_?key)"
# What stands before an announced value, up to it; the announcing word may have a plural, a number or a further part ("token_2", "secretKey").
BEFORE_VALUE = (
    r"(?i)(?:pass(?:word|wd|phrase|code)?|secret|token|api[_\-]?key|credential|auth(?:orization)?|access[_\-]?key)"
    r"(?:s|[_\-0-9][a-z0-9_\-]*|(?-i:[A-Z])[a-z0-9]*)?[\"']?\s*(?:=>|:=|=+|:)\s*(?:(?:bearer|basic)\s+)?"
)
# Each text that BEFORE_VALUE matches holds one of these in lower case; looking for them takes less than the match.
HINTS = ("pass", "secret", "token", "credential", "auth", "apikey", "api_key", "api-key", "accesskey", "access_key", "access-key")
VALUE = r"^(?:\"([^\"\n]+)\"|'([^'\n]+)'|[\"']?([^\s\"',;)\]}>](?:\S*[^\s\"',;)\]}>])?))"
ASSIGNED = r"(?i)^:|(?:pass(?:word|wd|phrase|code)?|secret|token|api[_\-]?key|credential|auth|access[_\-]?key)[a-z0-9_\-]*[\"']?:"
# A character that no text holds, put before each announced value.
MARK = "\uFDD0"
SPACES = r"[\x09-\x0D\x20]+"

FEATURES = [
    "n_chars", "n_runs", "runs_per_char", "digit_share", "upper_share", "covered_share", "path_signs", "announced", "quoted", "assigned",
    "to_digit", "to_letter", "to_upper", "to_lower", "pair_commonness",
    "rest_chars", "before_chars", "after_chars", "before_digits", "after_digits", "before_signs", "after_signs",
]

# Those that tell nothing of whether a value is announced, which ``labelled`` goes by.
BESIDE = ("announced", "assigned", "rest_chars", "before_chars", "after_chars", "before_digits", "after_digits", "before_signs", "after_signs")
FEATURES_OF_VALUE = [x for x in FEATURES if x not in BESIDE]


def candidates(documents: DataFrame) -> DataFrame:
    """``(doc_id, at, found, before, after, word)``: each candidate with its word's place and its neighbours."""
    rows = documents.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    hinted = reduce(lambda a, b: a | b, (F.contains(F.lower("text"), F.lit(x)) for x in HINTS))
    rows = rows.where((hinted & F.col("text").rlike(BEFORE_VALUE)) | F.col("text").rlike(CANDIDATE))
    marked = F.when(hinted, F.regexp_replace("text", f"({BEFORE_VALUE})(?=\\S)", f"$1{MARK}")).otherwise(F.col("text"))
    pieces = F.split(marked, MARK)
    rows = rows.select("doc_id", F.split("text", SPACES).alias("words"), pieces.alias("pieces"))
    pair = lambda at, found: F.struct(at.cast("int").alias("at"), found.alias("found"))
    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", i).rlike(CANDIDATE))
    runs = F.transform(places, lambda i: F.transform(F.regexp_extract_all(F.get("words", i), F.lit(CANDIDATE), F.lit(0)), lambda x: pair(i, x)))
    spaces = F.transform("pieces", lambda x: F.size(F.split(x, SPACES)) - 1)
    value = lambda x: F.concat(*(F.regexp_extract(x, VALUE, k) for k in (1, 2, 3)))
    place = lambda k: F.aggregate(F.slice("spaces", F.lit(1), k + 1), F.lit(0), lambda a, b: a + b)
    announced = F.transform(F.slice("pieces", F.lit(2), F.size("pieces")), lambda x, k: pair(place(k), value(x)))
    announced = F.filter(announced, lambda x: x["found"] != "")
    rows = rows.select("*", F.flatten(runs).alias("runs"), spaces.alias("spaces"))
    at = rows.select("doc_id", "words", F.explode(F.concat("runs", F.array_except(announced, "runs"))).alias("pair"))
    return at.select(
        "doc_id", F.col("pair.at").alias("at"), F.get("words", F.col("pair.at")).alias("word"),
        F.concat_ws(" ", F.get("words", F.col("pair.at") - 2), F.get("words", F.col("pair.at") - 1)).alias("before"),
        F.coalesce(F.get("words", F.col("pair.at") + 1), F.lit("")).alias("after"), F.col("pair.found").alias("found"),
    )


def value_parts(found: DataFrame) -> DataFrame:
    """``(found, part)``: the runs of letters in different values."""
    return found.select("found").distinct().select("found", F.explode(F.regexp_extract_all(F.lower("found"), F.lit("[a-z]{3,}+"), F.lit(0))).alias("part"))


def dictionary(documents: DataFrame, parts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(part)``: those of ``parts`` that ``min_docs`` documents hold as words.

    Where the different parts are few enough to be sent to all tasks, only their own words are moved, else those of all texts, combined in the tasks.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col("text").cast("string")), F.lit(r"[a-z]{3,}+"), F.lit(0)))
    words = documents.select(F.explode(words).alias("part"))
    asked = written(parts.select("part").distinct(), "parts")
    if asked.count() <= MOST_SENT:
        words = words.join(F.broadcast(asked), "part", "left_semi")
    counted = words.groupBy("part").count()
    return counted.where(F.col("count") >= min_docs).join(asked, "part", "left_semi").select("part")


def common_pairs(found: DataFrame) -> dict[str, float]:
    """How common each pair of letters is in the words beside the values, as a logarithm; no more than 26 x 26 of them."""
    beside = F.lower(F.concat_ws(" ", "before", "after"))
    pairs = found.select(F.explode(F.regexp_extract_all(beside, F.lit("(?=([a-z][a-z]))"), F.lit(1))).alias("pair")).groupBy("pair").count().collect()
    total = sum(r["count"] for r in pairs)
    return {r["pair"]: math.log10(r["count"] / total) for r in pairs}


def describe(found: DataFrame, words: DataFrame, pairs: dict[str, float]) -> DataFrame:
    """The candidates with the forest's features."""
    covered = value_parts(found).join(words, "part").groupBy("found").agg(F.sum(F.length("part")).alias("covered"))
    runs = F.col("found")
    for kind, sign in (("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "0")):
        runs = F.regexp_replace(runs, kind, sign)
    n = F.length("found")
    share = lambda column, pattern: F.length(F.regexp_replace(column, pattern, "")) / F.greatest(F.length(column), F.lit(1))
    flag = lambda c: c.cast("double")
    chars = lambda c: F.length(c).cast("double")
    changes = lambda one, other: F.regexp_count("found", F.lit(f"{one}(?={other})")) / n
    known = F.create_map(*(F.lit(x) for pair in pairs.items() for x in pair)) if pairs else F.create_map().cast("map<string,double>")
    own_pairs = F.regexp_extract_all(F.lower("found"), F.lit("(?=([a-z][a-z]))"), F.lit(1))
    common = F.aggregate(own_pairs, F.lit(0.0), lambda total, pair: total + F.coalesce(F.try_element_at(known, pair), F.lit(RARE_PAIR)))
    return found.join(covered, "found", "left").select(
        *found.columns, n.cast("double").alias("n_chars"), F.length(runs).cast("double").alias("n_runs"),
        (F.length(runs) / n).alias("runs_per_char"), share("found", "[^0-9]+").alias("digit_share"), share("found", "[^A-Z]+").alias("upper_share"),
        (F.coalesce("covered", F.lit(0)) / n).alias("covered_share"),
        F.length(F.regexp_replace("word", r"[^/.@:]+", "")).cast("double").alias("path_signs"),
        flag(F.concat_ws(" ", "before", F.replace("word", "found", F.lit(""))).rlike(ANNOUNCING)).alias("announced"),
        flag(F.contains("word", F.lit('"')) | F.contains("word", F.lit("'"))).alias("quoted"),
        flag(F.contains("word", F.lit("=")) | F.rlike("before", F.lit("(?i)[=:>](?: bearer| basic)?$")) | F.rlike("word", F.lit(ASSIGNED))).alias("assigned"),
        changes("[A-Za-z]", "[0-9]").alias("to_digit"), changes("[0-9]", "[A-Za-z]").alias("to_letter"), changes("[a-z]", "[A-Z]").alias("to_upper"), changes("[A-Z]", "[a-z]").alias("to_lower"),
        (common / F.greatest(F.size(own_pairs), F.lit(1))).alias("pair_commonness"),
        (F.length("word") - n).cast("double").alias("rest_chars"), chars("before").alias("before_chars"), chars("after").alias("after_chars"),
        share("before", "[^0-9]+").alias("before_digits"), share("after", "[^0-9]+").alias("after_digits"),
        share("before", r"[\p{L}\p{N} ]+").alias("before_signs"), share("after", r"[\p{L}\p{N} ]+").alias("after_signs"),
    )


def labelled(described: DataFrame) -> DataFrame:
    """``label`` 1 for credential forms and announced, assigned values, 0 for harmless forms and for
    values that words cover and nothing announces; the others get no label and are left out."""
    secret = F.col("found").rlike(SECRET_FORMS) | ((F.col("announced") == 1) & (F.col("assigned") == 1))
    harmless = F.col("found").rlike(HARMLESS_FORMS) | ((F.col("announced") == 0) & (F.col("covered_share") > 0.6))
    return described.withColumn("label", F.when(secret, 1.0).when(harmless, 0.0)).where("label is not null")


def training_sample(taught: DataFrame, rows: int) -> DataFrame:
    """The different rows of ``taught (found, label, ...)``, at most about ``rows`` of them, and a tenth as many of each label where there are."""
    once = written(taught.where("label is not null").dropDuplicates(), "taught")
    counts = {r["label"]: r["count"] for r in once.groupBy("label").count().collect()}
    place = F.pmod(F.xxhash64(*once.columns), F.lit(1 << 40))
    chosen = F.lit(False)
    for label, count in counts.items():
        share = min(1.0, max(rows / sum(counts.values()), rows / 10 / count))
        chosen = chosen | ((F.col("label") == label) & (place < math.ceil(share * (1 << 40))))
    return once.where(chosen)


def scan(documents: DataFrame, findings: DataFrame | None = None, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``(doc_id, at, found, score, is_secret)``: every candidate with the forest's verdict.

    ``findings`` are labelled candidates ``(found, before, after, word, label)``; without them
    ``labelled`` provides the labels.
    """
    # Written once each: features, training, its counts and the verdicts all read them.
    found = written(candidates(documents), "found")
    parts = value_parts(found) if findings is None else value_parts(found.select("found").unionByName(findings.select("found")))
    words, pairs = written(dictionary(documents, parts), "dictionary"), common_pairs(found)
    described = written(describe(found, words, pairs), "candidates")
    taught = labelled(described) if findings is None else describe(findings, words, pairs)
    features = FEATURES_OF_VALUE if findings is None else FEATURES
    sample = training_sample(taught.select("found", "label", *features), train_rows)
    labels = [r.label for r in sample.select("label").distinct().collect()]
    if len(labels) < 2:
        scored = described.withColumn("score", F.lit(float(labels[0]) if labels else 1.0))
    else:
        vectors = VectorAssembler(inputCols=features, outputCol="features")
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11, cacheNodeIds=False)
        model = forest.fit(vectors.transform(sample))
        scored = model.transform(vectors.transform(described)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", F.col("at").cast("bigint").alias("at"), "found", "score", (F.col("score") >= THRESHOLD).alias("is_secret"))


def redact(documents: DataFrame, mask: str = MASK) -> DataFrame:
    """``documents`` with the secrets found in each row's ``text`` replaced there; all rows and columns stay."""
    key, listed_as = free_name(documents, "text_hash"), free_name(documents, "secrets")
    found = scan(documents.select(text_hash().alias("doc_id"), "text")).where("is_secret").select("doc_id", "found").distinct()
    # Longest first, so that none is left in part; a list holds one text's findings and is bounded by it.
    listed = found.groupBy("doc_id").agg(F.collect_list(F.struct(-F.length("found"), "found")).alias("listed"))
    listed = listed.select(F.col("doc_id").alias(key), F.expr("transform(sort_array(listed), x -> x.found)").alias(listed_as))
    joined = documents.withColumn(key, text_hash()).join(listed, key, "left")
    # Long runs are masked wherever they stand, other values, which may be short or plain words, only where they are announced.
    exactly = lambda secret: F.concat(F.lit("\\Q"), F.replace(secret, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    announced = lambda secret: F.concat(F.lit(f"({BEFORE_VALUE}[\"']?)"), exactly(secret))
    put = "$1" + mask.replace("\\", "\\\\").replace("$", "\\$")
    masked = lambda text, secret: F.when(secret.rlike(f"^{CANDIDATE}$"), F.replace(text, secret, F.lit(mask))).otherwise(F.regexp_replace(text, announced(secret), F.lit(put)))
    clean = F.aggregate(listed_as, F.col("text").cast("string"), masked)
    return joined.withColumn("text", F.when(F.col(listed_as).isNull(), F.col("text")).otherwise(clean)).drop(key, listed_as)
