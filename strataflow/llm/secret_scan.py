"""Secret scans: a random forest takes false positives out of the candidates.

Candidates are runs of sixteen or more key characters in a word. Each is described by its
length, the changes between classes of characters, the share of its letter triples that are
in a dictionary, the path around it and its neighbouring words. The forest learns from labelled findings and
gives each candidate a probability. Extraction and features are built-in functions, the
forest is Spark's own; nothing runs in Python.

Fitting uses a bounded sample: the findings that come first by hash of their document, at most
``MOST_FINDINGS`` of each label. The dictionary holds the ``DICTIONARY_SIZE`` most
frequent letter triples in the plain words of all documents; with languages given, a triple counts
by its share in the language that has it most, so small languages are covered. Candidates
are sought and judged in all documents.

Defined cases: null and empty texts have no candidate; a candidate that stands twice is found
twice, told apart by the place of its word; repeated rows are scanned each; with labels of one
kind all candidates get that kind, without any label none is a secret; other columns are left out; an
empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import words
from strataflow.session import stage

RUN = r"[A-Za-z0-9+/_\-]{16,}"
# Up to a thousand, Spark limits ranks in every task before it deals the rows out by label.
MOST_FINDINGS = 1000
DICTIONARY_SIZE = 1500
# Triples added to the count of each language, so that a few words under a stray name weigh little.
LANGUAGE_LEAST = 1000
TREES, DEPTH, SEED = 20, 6, 42
# Words that name a credential.
NAMING = "(?i)(token|secret|passw|pwd|api.?key|access.?key|auth|credential)"

FEATURES = (
    "length", "letter_digit", "case_changes", "digit_share", "upper_share", "hex", "distinct_share",
    "dictionary", "path_marks", "url", "quoted", "assigned", "named", "next_word",
)


def candidates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ``word_at`` (place of the word), ``run_at`` (place in it), ``value``, the word and its neighbours."""
    long_text = F.coalesce(F.col(text), F.lit("")).rlike(RUN)
    split = df.where(long_text).select(F.col(key), words(F.col(text)).alias("words"))

    def neighbour(i: Column, by: int) -> Column:
        return F.coalesce(F.get("words", i + by), F.lit(""))

    hits = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1),
        lambda i: (F.length(F.get("words", i)) >= 16) & F.get("words", i).rlike(RUN),
    )
    found = F.transform(
        hits,
        lambda i: F.struct(
            i.cast("long").alias("word_at"),
            F.get("words", i).alias("word"),
            F.concat_ws(" ", neighbour(i, -2), neighbour(i, -1)).alias("before"),
            neighbour(i, 1).alias("after"),
        ),
    )
    # A word beside the text always exists: a run is a part of one.
    each = split.select(key, F.explode(found).alias("hit")).select(key, "hit.*")
    runs = F.regexp_extract_all("word", F.lit(RUN), F.lit(0))
    return each.select("*", F.posexplode(runs).alias("run_at", "value"))


def triples(value: Column) -> Column:
    """Letter triples of a value, once each."""
    letters = F.lower(F.regexp_replace(value, "[^A-Za-z]+", ""))
    places = F.sequence(F.lit(1), F.length(letters) - 2)
    found = F.transform(places, lambda i: F.substring(letters, i, F.lit(3)))
    return F.when(F.length(letters) >= 3, F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def fit_dictionary(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str | None = None) -> list[str]:
    """The most frequent letter triples of the plain words of all documents, by share of a language if ``lang`` names one."""
    language = F.lit("") if lang is None else F.coalesce(F.col(lang), F.lit(""))
    each = df.select(language.alias("language"), F.explode(words(F.col(text))).alias("word"))
    plain = each.where(F.col("word").rlike("^[A-Za-z]{3,15}$")).groupBy("language", "word").count()
    found = plain.select("language", F.explode(triples(F.col("word"))).alias("triple"), "count")
    # At most 26 ** 3 triples of a language.
    counted = stage(found.groupBy("language", "triple").agg(F.sum("count").alias("count")))
    totals = counted.groupBy("language").agg((F.sum("count") + LANGUAGE_LEAST).alias("total"))
    shares = counted.join(totals, "language").groupBy("triple").agg(F.max(F.col("count") / F.col("total")).alias("share"))
    return [r["triple"] for r in shares.orderBy(F.desc("share"), "triple").limit(DICTIONARY_SIZE).collect()]


def with_features(found: DataFrame, dictionary: list[str]) -> DataFrame:
    """Candidates with a column for each feature."""
    value, word, before, after = (F.col(c) for c in ("value", "word", "before", "after"))
    length = F.length(value).cast("double")
    known = F.array(*[F.lit(t) for t in dictionary]).cast("array<string>")
    own = triples(value)
    flag = {
        "hex": value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"),
        "url": word.rlike("://|^www[.]"),
        "quoted": word.rlike("[\"'`]"),
        "assigned": word.rlike("[=:]") | before.rlike("[=:]$"),
        "named": F.concat_ws(" ", before, F.call_function("substring_index", word, value, F.lit(1))).rlike(NAMING),
        "next_word": after.rlike("^[A-Za-z]+[.,;:]?$"),
    }
    number = {
        "length": length,
        "letter_digit": F.regexp_count(value, F.lit("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])")) / length,
        "case_changes": F.regexp_count(value, F.lit("[a-z](?=[A-Z])|[A-Z](?=[a-z])")) / length,
        "digit_share": F.regexp_count(value, F.lit("[0-9]")) / length,
        "upper_share": F.regexp_count(value, F.lit("[A-Z]")) / length,
        "distinct_share": F.size(F.array_distinct(F.split(value, ""))) / length,
        "dictionary": F.when(F.size(own) > 0, F.size(F.array_intersect(own, known)) / F.size(own)).otherwise(0.0),
        "path_marks": F.regexp_count(value, F.lit("[/_-]")) / length,
    }
    columns = {name: F.when(c, 1.0).otherwise(0.0) for name, c in flag.items()} | number
    return found.withColumns({name: columns[name].cast("double") for name in FEATURES})


@dataclass(frozen=True)
class Scanner:
    """A dictionary with a forest, or with one answer where there was nothing to tell apart."""

    dictionary: list[str]
    forest: RandomForestClassificationModel | None
    constant: float = 0.0

    def judge(self, found: DataFrame) -> DataFrame:
        """Candidates with ``probability`` and ``secret``."""
        if self.forest is None:
            scored = found.withColumn("probability", F.lit(self.constant))
        else:
            described = VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(
                with_features(found, self.dictionary)
            )
            answer = vector_to_array(F.col("_probability"))[1]
            scored = self.forest.transform(described).withColumn("probability", answer)
        return scored.withColumn("secret", F.col("probability") >= 0.5)


def fit(labelled: DataFrame, dictionary: list[str], key: str = "doc_id") -> Scanner:
    """Forest from findings with a ``label`` (1 for a secret); findings without a label are left out."""
    by_hash = Window.partitionBy("label").orderBy(F.xxhash64(F.col(key)), "word_at", "run_at", "value")
    first = labelled.where(F.col("label").isNotNull()).withColumn("rank", F.row_number().over(by_hash))
    sample = stage(first.where(F.col("rank") <= MOST_FINDINGS).drop("rank"))
    kinds = [r["label"] for r in sample.select("label").distinct().collect()]
    if len(kinds) < 2:
        return Scanner(dictionary, None, float(kinds[0]) if kinds else 0.0)
    described = with_features(sample, dictionary).withColumn("label", F.col("label").cast("double"))
    # One task, as the sample is bounded, and a fixed order: the same forest in every run.
    rows = described.select("label", *FEATURES).coalesce(1).sortWithinPartitions("label", *FEATURES)
    forest = RandomForestClassifier(
        featuresCol="_features", probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_prediction",
        numTrees=TREES, maxDepth=DEPTH, seed=SEED,
    )
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(rows)
    return Scanner(dictionary, forest.fit(vectors))


def scan(
    df: DataFrame, labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str | None = None
) -> DataFrame:
    """Key, word_at, run_at, value_sha256, length, probability and secret of every candidate.

    The value itself is left out: a report of secrets must not spread them.
    """
    scanner = fit(labelled, fit_dictionary(df, key, text, lang), key)
    judged = scanner.judge(candidates(df, key, text))
    return judged.select(
        key, "word_at", "run_at", F.sha2("value", 256).alias("value_sha256"), F.length("value").alias("length"), "probability", "secret"
    )


def redacted(df: DataFrame, scanner: Scanner, mark: str = "[secret]", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and text of all rows with the values that are secrets replaced, whatever their keys."""
    # Rows are told apart by a number of their own: keys may be null or repeated.
    rows = stage(df.select(F.col(key).alias("own_key"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row")))
    found = scanner.judge(candidates(rows, "row", "text")).where("secret").select("row", "value").distinct()
    values = found.groupBy("row").agg(F.sort_array(F.collect_set("value"), False).alias("values"))
    joined = rows.join(values, "row", "left")
    clean = F.aggregate(F.col("values"), F.col("text"), lambda t, v: F.replace(t, v, F.lit(mark)))
    return joined.select(F.col("own_key").alias(key), F.when(F.col("values").isNull(), F.col("text")).otherwise(clean).alias(text))
