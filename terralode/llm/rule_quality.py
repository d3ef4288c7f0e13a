"""Text quality by a sparse rule ensemble over text statistics.

Trees are grown on labelled rows; every path from a root to a node is a conjunctive
rule. A logistic model with an L1 penalty weighs the rules and drops most. What is
left is compiled into one Spark column expression, so that scoring is a scan.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from terralode.llm.common import saved

Condition = tuple[str, bool, float]  # statistic, whether it is at most (else above), threshold


@dataclass(frozen=True)
class Rules:
    """The model: ``weights`` by rule, a rule being its conditions."""

    intercept: float
    weights: dict[tuple[Condition, ...], float]


def rate(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")


def kept_length(text: Column, drop: str) -> Column:
    return F.length(F.regexp_replace(text, drop, ""))


STATISTICS = [
    "chars",
    "letters",
    "upper",
    "digits",
    "symbols",
    "stops",
    "word_length",
    "distinct_words",
    "distinct_lines",
    "words_per_line",
]


def measure(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the statistics of every row's whole text; a null text counts as empty, an empty one has all at 0."""
    text = F.col("text_")
    cut = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text_")).select(
        *keep,
        "text_",
        F.length("text_").alias("n_"),
        F.filter(F.split("text_", r"\s+"), lambda w: w != "").alias("words_"),
        F.split("text_", "\n").alias("lines_"),
        kept_length(text, r"[^\p{L}]+").alias("letters_"),
    )
    n, words, lines, letters = (F.col(c) for c in ("n_", "words_", "lines_", "letters_"))
    return cut.select(
        *keep,
        n.cast("double").alias("chars"),
        rate(letters, n).alias("letters"),
        rate(kept_length(text, r"[^\p{Lu}]+"), letters).alias("upper"),
        rate(kept_length(text, r"[^0-9]+"), n).alias("digits"),
        rate(kept_length(text, r"[\p{L}\p{N}\s.,;:'\"()-]+"), n).alias("symbols"),
        rate(kept_length(text, r"[^.,;:]+"), n).alias("stops"),
        rate(letters, F.size(words)).alias("word_length"),
        rate(F.size(F.array_distinct(words)), F.size(words)).alias("distinct_words"),
        rate(F.size(F.array_distinct(lines)), F.size(lines)).alias("distinct_lines"),
        rate(F.size(words), F.size(lines)).alias("words_per_line"),
    )


def holds(rule: tuple[Condition, ...], columns: dict[str, Column]) -> Column:
    found = F.lit(True)
    for name, at_most, threshold in rule:
        found = found & (columns[name] <= threshold if at_most else columns[name] > threshold)
    return found


def tree_paths(debug: str, names: list[str]) -> set[tuple[Condition, ...]]:
    """Every path from a root to an inner or outer node, from the forest's own description."""
    found: set[tuple[Condition, ...]] = set()
    path: list[tuple[int, Condition]] = []
    for line in debug.splitlines():
        match = re.match(r"(\s*)(If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", line)
        if match is None:
            continue
        depth = len(match.group(1))
        path = [p for p in path if p[0] < depth]
        path.append((depth, (names[int(match.group(3))], match.group(4) == "<=", float(match.group(5)))))
        found.add(tuple(sorted({c for _, c in path})))
    return found


def fit(labelled: DataFrame, trees: int = 12, depth: int = 3, penalty: float = 0.002, seed: int = 7) -> Rules:
    """Learns ``label`` (0 or 1) from the statistics of all the given rows; rows without label teach nothing.

    With rows of one label only, or none, every text gets that label's share (0.5 for none).
    """
    rows = saved(labelled.where("label in (0, 1)").select(F.col("label").cast("double").alias("label"), *STATISTICS), "labelled")
    seen = {int(r.label): r["count"] for r in rows.groupBy("label").count().collect()}
    n, ones = sum(seen.values()), seen.get(1, 0)
    if len(seen) < 2:
        return Rules(math.log((ones + 0.5) / (n - ones + 0.5)), {})
    weight = F.when(F.col("label") == 1, n / (2 * ones)).otherwise(n / (2 * (n - ones)))
    vectors = rows.select("label", weight.alias("weight"), array_to_vector(F.array(*STATISTICS)).alias("features"))
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, weightCol="weight", featureSubsetStrategy="sqrt", minInstancesPerNode=5
    ).fit(vectors)
    rules = sorted(tree_paths(forest.toDebugString, STATISTICS))
    columns = {name: F.col(name) for name in STATISTICS}
    fired = F.array(*[holds(r, columns).cast("double") for r in rules]) if rules else F.array(F.lit(0.0))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, standardization=False, weightCol="weight", maxIter=40)
    model = lasso.fit(rows.select("label", weight.alias("weight"), array_to_vector(fired).alias("features")))
    return Rules(float(model.intercept), {r: float(w) for r, w in zip(rules, model.coefficients) if w != 0.0})


def score(measured: DataFrame, model: Rules) -> DataFrame:
    """``score, predicted`` beside the statistics; ``score`` (0 to 1) is higher where label 1 is likelier.

    Rows are kept one for one; an empty text is scored like any other.
    """
    columns = {name: F.col(name) for name in STATISTICS}
    total = F.lit(model.intercept)
    for rule, weight in model.weights.items():
        total = total + F.when(holds(rule, columns), F.lit(weight)).otherwise(F.lit(0.0))
    scored = measured.withColumn("score", 1 / (1 + F.exp(-total)))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
