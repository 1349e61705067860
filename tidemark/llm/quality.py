"""Quality classifier: a sparse rule ensemble over text statistics.

A small random forest is grown on labelled documents; every path from a root to
a node is a conjunction of threshold tests, a *rule*. A logistic regression
with an L1 penalty weighs the rules and most weights become zero. The rules
left are compiled to Spark column expressions, so scoring is one projection
over the text: no model object, no Python on the executors, no shuffle.

Training reads a bounded sample of the labelled rows (``TRAIN_ROWS``, those
whose ids have the smallest hashes); scoring reads every document.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, held_out, read_documents, read_labels, saved, text_of

TRAIN_ROWS = 20_000    # bound on the labelled rows a model is fitted on
TREES, DEPTH = 24, 3
LASSO = 0.002
SEED = 11
HELD_OUT = (3, 1)      # labels of documents whose crc32 leaves 1 by 3 are not learned from

Test = tuple[str, bool, float]   # feature, whether it is at most the threshold, threshold
Rule = tuple[Test, ...]


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text; all are 0 for an empty one."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n = F.greatest(F.size(words), F.lit(1)).cast("double")
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")

    def per(pattern: str, of: Column) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / of

    return {
        "log_words": F.log1p(F.size(words).cast("double")),
        "word_length": F.length(text) / n,
        "distinct_words": F.size(F.array_distinct(words)) / n,
        "upper": per(r"\p{Lu}", chars),
        "digits": per(r"[0-9]", chars),
        "symbols": per(r"[^\p{L}\p{N}\s.,]", n),
        "stops": per(r"[.,]", n),
        "lines": per(r"\n", n),
        "doubled": per(r"([^\p{L}\p{N}\s])\1", n),
    }


FEATURES = ("log_words", "word_length", "distinct_words", "upper", "digits", "symbols", "stops", "lines", "doubled")


def with_statistics(rows: DataFrame) -> DataFrame:
    """``rows`` with a ``stats`` struct made from its ``text`` (null: empty)."""
    stats = statistics(text_of())
    return rows.withColumn("stats", F.struct(*[stats[n].cast("double").alias(n) for n in FEATURES]))


def tree_rules(model) -> list[Rule]:
    """Paths from the root to every other node of the forest's trees, each once."""
    found: dict[Rule, None] = {}

    def walk(node, path: dict[tuple[str, bool], float]) -> None:
        if path:
            found[tuple((f, low, t) for (f, low), t in sorted(path.items()))] = None
        if node.getClass().getSimpleName() != "InternalNode":
            return
        split = node.split()
        name, at = FEATURES[split.featureIndex()], float(split.threshold())
        # A later test on the same side of a feature is the narrower one.
        walk(node.leftChild(), path | {(name, True): at})
        walk(node.rightChild(), path | {(name, False): at})

    for tree in model.trees:
        walk(tree._call_java("rootNode"), {})
    return list(found)


def compiled(rule: Rule) -> Column:
    """A rule as a column: 1.0 where all its tests hold, else 0.0."""
    tests = [F.col(f"stats.{f}") <= t if low else F.col(f"stats.{f}") > t for f, low, t in rule]
    return F.when(reduce(Column.__and__, tests), 1.0).otherwise(0.0)


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """(label, stats) of at most ``most`` labelled documents that are not held out.

    A document labelled more than once gets the majority, a tie counts as 1; of
    texts that share an id the one with the smallest statistics is taken.
    """
    known = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(*HELD_OUT))
             .groupBy(F.col("doc_id").alias("id")).agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
             .orderBy(F.xxhash64("id"), "id").limit(most))
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("id"))
    return with_statistics(rows).groupBy("id", "label").agg(F.min("stats").alias("stats")).select("label", "stats")


class RuleModel:
    """Weighted rules; ``score`` is a column over ``stats``."""

    def __init__(self, bias: float, weights: list[tuple[Rule, float]]):
        self.bias, self.weights = bias, weights

    def score(self) -> Column:
        total = reduce(Column.__add__, [compiled(r) * w for r, w in self.weights], F.lit(float(self.bias)))
        return 1.0 / (1.0 + F.exp(-total))


def fit(rows: DataFrame, seed: int = SEED) -> RuleModel:
    """Fit on (label, stats) rows. With one class only, or no rows, the score is a constant."""
    rows = saved(rows, "quality-train").coalesce(2)
    n, ones = rows.agg(F.count("*"), F.sum("label")).first()
    if not n or ones in (0, n):
        share = (ones + 0.5) / (n + 1) if n else 0.5
        return RuleModel(math.log(share / (1 - share)), [])
    ordered = rows.orderBy("label", "stats")
    flat = ordered.select("label", array_to_vector(F.array(*[F.col(f"stats.{f}") for f in FEATURES])).alias("features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="onethird",
                                    minInstancesPerNode=10).fit(flat)
    rules = tree_rules(forest)
    if not rules:
        return RuleModel(math.log(ones / (n - ones)), [])
    held = ordered.select("label", array_to_vector(F.array(*[compiled(r) for r in rules])).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False).fit(held)
    weights = [(r, float(w)) for r, w in zip(rules, lasso.coefficients) if w != 0.0]
    return RuleModel(float(lasso.intercept), weights)


def score_documents(docs: DataFrame, model: RuleModel) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. Null text counts as
    empty; a null id is not held out; repeated rows each get their row."""
    rows = with_statistics(docs.select("doc_id", "text")).withColumn("score", model.score())
    return rows.select("doc_id", held_out(*HELD_OUT).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    docs = read_documents(spark, sf_dir)
    return score_documents(docs, fit(training_rows(docs, read_labels(spark, sf_dir))))
