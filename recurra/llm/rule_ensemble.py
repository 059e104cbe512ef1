"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Statistics of every whole text, in one scan, by built-in column functions.
2. A random forest of shallow trees is fitted on labelled rows. Every node of a
   tree but its root is a rule: the conjunction of the comparisons on its path.
3. A logistic regression with a lasso penalty weighs the distinct rules and
   leaves most of them out.
4. The rules left become one column expression: the logistic of a weighted sum
   of comparisons. Scoring is a projection, without a join or a shuffle.

Forest and regression are Spark's own, fitted on at most ``TRAIN_ROWS`` labelled
rows, chosen by hash of the id. Statistics are computed once and written, as
both fitting and scoring read them.

Rows: a null, empty or blank text has statistics of zero, and is scored like any
other. Unlabelled rows and null labels are not learned from; with only one label
or none, every score is the share of label 1 (0.5 without labels). Repeated rows
get equal scores, an empty table gives an empty result. Very long texts count
whole. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.llm.common import BLANKS, cut, let, words

TRAIN_ROWS = 200_000
TREES, DEPTH, SEED = 24, 3, 17
LASSO = 0.001
MIN_SUPPORT = 0.005       # a rule holds for this share of the rows fitted on, or fails for it

STATISTICS = ("log_words", "word_length", "upper", "digits", "symbols", "marks", "exclaims", "bars", "distinct_words",
              "distinct_lines", "words_per_line", "closed_lines", "repeated_next")


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def statistics(text: Column) -> list[Column]:
    """The statistics of a text; shares are of its word characters, words or lines."""
    t = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.length(F.translate(t, BLANKS, "")), F.lit(1)).cast("double")
    w = words(t)
    n = F.greatest(F.size(w), F.lit(1)).cast("double")
    lines = F.filter(F.split(t, "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != "")
    n_lines = F.greatest(F.size(lines), F.lit(1)).cast("double")
    closed = F.filter(lines, lambda x: x.rlike("[.!?][\"')\\]]*\\s*$"))
    next_same = let(w, lambda v: F.size(F.filter(v, lambda x, i: x == F.get(v, i + 1))))
    upper = F.length(t) - F.length(F.regexp_replace(t, "\\p{Lu}", ""))
    values = {
        "log_words": F.log(F.size(w) + 1.0), "word_length": chars / n, "upper": upper / chars,
        "digits": _count(t, "0123456789") / chars, "symbols": _count(t, "#*$%&<>@^~=+_\\/") / chars,
        "marks": _count(t, ".,;:-'\"()") / chars, "exclaims": _count(t, "!?") / chars, "bars": _count(t, "|") / chars,
        "distinct_words": F.size(F.array_distinct(w)) / n, "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
        "words_per_line": n / n_lines, "closed_lines": F.size(closed) / n_lines, "repeated_next": next_same / n,
    }
    return [values[s].cast("double").alias(s) for s in STATISTICS]


Rule = tuple[tuple[str, str, float], ...]      # (statistic, "<=" or ">", threshold) of each comparison


def tree_rules(model) -> list[Rule]:
    """The rules of a fitted forest: for every node but the roots, the comparisons on its path."""
    rules: dict[Rule, None] = {}

    def walk(node, path: dict[tuple[str, str], float]) -> None:
        if path:
            rules[tuple(sorted((s, op, t) for (s, op), t in path.items()))] = None
        if node.getClass().getSimpleName() != "InternalNode":
            return
        split = node.split()
        name, at = STATISTICS[split.featureIndex()], split.threshold()
        walk(node.leftChild(), {**path, (name, "<="): min(at, path.get((name, "<="), math.inf))})
        walk(node.rightChild(), {**path, (name, ">"): max(at, path.get((name, ">"), -math.inf))})

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), {})
    return list(rules)


def holds(rule: Rule) -> Column:
    """A rule as a column expression over the statistics."""
    out = F.lit(True)
    for name, op, at in rule:
        out = out & ((F.col(name) <= at) if op == "<=" else (F.col(name) > at))
    return out


class RuleEnsemble:
    """Weighted rules and an intercept."""

    def __init__(self, weights: list[tuple[Rule, float]], intercept: float):
        self.weights, self.intercept = weights, intercept

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, w in self.weights:
            total = total + F.when(holds(rule), F.lit(w)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))

    def describe(self) -> list[str]:
        return [f"{w:+.3f}  " + " and ".join(f"{s} {op} {t:.4g}" for s, op, t in rule)
                for rule, w in sorted(self.weights, key=lambda x: -abs(x[1]))]

    @staticmethod
    def fit(rows: DataFrame, lasso: float = LASSO) -> "RuleEnsemble":
        """Fit on ``rows``: the statistics, and label (0 or 1)."""
        rows = cut(VectorAssembler(inputCols=list(STATISTICS), outputCol="features")
                   .transform(rows.withColumn("label", F.col("label").cast("double"))), "rule-rows")
        n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
        share = ones / n if n else 0.5
        if ones in (0, n):
            share = min(max(share, 1e-6), 1 - 1e-6)
            return RuleEnsemble([], math.log(share / (1 - share)))
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt",
                                        subsamplingRate=0.7).fit(rows)
        rules = tree_rules(forest)
        support = rows.agg(*[F.avg(holds(r).cast("double")).alias(f"r{i}") for i, r in enumerate(rules)]).first()
        rules = [r for i, r in enumerate(rules) if MIN_SUPPORT <= support[i] <= 1 - MIN_SUPPORT]
        if not rules:
            return RuleEnsemble([], math.log(share / (1 - share)))
        held = cut(rows.select("label", array_to_vector(F.array(*[holds(r).cast("double") for r in rules])).alias("features")),
                   "rule-matrix")
        fitted = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60, standardization=True).fit(held)
        weights = [(r, float(w)) for r, w in zip(rules, fitted.coefficients) if w != 0]
        return RuleEnsemble(weights, float(fitted.intercept))


def held_out(doc_id: Column) -> Column:
    """The fold that is not learned from: one id in three, by checksum."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
             label: str = "quality", rows: int = TRAIN_ROWS) -> tuple[DataFrame, RuleEnsemble]:
    """Learn from the labelled rows outside the held-out fold, and score all documents.

    Returns (scores, ensemble); scores has doc_id, held_out, score, predicted
    and the statistics.
    """
    measured = cut(docs.select(F.col(doc_id).alias("doc_id"), *statistics(F.col(text))), "text-statistics")
    known = (labels.select(F.col(doc_id).alias("of_id"), F.col(label).alias("label"))
             .where(F.col("label").isin(0, 1) & ~held_out(F.col("of_id"))))
    share = min(1.0, rows / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("of_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    ensemble = RuleEnsemble.fit(known.join(measured, F.col("of_id") == F.col("doc_id")).select("label", *STATISTICS))
    score = ensemble.score()
    return (measured.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), *STATISTICS)
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))), ensemble
