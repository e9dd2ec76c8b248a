"""Quality scores from a sparse ensemble of rules over text statistics.

Decision trees of a random forest are cut into their paths; each path from a root is a rule, a
conjunction of bounds on statistics.  A logistic regression with an L1 penalty on the rules'
indicators keeps a few of them, and those become one Spark column expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.tables import held_out, written
from zonepulse.llm.training import TRAIN_ROWS, labelled_sample

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
TREES, DEPTH = 30, 4
L1_PENALTY = 5e-4

# Names of the statistics, in the order of the feature vector.
STATISTICS = [
    "chars", "words", "lines", "word_chars", "upper_share", "digit_share", "symbol_share",
    "mark_share", "pipe_share", "non_ascii_share", "distinct_word_share", "distinct_line_share",
    "symbol_word_share", "line_chars", "stop_share", "longest_word",
]


def _count(text: Column, pattern: str) -> Column:
    """Characters of the text that belong to a class."""
    return F.length(text) - F.length(F.regexp_replace(text, F.lit(pattern), F.lit("")))


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and one double column per statistic; a null text counts as empty."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    base = docs.select(
        *keep, text.alias("_t"), F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " ").alias("_w"),
        F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "").alias("_l"))
    t, n = F.col("_t"), F.greatest(F.length("_t"), F.lit(1))
    words, lines = F.size("_w"), F.greatest(F.size("_l"), F.lit(1))
    values = {
        "chars": F.log1p(F.length(t)),
        "words": F.log1p(words),
        "lines": F.log1p(lines),
        "word_chars": F.length(t) / F.greatest(words, F.lit(1)),
        "upper_share": _count(t, r"\p{Lu}+") / n,
        "digit_share": _count(t, r"[0-9]+") / n,
        "symbol_share": _count(t, r"[#$%&*@^~<>{}\[\]\\|=+_/]+") / n,
        "mark_share": _count(t, r"[!?]+") / n,
        "pipe_share": _count(t, r"\|+") / n,
        "non_ascii_share": _count(t, r"[^\x00-\x7f]+") / n,
        "distinct_word_share": F.size(F.array_distinct("_w")) / F.greatest(words, F.lit(1)),
        "distinct_line_share": F.size(F.array_distinct("_l")) / lines,
        "symbol_word_share": F.size(F.regexp_extract_all(
            t, F.lit(r"\p{L}[^\p{L}\p{N}\s]{2,}"), F.lit(0))) / F.greatest(words, F.lit(1)),
        "line_chars": F.log1p(F.length(t) / lines),
        "stop_share": F.size(F.regexp_extract_all(
            t, F.lit(r"(?<!\S)\p{Ll}{1,3}(?!\S)"), F.lit(0))) / F.greatest(words, F.lit(1)),
        "longest_word": F.log1p(F.array_max(F.transform("_w", F.length))),
    }
    return base.select(*keep, *[values[s].cast("double").alias(f"q_{s}") for s in STATISTICS])


@dataclass(frozen=True)
class Bound:
    statistic: str
    above: bool
    value: float

    def column(self) -> Column:
        c = F.col(f"q_{self.statistic}")
        return c > self.value if self.above else c <= self.value

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.value:.6g}"


Rule = tuple[Bound, ...]


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """Probability of label 1 over the statistics' columns, as one expression."""
        terms = [F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
                 for rule, weight in self.rules]
        total = F.lit(self.intercept)
        for term in terms:
            total = total + term
        return 1.0 / (1.0 + F.exp(-total))


def holds(rule: Rule) -> Column:
    condition = rule[0].column()
    for bound in rule[1:]:
        condition = condition & bound.column()
    return condition


def _tightened(path: list[Bound]) -> Rule:
    """The path with one bound per statistic and direction, in a fixed order."""
    least: dict[tuple[str, bool], float] = {}
    for b in path:
        key = (b.statistic, b.above)
        known = least.get(key)
        least[key] = b.value if known is None else (max if b.above else min)(known, b.value)
    return tuple(Bound(s, above, v) for (s, above), v in sorted(least.items()))


def _paths(node, path: list[Bound]) -> list[Rule]:
    """All paths from a tree's root to its nodes, the root itself left out."""
    found = [_tightened(path)] if path else []
    if node.subtreeDepth() > 0:
        split = node.split()
        name, value = STATISTICS[split.featureIndex()], float(split.threshold())
        found += _paths(node.leftChild(), [*path, Bound(name, False, value)])
        found += _paths(node.rightChild(), [*path, Bound(name, True, value)])
    return found


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, seed: int = 7) -> RuleModel:
    """Fit on about ``rows`` labelled documents at most, none of them held out.

    With labels of one kind only, every text gets that kind's share; without labels, a half.
    """
    allowed = ~held_out(F.col("doc_id"), FOLDS, HELD_OUT)
    sample = labelled_sample(docs, labels, "quality", allowed, rows)
    stats = written(with_statistics(sample, ["y"]), "quality-sample")
    n, ones = stats.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    if ones in (0, n):
        share = min(max((ones + 0.5) / (n + 1), 0.0), 1.0)
        return RuleModel(math.log(share / (1 - share)), ())
    vectors = VectorAssembler(inputCols=[f"q_{s}" for s in STATISTICS], outputCol="features")
    forest = RandomForestClassifier(labelCol="y", numTrees=TREES, maxDepth=DEPTH, seed=seed,
                                    featureSubsetStrategy="sqrt", subsamplingRate=0.5,
                                    ).fit(vectors.transform(stats).select("y", "features"))
    rules = sorted({rule for tree in forest.trees
                    for rule in _paths(tree._call_java("rootNode"), [])}, key=str)
    if not rules:
        share = ones / n
        return RuleModel(math.log(share / (1 - share)), ())
    indicators = stats.select("y", *[holds(r).cast("double").alias(f"r{i}")
                                     for i, r in enumerate(rules)])
    as_vector = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features")
    lasso = LogisticRegression(labelCol="y", elasticNetParam=1.0, regParam=L1_PENALTY,
                               standardization=False, maxIter=60,
                               ).fit(written(as_vector.transform(indicators).select("y", "features"),
                                             "quality-rules"))
    kept = [(rules[i], float(w)) for i, w in enumerate(lasso.coefficients) if w != 0.0]
    return RuleModel(float(lasso.intercept), tuple(kept))


def score_documents(docs: DataFrame, model: RuleModel) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Null texts count as empty and are scored by the same rules.  Rows are kept as they are,
    repeated ones and null ids too; other columns are not looked at.
    """
    scored = with_statistics(docs, ["doc_id"]).select("doc_id", model.score().alias("score"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
