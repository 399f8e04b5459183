"""Text quality by a sparse ensemble of rules over statistics, compiled to column expressions."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.common import WHITE, stage, text_or_empty

# One test of a rule: (statistic, "<=" or ">", threshold).
Test = tuple[str, str, float]


@dataclass(frozen=True)
class QualityParams:
    """``sample_rows``: labelled rows the trees and weights are fitted on, at most."""

    sample_rows: int = 20_000
    trees: int = 12
    depth: int = 3
    penalty: float = 0.001
    iterations: int = 60
    seed: int = 11


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[tuple[Test, ...], float], ...]

    def score(self) -> Column:
        """Probability of label 1 as an expression over the columns of ``statistics``."""
        logit = F.lit(self.intercept)
        for tests, weight in self.rules:
            logit = logit + F.when(rule_column(tests), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-logit))


STATISTICS = (
    "log_chars", "letters", "uppers", "digits", "marks", "blanks", "word_length", "distinct_words", "repeats",
    "distinct_lines", "line_chars", "short_words",
)


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns ``STATISTICS``, built-in expressions over the whole text.

    Null texts are empty; every statistic of an empty text is 0 (no division by zero).
    """
    text = text_or_empty(text_col)
    base = docs.withColumns(
        {
            "_other": F.regexp_replace(text, r"\p{L}+", ""),
            "_small": F.length(F.regexp_replace(text, r"\p{Lu}+", "")),
            "_chars": F.length(text),
            "_words": F.filter(F.split(text, f"{WHITE}+"), lambda w: w != ""),
            "_lines": F.filter(F.split(text, "\n"), lambda w: w != ""),
        }
    )
    chars, words, lines = F.greatest("_chars", F.lit(1)), F.greatest(F.size("_words"), F.lit(1)), F.greatest(F.size("_lines"), F.lit(1))
    others = F.length("_other")
    digits = others - F.length(F.regexp_replace("_other", "[0-9]+", ""))
    blanks = others - F.length(F.regexp_replace("_other", f"{WHITE}+", ""))
    pairs = F.zip_with(F.col("_words"), F.slice("_words", 2, F.greatest(F.size("_words") - 1, F.lit(0))), lambda a, b: F.coalesce(a == b, F.lit(False)))
    out = {
        "log_chars": F.log1p(F.col("_chars")),
        "letters": (F.col("_chars") - others) / chars,
        "uppers": (F.col("_chars") - F.col("_small")) / F.greatest(F.col("_chars") - others, F.lit(1)),
        "digits": digits / chars,
        "marks": (others - digits - blanks) / words,
        "blanks": blanks / chars,
        "word_length": (F.col("_chars") - blanks) / words,
        "distinct_words": F.size(F.array_distinct("_words")) / words,
        "repeats": F.size(F.filter(pairs, lambda same: same)) / words,
        "distinct_lines": F.size(F.array_distinct("_lines")) / lines,
        "line_chars": F.log1p(F.col("_chars") / lines),
        "short_words": F.size(F.filter("_words", lambda w: F.length(w) <= 3)) / words,
    }
    return base.withColumns({k: c.cast("double") for k, c in out.items()}).drop("_other", "_small", "_chars", "_words", "_lines")


def rule_column(tests: tuple[Test, ...]) -> Column:
    """The conjunction of ``tests`` as a boolean expression."""
    out = F.lit(True)
    for name, sign, at in tests:
        out = out & ((F.col(name) <= at) if sign == "<=" else (F.col(name) > at))
    return out


def simplified(path: list[Test]) -> tuple[Test, ...]:
    """``path`` with one test at most for each statistic and side, in a fixed order."""
    best: dict[tuple[str, str], float] = {}
    for name, sign, at in path:
        held = best.get((name, sign), at)
        best[name, sign] = min(held, at) if sign == "<=" else max(held, at)
    return tuple((name, sign, at) for (name, sign), at in sorted(best.items()))


def tree_paths(described: str, names: tuple[str, ...]) -> list[tuple[Test, ...]]:
    """All paths from a root to an inner node or leaf in the printed form of Spark's trees."""
    found, stack = {}, []
    for line in described.splitlines():
        if m := re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            depth = len(m[1])
            stack = [(d, t) for d, t in stack if d < depth]
            stack.append((depth, (names[int(m[2])], m[3], float(m[4]))))
            found[simplified([t for _, t in stack])] = True
        elif re.match(r"\s*Tree \d+", line):
            stack = []
    return sorted(found)


def fit_quality(labelled: DataFrame, params: QualityParams = QualityParams()) -> RuleModel:
    """Rules and weights from rows ``(text, label)``, label 0 or 1; null labels teach nothing.

    At most ``sample_rows`` rows are used, those with the smallest hash of their text. Trees are
    grown on the statistics, every path becomes a rule, and logistic weights under an L1
    penalty keep few of them. With fewer than two labels the score is the share of label 1
    (1/2 without rows).
    """
    rows = labelled.where("label is not null").select(F.col("label").cast("double").alias("label"), text_or_empty().alias("text"))
    sampled = rows.withColumn("draw", F.xxhash64("text", F.lit(params.seed))).orderBy("draw", "label").limit(params.sample_rows)
    sample = stage(statistics(sampled).select("label", *STATISTICS), "quality-sample")
    ones, total = sample.agg(F.sum("label"), F.count("*")).first()
    if not total or ones in (0, total):
        share = 0.5 if not total else min(max(ones / total, 1e-3), 1 - 1e-3)
        return RuleModel(math.log(share / (1 - share)), ())

    vector = VectorAssembler(inputCols=list(STATISTICS), outputCol="x").transform(sample).select("label", "x").coalesce(4)
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="label", numTrees=params.trees, maxDepth=params.depth, seed=params.seed,
        featureSubsetStrategy="sqrt", minInstancesPerNode=5,
    ).fit(vector)
    rules = tree_paths(forest.toDebugString, STATISTICS)
    fired = sample.select("label", *[rule_column(r).cast("double").alias(f"r{k}") for k, r in enumerate(rules)]).coalesce(4)
    fired = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="x").transform(fired).select("label", "x")
    linear = LogisticRegression(
        featuresCol="x", labelCol="label", elasticNetParam=1.0, regParam=params.penalty, maxIter=params.iterations
    ).fit(fired)
    weights = linear.coefficients.toArray()
    return RuleModel(float(linear.intercept), tuple((r, float(w)) for r, w in zip(rules, weights, strict=True) if w))


def scored(docs: DataFrame, model: RuleModel, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from ``threshold`` on): one pass, no Python.

    Other columns stay, also those named like statistics. Null and empty texts are scored by
    the same rules; rows may repeat; an empty table stays empty.
    """
    stated = docs.select(F.struct("*").alias("_row"), F.col(text_col).alias("_text"))
    stated = statistics(stated, "_text").withColumn("_score", model.score())
    return stated.select(
        *[F.col("_row").getField(c).alias(c) for c in docs.columns if c not in ("score", "predicted")],
        F.col("_score").alias("score"),
        (F.col("_score") >= threshold).cast("int").alias("predicted"),
    )


def training_rows(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """``(text, label)`` of at most ``sample_rows`` labelled documents, chosen by a hash of the id.

    The chosen ids are bounded, so they are broadcast and texts never move. Of several labels
    for one id the lowest counts.
    """
    chosen = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id", F.lit(params.seed)), "doc_id").limit(params.sample_rows)
    chosen = stage(chosen.select(F.col("doc_id").alias("_id"), "label"), "quality-labels")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("text", "label")
