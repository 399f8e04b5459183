"""Label schemes, field variants and the tunable parameters of every job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The document fields a pair can be built from.
FIELD_VARIANTS = ("title", "abstract", "title_abstract")

# Label ids of the two tasks.
RELEVANCE_LABELS = {"not_relevant": 0, "relevant": 1}
STANCE_LABELS = {"NEI": 0, "REFUTES": 1, "SUPPORTS": 2}

# Classifier families in comparison (and tie-break) order.
CLASSIFIER_FAMILIES = (
    "logistic_regression",
    "linear_svm",
    "random_forest",
    "hist_gradient_boosting",
    "mlp",
)

SEED = 42

PAIR_SCHEMA = T.StructType(
    [
        T.StructField("split", T.StringType()),
        T.StructField("field_variant", T.StringType()),
        T.StructField("query_id", T.StringType()),
        T.StructField("doc_id", T.StringType()),
        T.StructField("claim", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("abstract", T.StringType()),
        T.StructField("document_text", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("label_id", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class NegativeParams:
    """How many negatives each claim gets, and how its lexical index is built."""

    n_random: int = 2
    n_hard: int = 2
    seed: int = SEED
    min_df: int = 2
    max_features: int = 50_000
    stop_words: tuple[str, ...] | None = None  # None = the package's English list


@dataclass(frozen=True)
class SearchParams:
    """Retrieval depth and the thresholds of the evidence summary."""

    top_k: int = 50
    top_n: int = 10
    coverage_low: float = 0.55
    coverage_ok: float = 0.65
    confidence: float = 0.6
    min_stance_docs: int = 5
    alpha: float = 0.05
    nei_share: float = 0.7
    min_density: float = 0.20
    source_url: str = "https://www.semanticscholar.org/paper/CorpusID:"


@dataclass(frozen=True)
class TrainParams:
    """Classifier settings; the defaults are the full-size experiment."""

    c: float = 1.0
    linear_iterations: int = 2000
    trees: int = 300
    tree_depth: int = 30
    boosting_rounds: int = 400
    learning_rate: float = 0.05
    boosting_depth: int = 5
    boosting_bins: int = 255
    boosting_min_leaf: int = 20
    hidden: int = 256
    mlp_iterations: int = 200
    seed: int = SEED
    families: tuple[str, ...] = CLASSIFIER_FAMILIES
