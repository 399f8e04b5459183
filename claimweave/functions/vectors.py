"""Column expressions on ``array<double>`` vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _doubles(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("array<double>")


def total(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product; the cosine when both sides have unit length."""
    return total(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y))


def l2_norm(c: Column | str) -> Column:
    return F.sqrt(F.aggregate(_doubles(c), F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalize(c: Column | str) -> Column:
    """Unit-length vector; the zero vector stays as it is."""
    v = _doubles(c)
    norm = l2_norm(c)
    return F.when(norm == 0, v).otherwise(F.transform(v, lambda x: x / norm))


def abs_difference(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(_doubles(a), _doubles(b), lambda x, y: F.abs(x - y))


def elementwise_product(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y)


def pair_features(q: Column | str, d: Column | str) -> Column:
    """``[q, d, |q-d|, q*d, q.d]``: 4 * dim + 1 numbers."""
    return F.concat(
        _doubles(q),
        _doubles(d),
        abs_difference(q, d),
        elementwise_product(q, d),
        F.array(dot(q, d)),
    )


def concat_features(q: Column | str, d: Column | str) -> Column:
    """``[q, d]`` only: 2 * dim numbers."""
    return F.concat(_doubles(q), _doubles(d))


def softmax(scores: Column) -> Column:
    """Probabilities from an array of scores, shifted by the maximum against overflow."""
    top = F.array_max(scores)
    exps = F.transform(scores, lambda z: F.exp(z - top))
    return F.transform(exps, lambda e: e / total(exps))


def linear_scores(
    features: Column | str, coefficients: list[list[float]], intercepts: list[float]
) -> Column:
    """``W x + b`` with literal weights, one score per class."""

    def score(weights: list[float], bias: float) -> Column:
        used = [(i, w) for i, w in enumerate(weights) if w != 0.0]
        if len(used) * 8 < len(weights):  # sparse row: read only the features it uses
            terms = [F.get(_doubles(features), F.lit(i)) * F.lit(float(w)) for i, w in used]
            out = F.lit(float(bias))
            for term in terms:
                out = out + term
            return out
        return dot(features, F.array(*[F.lit(float(w)) for w in weights])) + F.lit(float(bias))

    return F.array(*[score(w, b) for w, b in zip(coefficients, intercepts, strict=True)])
