"""Mean and spread of feature columns."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def feature_moments(rows: DataFrame, features: str) -> DataFrame:
    """``(position, mean, std)`` of an array column, std over the population.

    One pass keeps a single running summary per task; the arrays are never exploded.
    """
    summary = rows.select(
        Summarizer.metrics("mean", "variance", "count")
        .summary(array_to_vector(F.col(features).cast("array<double>")))
        .alias("s")
    )
    n = F.col("s.count").cast("double")
    arrays = summary.select(
        vector_to_array("s.mean").alias("means"), vector_to_array("s.variance").alias("vars"), n.alias("n")
    )
    zipped = F.posexplode(F.arrays_zip("means", "vars"))
    return arrays.select(zipped.alias("position", "m"), "n").select(
        "position",
        F.col("m.means").alias("mean"),
        F.sqrt(F.col("m.vars") * (F.col("n") - 1) / F.col("n")).alias("std"),
    )
