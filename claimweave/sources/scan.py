"""Reading tables so that small inputs still use every core."""

from __future__ import annotations

from pyspark.sql import DataFrame

# A scan below this size may be redistributed; larger ones have splits of their own.
SPREAD_LIMIT = 1 << 30
SPLIT_BYTES = 128 << 20


def scan_bytes(df: DataFrame) -> int:
    """The planner's size estimate of ``df``."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small scan over all cores.

    A file with one row group is one task however many cores there are. Inputs large enough
    to have a split per core are left alone, so big tables are never shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if scan_bytes(df) < min(SPREAD_LIMIT, cores * SPLIT_BYTES):
        return df.repartition(cores)
    return df
