"""Dense document positions, and picking documents outside an excluded set.

Negative sampling asks, for every claim, for some documents that are not in the claim's
excluded set. Pairing claims with the whole corpus to find out would be a cross product, and
drawing with rejection has no bound. Here every document has a position 0..N-1, a claim with
P excluded documents draws ranks in 0..N-P-1, and rank ``r`` is turned into the position of
the r-th document outside the set: ``r`` plus the number of excluded positions before it.
Everything is an equi-join on ids or positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of the position hash that form a bucket: 16 ** 4 buckets, a fixed number, so
# the running sum over buckets stays a small single task at any corpus size.
BUCKET_DIGITS = 4

# Upper bound of position ranges per claim when ranking its excluded documents.
RANGES = 1024


def document_positions(doc_ids: DataFrame) -> DataFrame:
    """``(doc_id, position)``: rank of every document in md5 order. Ids are unique.

    The rank is taken inside hash buckets and shifted by the size of the earlier buckets, so
    no task ever sorts more than its buckets.
    """
    ids = doc_ids.select("doc_id").withColumn("_hash", F.md5("doc_id"))
    ids = ids.withColumn("_bucket", F.substring("_hash", 1, BUCKET_DIGITS))
    sizes = ids.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("_bucket").orderBy("_hash", "doc_id")
    return (
        ids.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(offsets, "_bucket")
        .select("doc_id", (F.col("_offset") + F.col("_rank")).alias("position"))
    )


def with_gaps(excluded: DataFrame, keys: list[str], n_docs: int) -> DataFrame:
    """Add ``gap`` and its ``_range`` to ``(*keys, position)``: how many allowed positions lie before it.

    A position's gap is itself minus its rank in the claim's excluded set. A claim may own a
    large share of all exclusions, so the rank is taken per range of positions and shifted by
    the claim's earlier ranges instead of in one window per claim.
    """
    width = max(1, -(-n_docs // RANGES))
    ranged = excluded.withColumn("_range", F.floor(F.col("position") / F.lit(width)))
    sizes = ranged.groupBy(*keys, "_range").agg(F.count("*").alias("_size"))
    before = (
        Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        *keys, "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy(*keys, "_range").orderBy("position")
    return (
        ranged.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(offsets, [*keys, "_range"])
        .select(
            *keys,
            "position",
            "_range",
            (F.col("position") - F.col("_offset") - F.col("_rank")).alias("gap"),
        )
    )


def pick_outside(
    picks: DataFrame, excluded: DataFrame, positions: DataFrame, keys: list[str], n_docs: int
) -> DataFrame:
    """Turn ``(*keys, rank)`` into ``(*keys, doc_id)`` outside ``excluded (*keys, position)``."""
    gaps = with_gaps(excluded, keys, n_docs).withColumnRenamed("gap", "_gap")
    # Gaps grow with the position: for a rank, ranges count whole up to some point, at most one
    # counts in part, and the rest not at all. So a claim meets its ranges (1,024 at most), and
    # only that one range's exclusions, wherever a claim with very many has them.
    ranges = gaps.groupBy(*keys, "_range").agg(
        F.count("*").alias("_size"), F.min("_gap").alias("_low"), F.max("_gap").alias("_high")
    )
    met = picks.join(ranges, keys).where(F.col("_low") <= F.col("rank"))
    whole = met.where(F.col("_high") <= F.col("rank")).select(*keys, "rank", F.col("_size").alias("_n"))
    parts = met.where(F.col("_high") > F.col("rank")).select(*keys, "rank", "_range")
    parts = parts.join(gaps, [*keys, "_range"]).where(F.col("_gap") <= F.col("rank"))
    skipped = (
        whole.unionByName(parts.select(*keys, "rank", F.lit(1).cast("long").alias("_n")))
        .groupBy(*keys, "rank")
        .agg(F.sum("_n").alias("_skipped"))
    )
    return (
        picks.join(skipped, [*keys, "rank"], "left")
        .withColumn("position", F.col("rank") + F.coalesce("_skipped", F.lit(0)))
        .join(positions, "position")
        .select(*keys, "doc_id")
    )
