"""Shards that all match the mixture of sources: proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.llm.common import stage, text_or_empty

# Rows that one task ranks at a time; the number of ranges follows the number of rows.
RANGE_ROWS = 10_000


def _within(rows: DataFrame, keys: list[str], order: list[Column], out: str) -> DataFrame:
    """``out``: rank from 1 by ``order`` among rows equal in ``keys[:-1]``.

    ``keys[-1]`` numbers ranges that already follow ``order``: rows are ranked inside a range
    and shifted by the rows in the ranges before it, so no group is ranked in one task.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.join(counts, same).select(*rows.columns, (F.col("_before") + F.col("_rank")).alias(out))


def assign_shards(
    docs: DataFrame, shards: int = 16, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """``(doc_id, source, size, text_crc32, shard, slot)`` for every row of ``docs``.

    Rows are shuffled within each source by a seeded hash of their id, given the fractional
    rank ``(rank - 1/2) / rows of the source``, sorted by it over all sources, and cut into
    ``shards`` runs whose row counts differ by at most one. A shard so holds each source in
    proportion, to within a row or two per source. ``slot`` counts from 0 within a shard.

    Every ranking is done in ranges of about ``RANGE_ROWS`` rows of the hash (then of the
    fractional rank), so a source with a third of all rows is ranked by many tasks. Null
    sources are a source of their own; a null text has size 1 and the checksum of an empty
    one; equal ids are ordered by size and checksum. With fewer rows than shards some shards
    are empty, and an empty table gives an empty result. Other columns are ignored.
    """
    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string"))).alias("draw"),
    )
    rows = stage(rows, "shard-rows")
    total = rows.count()
    ranges = -(-total // RANGE_ROWS) or 1

    ties = [F.col("doc_id"), F.col("size"), F.col("text_crc32")]
    part = F.floor(F.conv(F.substring("draw", 1, 8), 16, 10).cast("double") * ranges / float(2**32))
    ranked = _within(rows.withColumn("part", part), ["source", "part"], [F.col("draw"), *ties], "rank")
    sizes = rows.groupBy(F.col("source").alias("_source")).agg(F.count("*").alias("_rows"))
    ranked = ranked.join(sizes, F.col("source").eqNullSafe(F.col("_source")))
    ranked = ranked.withColumn("fraction", (F.col("rank") - 0.5) / F.col("_rows"))
    ranked = ranked.withColumn("all", F.lit(0)).withColumn("slice", F.floor(F.col("fraction") * ranges))
    order = [F.col("fraction"), F.col("draw"), *ties, F.col("source")]
    placed = _within(ranked, ["all", "slice"], order, "place")

    placed = placed.withColumn("shard", F.expr(f"((place - 1) * {shards}) div {max(total, 1)}"))
    slot = F.expr(f"place - 1 - ((shard * {total} + {shards - 1}) div {shards})")
    return placed.select("doc_id", "source", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), slot.alias("slot"))
