"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.common import WHITE, small, stage, text_or_empty

PREFIX_CHARS = 256


def normalised(text: str = "text") -> Column:
    """The text without any white space; null is empty."""
    return F.regexp_replace(text_or_empty(text), f"{WHITE}+", "")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``(id, keep_id, group_size, kept, text_sha256)``.

    Texts are equal when they are identical without white space. The row with the most code
    points in the original text stays, then the one with the smallest id (a null id last).
    ``text_sha256`` is null where a cheaper step already told the text apart from all others;
    ``digest_all`` fills it there too.

    One scan keeps length and prefix hash of each text. Lengths that occur once are out, then
    prefixes that occur once at their length; only ids of what survives are read again for the
    full hash. Groups are counted and their best row found by aggregation before they meet
    their rows, so a group with a third of all rows is never gathered.

    Null and empty texts are equal to each other and to texts of white space alone. Rows with
    the same id and text are members like any others, and one of them stays. An empty table
    gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    plain = rows.select("doc_id", normalised().alias("norm"))
    probes = stage(
        plain.select("doc_id", F.length("norm").alias("size"), F.xxhash64(F.substring("norm", 1, PREFIX_CHARS)).alias("head")),
        "dedup-probes",
    )
    sizes = probes.groupBy("size").count().where("count > 1").select("size")
    same_size = probes.join(sizes, "size", "left_semi")
    heads = same_size.groupBy("size", "head").count().where("count > 1").select("size", "head")
    ids = stage(same_size.join(heads, ["size", "head"], "left_semi").select(F.col("doc_id").alias("again")).distinct(), "dedup-ids")
    again = small(ids.withColumn("hit", F.lit(True)), ids.count())

    full = rows.join(again, F.col("doc_id").eqNullSafe(F.col("again")), "left").select(
        "doc_id",
        F.length(text_or_empty()).alias("points"),
        F.coalesce("hit", F.lit(False)).alias("shared"),
        F.monotonically_increasing_id().alias("row"),
        (F.sha2(normalised(), 256) if digest_all else F.when(F.col("hit"), F.sha2(normalised(), 256))).alias("text_sha256"),
    )
    full = stage(full, "dedup-full")
    shared = full.where("shared")
    best = F.min(F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("n"), F.col("doc_id"), F.col("row")))
    groups = shared.groupBy("text_sha256").agg(F.count("*").alias("group_size"), best.alias("best"))
    members = shared.join(groups, "text_sha256").select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )
    alone = full.where("not shared").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    return members.unionByName(alone)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept.

    Rows are found again by id, and where an id occurs on several rows also by text.
    """
    groups = stage(exact_groups(docs, id_col, text_col), "dedup-groups")
    repeated = groups.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_again"))
    repeated = stage(repeated, "dedup-repeated")
    several = repeated.count()
    gone = groups.where("not kept").select(F.col("doc_id").alias("_gone"))
    gone = stage(gone.unionByName(repeated.select(F.col("_again").alias("_gone"))).distinct(), "dedup-gone")
    out = docs.join(small(gone, gone.count()), F.col(id_col).eqNullSafe(F.col("_gone")), "left_anti")
    if not several:
        return out
    again = docs.join(small(repeated, several), F.col(id_col).eqNullSafe(F.col("_again")), "left_semi")
    again = again.withColumn("_digest", F.sha2(normalised(text_col), 256))
    lost = groups.where("not (doc_id <=> keep_id)").select(F.col("doc_id").alias("_lost"), F.col("text_sha256").alias("_sha")).distinct()
    again = again.join(lost, F.col(id_col).eqNullSafe(F.col("_lost")) & (F.col("_digest") == F.col("_sha")), "left_anti")
    return out.unionByName(again.dropDuplicates([id_col, "_digest"]).drop("_digest"))
