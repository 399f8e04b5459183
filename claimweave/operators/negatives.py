"""Random and lexical hard negatives per claim."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.config import FIELD_VARIANTS, NegativeParams
from claimweave.operators import positions as pos
from claimweave.operators import tfidf
from claimweave.session import run_together, stage


def _draw(seed: int, slot: Column, upper: Column) -> Column:
    """Uniform integer in [0, upper] from the first 60 bits of md5(seed|query|slot)."""
    key = F.concat_ws("|", F.lit(str(seed)), F.col("query_id"), slot.cast("string"))
    bits = F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")
    return bits % (upper + 1)


def draw_ranks(claims: DataFrame, n_docs: int, k: int, seed: int) -> DataFrame:
    """``k`` distinct uniform ranks below ``n_docs - n_excluded`` for each claim.

    ``claims`` has ``(query_id, n_excluded)``. Slot ``i`` of ``m = min(k, available)`` draws
    below ``available - m + i`` and takes that bound itself when its draw is already there
    (Floyd's sampling), so no draw is repeated and every subset is equally likely.
    """
    available = F.lit(n_docs) - F.col("n_excluded")
    size = F.least(F.lit(k), available).cast("int")

    def add(chosen: Column, slot: Column) -> Column:
        upper = available - size + slot - 1
        draw = _draw(seed, slot, upper)
        return F.concat(
            chosen, F.array(F.when(F.array_contains(chosen, draw), upper).otherwise(draw))
        )

    ranks = F.aggregate(F.sequence(F.lit(1), size), F.array().cast("array<bigint>"), add)
    return claims.where(size > 0).select("query_id", F.explode(ranks).alias("rank"))


def random_negatives(
    claims: DataFrame,
    excluded: DataFrame,
    positions: DataFrame,
    n_docs: int,
    k: int,
    seed: int,
) -> DataFrame:
    """``k`` uniform documents per claim outside ``excluded (query_id, doc_id)``, fewer if
    there are not enough. The pick depends on seed, claim and corpus only."""
    placed = excluded.join(positions, "doc_id").select("query_id", "position")
    counts = placed.groupBy("query_id").agg(F.count("*").alias("n_excluded"))
    sized = (
        claims.select("query_id")
        .distinct()
        .join(counts, "query_id", "left")
        .select("query_id", F.coalesce("n_excluded", F.lit(0)).alias("n_excluded"))
    )
    ranks = draw_ranks(sized, n_docs, k, seed)
    return pos.pick_outside(ranks, placed, positions, ["query_id"], n_docs)


def top_outside(
    top: Callable[[DataFrame], DataFrame], claims: DataFrame, excluded: DataFrame, k: int
) -> DataFrame:
    """Top ``k`` documents per (variant, claim) outside ``excluded``.

    ``top`` gives each claim's best documents for ``(query_id, depth)``. A claim asks for ``k`` more than
    it excludes, so only rows that can matter meet the exclusions.
    """
    counts = excluded.groupBy("query_id").agg(F.count("*").alias("_n"))
    depth = claims.select("query_id").distinct().join(counts, "query_id", "left")
    depth = depth.select("query_id", (F.coalesce("_n", F.lit(0)) + k).alias("depth"))
    kept = top(stage(depth, "depth")).join(excluded, ["query_id", "doc_id"], "left_anti")
    return tfidf.top_similar(kept, k).select("field_variant", "query_id", "doc_id", "score")


def hard_negatives(
    claims: DataFrame,
    top: DataFrame,
    excluded: DataFrame,
    positions: DataFrame,
    n_docs: int,
    k: int,
    variants: Iterable[str] = FIELD_VARIANTS,
) -> DataFrame:
    """The ``k`` most similar documents per (variant, claim) outside ``excluded``.

    ``top`` is the staged result of :func:`top_outside`. A claim that shares a term with fewer
    than ``k`` allowed documents is filled with documents of score zero, all of which tie; they
    are taken in position order. Result: ``(field_variant, query_id, doc_id, score)``.
    """
    found = top.groupBy("field_variant", "query_id").agg(F.count("*").alias("_found"))
    keys = F.explode(F.array(*[F.lit(v) for v in variants])).alias("field_variant")
    lacking = (
        claims.select("query_id")
        .distinct()
        .select(keys, "query_id")
        .join(found, ["field_variant", "query_id"], "left")
        .select(
            "field_variant", "query_id", (F.lit(k) - F.coalesce("_found", F.lit(0))).alias("_lack")
        )
        .where(F.col("_lack") > 0)
    )
    if lacking.isEmpty():
        return top
    # A lacking claim's scored documents are few, so its exclusions plus what was found are
    # all that has to be stepped over.
    taken = (
        lacking.select("field_variant", "query_id")
        .join(excluded, "query_id")
        .select("field_variant", "query_id", "doc_id")
        .unionByName(
            top.join(lacking, ["field_variant", "query_id"], "left_semi").select(
                "field_variant", "query_id", "doc_id"
            )
        )
        .distinct()
        .join(positions, "doc_id")
        .select("field_variant", "query_id", "position")
    )
    used = taken.groupBy("field_variant", "query_id").agg(F.count("*").alias("_used"))
    size = F.least(F.col("_lack"), F.lit(n_docs) - F.coalesce("_used", F.lit(0))).cast("int")
    ranks = (
        lacking.join(used, ["field_variant", "query_id"], "left")
        .withColumn("_size", size)
        .where(F.col("_size") > 0)
        .select(
            "field_variant",
            "query_id",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_size").cast("bigint") - 1)).alias(
                "rank"
            ),
        )
    )
    fill = pos.pick_outside(ranks, taken, positions, ["field_variant", "query_id"], n_docs)
    return top.unionByName(fill.withColumn("score", F.lit(0.0)))


def choose_negatives(
    corpus: DataFrame,
    claims: DataFrame,
    excluded: DataFrame,
    variants: Iterable[str] = FIELD_VARIANTS,
    params: NegativeParams = NegativeParams(),
) -> DataFrame:
    """``(field_variant, query_id, doc_id, kind)`` with kind ``random`` or ``hard``.

    Random picks are the same in every variant, hard picks follow each variant's own index.
    """
    variants = tuple(variants)
    excluded = excluded.select("query_id", "doc_id").distinct()
    claims = claims.select("query_id", "claim").dropDuplicates(["query_id"])

    def sample():
        positions = stage(pos.document_positions(corpus), "positions")
        n_docs = positions.count()
        picks = random_negatives(
            claims, excluded, positions, n_docs, params.n_random, params.seed
        )
        return positions, n_docs, stage(picks, "random")

    def index():
        terms = stage(tfidf.document_terms(corpus, variants, params.stop_words), "document_terms")
        n_docs = corpus.count()
        vocabulary = tfidf.build_vocabulary(terms, n_docs, params.min_df, params.max_features)
        vectors = tfidf.claim_vectors(claims, vocabulary, params.stop_words)
        return terms, vocabulary, stage(vectors, "claim_vectors")

    by_variant = F.explode(F.array(*[F.lit(v) for v in variants])).alias("field_variant")
    if params.n_hard <= 0:
        _, _, randoms = sample()
        return randoms.select(by_variant, "query_id", "doc_id", F.lit("random").alias("kind"))
    (positions, n_docs, randoms), (terms, vocabulary, vectors) = run_together(
        corpus.sparkSession, sample, index
    )
    taken = excluded.unionByName(randoms)
    top = top_outside(
        lambda depth: tfidf.top_documents(terms, vocabulary, vectors, depth), claims, taken, params.n_hard
    )
    hard = hard_negatives(
        claims, stage(top, "hard_scored"), taken, positions, n_docs, params.n_hard, variants
    )
    return randoms.select(
        by_variant, "query_id", "doc_id", F.lit("random").alias("kind")
    ).unionByName(hard.select("field_variant", "query_id", "doc_id", F.lit("hard").alias("kind")))
