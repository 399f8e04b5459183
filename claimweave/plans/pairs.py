"""Building labelled (claim, document) pairs for the relevance and the stance task."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.config import (
    FIELD_VARIANTS,
    PAIR_SCHEMA,
    RELEVANCE_LABELS,
    STANCE_LABELS,
    NegativeParams,
)
from claimweave.functions import text as tx
from claimweave.functions.labels import label_to_id, normalize_stance
from claimweave.operators.judgments import positive_lookup, positives_per_split
from claimweave.operators.negatives import choose_negatives
from claimweave.session import stage


def attach_texts(
    pairs: DataFrame, claims: DataFrame, corpus: DataFrame, labels: dict[str, int]
) -> DataFrame:
    """Full pair rows from staged ``(split, field_variant, query_id, doc_id, label)``.

    Sampling works on ids; texts join only here, for the sampled pairs. The corpus comes first:
    while the ids are small they are broadcast and the texts stay where they are read.
    """
    columns: dict[str, Column] = {
        "claim": F.col("claim"),
        "title": tx.clean("title"),
        "abstract": tx.clean("abstract"),
        "document_text": tx.document_text("title", "abstract", F.col("field_variant")),
        "label_id": label_to_id("label", labels),
    }
    joined = pairs.join(corpus.select("doc_id", "title", "abstract"), "doc_id").join(
        claims.select("query_id", "claim"), "query_id"
    )
    return joined.select(*[columns.get(n, F.col(n)).alias(n) for n in PAIR_SCHEMA.names])


def build_relevance_pairs(
    corpus: DataFrame,
    claims: DataFrame,
    qrels: DataFrame,
    variants: Iterable[str] = FIELD_VARIANTS,
    params: NegativeParams = NegativeParams(),
) -> DataFrame:
    """Relevant pairs of every judged claim plus its random and hard negatives.

    A negative is never a positive of the claim in any split. Inputs are
    ``corpus (doc_id, title, abstract)``, ``claims (query_id, claim)`` and
    ``qrels (split, query_id, doc_id)``; a claim without judgments yields no rows.
    """
    judged = stage(positives_per_split(qrels), "judged")
    asked = claims.join(judged, "query_id", "left_semi")
    negatives = choose_negatives(corpus, asked, positive_lookup(judged), variants, params)
    positives = tx.with_variants(judged, variants).withColumn("label", F.lit("relevant"))
    pairs = positives.unionByName(
        negatives.join(judged.select("split", "query_id").distinct(), "query_id").select(
            "split", "query_id", "doc_id", "field_variant", F.lit("not_relevant").alias("label")
        )
    )
    return attach_texts(stage(pairs, "relevance_pairs"), claims, corpus, RELEVANCE_LABELS)


def stance_positives(corpus: DataFrame, evidence: DataFrame) -> DataFrame:
    """``(split, query_id, doc_id, label)`` of evidence that takes a stance on a known document."""
    return (
        evidence.withColumn("label", normalize_stance("label"))
        .where(F.col("label").isin("SUPPORTS", "REFUTES"))
        .join(corpus.select("doc_id"), "doc_id", "left_semi")
        .select("split", "query_id", "doc_id", "label")
    )


def build_stance_pairs(
    corpus: DataFrame,
    claims: DataFrame,
    evidence: DataFrame,
    variants: Iterable[str] = FIELD_VARIANTS,
    params: NegativeParams = NegativeParams(),
) -> DataFrame:
    """SUPPORTS and REFUTES pairs of every claim with evidence, plus sampled NEI pairs.

    ``claims`` is ``(split, query_id, claim)`` and ``evidence`` ``(split, query_id, doc_id,
    label)``, one row per claim and document. NEI documents are drawn outside the claim's own
    kept evidence only; a claim whose evidence documents are all unknown still gets them.
    """
    positives = stage(stance_positives(corpus, evidence), "stance_positives")
    asked = claims.join(evidence, ["split", "query_id"], "left_semi")
    negatives = choose_negatives(corpus, asked, positives, variants, params)
    pairs = tx.with_variants(positives, variants).unionByName(
        negatives.join(asked.select("split", "query_id").distinct(), "query_id").select(
            "split", "query_id", "doc_id", "field_variant", F.lit("NEI").alias("label")
        )
    )
    texts = claims.select("query_id", "claim").dropDuplicates(["query_id"])
    return attach_texts(stage(pairs, "stance_pairs"), texts, corpus, STANCE_LABELS)
