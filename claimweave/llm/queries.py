"""Registered queries of the text operators: each over its whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm import (
    bpe, collocations, decontaminate, exact_dedup, language, ngram_join, passages, periodic, pii, quality, secrets, sharding,
    suffix_dedup,
)
from claimweave.llm.common import id_bucket

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    return decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from three of four folds."""
    docs = table(spark, sf_dir, "documents")
    held_out = id_bucket("doc_id", 4) == 2
    model = language.fit_languages(docs.where(~held_out))
    return language.identify(docs, model, keep={"held_out": held_out}).select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document under links of at least 0.9 between sets of three-word shingles."""
    return ngram_join.jaccard_classes(table(spark, sf_dir, "documents"), ngram_join.JoinParams(width=3, percent=90))


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 shards with equal row counts (to one) and equal mixtures of sources."""
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


@query
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded texts under the public word-end vocabulary."""
    import public_tokenizers

    encoded = bpe.tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from labels of four of five folds."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = id_bucket("doc_id", 5) == 0
    model = quality.fit_quality(quality.training_rows(docs, labels.where(~held_out)))
    return quality.scored(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays for its text."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), digest_all=True)


@query
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets the forest keeps, by place and digest; the strings themselves are not repeated."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents")).where("secret")
    return found.select("doc_id", "start", "end", F.sha2("value", 256).alias("value_sha256"), "score")


@query
def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that repeat, at similarity 0.8 or more, in another document."""
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 phrases of each language whose words attract each other most."""
    return collocations.mine_phrases(table(spark, sf_dir, "documents"))


@query
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 50 bytes that stand in an earlier one."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), digest=True)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@query
def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words, and digests of all of them and of what is left without their repeats."""
    found = periodic.find_runs(periodic.seeded_repeats(table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
