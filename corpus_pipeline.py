"""Preparation of training text in five stages, each written as Parquet and read again.

Documents that the quality rules reject go, then copies, near copies (five-word shingles,
similarity 0.8 or more; the smallest id of each class stays), documents that hold a benchmark
item, and what is left is encoded. Every stage works on all rows its predecessor kept; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from claimweave.llm import bpe, decontaminate, exact_dedup, ngram_join, quality
from claimweave.llm.common import stage

# Whole texts on their way to a Python worker at a time: Spark holds each such batch several times over.
TEXTS = 1000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Vectored reads copy whole column chunks of texts through direct buffers that their threads keep.
VECTORED = "parquet.hadoop.vectored.io.enabled"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def bound_memory(spark: SparkSession) -> None:
    """Let texts reach Python ``TEXTS`` rows at a time or fewer, and read files without direct buffers."""
    rows = int(spark.conf.get(ARROW_ROWS))
    spark.conf.set(ARROW_ROWS, min(rows, TEXTS) if rows > 0 else TEXTS)
    spark.conf.set(VECTORED, "false")


def bounded(function: Stage) -> Stage:
    """``function`` under the settings of :func:`bound_memory`.

    They stay set, as the last step of a stage is computed when its result is written; ``run``
    puts them back.
    """

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_memory(spark)
        return function(spark, docs, sf_dir)

    return run_stage


@bounded
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the rules accept; they are learnt from the labelled ones among ``docs``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit_quality(quality.training_rows(docs, labels))
    return quality.scored(docs, model).where("predicted = 1").select(*docs.columns)


@bounded
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space."""
    return exact_dedup.drop_copies(docs)


@bounded
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return ngram_join.drop_similar(docs, ngram_join.JoinParams(width=5, percent=80))


@bounded
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@bounded
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and digests of them and of the text they decode to."""
    tokens = bpe.tokens(docs, public_tokenizers.path("word_bpe_49k.json"), with_decoded=False)
    return tokens.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode),
]

# Trained rules cannot be stated in SQL; the tests compare every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each is a written table.

    While they run, memory outside the heap is bounded (``bound_memory``); the settings are put back in the end.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {name: spark.conf.get(name, None) for name in (ARROW_ROWS, VECTORED)}
    bound_memory(spark)
    try:
        for name, function in STAGES:
            docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return docs
