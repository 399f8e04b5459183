"""Loading a retrieval benchmark: corpus, claims and relevance judgments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def as_corpus(df: DataFrame, doc_id: str = "_id", title: str = "title", text: str = "text") -> DataFrame:
    """``(doc_id, title, abstract)`` with string ids."""
    return df.select(
        F.col(doc_id).cast("string").alias("doc_id"),
        F.col(title).alias("title"),
        F.col(text).alias("abstract"),
    )


def as_claims(df: DataFrame, query_id: str = "_id", text: str = "text") -> DataFrame:
    """``(query_id, claim)`` with string ids."""
    return df.select(F.col(query_id).cast("string").alias("query_id"), F.col(text).alias("claim"))


def as_qrels(
    splits: dict[str, DataFrame], query_id: str = "query-id", doc_id: str = "corpus-id"
) -> DataFrame:
    """``(split, query_id, doc_id)`` from one judgment table per split; every row is a positive."""
    parts = [
        df.select(
            F.lit(split).alias("split"),
            F.col(f"`{query_id}`").cast("string").alias("query_id"),
            F.col(f"`{doc_id}`").cast("string").alias("doc_id"),
        )
        for split, df in splits.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def load_benchmark(
    spark: SparkSession,
    corpus_path: str,
    claims_path: str,
    qrels_paths: dict[str, str],
    fmt: str = "parquet",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Corpus, claims and qrels of a benchmark stored as one table each plus qrels per split.

    JSON has its schema stated; ids may be written as numbers or strings.
    """
    reader = spark.read
    if fmt == "json":
        corpus = reader.schema("_id string, title string, text string").json(corpus_path)
        claims = reader.schema("_id string, text string").json(claims_path)
        qrels = {
            s: reader.schema("`query-id` string, `corpus-id` string").json(p)
            for s, p in qrels_paths.items()
        }
    elif fmt == "parquet":
        corpus, claims = reader.parquet(corpus_path), reader.parquet(claims_path)
        qrels = {s: reader.parquet(p) for s, p in qrels_paths.items()}
    else:
        raise ValueError(f"unknown benchmark format: {fmt}")
    return as_corpus(corpus), as_claims(claims), as_qrels(qrels)
