"""Approximate dense top-k retrieval: vectors in buckets of random projections."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimweave.operators.retrieval import CELLS, CLAIM_BLOCK, HIT_SCHEMA, BlockTopK, _matrix, cosine_top_k
from claimweave.session import stage


@dataclass(frozen=True)
class ProjectionParams:
    """``tables`` bucketings, each by the sides of ``planes`` random planes a vector lies on.

    A claim looks into the buckets within ``radius`` changed sides of its own, in every table.
    The radius is fitted: the least that holds ``target`` of the exact hits of at most ``sample``
    claims (a bound of the fit alone; every vector is indexed and every claim answered).
    """

    tables: int = 8
    planes: int = 10
    seed: int = 7
    target: float = 0.97
    sample: int = 200


def _planes(width: int, params: ProjectionParams) -> np.ndarray:
    return np.random.default_rng(params.seed).normal(size=(width, params.tables * params.planes))


def bucket_codes(vectors: np.ndarray, params: ProjectionParams) -> np.ndarray:
    """The bucket of every vector (row) in every table (column)."""
    if not len(vectors):
        return np.zeros((0, params.tables), np.int32)
    sides = (vectors @ _planes(vectors.shape[1], params) > 0).reshape(len(vectors), params.tables, params.planes)
    return (sides @ (1 << np.arange(params.planes))).astype(np.int32)


def with_buckets(vectors: DataFrame, id_col: str, params: ProjectionParams) -> DataFrame:
    """``(id, embedding, buckets)`` of the rows with a vector: the index, made where rows are read."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = bucket_codes(_matrix(batch.column("embedding")), params)
                ends = np.arange(0, codes.size + 1, params.tables, dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(codes.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "buckets"])

    rows = vectors.where(F.col("embedding").isNotNull()).select(F.col(id_col).cast("string").alias(id_col), "embedding")
    kind = rows.schema["embedding"].dataType.simpleString()
    return rows.mapInArrow(index, f"{id_col} string, embedding {kind}, buckets array<int>")


def fit_radius(claims: DataFrame, index: DataFrame, k: int, params: ProjectionParams) -> int:
    """The least number of changed sides that holds ``target`` of the exact hits of a sample of claims."""
    some = stage(claims.orderBy(F.xxhash64("query_id"), "query_id").limit(params.sample), "projection-sample")
    exact = cosine_top_k(some, index, k).select("query_id", "doc_id")
    pairs = index.select("doc_id", F.col("buckets").alias("theirs")).join(exact, "doc_id")
    pairs = pairs.join(some.select("query_id", "buckets"), "query_id")
    apart = F.array_min(F.zip_with("buckets", "theirs", lambda a, b: F.bit_count(a.bitwiseXOR(b))))
    counts = dict(pairs.groupBy(apart.alias("apart")).count().collect())  # at most planes + 1 rows
    total = sum(counts.values())
    held = 0
    for radius in range(params.planes + 1):
        held += counts.get(radius, 0)
        if held >= params.target * total:
            return radius
    return params.planes


def _candidates(codes: np.ndarray, theirs: np.ndarray, changes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``(claim, vector)`` that share a bucket in some table, up to ``changes`` of sides."""
    met = np.zeros((len(codes), len(theirs)), bool)
    for t in range(codes.shape[1]):
        order = np.argsort(theirs[:, t], kind="stable")
        many = np.bincount(theirs[:, t], minlength=size)
        start = np.cumsum(many) - many
        for change in changes:  # one bucket of each claim at a time
            seen = codes[:, t] ^ change
            claim = np.repeat(np.arange(len(codes)), many[seen])
            first = np.repeat(start[seen] - np.cumsum(many[seen]) + many[seen], many[seen])
            met[claim, order[first + np.arange(len(claim))]] = True
    return np.nonzero(met)


def _score_buckets(claims: DataFrame, index: DataFrame, k: int, radius: int, params: ProjectionParams, decimals: int) -> DataFrame:
    """The best ``k`` candidates of each task for a block of claims, which is broadcast."""
    table = claims.select("query_id", "embedding", "buckets").toArrow()
    ids = np.array(table["query_id"].to_pylist(), dtype=object)
    shared = claims.sparkSession.sparkContext.broadcast((ids, _matrix(table["embedding"]), _matrix(table["buckets"]).astype(np.int32)))
    size = 1 << params.planes
    changes = np.array([c for c in range(size) if c.bit_count() <= radius], np.int32)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim_ids, matrix, codes = shared.value
        top = BlockTopK(matrix, k, decimals)
        for batch in batches:
            step = max(1, CELLS // max(1, len(matrix)))
            for at in range(0, batch.num_rows if len(matrix) else 0, step):
                part = batch.slice(at, step)
                vectors = _matrix(part.column("embedding"))
                docs = np.array(part.column("doc_id").to_pylist(), dtype=str)
                claim, doc = _candidates(codes, _matrix(part.column("buckets")).astype(np.int32), changes, size)
                for lo in range(0, len(claim), 1 << 16):
                    c, d = claim[lo : lo + (1 << 16)], doc[lo : lo + (1 << 16)]
                    top.offer(c, docs[d], np.round(np.einsum("ij,ij->i", matrix[c], vectors[d]), decimals))
        yield pa.RecordBatch.from_pydict(top.hits(claim_ids))

    return index.select("doc_id", "embedding", "buckets").mapInArrow(scan, HIT_SCHEMA)


def approximate_top_k(
    claims: DataFrame,
    index: DataFrame,
    k: int = 50,
    radius: int | None = None,
    params: ProjectionParams = ProjectionParams(),
    decimals: int = 6,
    claim_block: int = CLAIM_BLOCK,
) -> DataFrame:
    """``cosine_top_k`` among the vectors that share a bucket with a claim.

    ``index (doc_id, embedding, buckets)`` is the store as ``with_buckets`` gives it, best written
    once. It is scanned in place for each block of about ``claim_block`` claims, so a bucket that
    holds a third of all vectors is no one task's; only the best ``k`` of every task are exchanged.
    Without a ``radius`` it is fitted to these claims (``fit_radius``). No candidate is left out, and
    copies of one vector share all buckets, so ties go to the smaller ``doc_id`` as in the exact
    search. A claim with fewer than ``k`` candidates is answered by the exact search instead.

    Rows with a null vector take no part; ids are distinct. No claims or an empty store give an
    empty result. How much is saved depends on the vectors: the less the hits of a claim stand out
    from the rest, the larger the radius, up to all buckets, which is the exact result.
    Result: ``(query_id, doc_id, cosine, rank)``.
    """
    claims = stage(with_buckets(claims, "query_id", params), "projection-claims")
    if radius is None:
        radius = fit_radius(claims, index, k, params)
    blocks = max(1, -(-claims.count() // claim_block))
    best = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "doc_id")
    parts = []
    for block in range(blocks):
        some = claims.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)
        hits = _score_buckets(some, index, k, radius, params, decimals)
        hits = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        parts.append(stage(hits, "projection-hits"))
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    answered = hits.where(F.col("rank") == k).select("query_id")
    short = claims.join(answered, "query_id", "left_anti")
    exact = cosine_top_k(short, index, k, decimals, claim_block)
    return hits.join(answered, "query_id", "left_semi").unionByName(exact)


def retrieval_recall(hits: DataFrame, exact: DataFrame) -> DataFrame:
    """``(query_id, recall)``: the share of a claim's exact hits that are among ``hits``."""
    found = hits.select("query_id", "doc_id", F.lit(1.0).alias("found"))
    return (
        exact.join(found, ["query_id", "doc_id"], "left")
        .groupBy("query_id")
        .agg(F.avg(F.coalesce("found", F.lit(0.0))).alias("recall"))
    )
