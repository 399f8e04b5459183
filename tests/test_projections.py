"""Approximate retrieval against the exact one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimweave.operators import projections as pj
from claimweave.operators import retrieval as rt
from claimweave.session import stage

PARAMS = pj.ProjectionParams()


def clustered(n, dim, centres, seed):
    rng = np.random.default_rng(seed)
    middle = np.random.default_rng(1).normal(size=(centres, dim))
    v = middle[rng.integers(0, centres, n)] + 0.35 * rng.normal(size=(n, dim))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def frame(spark, matrix, prefix, id_column):
    data = [(f"{prefix}{i}", [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(data, f"{id_column} string, embedding array<float>")


def hits(df):
    return {(r.query_id, r.doc_id, r["rank"]) for r in df.collect()}


@pytest.fixture(scope="module")
def vectors(spark):
    claims = stage(frame(spark, clustered(40, 32, 30, 2), "q", "query_id"), "claims")
    store = stage(frame(spark, clustered(3000, 32, 30, 3), "d", "doc_id").repartition(5), "store")
    return claims, store


def test_codes_are_the_sides_of_the_planes():
    v = clustered(20, 16, 5, 4)
    codes = pj.bucket_codes(v, PARAMS)
    planes = pj._planes(16, PARAMS)
    for i in range(20):
        for t in range(PARAMS.tables):
            sides = [int(v[i] @ planes[:, t * PARAMS.planes + b] > 0) for b in range(PARAMS.planes)]
            assert codes[i, t] == sum(s << b for b, s in enumerate(sides))


def test_candidates_equal_a_plain_search():
    rng = np.random.default_rng(6)
    codes, theirs = rng.integers(0, 32, (7, 3)).astype(np.int32), rng.integers(0, 32, (50, 3)).astype(np.int32)
    for radius in range(4):
        changes = np.array([c for c in range(32) if c.bit_count() <= radius], np.int32)
        got = set(zip(*(x.tolist() for x in pj._candidates(codes, theirs, changes, 32))))
        plain = {
            (i, j)
            for i in range(7)
            for j in range(50)
            if min(int(codes[i, t] ^ theirs[j, t]).bit_count() for t in range(3)) <= radius
        }
        assert got == plain


def test_recall_on_clustered_vectors(spark, vectors):
    claims, store = vectors
    index = stage(pj.with_buckets(store, "doc_id", PARAMS), "index")
    indexed = pj.with_buckets(claims, "query_id", PARAMS)
    radius = pj.fit_radius(stage(indexed, "indexed"), index, 10, PARAMS)
    assert radius <= 2  # the hits stand out: few buckets hold them
    exact = rt.cosine_top_k(claims, store, 10)
    found = stage(pj.approximate_top_k(claims, index, 10, claim_block=15), "found")
    assert found.count() == 400
    assert pj.retrieval_recall(found, exact).agg(F.avg("recall")).first()[0] >= 0.9
    assert found.groupBy("query_id").agg(F.count_distinct("rank").alias("n")).where("n <> 10").isEmpty()


def test_all_buckets_are_the_exact_search(spark, vectors):
    claims, store = vectors
    index = pj.with_buckets(store, "doc_id", PARAMS)
    assert hits(pj.approximate_top_k(claims, index, 10, radius=PARAMS.planes)) == hits(rt.cosine_top_k(claims, store, 10))


def test_claims_with_few_candidates_are_answered_exactly(spark, vectors):
    claims, store = vectors
    index = pj.with_buckets(store, "doc_id", PARAMS)
    got = pj.approximate_top_k(claims, index, 2990, radius=0)
    assert hits(got) == hits(rt.cosine_top_k(claims, store, 2990))


def test_copies_tie_as_in_the_exact_search(spark):
    v = clustered(400, 16, 8, 9)
    v[:200] = v[0]
    store, claims = frame(spark, v, "d", "doc_id").repartition(4), frame(spark, v[:1], "q", "query_id")
    index = pj.with_buckets(store, "doc_id", PARAMS)
    assert hits(pj.approximate_top_k(claims, index, 20, radius=0)) == hits(rt.cosine_top_k(claims, store, 20))


def test_nulls_and_empty_tables(spark, vectors):
    claims, store = vectors
    nothing = spark.createDataFrame([("n", None)], "doc_id string, embedding array<float>")
    index = pj.with_buckets(store.limit(20).unionByName(nothing), "doc_id", PARAMS)
    assert pj.approximate_top_k(claims, index, 5).where("doc_id = 'n'").isEmpty()
    assert pj.approximate_top_k(claims.where("false"), index, 5).isEmpty()
    assert pj.approximate_top_k(claims, pj.with_buckets(nothing, "doc_id", PARAMS), 5).isEmpty()


def test_vectors_are_not_exchanged(spark, vectors):
    claims, store = vectors
    index = stage(pj.with_buckets(store, "doc_id", PARAMS), "index")
    block = stage(pj.with_buckets(claims, "query_id", PARAMS), "block")
    plan = pj._score_buckets(block, index, 10, 1, PARAMS, 6)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
