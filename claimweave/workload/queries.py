"""The registered queries: each runs one operator or job over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.config import (
    RELEVANCE_LABELS,
    STANCE_LABELS,
    NegativeParams,
    SearchParams,
    TrainParams,
)
from claimweave.functions import labels as lb
from claimweave.functions import stats as st
from claimweave.functions import text as tx
from claimweave.functions import vectors as vx
from claimweave.operators import judgments as jd
from claimweave.operators import metrics as mx
from claimweave.operators import models as md
from claimweave.operators import negatives as ng
from claimweave.operators import positions as pos
from claimweave.operators import projections as pj
from claimweave.operators import retrieval as rt
from claimweave.operators import tfidf
from claimweave.operators.encode import HashedTermEncoder, encode_claims, fit_hashed_encoder
from claimweave.operators.moments import feature_moments
from claimweave.plans import classify, encoding, pairs, publishing, search, training
from claimweave.session import stage, staging_path
from claimweave.sources import artifacts, jsonl, pair_tables
from claimweave.sources.benchmark import as_qrels
from claimweave.streaming import classify as streaming
from claimweave.workload import bindings as bd

DIM = 64

# Thresholds that fit the cosines of the given tables; the package defaults suit a neural encoder.
VECTOR_SEARCH = SearchParams(coverage_low=0.35, coverage_ok=0.23)
TEXT_SEARCH = SearchParams(coverage_low=0.64, coverage_ok=0.62)
COUNT_PARAMS = SearchParams(top_k=20)
TREND_PARAMS = SearchParams(top_k=20, min_density=0.1, nei_share=0.25)

# Fixed linear stance scorers over pair features of 64-dim vectors (class order NEI, REFUTES,
# SUPPORTS): entry ``DIM + j`` weighs coordinate j of the document.
VECTOR_WEIGHTS = {1: {0: 8.0}, 2: {1: 8.0}}
VECTOR_BIAS = [0.0, 0.0, 0.5]
TEXT_WEIGHTS = {1: {0: 16.0, 2: 8.0}, 2: {1: 16.0, 3: 8.0}}
TEXT_BIAS = [2.6, 0.0, 0.0]

# A p-value against an even split and a mean of 50 rounded cosines often sit exactly between two
# decimals, and a Wilson bound of zero may come out on either side of it; the nudge sends both
# engines the same way.
NUDGE = 1e-12

def _weights(table: dict[int, dict[int, float]]) -> list[list[float]]:
    rows = [[0.0] * (4 * DIM + 1) for _ in STANCE_LABELS]
    for cls, entries in table.items():
        for j, w in entries.items():
            rows[cls][DIM + j] = w
    return rows


def vector_scorer():
    return md.linear_scorer(_weights(VECTOR_WEIGHTS), VECTOR_BIAS)


def text_scorer():
    return md.linear_scorer(_weights(TEXT_WEIGHTS), TEXT_BIAS)


# --- sources ---------------------------------------------------------------------------------


def load_qrels(spark: SparkSession, sf: str) -> DataFrame:
    q = bd.qrels(spark, sf)
    splits = {
        s: q.where(F.col("split") == s).select(
            F.col("query_id").cast("bigint").alias("query-id"),
            F.col("doc_id").cast("bigint").alias("corpus-id"),
        )
        for s in ("train", "test")
    }
    return as_qrels(splits)


def vector_store_integrity(spark: SparkSession, sf: str) -> DataFrame:
    return artifacts.vector_store_integrity(bd.vector_store(spark, sf))


# --- text functions --------------------------------------------------------------------------


def document_text_variants(spark: SparkSession, sf: str) -> DataFrame:
    rows = tx.with_variants(bd.corpus(spark, sf))
    text = tx.document_text("title", "abstract", F.col("field_variant"))
    return rows.select(
        "doc_id", "field_variant", F.length(text).alias("n_chars"), F.md5(text).alias("text_md5")
    )


def passage_text(spark: SparkSession, sf: str) -> DataFrame:
    return bd.corpus(spark, sf).select(
        "doc_id", tx.as_passage(tx.passage_text("title", "abstract")).alias("passage")
    )


def claim_prompts(spark: SparkSession, sf: str) -> DataFrame:
    return bd.claims(spark, sf).select("query_id", tx.as_query(tx.clean("claim")).alias("prompt"))


def stance_bodies(spark: SparkSession, sf: str) -> DataFrame:
    rows = bd.corpus(spark, sf)
    body = tx.stance_abstract(F.col("abstract"), F.col("title"))
    return rows.select("doc_id", F.md5(tx.clean(body)).alias("body_md5"))


def normalize_stance(spark: SparkSession, sf: str) -> DataFrame:
    word = (
        F.when(F.col("doc_id") % 5 == 0, "unclear")
        .when(F.col("toxic") == 1, "nei")
        .when(F.col("quality") == 1, "Support")
        .otherwise("contradict")
    )
    stance = lb.normalize_stance("word")
    return bd.table(spark, sf, "labels").withColumn("word", word).select("doc_id", "word", stance.alias("stance"))


def label_ids(spark: SparkSession, sf: str) -> DataFrame:
    rows = bd.labelled_rows(spark, sf).withColumn("id", lb.label_to_id("label", RELEVANCE_LABELS))
    named = rows.withColumn("name", lb.id_to_label("id", RELEVANCE_LABELS))
    return named.groupBy("split", "label", "id", "name").agg(F.count("*").alias("n_rows"))


def tokenize_terms(spark: SparkSession, sf: str) -> DataFrame:
    terms = tfidf.document_terms(bd.corpus(spark, sf), ["title_abstract"])
    return tfidf.postings(terms).select("doc_id", "term", "tf")


def valid_pairs(spark: SparkSession, sf: str) -> DataFrame:
    turns = bd.table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "user", F.col("text")).otherwise(" \t").alias("claim"),
        *bd.title_and_abstract(),
    )
    valid, rejected = classify.split_valid(turns)
    ids = ["conv_id", "turn"]
    return valid.select(*ids, F.lit("valid").alias("status")).unionByName(
        rejected.select(*ids, F.col("reason").alias("status"))
    )


def abstract_excerpt(spark: SparkSession, sf: str) -> DataFrame:
    return bd.corpus(spark, sf).select(
        "doc_id",
        tx.abstract_excerpt(tx.clean("abstract")).alias("excerpt"),
        tx.source_link("title", "doc_id", SearchParams().source_url).alias("source"),
    )


def corpus_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as JSON lines, abstracts of even ids as a list, and read back."""
    corpus = bd.corpus(spark, sf)
    as_text = F.to_json(F.struct("doc_id", "title", "abstract"))
    as_list = F.to_json(F.struct("doc_id", "title", F.split("abstract", "\n").alias("abstract")))
    path = staging_path(spark, "corpus_jsonl")
    corpus.select(F.when(F.col("doc_id").cast("long") % 2 == 0, as_list).otherwise(as_text).alias("value")).write.text(path)
    read = jsonl.read_corpus_jsonl(spark, path)
    return read.select("doc_id", F.md5("title").alias("title_md5"), F.md5("abstract").alias("abstract_md5"))


def _claims_read(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    lines = stage(bd.claim_lines(spark, sf), "claim_lines")
    paths = {}
    for split in ("train", "validation"):
        paths[split] = staging_path(spark, f"claims_{split}")
        lines.where(F.col("split") == split).select("value").write.text(paths[split])
    return jsonl.split_claims(spark, paths)


def claims_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence of the claims written as JSON lines and read back: one row per judged document."""
    return jsonl.explode_evidence(_claims_read(spark, sf)[0])


def rejected_claims(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of the same files that are no usable claims, and why."""
    return _claims_read(spark, sf)[1]


def pairs_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Relevance pairs written as CSV and read back."""
    paths = pair_tables.write_pairs_csv(stage(relevance_pairs(spark, sf), "pairs"), staging_path(spark, "pairs_csv"), "pairs")
    return pair_tables.read_pairs_csv(spark, paths[-1])


def pairs_published(spark: SparkSession, sf: str) -> DataFrame:
    """Relevance pairs in the partitioned layout, read back."""
    path = staging_path(spark, "pairs_published")
    pair_tables.publish_pairs(relevance_pairs(spark, sf), path)
    return pair_tables.read_published(spark, path)


def pairs_republished(spark: SparkSession, sf: str) -> DataFrame:
    """Published pairs whose test split is published again with its relevant pairs only."""
    rows = stage(relevance_pairs(spark, sf), "pairs")
    path = staging_path(spark, "pairs_published")
    pair_tables.publish_pairs(rows, path)
    again = rows.where((F.col("split") == "test") & (F.col("label") == "relevant"))
    pair_tables.publish_pairs(again, path, incremental=True)
    return pair_tables.read_published(spark, path)


def pairs_quality(spark: SparkSession, sf: str) -> DataFrame:
    """What joining the judgments and checking the dialog turns left out.

    Every third document and every fifth passage is taken away first, so that something is missing.
    """
    corpus, claims, qrels = bd.passages(spark, sf)
    known = corpus.where(F.col("doc_id").cast("long") % 3 != 0), claims.where(F.col("query_id").cast("long") % 5 != 0)
    _, judged = jd.counted_positives(*known, qrels)
    turns = bd.table(spark, sf, "conversations").select(
        F.when(F.col("role") == "user", F.col("text")).otherwise(" ").alias("claim"), *bd.title_and_abstract()
    )
    _, checked = classify.counted_valid(turns)

    def listed(counts: DataFrame) -> DataFrame:
        return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("n")) for c in counts.columns])))

    return listed(judged).unionByName(listed(checked))


# --- judgments, TF-IDF and negatives ---------------------------------------------------------


def positive_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return jd.positive_lookup(bd.qrels(spark, sf))


def relevance_positives(spark: SparkSession, sf: str) -> DataFrame:
    return jd.relevance_positives(*bd.passages(spark, sf))


def stance_positives(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.stance_positives(bd.corpus(spark, sf), bd.stance_evidence(spark, sf))


def _index(spark: SparkSession, sf: str, p: NegativeParams = NegativeParams()):
    corpus = bd.corpus(spark, sf)
    terms = stage(tfidf.document_terms(corpus), "document_terms")
    n_docs = corpus.count()
    return terms, tfidf.build_vocabulary(terms, n_docs, p.min_df, p.max_features)


def term_statistics(spark: SparkSession, sf: str) -> DataFrame:
    _, vocabulary = _index(spark, sf)
    return vocabulary.select("field_variant", "term", "df", "ctf", F.round("idf", 6).alias("idf"))


def capped_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    _, vocabulary = _index(spark, sf, NegativeParams(max_features=500))
    return vocabulary.select("field_variant", "term", "df", "ctf")


def tfidf_weights(spark: SparkSession, sf: str) -> DataFrame:
    terms, vocabulary = _index(spark, sf)
    weighted = tfidf.weighted_postings(terms, vocabulary)
    w = F.col("weight")
    return weighted.groupBy("field_variant", "doc_id").agg(
        F.count("*").alias("n_terms"),
        F.round(F.sum(w), 4).alias("weight_sum"),
        F.round(F.sqrt(F.sum(w * w)), 6).alias("norm"),
    )


def tfidf_similarity(spark: SparkSession, sf: str) -> DataFrame:
    terms, vocabulary = _index(spark, sf)
    vectors = stage(tfidf.claim_vectors(bd.claims(spark, sf), vocabulary), "claim_vectors")
    depth = vectors.select("query_id", F.lit(20).alias("depth")).distinct()
    top = tfidf.top_similar(tfidf.top_documents(terms, vocabulary, vectors, depth), 20)
    return top.select("field_variant", "query_id", "doc_id", "score", "rank")


def random_negatives(spark: SparkSession, sf: str) -> DataFrame:
    corpus, claims, qrels = bd.passages(spark, sf)
    positions = stage(pos.document_positions(corpus), "positions")
    excluded = stage(jd.positive_lookup(qrels), "excluded")
    p = NegativeParams()
    return ng.random_negatives(claims, excluded, positions, positions.count(), p.n_random, p.seed)


def hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    corpus, claims, qrels = bd.passages(spark, sf)
    chosen = ng.choose_negatives(corpus, claims, jd.positive_lookup(qrels))
    return chosen.where(F.col("kind") == "hard").select("field_variant", "query_id", "doc_id")


def relevance_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.build_relevance_pairs(*bd.passages(spark, sf))


def relevance_pairs_dialog(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.build_relevance_pairs(*bd.dialog(spark, sf))


def stance_pairs(spark: SparkSession, sf: str) -> DataFrame:
    evidence = stage(bd.stance_evidence(spark, sf), "evidence")
    claims = evidence.select("split", "query_id").distinct().join(bd.claims(spark, sf), "query_id")
    return pairs.build_stance_pairs(bd.corpus(spark, sf), claims, evidence)


# --- metrics ---------------------------------------------------------------------------------


def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return mx.confusion_matrix(bd.rule_predictions(spark, sf), ["classifier"])


def accuracy_macro_f1(spark: SparkSession, sf: str) -> DataFrame:
    scores = mx.accuracy_macro_f1(bd.rule_predictions(spark, sf), RELEVANCE_LABELS, ["classifier"])
    return scores.select(
        "classifier",
        F.round("accuracy", 6).alias("accuracy"),
        F.round("macro_f1", 6).alias("macro_f1"),
    )


def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    report = mx.classification_report(
        bd.rule_predictions(spark, sf), RELEVANCE_LABELS, ["classifier"]
    )
    return report.select(
        "classifier",
        "label",
        *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
        "support",
    )


def recovered_confusion(spark: SparkSession, sf: str) -> DataFrame:
    """Confusion counts found again from rounded reports."""
    return mx.confusion_from_report(classification_report(spark, sf), RELEVANCE_LABELS, ["classifier"])


def class_balance(spark: SparkSession, sf: str) -> DataFrame:
    return mx.class_balance(bd.labelled_rows(spark, sf))


def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    weights = mx.class_weights(bd.labelled_rows(spark, sf))
    return weights.select("label_id", "n_rows", F.round("weight", 6).alias("weight"))


def variant_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = tx.with_variants(bd.labelled_rows(spark, sf))
    return mx.variant_summary(rows, 4 * DIM + 1)


def best_model(spark: SparkSession, sf: str) -> DataFrame:
    scores = mx.accuracy_macro_f1(bd.rule_predictions(spark, sf), RELEVANCE_LABELS, ["classifier"])
    order = [mx.listing_order("classifier", ["long_text", "longer_text", "english"])]
    best = mx.best_model(scores, order)
    return best.select("classifier", F.round("macro_f1", 6).alias("macro_f1"))


def split_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = bd.labelled_rows(spark, sf).where(F.col("split") == "test")
    return rows.groupBy("label").agg(F.count("*").alias("n_rows"))


# --- vectors ---------------------------------------------------------------------------------


def l2_normalize(spark: SparkSession, sf: str) -> DataFrame:
    scaled = bd.table(spark, sf, "embeddings").withColumn(
        "v", F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 2))
    )
    unit = scaled.withColumn("u", vx.l2_normalize("v"))
    return unit.select(
        "vec_id",
        F.round(vx.l2_norm("v"), 5).alias("norm_before"),
        F.round(vx.l2_norm("u"), 6).alias("norm_after"),
        F.round(F.element_at("u", 1), 6).alias("first"),
        F.round(F.element_at("u", -1), 6).alias("last"),
    )


def pair_cosine(spark: SparkSession, sf: str) -> DataFrame:
    return bd.vector_pairs(spark, sf).select("vec_id", F.round(vx.dot("q", "d"), 6).alias("cosine"))


def pair_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = bd.vector_pairs(spark, sf).withColumn("f", vx.pair_features("q", "d"))

    def block(i: int):
        part = F.slice("f", i * DIM + 1, DIM)
        return [
            F.round(vx.total(part), 6).alias(f"sum_{i}"),
            F.round(vx.total(F.transform(part, F.abs)), 6).alias(f"abs_{i}"),
        ]

    blocks = [c for i in range(4) for c in block(i)]
    return rows.select(
        "vec_id", F.size("f").alias("width"), *blocks, F.round(F.element_at("f", -1), 6).alias("cosine")
    )


def pair_features_concat(spark: SparkSession, sf: str) -> DataFrame:
    rows = bd.vector_pairs(spark, sf).withColumn("f", vx.concat_features("q", "d"))
    return rows.select(
        "vec_id",
        F.size("f").alias("width"),
        F.round(vx.total(F.slice("f", 1, DIM)), 6).alias("sum_q"),
        F.round(vx.total(F.slice("f", DIM + 1, DIM)), 6).alias("sum_d"),
    )


def feature_moments_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = bd.vector_pairs(spark, sf).withColumn("f", vx.pair_features("q", "d"))
    moments = feature_moments(rows, "f")
    return moments.select(
        F.col("position").cast("bigint").alias("position"),
        F.round("mean", 6).alias("mean"),
        F.round("std", 6).alias("std"),
    )


def _text_encoder(spark: SparkSession, sf: str):
    corpus = bd.corpus(spark, sf)
    terms = stage(tfidf.document_terms(corpus, ["title_abstract"]), "document_terms")
    return fit_hashed_encoder(tfidf.build_vocabulary(terms, corpus.count()), DIM)


def hashed_embedding(spark: SparkSession, sf: str) -> DataFrame:
    store = encoding.encode_corpus(bd.corpus(spark, sf), _text_encoder(spark, sf))
    cells = store.select("doc_id", F.posexplode("embedding").alias("bucket", "v"))
    return cells.select(
        "doc_id",
        F.col("bucket").cast("bigint").alias("bucket"),
        F.round(F.col("v").cast("double"), 5).alias("value"),
    )


def encode_corpus(spark: SparkSession, sf: str) -> DataFrame:
    store = encoding.encode_corpus(bd.corpus(spark, sf), _text_encoder(spark, sf))
    return store.select(
        "doc_id",
        F.md5("title").alias("title_md5"),
        F.md5("abstract").alias("abstract_md5"),
        F.size("embedding").alias("dim"),
        F.round(vx.l2_norm("embedding"), 4).alias("norm"),
    )


# --- retrieval and evidence ------------------------------------------------------------------


def _vector_hits(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    store = bd.vector_store(spark, sf)
    claims = store.select(F.col("doc_id").alias("query_id"), "embedding")
    return claims, store, rt.cosine_top_k(claims, store, VECTOR_SEARCH.top_k)


def cosine_retrieval(spark: SparkSession, sf: str) -> DataFrame:
    return _vector_hits(spark, sf)[2].select("query_id", "doc_id", "cosine", "rank")


def cosine_retrieval_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The same retrieval from a store in hash buckets, with more claims than fit one block."""
    store = bd.vector_store(spark, sf)
    claims = store.select(F.col("doc_id").alias("query_id"), "embedding")
    table = "claimweave_store_" + uuid.uuid4().hex
    artifacts.write_bucketed_store(store, table, 8, staging_path(spark, "bucketed-store"))
    block = max(1, claims.count() // 3)
    hits = rt.bucketed_top_k(claims, spark.table(table), 8, VECTOR_SEARCH.top_k, claim_block=block)
    return hits.select("query_id", "doc_id", "cosine", "rank")


def _approximate_hits(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Approximate and exact hits of every vector whose id is divisible by 100, against all."""
    store = bd.vector_store(spark, sf)
    claims = store.where(F.col("doc_id").cast("long") % 100 == 0).select(F.col("doc_id").alias("query_id"), "embedding")
    params = pj.ProjectionParams()
    index = stage(pj.with_buckets(store, "doc_id", params), "projection-index")
    hits = stage(pj.approximate_top_k(claims, index, VECTOR_SEARCH.top_k, params=params), "approximate-hits")
    return hits, stage(rt.cosine_top_k(claims, store, VECTOR_SEARCH.top_k), "exact-hits")


def cosine_retrieval_approximate(spark: SparkSession, sf: str) -> DataFrame:
    """Hits from buckets of random projections, with each claim's recall of the exact ones."""
    hits, exact = _approximate_hits(spark, sf)
    return hits.join(pj.retrieval_recall(hits, exact), "query_id").select("query_id", "doc_id", "cosine", "rank", "recall")


def approximate_recall(spark: SparkSession, sf: str) -> DataFrame:
    """What has to hold of approximate hits: as many as exact ones, true cosines, a recall of 0.9."""
    hits, exact = _approximate_hits(spark, sf)
    pairs = hits.join(exact.select("query_id", "doc_id", F.col("cosine").alias("true_cosine")), ["query_id", "doc_id"], "left")
    checked = pairs.agg(
        F.countDistinct("query_id").alias("n_claims"),
        F.count("*").alias("n_hits"),
        F.coalesce(F.bool_and(F.abs(F.col("cosine") - F.coalesce("true_cosine", "cosine")) < 2e-6), F.lit(True)).alias("true_cosines"),
    )
    reached = pj.retrieval_recall(hits, exact).agg((F.avg("recall") >= 0.9).alias("recall_reached"))
    return checked.join(reached)


def retrieval_coverage(spark: SparkSession, sf: str) -> DataFrame:
    coverage = rt.retrieval_coverage(_vector_hits(spark, sf)[2])
    return coverage.select(
        "query_id",
        F.round(F.col("avg_cos") + NUDGE, 6).alias("avg_cos"),
        F.round("max_cos", 6).alias("max_cos"),
    )


def linear_stance_scores(spark: SparkSession, sf: str) -> DataFrame:
    rows = bd.vector_pairs(spark, sf).withColumn("features", vx.pair_features("q", "d"))
    scored = vector_scorer()(rows.select("vec_id", "features"))
    scored = scored.withColumns(md.prediction_columns("probabilities", STANCE_LABELS))
    return scored.select(
        "vec_id",
        *[
            F.round(F.get("probabilities", F.lit(i)), 6).alias(f"p_{n.lower()}")
            for n, i in STANCE_LABELS.items()
        ],
        "stance",
        F.round("confidence", 6).alias("confidence"),
    )


def _scored_vector_hits(spark: SparkSession, sf: str) -> DataFrame:
    claims, store, hits = _vector_hits(spark, sf)
    return search.score_hits(stage(hits, "hits"), claims, store, vector_scorer())


def stance_counts(spark: SparkSession, sf: str) -> DataFrame:
    return search.stance_counts(_scored_vector_hits(spark, sf), VECTOR_SEARCH)


def stance_rerank(spark: SparkSession, sf: str) -> DataFrame:
    top = rt.rerank_by_stance(_scored_vector_hits(spark, sf), VECTOR_SEARCH.top_n)
    return top.select("query_id", "rank", "doc_id", "p_stance", "cosine")


def _text_search(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    encoder = _text_encoder(spark, sf)
    store = stage(encoding.encode_corpus(bd.corpus(spark, sf), encoder), "store")
    claims = stage(encode_claims(bd.claims(spark, sf), encoder), "claims")
    return search.search_evidence(claims, store, text_scorer(), TEXT_SEARCH)


def evidence_search(spark: SparkSession, sf: str) -> DataFrame:
    return _text_search(spark, sf)[0]


def _rounded(summary: DataFrame) -> DataFrame:
    numbers = ("avg_cos", "max_cos", "support_share", "wilson_low", "wilson_high", "p_value")
    rounded = {c: F.round(F.col(c) + NUDGE, 6) for c in numbers if c in summary.columns}
    return summary.withColumns(rounded)


def evidence_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_text_search(spark, sf)[1])


# --- statistics ------------------------------------------------------------------------------


def binomial_test(spark: SparkSession, sf: str) -> DataFrame:
    rows = bd.customer_counts(spark, sf).withColumn("n", F.col("supports") + F.col("refutes"))
    p = st.binomial_two_sided_p("supports", "n")
    return rows.select("o_custkey", "supports", "n", F.round(p + NUDGE, 9).alias("p_value"))


def wilson_interval(spark: SparkSession, sf: str) -> DataFrame:
    rows = bd.customer_counts(spark, sf).withColumn("n", F.col("supports") + F.col("refutes"))
    return rows.select(
        "o_custkey",
        F.round(st.wilson_low("supports", "n") + NUDGE, 9).alias("wilson_low"),
        F.round(st.wilson_high("supports", "n") + NUDGE, 9).alias("wilson_high"),
    )


def directional_test(spark: SparkSession, sf: str) -> DataFrame:
    columns = st.directional_columns("supports", "refutes", "max_cos", COUNT_PARAMS)
    return _rounded(bd.customer_counts(spark, sf).select("o_custkey", *columns))


def coverage_class(spark: SparkSession, sf: str) -> DataFrame:
    coverage = st.coverage_class("avg_cos", "max_cos", COUNT_PARAMS)
    return bd.customer_counts(spark, sf).select("o_custkey", coverage.alias("coverage"))


def evidence_trend(spark: SparkSession, sf: str) -> DataFrame:
    trend = st.evidence_trend("supports", "refutes", "nei", "max_cos", TREND_PARAMS)
    return bd.customer_counts(spark, sf).select("o_custkey", trend.alias("trend"))


# --- fitted models (no SQL form) -------------------------------------------------------------


def _dialog_vectors(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(pairs.build_relevance_pairs(*bd.dialog(spark, sf)), "pairs")
    return stage(training.pair_vectors(rows, HashedTermEncoder(DIM)), "pair_vectors")


def _checked_comparison(result: training.Comparison, labels: dict[str, int]) -> DataFrame:
    """One row per variant and classifier with what has to hold of any fit.

    ``n_scored`` counts test pairs with probabilities that sum to 1 or else a margin.
    """
    total = F.aggregate("probabilities", F.lit(0.0), lambda x, y: x + y)
    scored = (F.abs(total - 1) < 1e-6) | F.col("decision_score").isNotNull()
    told = result.predictions.groupBy("field_variant", "classifier").agg(
        F.count("*").alias("n_predictions"),
        F.count_if(F.col("prediction_id").isin(list(labels.values()))).alias("n_known"),
        F.count_if(scored).alias("n_scored"),
        *[F.count_if(F.col("label_id") == i).alias(f"support_{name.lower()}") for name, i in labels.items()],
    )
    whole = (F.col("accuracy").between(0, 1) & F.col("macro_f1").between(0, 1)).alias("in_range")
    sizes = result.scores.select("field_variant", "classifier", "feature_dim", "train_rows", "test_rows", whole)
    return sizes.join(told, ["field_variant", "classifier"])


def train_compare(spark: SparkSession, sf: str) -> DataFrame:
    """All families on all variants with the full settings, checked against the pairs they were fitted on."""
    features = stage(training.pair_feature_rows(_dialog_vectors(spark, sf)), "features")
    result = training.train_and_compare(features, RELEVANCE_LABELS, TrainParams())
    return _checked_comparison(result, RELEVANCE_LABELS)


def _stance_features(spark: SparkSession, sf: str) -> DataFrame:
    corpus, claims, evidence = bd.dialog_stance(spark, sf)
    rows = stage(pairs.build_stance_pairs(corpus, claims, evidence), "stance_pairs")
    vectors = stage(training.pair_vectors(rows, HashedTermEncoder(DIM)), "pair_vectors")
    return stage(training.pair_feature_rows(vectors), "features")


def train_compare_stance(spark: SparkSession, sf: str) -> DataFrame:
    """The three-class comparison with the full settings, on the variant of title and abstract."""
    features = _stance_features(spark, sf)
    result = training.train_and_compare(features, STANCE_LABELS, TrainParams(), ["title_abstract"])
    return _checked_comparison(result, STANCE_LABELS)


def _published_stance(spark: SparkSession, features: DataFrame) -> tuple[training.Comparison, publishing.Published]:
    lr = TrainParams(families=("logistic_regression",))
    result = training.train_and_compare(features, STANCE_LABELS, lr, ["title_abstract"])
    root = staging_path(spark, "published")
    publishing.publish(spark, result, STANCE_LABELS, root, "claimweave", f"hashed-{DIM}")
    return result, publishing.load_current(spark, root)


def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Test pairs predicted by a fitted stance model and by the same model published and loaded."""
    features = _stance_features(spark, sf)
    result, current = _published_stance(spark, features)
    asked = features.where((F.col("field_variant") == current.metadata.field_variant) & (F.col("split") == "test"))
    loaded = md.predict(current.model, asked, current.labels).select(
        "query_id", "doc_id", F.col("prediction_id").alias("loaded_id"), F.col("probabilities").alias("loaded")
    )
    largest = F.array_max(F.zip_with("probabilities", "loaded", lambda x, y: F.abs(x - y)))
    both = result.predictions.join(loaded, ["query_id", "doc_id"])
    return both.select(
        "query_id",
        "doc_id",
        "label_id",
        F.lit(current.metadata.classifier).alias("classifier"),
        F.lit(current.metadata.feature_dim).alias("feature_dim"),
        ((F.col("prediction_id") == F.col("loaded_id")) & (largest < 1e-9)).alias("same"),
    )


def evidence_search_fitted(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence search with the published stance model; as many hits are shown as are retrieved."""
    _, current = _published_stance(spark, _stance_features(spark, sf))
    encoder = _text_encoder(spark, sf)
    store = stage(encoding.encode_corpus(bd.corpus(spark, sf), encoder), "store")
    claims = stage(encode_claims(bd.claims(spark, sf), encoder), "claims")
    every = SearchParams(**{**TEXT_SEARCH.__dict__, "top_n": TEXT_SEARCH.top_k})
    hits, summary = search.search_evidence(claims, store, md.model_scorer(current.model), every)
    total = F.col("p_supports") + F.col("p_refutes") + F.col("p_nei")
    counted = F.col("supports") + F.col("refutes") + F.col("nei") + F.col("uncertain")
    shown = hits.join(summary.select("query_id", counted.alias("n_counted")), "query_id")
    return shown.select(
        "query_id",
        "doc_id",
        "retrieval_cos",
        "source",
        "n_counted",
        (F.abs(total - 1) < 0.002).alias("sums_to_one"),
        F.col("rank").between(1, every.top_n).alias("ranked"),
    )


def feature_ablation(spark: SparkSession, sf: str) -> DataFrame:
    return training.ablate_features(_dialog_vectors(spark, sf), RELEVANCE_LABELS, TrainParams())


def _fitted_on_dialog(spark: SparkSession, sf: str):
    """Dialog pairs, an encoder, and a regression on titles and abstracts of the training split."""
    rows = stage(pairs.build_relevance_pairs(*bd.dialog(spark, sf)), "pairs")
    encoder = HashedTermEncoder(DIM)
    features = training.pair_feature_rows(training.pair_vectors(rows, encoder))
    lr = TrainParams(families=("logistic_regression",))
    fitted = training.train_and_compare(
        stage(features, "features"), RELEVANCE_LABELS, lr, ["title_abstract"]
    )
    unseen = (F.col("field_variant") == "title_abstract") & (F.col("split") == "test")
    return rows.where(unseen), encoder, fitted.models["title_abstract", "logistic_regression"]


def classify_pairs(spark: SparkSession, sf: str) -> DataFrame:
    rows, encoder, model = _fitted_on_dialog(spark, sf)
    asked = rows.select("query_id", "doc_id", "claim", "title", "abstract", "label")
    scored = classify.classify_pairs(asked, model, encoder, "title_abstract", RELEVANCE_LABELS)
    return scored.select("query_id", "doc_id", "label", "predicted_label", "probabilities")


def classify_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The test pairs as a stream, claims of every fifth conversation blank, against the batch result."""
    rows, encoder, model = _fitted_on_dialog(spark, sf)
    spoilt = F.floor(F.col("query_id").cast("long") / 1000) % 5 == 0
    requests = rows.select(
        F.concat_ws("/", "query_id", "doc_id").alias("request_id"),
        F.when(spoilt, " ").otherwise(F.col("claim")).alias("claim"),
        "title",
        "abstract",
    )
    path, root = staging_path(spark, "requests"), staging_path(spark, "classified")
    requests.write.json(path)
    run = streaming.classify_available(
        streaming.read_requests(spark, path), model, encoder, "title_abstract", RELEVANCE_LABELS, root
    )
    run.awaitTermination()
    batch = classify.classify_pairs(requests, model, encoder, "title_abstract", RELEVANCE_LABELS)
    both = streaming.read_outcome(spark, root).join(
        batch.select("request_id", F.col("predicted_label").alias("batch_label")), "request_id", "left"
    )
    return both.select("request_id", "status", F.col("predicted_label").eqNullSafe(F.col("batch_label")).alias("same"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__.removesuffix("_query"): f
    for f in (
        load_qrels,
        corpus_jsonl,
        claims_jsonl,
        rejected_claims,
        pairs_csv,
        pairs_published,
        pairs_republished,
        pairs_quality,
        vector_store_integrity,
        document_text_variants,
        passage_text,
        claim_prompts,
        stance_bodies,
        normalize_stance,
        label_ids,
        tokenize_terms,
        valid_pairs,
        abstract_excerpt,
        positive_lookup,
        relevance_positives,
        stance_positives,
        term_statistics,
        capped_vocabulary,
        tfidf_weights,
        tfidf_similarity,
        random_negatives,
        hard_negatives,
        relevance_pairs,
        relevance_pairs_dialog,
        stance_pairs,
        confusion_matrix,
        accuracy_macro_f1,
        classification_report,
        recovered_confusion,
        class_balance,
        class_weights,
        variant_summary,
        best_model,
        split_filter,
        l2_normalize,
        pair_cosine,
        pair_features,
        pair_features_concat,
        feature_moments_query,
        hashed_embedding,
        encode_corpus,
        cosine_retrieval,
        cosine_retrieval_bucketed,
        cosine_retrieval_approximate,
        approximate_recall,
        retrieval_coverage,
        linear_stance_scores,
        stance_counts,
        stance_rerank,
        evidence_search,
        evidence_summary,
        binomial_test,
        wilson_interval,
        directional_test,
        coverage_class,
        evidence_trend,
        train_compare,
        train_compare_stance,
        model_roundtrip,
        evidence_search_fitted,
        feature_ablation,
        classify_pairs,
        classify_stream,
    )
}
