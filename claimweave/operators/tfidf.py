"""TF-IDF statistics, weights and the exact sparse top-k similarity join."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweave.config import FIELD_VARIANTS
from claimweave.functions import text as tx
from claimweave.operators import sparse_topk
from claimweave.session import append, stage, staging_path

# Decimals kept of a similarity before it is compared, so that summation order cannot
# decide between documents of equal score.
SCORE_DECIMALS = 6

# Rows of claim vectors broadcast at a time (some 100 bytes each).
CLAIM_TERM_ROWS = 2_000_000

# A vocabulary up to this many rows (counted) is sent to the tasks whole, and claim vectors and
# kept documents are sent to the documents up to this many rows.
VOCABULARY_ROWS = 1_000_000
BLOCK_ROWS = 100_000

BEST = "field_variant string, query_id string, doc_id string, score double"

# Documents whose terms are counted at a time.
COUNTED_DOCUMENTS = 1000


def document_terms(
    corpus: DataFrame,
    variants: Iterable[str] = FIELD_VARIANTS,
    stop_words: Iterable[str] | None = None,
) -> DataFrame:
    """``(doc_id, field_variant, terms array<struct<term, tf>>)`` of ``(doc_id, title, abstract)``.

    Title and abstract are tokenised once; the combined variant counts the terms of both, since
    the ``". "`` between them never belongs to a term. Terms come in the order of their bytes.
    """
    variants = tuple(variants)
    if unknown := set(variants) - set(FIELD_VARIANTS):
        raise KeyError(*unknown)
    texts = {"title": tx.clean("title"), "abstract": tx.clean("abstract")}
    tokens = tx.tokenize(corpus.select("doc_id", "title", "abstract"), texts, stop_words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, COUNTED_DOCUMENTS):
                part = whole.slice(at, COUNTED_DOCUMENTS)
                # The variants of a document side by side, as they share most terms.
                order = np.arange(len(variants) * part.num_rows).reshape(len(variants), -1).T.ravel()
                terms = pa.concat_arrays(list(_count_tokens(part, variants))).take(pa.array(order))
                doc_ids = part.column("doc_id").take(pa.array(np.repeat(np.arange(part.num_rows), len(variants))))
                names = pa.array(variants * part.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays([doc_ids, names, terms], ["doc_id", "field_variant", "terms"])

    counted = T.StructType().add("term", T.StringType()).add("tf", T.IntegerType())
    declared = T.StructType([tokens.schema["doc_id"]]).add("field_variant", T.StringType())
    return tokens.mapInArrow(count, declared.add("terms", T.ArrayType(counted)))


def _count_tokens(batch: pa.RecordBatch, variants: tuple[str, ...]) -> Iterator[pa.ListArray]:
    """For each variant the terms and counts of every row of ``(title, abstract)``, lists of tokens."""
    title, abstract = (batch.column(c).flatten() for c in ("title", "abstract"))
    words = pa.concat_arrays([title, abstract]).dictionary_encode()
    order = pc.sort_indices(words.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    names = words.dictionary.take(pa.array(order))
    rows = np.arange(batch.num_rows + 1)
    document = [
        np.repeat(rows[:-1], pc.list_value_length(batch.column(c)).to_numpy()) for c in ("title", "abstract")
    ]
    width = max(1, len(names))
    codes = np.concatenate(document) * width + rank[words.indices.to_numpy()]
    parts = {"title": codes[: len(title)], "abstract": codes[len(title) :], "title_abstract": codes}
    for variant in variants:
        found, tf = np.unique(parts[variant], return_counts=True)
        terms = pa.StructArray.from_arrays(
            [names.take(pa.array(found % width)), pa.array(tf, pa.int32())], ["term", "tf"]
        )
        ends = np.searchsorted(found, rows * width).astype(np.int32)
        yield pa.ListArray.from_arrays(pa.array(ends), terms)


def postings(doc_terms: DataFrame) -> DataFrame:
    """One row per (document, variant, term)."""
    return doc_terms.select("doc_id", "field_variant", F.inline("terms"))


def term_statistics(doc_terms: DataFrame, min_df: int = 2) -> DataFrame:
    """Document frequency ``df`` and corpus frequency ``ctf`` of the terms kept by ``min_df``.

    Each batch of documents is counted before its terms become rows, and a term is one row for all
    variants until it is summed up, as they share most terms.
    """
    names = pa.array(FIELD_VARIANTS)
    counts = [f"{c}_{v}" for c in ("df", "ctf") for v in FIELD_VARIANTS]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("terms")
            flat = lists.flatten()
            words = flat.field("term").dictionary_encode()
            n = len(words.dictionary)
            variant = pc.index_in(batch.column("field_variant"), value_set=names).to_numpy()
            lengths = pc.list_value_length(lists).fill_null(0).to_numpy()
            key = np.repeat(variant.astype(np.int64) * n, lengths) + words.indices.to_numpy()
            size = len(names) * n
            df = np.bincount(key, minlength=size)
            ctf = np.bincount(key, flat.field("tf").to_numpy(), size).astype(np.int64)
            summed = np.concatenate([df, ctf]).reshape(len(counts), n)
            yield pa.RecordBatch.from_arrays([words.dictionary, *map(pa.array, summed)], ["term", *counts])

    declared = ", ".join(["term string", *[f"{c} long" for c in counts]])
    summed = doc_terms.select("field_variant", "terms").mapInArrow(count, declared)
    summed = summed.groupBy("term").agg(*[F.sum(c).alias(c) for c in counts])
    each = [F.struct(F.col(f"df_{v}").alias("df"), F.col(f"ctf_{v}").alias("ctf")).alias(v) for v in FIELD_VARIANTS]
    told = summed.select("term", *each).unpivot("term", list(FIELD_VARIANTS), "field_variant", "_told")
    return told.select("field_variant", "term", "_told.df", "_told.ctf").where(F.col("df") >= max(1, min_df))


def cap_vocabulary(stats: DataFrame, max_features: int) -> DataFrame:
    """The ``max_features`` most frequent terms per variant, ties by term.

    ``stats`` is read twice, so hand in a staged table. A histogram of ``ctf`` first gives the
    frequency at which the cap falls, and only the terms at or above it are ranked: the one
    task that ranks a variant sees little more than ``max_features`` rows.
    """
    histogram = stats.groupBy("field_variant", "ctf").agg(F.count("*").alias("_terms"))
    higher = (
        Window.partitionBy("field_variant")
        .orderBy(F.desc("ctf"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    cut = (
        histogram.withColumn("_higher", F.coalesce(F.sum("_terms").over(higher), F.lit(0)))
        .where(F.col("_higher") < max_features)
        .groupBy("field_variant")
        .agg(F.min("ctf").alias("_cut"))
    )
    ranked = Window.partitionBy("field_variant").orderBy(F.desc("ctf"), "term")
    return (
        stats.join(F.broadcast(cut), "field_variant")  # one row per field variant
        .where(F.col("ctf") >= F.col("_cut"))
        .withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") <= max_features)
        .select("field_variant", "term", "df", "ctf")
    )


def idf(df: Column | str, n_docs: int) -> Column:
    """Smooth inverse document frequency ``ln((1 + n) / (1 + df)) + 1``."""
    df = F.col(df) if isinstance(df, str) else df
    return F.log(F.lit(1.0 + n_docs) / (F.lit(1.0) + df)) + F.lit(1.0)


def build_vocabulary(
    doc_terms: DataFrame, n_docs: int, min_df: int = 2, max_features: int = 50_000
) -> DataFrame:
    """Staged ``(field_variant, term, df, ctf, idf)``; at most ``max_features`` rows per variant."""
    stats = stage(term_statistics(doc_terms, min_df), "term_statistics")
    vocabulary = cap_vocabulary(stats, max_features)
    return stage(vocabulary.withColumn("idf", idf("df", n_docs)), "vocabulary")


def weighted_postings(doc_terms: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(doc_id, field_variant, term, weight)`` of the terms in the vocabulary.

    The vocabulary is bounded by its feature cap, hence the broadcast: postings stay where
    they were exploded.
    """
    return (
        postings(doc_terms)
        .join(F.broadcast(vocabulary), ["field_variant", "term"])
        .withColumn("weight", F.col("tf") * F.col("idf"))
    )


def document_norms(weighted: DataFrame) -> DataFrame:
    return weighted.groupBy("field_variant", "doc_id").agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm")
    )


def claim_vectors(
    claims: DataFrame, vocabulary: DataFrame, stop_words: Iterable[str] | None = None
) -> DataFrame:
    """Unit-length ``(field_variant, query_id, term, query_weight)`` of ``(query_id, claim)``."""
    tokens = tx.tokenize(claims.select("query_id", "claim"), {"_tokens": "claim"}, stop_words)
    terms = tokens.select("query_id", F.inline(tx.count_terms("_tokens")))
    weighted = terms.join(F.broadcast(vocabulary), "term").select(
        "field_variant", "query_id", "term", (F.col("tf") * F.col("idf")).alias("_weight")
    )
    norms = weighted.groupBy("field_variant", "query_id").agg(
        F.sqrt(F.sum(F.col("_weight") * F.col("_weight"))).alias("_norm")
    )
    return weighted.join(norms, ["field_variant", "query_id"]).select(
        "field_variant",
        "query_id",
        "term",
        (F.col("_weight") / F.col("_norm")).alias("query_weight"),
    )


def gather_documents(
    doc_terms: DataFrame, vocabulary: DataFrame, claims: DataFrame
) -> DataFrame:
    """``(field_variant, doc_id, norm, entries array<struct<term, weight>>)``.

    The norm is over all vocabulary terms, the entries are only those some claim uses. The
    result is partitioned by (variant, document).
    """
    asked = claims.select("field_variant", "term").distinct().withColumn("_asked", F.lit(True))
    terms = vocabulary.select("field_variant", "term", "idf").join(
        asked, ["field_variant", "term"], "left"
    )
    weight = F.col("tf") * F.col("idf")
    return (
        postings(doc_terms)
        .join(F.broadcast(terms), ["field_variant", "term"])  # bounded by the feature cap
        .groupBy("field_variant", "doc_id")
        .agg(
            F.sqrt(F.sum(weight * weight)).alias("norm"),
            F.collect_list(
                F.when(F.col("_asked"), F.struct("term", weight.alias("weight")))
            ).alias("entries"),
        )
    )


def similarity(doc_terms: DataFrame, vocabulary: DataFrame, claims: DataFrame) -> DataFrame:
    """Cosine of every (claim, document) with a common term, per variant.

    ``claims`` is the staged output of :func:`claim_vectors`. Documents are gathered by
    (variant, document) once; the claims are then broadcast against them and summed per
    (document, claim) inside the same partitioning. So postings are never shuffled by term,
    however frequent it is, and scored pairs are not shuffled before they are cut to the top
    of each claim. Claim terms beyond ``CLAIM_TERM_ROWS`` are broadcast block by block, each
    claim in one block; all blocks read the one shuffle of the documents.
    """
    documents = gather_documents(doc_terms, vocabulary, claims)
    blocks = max(1, -(-claims.count() // CLAIM_TERM_ROWS))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    scored = None
    for i in range(blocks):
        part = claims if blocks == 1 else claims.where(block == i)
        part_scored = (
            documents.select("field_variant", "doc_id", "norm", F.inline("entries"))
            .join(F.broadcast(part), ["field_variant", "term"])
            .groupBy("field_variant", "doc_id", "query_id")
            .agg(F.sum(F.col("query_weight") * F.col("weight") / F.col("norm")).alias("_score"))
        )
        scored = part_scored if scored is None else scored.unionByName(part_scored)
    return scored.select(
        "field_variant", "query_id", "doc_id", F.round("_score", SCORE_DECIMALS).alias("score")
    ).where(F.col("score") > 0)


def top_similar(scored: DataFrame, k: int) -> DataFrame:
    """Best ``k`` documents per (variant, claim): score descending, then ``doc_id``.

    Each task first cuts its own rows to ``k`` per claim, so the shuffle carries only those.
    """
    best = Window.partitionBy("field_variant", "query_id").orderBy(F.desc("score"), "doc_id")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


class _Claims:
    """Claim vectors of one variant over the numbers of its vocabulary terms."""

    def __init__(self, terms: list[str], idf: list[float], rows: list[tuple[str, str, float]], depth: dict[str, int]):
        self.terms, self.idf = pa.array(terms, pa.string()), np.array(idf)
        number = {t: i for i, t in enumerate(terms)}
        vectors: dict[str, list[tuple[int, float]]] = {}
        for query_id, term, weight in rows:
            vectors.setdefault(query_id, []).append((number[term], weight))
        self.vectors = {q: (np.array([t for t, _ in v]), np.array([w for _, w in v])) for q, v in vectors.items()}
        self.depth = {q: depth[q] for q in vectors}

    def postings(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(documents, weights, start, largest)`` by term: unit-length documents, inverted."""
        lists = batch.column("terms")
        flat = lists.flatten()
        document = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
        term = pc.index_in(flat.field("term"), value_set=self.terms).fill_null(-1).to_numpy(zero_copy_only=False)
        known = term >= 0
        document, term = document[known], term[known]
        weight = flat.field("tf").to_numpy()[known] * self.idf[term]
        norm = np.sqrt(np.bincount(document, weight * weight, batch.num_rows))
        weight = weight / norm[document]
        order = np.argsort(term, kind="stable")
        start = np.searchsorted(term[order], np.arange(len(self.terms) + 1))
        largest = np.zeros(len(self.terms))
        used = np.flatnonzero(np.diff(start))
        if len(used):
            largest[used] = np.maximum.reduceat(weight[order], start[used])
        return document[order], weight[order], start, largest


def _score_claim(terms, weights, postings, n_docs: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Documents that may reach ``floor`` and their scores, by MaxScore.

    No document scores more on a term than the largest weight it has here. Terms are taken from the
    strongest; once those left cannot reach ``floor`` together, no new document can come in, and
    documents that cannot reach it any more are dropped before the rest are added.
    """
    documents, values, start, largest = postings
    bound = weights * largest[terms]
    order = np.argsort(-bound)
    left = np.r_[np.cumsum(bound[order][::-1])[::-1], 0.0]
    score = np.zeros(n_docs)
    alive = None
    for i, k in enumerate(order):
        if bound[k] <= 0:
            break
        lo, hi = start[terms[k]], start[terms[k] + 1]
        if alive is None and left[i] < floor:
            alive = np.flatnonzero(score > 0)
        if alive is None:
            score[documents[lo:hi]] += weights[k] * values[lo:hi]
            continue
        alive = alive[score[alive] + left[i] >= floor]
        if not len(alive):
            break
        if len(alive) * 8 < hi - lo:
            at = lo + np.searchsorted(documents[lo:hi], alive)
            hit = at < hi
            hit[hit] = documents[at[hit]] == alive[hit]
            score[alive[hit]] += weights[k] * values[at[hit]]
        else:
            score[documents[lo:hi]] += weights[k] * values[lo:hi]
    found = np.flatnonzero(score > 0) if alive is None else alive
    return found, score[found]


def _best(ids: np.ndarray, scores: np.ndarray, depth: int) -> np.ndarray:
    """Places of the ``depth`` best: score descending, then id."""
    if len(scores) > depth:
        cut = np.partition(scores, len(scores) - depth)[len(scores) - depth]
        keep = np.flatnonzero(scores >= cut)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))[:depth]]


def top_documents(doc_terms: DataFrame, vocabulary: DataFrame, claims: DataFrame, depth: DataFrame) -> DataFrame:
    """``(field_variant, query_id, doc_id, score)``: each claim's best documents in every variant.

    ``claims`` is the staged output of :func:`claim_vectors` and ``depth`` ``(query_id, depth)`` how many
    documents a claim gets at most. Documents are weighed and scored where they are read: the
    vocabulary and a block of claims are sent to the tasks, postings are never exchanged, and of
    each claim only its best documents leave a task. A task carries the score a document has to
    reach from batch to batch and leaves out what cannot reach it (:func:`_score_claim`).
    Claims beyond ``BLOCK_ROWS`` terms and kept documents are sent a block after the other
    (:func:`sparse_topk.scored_blocks`). A vocabulary beyond ``VOCABULARY_ROWS`` is not sent but joined
    (:func:`similarity`).
    """
    if vocabulary.count() > VOCABULARY_ROWS:
        return _ranked(similarity(doc_terms, vocabulary, claims).join(depth, "query_id"))
    words: dict[str, tuple[list[str], list[float]]] = {}
    for r in vocabulary.select("field_variant", "term", "idf").toLocalIterator():
        held = words.setdefault(r.field_variant, ([], []))
        held[0].append(r.term)
        held[1].append(r.idf)
    sizes = claims.groupBy("query_id").agg(F.count("*").alias("n")).join(depth, "query_id")
    total = sizes.agg(F.coalesce(F.sum(F.col("n") + F.col("depth")), F.lit(0))).first()[0]
    if total > BLOCK_ROWS:
        return _by_blocks(doc_terms, words, claims, depth)
    vectors = claims.join(depth, "query_id").collect()
    depths = {r.query_id: r.depth for r in vectors}
    index = {}
    for variant, (terms, idfs) in words.items():
        rows = [(r.query_id, r.term, r.query_weight) for r in vectors if r.field_variant == variant]
        index[variant] = _Claims(terms, idfs, rows, depths)
    return stage(_ranked(_scan_block(doc_terms, index).join(depth, "query_id")), "top_documents")


def _by_blocks(doc_terms: DataFrame, words: dict, claims: DataFrame, depth: DataFrame) -> DataFrame:
    def entries(weight: str):
        return F.struct("term", F.col(weight).cast("double").alias("value"))

    asked = claims.groupBy("field_variant", "query_id").agg(F.collect_list(entries("query_weight")).alias("terms"))
    asked = sparse_topk.numbered(asked.withColumnRenamed("query_id", "id"), words, unit=False)
    asked = asked.join(depth.select(F.col("query_id").alias("id"), F.col("depth").cast("long").alias("depth")), "id")
    named = F.transform("terms", lambda t: F.struct(t.term.alias("term"), t.tf.alias("value")))
    given = doc_terms.select("field_variant", F.col("doc_id").alias("id"), named.alias("terms"))
    given = sparse_topk.numbered(sparse_topk.in_runs(given, doc_terms.count()), words, unit=True)
    given = stage(given.sortWithinPartitions("field_variant", "id"), "numbered_documents")
    path = staging_path(doc_terms.sparkSession, "top_documents")
    for scored in sparse_topk.scored_blocks(given, stage(asked, "numbered_claims"), SCORE_DECIMALS):
        append(_ranked(scored), path)
    return doc_terms.sparkSession.read.schema(BEST).parquet(path)


def _ranked(scored: DataFrame) -> DataFrame:
    best = Window.partitionBy("field_variant", "query_id").orderBy(F.desc("score"), "doc_id")
    kept = scored.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= F.col("depth"))
    return kept.select("field_variant", "query_id", "doc_id", "score")


def _scan_block(doc_terms: DataFrame, index: dict[str, _Claims]) -> DataFrame:
    sent = doc_terms.sparkSession.sparkContext.broadcast(index)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[np.ndarray, np.ndarray]] = {}
        for whole in batches:
            for variant, claims in sent.value.items():
                batch = whole.filter(pc.equal(whole.column("field_variant"), variant))
                if not batch.num_rows or not claims.vectors:
                    continue
                ids = np.array([d.as_py().encode() for d in batch.column("doc_id")], object)
                postings = claims.postings(batch)
                for query_id, (terms, weights) in claims.vectors.items():
                    depth = claims.depth[query_id]
                    old = held.get((variant, query_id))
                    # Half a unit of the last kept decimal, so that rounding cannot lift a left-out one.
                    floor = old[1][-1] - 10.0**-SCORE_DECIMALS if old and len(old[1]) == depth else 0.0
                    at, score = _score_claim(terms, weights, postings, batch.num_rows, floor)
                    score = np.round(score, SCORE_DECIMALS)
                    at, score = at[score > 0], score[score > 0]
                    if not len(at):
                        continue
                    names = ids[at] if old is None else np.concatenate([old[0], ids[at]])
                    score = score if old is None else np.concatenate([old[1], score])
                    best = _best(names, score, depth)
                    held[variant, query_id] = names[best], score[best]
        for (variant, query_id), (names, score) in held.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "field_variant": pa.array([variant] * len(score), pa.string()),
                    "query_id": pa.array([query_id] * len(score), pa.string()),
                    "doc_id": pa.array([n.decode() for n in names], pa.string()),
                    "score": pa.array(score, pa.float64()),
                }
            )

    return doc_terms.select("doc_id", "field_variant", "terms").mapInArrow(scan, BEST)
