import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from claimweave.config import NegativeParams
from claimweave.functions import text as tx
from claimweave.functions.text import ENGLISH_STOP_WORDS
from claimweave.operators import negatives as ng
from claimweave.operators import positions as pos
from claimweave.operators import tfidf
from claimweave.operators.judgments import positive_lookup
from claimweave.plans.pairs import build_relevance_pairs, build_stance_pairs
from claimweave.session import stage
from claimweave.workload import bindings as bd


def small_world(n_docs=60, n_claims=12, seed=7):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(25)]
    corpus = [
        (f"d{i}", " ".join(rng.choices(words, k=3)), " ".join(rng.choices(words, k=9)))
        for i in range(n_docs)
    ]
    claims = [(f"q{i}", " ".join(rng.choices(words, k=4))) for i in range(n_claims)]
    claims.append(("q_blank", "zz yy xx"))  # shares no term with the corpus
    qrels = [("train" if i % 3 else "test", q, f"d{rng.randrange(n_docs)}") for i, (q, _) in enumerate(claims)]
    qrels.append(("train", "q0", "d1"))
    return corpus, claims, qrels


def frames(spark, world):
    corpus, claims, qrels = world
    return (
        spark.createDataFrame(corpus, "doc_id string, title string, abstract string"),
        spark.createDataFrame(claims, "query_id string, claim string"),
        spark.createDataFrame(qrels, "split string, query_id string, doc_id string"),
    )


def terms(text):
    return [t for t in re.findall(r"\w\w+", text.lower()) if t not in ENGLISH_STOP_WORDS]


def brute_scores(docs, claims, min_df=2):
    """Plain TF-IDF cosines of one variant: {(query, doc): rounded score}."""
    counts = {d: Counter(terms(t)) for d, t in docs.items()}
    df = Counter(t for c in counts.values() for t in c)
    idf = {t: math.log((1 + len(docs)) / (1 + n)) + 1 for t, n in df.items() if n >= min_df}

    def unit(counter):
        v = {t: n * idf[t] for t, n in counter.items() if t in idf}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()} if norm else {}

    units = {d: unit(c) for d, c in counts.items()}
    out = {}
    for q, text in claims:
        uq = unit(Counter(terms(text)))
        for d, ud in units.items():
            out[q, d] = round(sum(w * ud.get(t, 0.0) for t, w in uq.items()), 6)
    return out


def test_positions_are_dense_and_in_hash_order(spark):
    ids = [f"d{i}" for i in range(500)]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id string").repartition(7)
    got = rows(pos.document_positions(df), "position", "doc_id")
    want = sorted(ids, key=lambda d: hashlib.md5(d.encode()).hexdigest())
    assert got == list(enumerate(want))


@pytest.mark.parametrize("ranges", [1, 3, 1024])
def test_pick_outside_equals_listing_the_complement(spark, monkeypatch, ranges):
    monkeypatch.setattr(pos, "RANGES", ranges)
    n = 40
    rng = random.Random(1)
    excluded = {q: sorted(rng.sample(range(n), size)) for q, size in (("a", 0), ("b", 1), ("c", 35), ("d", 39))}
    positions = spark.createDataFrame([(f"d{i}", i) for i in range(n)], "doc_id string, position bigint")
    ex = spark.createDataFrame(
        [(q, p) for q, ps in excluded.items() for p in ps], "query_id string, position bigint"
    )
    ranks = [(q, r) for q, ps in excluded.items() for r in range(n - len(ps))]
    picks = spark.createDataFrame(ranks, "query_id string, rank bigint")
    got = rows(pos.pick_outside(picks, ex, positions, ["query_id"], n), "query_id", "doc_id")
    want = sorted((q, f"d{i}") for q, ps in excluded.items() for i in range(n) if i not in ps)
    assert got == want


def test_draws_are_distinct_in_range_and_spread(spark):
    claims = spark.range(4000).select(F.col("id").cast("string").alias("query_id"), F.lit(3).alias("n_excluded"))
    drawn = defaultdict(list)
    for q, r in ng.draw_ranks(claims, 13, 4, 42).collect():
        drawn[q].append(r)
    assert all(len(set(r)) == 4 and min(r) >= 0 and max(r) < 10 for r in drawn.values())
    share = Counter(r for rs in drawn.values() for r in rs)
    assert all(1400 < share[i] < 1800 for i in range(10))  # 1600 expected


def test_fewer_documents_than_asked_for(spark):
    world = [("d0", "aa", "bb"), ("d1", "cc", "dd"), ("d2", "ee", "ff")], [("q", "aa")], [("train", "q", "d0")]
    corpus, claims, qrels = frames(spark, world)
    out = build_relevance_pairs(corpus, claims, qrels, ["title"], NegativeParams(n_random=5, n_hard=5))
    assert rows(out, "doc_id", "label") == [
        ("d0", "relevant"), ("d1", "not_relevant"), ("d2", "not_relevant")
    ]


@pytest.mark.parametrize("variant", ["title", "abstract", "title_abstract"])
def test_hard_negatives_equal_brute_force(spark, variant):
    world = small_world()
    corpus, claims, qrels = frames(spark, world)
    chosen = ng.choose_negatives(corpus, claims, positive_lookup(qrels), [variant], NegativeParams(n_hard=3))
    got = defaultdict(dict)
    for r in chosen.collect():
        got[r.query_id].setdefault(r.kind, set()).add(r.doc_id)
    text = {
        "title": lambda t, a: t, "abstract": lambda t, a: a, "title_abstract": lambda t, a: f"{t}. {a}"
    }[variant]
    scores = brute_scores({d: text(t, a) for d, t, a in world[0]}, world[1])
    for q, _ in world[1]:
        positives = {d for _, qq, d in world[2] if qq == q}
        assert len(got[q]["random"]) == 2
        assert not (got[q]["random"] | got[q]["hard"]) & positives
        allowed = [d for d, _, _ in world[0] if d not in positives | got[q]["random"]]
        order = sorted(
            allowed,
            key=lambda d: (-scores[q, d], d if scores[q, d] > 0 else hashlib.md5(d.encode()).hexdigest()),
        )
        assert got[q]["hard"] == set(order[:3])


def test_random_picks_do_not_depend_on_variant_or_partitions(spark):
    corpus, claims, qrels = frames(spark, small_world())
    picks = {}
    for parts in (1, 5):
        chosen = ng.choose_negatives(
            corpus.repartition(parts), claims.repartition(parts), positive_lookup(qrels)
        )
        picks[parts] = rows(chosen, "field_variant", "query_id", "doc_id", "kind")
    assert picks[1] == picks[5]
    by_variant = defaultdict(set)
    for v, q, d, kind in picks[1]:
        if kind == "random":
            by_variant[v].add((q, d))
    assert by_variant["title"] == by_variant["abstract"] == by_variant["title_abstract"]


def test_no_hard_negatives_means_none(spark):
    corpus, claims, qrels = frames(spark, small_world())
    chosen = ng.choose_negatives(
        corpus, claims, positive_lookup(qrels), ["title"], NegativeParams(n_random=1, n_hard=0)
    )
    assert {r.kind for r in chosen.collect()} == {"random"}


def test_claim_blocks_and_heavy_claims_change_nothing(spark, monkeypatch):
    corpus, claims, qrels = frames(spark, small_world())
    # One claim holds most of the judgments.
    hot = corpus.limit(40).select(F.lit("train").alias("split"), F.lit("q3").alias("query_id"), "doc_id")
    excluded = positive_lookup(qrels.unionByName(hot))
    columns = ("field_variant", "query_id", "doc_id", "kind")
    want = rows(ng.choose_negatives(corpus, claims, excluded), *columns)
    monkeypatch.setattr(tfidf, "BLOCK_ROWS", 60)
    assert rows(ng.choose_negatives(corpus, claims, excluded), *columns) == want
    # A vocabulary too large to be sent is joined.
    monkeypatch.setattr(tfidf, "VOCABULARY_ROWS", 1)
    monkeypatch.setattr(tfidf, "CLAIM_TERM_ROWS", 20)
    assert rows(ng.choose_negatives(corpus, claims, excluded), *columns) == want


def test_best_documents_are_those_of_plain_scoring(spark):
    """Many batches, mass copies and every depth: what MaxScore leaves out never belongs to the best."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(40)]
    texts = [" ".join(rng.choices(words, weights, k=rng.randrange(0, 30))) for _ in range(500)] + ["w0 w1 w7 w9"] * 80
    corpus = spark.createDataFrame([(f"d{i:04}", t, "") for i, t in enumerate(texts)], "doc_id string, title string, abstract string")
    claims = spark.createDataFrame(
        [(f"q{i}", " ".join(rng.choices(words, k=6))) for i in range(12)] + [("q99", "nothing known")], "query_id string, claim string"
    )
    doc_terms = stage(tfidf.document_terms(corpus, ["title"]), "t")
    vocabulary = tfidf.build_vocabulary(doc_terms, corpus.count())
    vectors = stage(tfidf.claim_vectors(claims, vocabulary), "v")
    plain = stage(tfidf.similarity(doc_terms, vocabulary, vectors), "plain")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        for depth in (1, 7, 90, 1000):
            asked = claims.select("query_id", F.lit(depth).alias("depth"))
            got = rows(tfidf.top_documents(doc_terms, vocabulary, vectors, asked), "query_id", "doc_id", "score")
            assert got == rows(tfidf.top_similar(plain, depth), "query_id", "doc_id", "score")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_terms_are_counted_a_batch_at_a_time(spark):
    """The rows that counting each array by column expressions gives, in one place for all variants, and no row per posting."""
    texts = [("Kidney kidney stones", "the kidney\u00e9 stones, Stones"), (None, None), ("", "a b"), ("\u4e2d\u6587 the", None), ("x1 x2 x1", "x2")]
    corpus = spark.createDataFrame([(f"d{i}", *t) for i, t in enumerate(texts)], "doc_id string, title string, abstract string")
    corpus = corpus.coalesce(1)
    counted = tfidf.document_terms(corpus)
    tokens = tx.tokenize(corpus, {v: tx.clean(v) for v in ("title", "abstract")})
    per_variant = {"title": F.col("title"), "abstract": F.col("abstract"), "title_abstract": F.concat("title", "abstract")}
    want = [tokens.select("doc_id", F.lit(v).alias("v"), tx.count_terms(c).alias("terms")) for v, c in per_variant.items()]
    assert rows(counted, "doc_id", "field_variant", "terms") == sorted(sum((rows(w, "*") for w in want), []))
    assert counted.dtypes == [("doc_id", "string"), ("field_variant", "string"), ("terms", "array<struct<term:string,tf:int>>")]
    with pytest.raises(KeyError):
        tfidf.document_terms(corpus, ["body"])

    plain = tfidf.postings(counted).groupBy("field_variant", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("ctf"))
    statistics = tfidf.term_statistics(counted, 1)
    assert rows(statistics, *plain.columns) == rows(plain, *plain.columns)
    plan = statistics._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 and "Generate" not in plan and "sort_array" not in plan
    assert tfidf.term_statistics(counted.limit(0), 1).isEmpty()


def test_a_term_is_one_row_for_all_variants_until_it_is_summed_up(spark):
    """A third of the rows or so to exchange; a variant without a term has no row for it, nor has one below ``min_df``."""
    texts = [("stone kidney", "stone stone"), ("stone", "liver"), ("", "liver kidney"), ("", "")]
    corpus = spark.createDataFrame([(f"d{i}", *t) for i, t in enumerate(texts)], "doc_id string, title string, abstract string")
    counted = stage(tfidf.document_terms(corpus.coalesce(1)), "t")
    columns = ("field_variant", "term", "df", "ctf")
    assert rows(tfidf.term_statistics(counted), *columns) == [
        ("abstract", "liver", 2, 2), ("title", "stone", 2, 2), ("title_abstract", "kidney", 2, 2),
        ("title_abstract", "liver", 2, 2), ("title_abstract", "stone", 2, 4),
    ]
    assert len(rows(tfidf.term_statistics(counted, 0), *columns)) == 8
    statistics = tfidf.term_statistics(tfidf.document_terms(corpus, ["abstract"]), 1)
    assert {r.field_variant for r in statistics.collect()} == {"abstract"}
    plan = statistics._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"hashpartitioning\(([^)]*)\)", plan)[0].startswith("term#")


def test_many_claims_meet_documents_in_cells_of_bounded_size(spark, monkeypatch):
    """Blocks and chunks of a few rows, copies and uneven depths: the same rows as plain scoring, no claim on the driver."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    texts = [" ".join(rng.choices(words, weights, k=rng.randrange(0, 30))) for _ in range(300)] + ["w0 w1 w7 w9"] * 80
    corpus = spark.createDataFrame([(f"d{i:04}", t, t[:9]) for i, t in enumerate(texts)], "doc_id string, title string, abstract string")
    claims = spark.createDataFrame([(f"q{i}", " ".join(rng.choices(words, k=6))) for i in range(50)], "query_id string, claim string")
    doc_terms = stage(tfidf.document_terms(corpus), "t")
    vocabulary = tfidf.build_vocabulary(doc_terms, corpus.count())
    vectors = stage(tfidf.claim_vectors(claims, vocabulary), "v")
    plain = stage(tfidf.similarity(doc_terms, vocabulary, vectors), "plain")
    depth = claims.select("query_id", F.when(F.col("query_id") == "q7", 200).otherwise(3).alias("depth"))
    joined = tfidf.top_similar(plain, 200).join(depth, "query_id").where("rank <= depth")
    want = rows(joined, "field_variant", "query_id", "doc_id", "score")
    monkeypatch.setattr(tfidf, "BLOCK_ROWS", 0)
    monkeypatch.setattr(tfidf, "_scan_block", None)
    for small in (7, 2048):
        monkeypatch.setattr(tfidf.sparse_topk, "CLAIM_BLOCK", 3 * small)
        monkeypatch.setattr(tfidf.sparse_topk, "DOCUMENT_BLOCK", 20 * small)
        got = tfidf.top_documents(doc_terms, vocabulary, vectors, depth)
        assert rows(got, "field_variant", "query_id", "doc_id", "score") == want


@pytest.mark.parametrize("chunk", [3, 64, 2048])
def test_a_cell_keeps_the_best_of_plain_scoring(monkeypatch, chunk):
    """Chunks, pieces and shallow cuts of any size, uneven depths, copies and tied scores."""
    monkeypatch.setattr(tfidf.sparse_topk, "CHUNK", chunk)
    monkeypatch.setattr(tfidf.sparse_topk, "PRODUCTS", 10 * chunk)
    monkeypatch.setattr(tfidf.sparse_topk, "SHALLOW", chunk)
    rng = np.random.default_rng(chunk)
    documents = np.where(rng.random((400, 30)) < 0.15, rng.integers(1, 4, (400, 30)), 0.0) * np.linspace(1, 4, 30)
    documents[100:250] = documents[100]
    documents /= np.maximum(np.linalg.norm(documents, axis=1, keepdims=True), 1e-9)
    claims = np.where(rng.random((40, 30)) < 0.3, rng.random((40, 30)), 0.0)
    depth = np.where(np.arange(40) % 9 == 0, 170, rng.integers(1, 6, 40))

    def sparse(rows):
        row, term = np.nonzero(rows)
        return np.bincount(row, minlength=len(rows)), term.astype(np.int32), rows[row, term]

    top = tfidf.sparse_topk.CellTopK(*sparse(claims), depth, 6)
    for at in range(0, 400, 90):
        top.add(*sparse(documents[at : at + 90]))
    claim, document, score = top.best()
    scores = np.round(claims @ documents.T, 6)
    for c in range(40):
        want = [d for d in np.lexsort((np.arange(400), -scores[c])) if scores[c, d] > 0][: depth[c]]
        assert document[claim == c].tolist() == want
        assert np.allclose(score[claim == c], scores[c, want], atol=1e-9)


def test_blocks_of_claims_are_sent_and_nothing_is_exchanged(spark, monkeypatch):
    """Whatever the number of blocks, documents are scored where they are read and no row is copied for a block."""
    words = {"title": (["a", "b"], [1.0, 2.0])}
    entries = "array(struct('a' AS term, 1.0D AS value), struct('b' AS term, cast(id % 3 AS double) + 1 AS value)) AS terms"
    rows_ = spark.range(40).selectExpr("'title' AS field_variant", "concat('x', id) AS id", entries)
    documents = stage(tfidf.sparse_topk.numbered(rows_, words, unit=True).coalesce(2).sortWithinPartitions("field_variant", "id"), "n")
    claims = stage(tfidf.sparse_topk.numbered(rows_, words, unit=False).withColumn("depth", F.lit(2).cast("long")), "c")
    assert tfidf.sparse_topk.in_runs(documents, 10**9).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    found = {}
    for size in (1000, 10):
        monkeypatch.setattr(tfidf.sparse_topk, "CLAIM_BLOCK", size)
        plans, got = [], []
        for scored in tfidf.sparse_topk.scored_blocks(documents, claims, 6):
            plans.append(scored._jdf.queryExecution().executedPlan().toString())
            got += scored.where("depth = 2").collect()
        assert len(plans) == 40 // min(size, 40)
        assert not any("Exchange" in p or "Join" in p for p in plans)
        found[size] = sorted(map(tuple, got))
        assert {r.query_id for r in got} == {f"x{i}" for i in range(40)}
    assert found[10] == found[1000]


def test_a_run_ends_where_ids_or_the_variant_start_anew():
    def batch(*rows):
        return pa.RecordBatch.from_pylist([{"field_variant": v, "id": i} for v, i in rows], pa.schema([("field_variant", pa.string()), ("id", pa.string())]))

    batches = [batch(("a", "d1"), ("a", "d2")), batch(), batch(("a", "d2"), ("a", "\u00e9"), ("b", "d1")), batch(("b", "d0"), ("b", None))]
    got = [(v, fresh, rows.column("id").to_pylist()) for v, fresh, rows in tfidf.sparse_topk._runs(iter(batches))]
    assert got == [
        ("a", True, ["d1", "d2"]),
        ("a", False, ["d2", "\u00e9"]),
        ("b", True, ["d1"]),
        ("b", True, ["d0"]),
        ("b", True, [None]),
    ]


def test_a_full_claim_keeps_the_first_of_equal_documents():
    """Copies that come later never wait to be sorted, and a term that cannot help is looked up for candidates alone."""
    top = tfidf.sparse_topk.CellTopK(np.array([2]), np.array([0, 1]), np.array([0.9, 0.1]), np.array([2]), 6)
    copies = (np.full(3000, 1), np.zeros(3000, np.int32), np.ones(3000))
    top.add(*copies)
    top.best()
    before = top.waiting
    top.add(*copies)
    assert top.waiting == before == 0
    top.add(np.array([2, 1]), np.array([0, 1, 1], np.int32), np.array([1.0, 0.5, 1.0]))
    claim, document, score = top.best()
    assert document.tolist() == [6000, 0] and score.tolist() == [0.95, 0.9]


def test_postings_are_not_exchanged_on_the_way_to_the_claims(spark, sf_dir):
    corpus, claims, _ = bd.passages(spark, sf_dir)
    doc_terms = stage(tfidf.document_terms(corpus), "t")
    vocabulary = tfidf.build_vocabulary(doc_terms, corpus.count())
    vectors = stage(tfidf.claim_vectors(claims, vocabulary), "v")
    index = {"title": tfidf._Claims(["a"], [1.0], [("q", "a", 1.0)], {"q": 2})}
    scored = tfidf._scan_block(doc_terms, index)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "MapInArrow" in plan
    depth = vectors.select("query_id", F.lit(2).alias("depth")).distinct()
    top = tfidf.top_documents(doc_terms, vocabulary, vectors, depth)
    assert "Exchange" not in top._jdf.queryExecution().executedPlan().toString()  # staged


def test_vocabulary_cap_keeps_the_most_frequent_terms(spark):
    corpus, _, _ = frames(spark, small_world())
    doc_terms = stage(tfidf.document_terms(corpus), "t")
    stats = stage(tfidf.term_statistics(doc_terms), "s")
    everything = stats.collect()
    for cap in (1, 7, 10_000):
        got = Counter(r.field_variant for r in tfidf.cap_vocabulary(stats, cap).collect())
        for v in ("title", "abstract", "title_abstract"):
            ranked = sorted((r for r in everything if r.field_variant == v), key=lambda r: (-r.ctf, r.term))
            kept = {
                r.term for r in tfidf.cap_vocabulary(stats, cap).where(F.col("field_variant") == v).collect()
            }
            assert got[v] == min(cap, len(ranked))
            assert kept == {r.term for r in ranked[:cap]}


def test_relevance_pairs_shape(spark):
    world = small_world()
    corpus, claims, qrels = frames(spark, world)
    pairs = build_relevance_pairs(corpus, claims, qrels).collect()
    assert len({(r.split, r.field_variant, r.query_id, r.doc_id) for r in pairs}) == len(pairs)
    per_claim = Counter((r.field_variant, r.split, r.query_id) for r in pairs if r.label == "not_relevant")
    assert set(per_claim.values()) == {4}
    assert all(r.label_id == (1 if r.label == "relevant" else 0) for r in pairs)
    judged = {(s, q, d) for s, q, d in world[2]}
    assert {(r.split, r.query_id, r.doc_id) for r in pairs if r.label == "relevant"} == judged


def test_stance_pairs(spark):
    corpus, claims, _ = frames(spark, small_world())
    claims = claims.withColumn("split", F.lit("train"))
    evidence = spark.createDataFrame(
        [
            ("train", "q0", "d1", "SUPPORT"),
            ("train", "q0", "d2", "contradict"),
            ("train", "q1", "missing", "SUPPORT"),
            ("train", "q2", "d3", "NEI"),
        ],
        "split string, query_id string, doc_id string, label string",
    )
    out = build_stance_pairs(corpus, claims, evidence, ["title"])
    stances = [r for r in rows(out, "query_id", "doc_id", "label") if r[2] != "NEI"]
    assert stances == [("q0", "d1", "SUPPORTS"), ("q0", "d2", "REFUTES")]
    nei = Counter(r.query_id for r in out.where("label = 'NEI'").collect())
    assert nei == {"q0": 4, "q1": 4, "q2": 4}
    ids = {(r.label, r.label_id) for r in out.collect()}
    assert ids == {("NEI", 0), ("REFUTES", 1), ("SUPPORTS", 2)}


def test_similarity_plan_has_no_pair_shuffle(spark, sf_dir):
    corpus, claims, _ = bd.passages(spark, sf_dir)
    doc_terms = stage(tfidf.document_terms(corpus), "t")
    vocabulary = tfidf.build_vocabulary(doc_terms, corpus.count())
    vectors = stage(tfidf.claim_vectors(claims, vocabulary), "v")
    top = tfidf.top_similar(tfidf.similarity(doc_terms, vocabulary, vectors), 2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert "SortMergeJoin" not in plan and "Python" not in plan and "Cartesian" not in plan
    # asked terms, documents, final top-k: nothing keyed by the scored pairs
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(exchanges) == 3
    assert not any("doc_id" in e and "query_id" in e for e in exchanges)


def test_corpus_text_is_not_shuffled_for_small_samples(spark, tmp_path):
    corpus, claims, qrels = frames(spark, small_world())
    corpus.write.parquet(str(tmp_path / "corpus"))
    corpus = spark.read.parquet(str(tmp_path / "corpus"))
    claims.write.parquet(str(tmp_path / "claims"))
    claims = spark.read.parquet(str(tmp_path / "claims"))
    pairs = build_relevance_pairs(corpus, claims, qrels)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2
    assert "Exchange hashpartitioning" not in plan
