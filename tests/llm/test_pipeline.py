"""Every stage against a plain version on its own input."""

import corpus_pipeline
import pyarrow as pa
import pytest

from claimweave.llm import bpe, quality
from claimweave.llm.common import stage

BASE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    out = [docs]
    for _, function in corpus_pipeline.STAGES:
        out.append(stage(function(spark, out[-1], BASE), "step"))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_and_order(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "BPE encoding and decoding"
    ]
    assert all(s.columns == steps[0].columns for s in steps[:-1])


def test_quality_keeps_clean_documents(spark, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{BASE}/labels.parquet").collect()}
    kept = texts(steps[1])
    clean = [i for i, q in labels.items() if q == 1]
    junk = [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in clean) > 0.99 * len(clean) and sum(i in kept for i in junk) < 0.1 * len(junk)
    model = quality.fit_quality(quality.training_rows(steps[0], spark.read.parquet(f"{BASE}/labels.parquet")))
    again = quality.scored(steps[0], model).where("predicted = 1")
    assert {r.doc_id for r in again.select("doc_id").collect()} == set(kept)


def test_one_of_each_exact_group_stays(steps):
    best = {}
    for i, t in texts(steps[1]).items():
        key = "".join(t.split())
        best[key] = min(best.get(key, (1, 0)), (-len(t), i))
    assert set(texts(steps[2])) == {i for _, i in best.values()}


def test_one_of_each_near_class_stays(steps):
    sets = {}
    for i, t in texts(steps[2]).items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    inverse = {}
    for i, s in sets.items():
        for x in s:
            inverse.setdefault(x, []).append(i)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in {(p[0], q) for p in inverse.values() for q in p[1:]} | {(a, b) for p in inverse.values() if len(p) < 50 for a in p for b in p}:
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    assert set(texts(steps[3])) == {i for i in sets if find(i) == i}


def test_benchmark_items_are_gone(spark, steps):
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{BASE}/benchmark.parquet").collect()]
    before, after = texts(steps[3]), texts(steps[4])
    holds = {i for i, t in before.items() if any(x in " ".join(t.lower().split()) for x in items)}
    gone = set(before) - set(after)
    assert holds <= gone and len(gone - holds) <= 2


def test_tokens_of_what_is_left(steps):
    import public_tokenizers

    own = bpe.load(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: len(own.encode(t)) // 4 for i, t in texts(steps[4]).items()}
    assert {r.doc_id: r.n_tokens for r in steps[5].collect()} == want
    assert all(len(r.ids) == r.n_tokens for r in steps[5].collect())


def test_texts_reach_python_in_bounded_batches(spark, tmp_path, monkeypatch):
    def largest(session, docs, sf_dir):
        def count(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows])})

        return docs.mapInArrow(count, "n long")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("count rows", largest)])
    docs = [(i, "word " * 50) for i in range(3500)]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    before = spark.conf.get(corpus_pipeline.ARROW_ROWS)
    sizes = [r.n for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sum(sizes) == 3500 and max(sizes) <= corpus_pipeline.TEXTS
    assert spark.conf.get(corpus_pipeline.ARROW_ROWS) == before


def test_stages_bound_memory_also_when_called_one_by_one(spark, tmp_path):
    """Stages are called without ``run`` as well; what they return is computed under the same settings."""
    texts = [f"word{i} letters and some more words of text number {i}, all in one line. " * 3 for i in range(2500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    names = (corpus_pipeline.ARROW_ROWS, corpus_pipeline.VECTORED)
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for _, function in corpus_pipeline.STAGES[1:2] + corpus_pipeline.STAGES[4:]:
            for name in names:
                spark.conf.unset(name)
            function(spark, docs, str(tmp_path))
            assert int(spark.conf.get(names[0])) <= corpus_pipeline.TEXTS and spark.conf.get(names[1]) == "false"
        spark.conf.unset(names[1])
        spark.conf.set(names[0], "300")  # fewer than the bound stay
        corpus_pipeline.encode(spark, docs, str(tmp_path))
        assert spark.conf.get(names[0]) == "300"
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
