import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from claimweave.config import PAIR_SCHEMA
from claimweave.sources import artifacts, benchmark, jsonl, pair_tables
from claimweave.sources.scan import scan_bytes, spread


def write_lines(path, records):
    path.write_text("\n".join(json.dumps(r) for r in records) + "\n", encoding="utf-8")
    return str(path)


def test_corpus_jsonl(spark, tmp_path):
    path = write_lines(
        tmp_path / "corpus.jsonl",
        [
            {"doc_id": 1, "title": " padded ", "abstract": ["One.", "Two [2]."]},
            {"doc_id": "2", "title": "t", "abstract": " plain text "},
            {"doc_id": 3, "title": "t", "abstract": "[Background] text"},
            {"doc_id": 4, "title": "t"},
            {"doc_id": 5, "abstract": []},
        ],
    )
    assert rows(jsonl.read_corpus_jsonl(spark, path), "doc_id", "title", "abstract") == [
        ("1", "padded", "One. Two [2]."),
        ("2", "t", "plain text"),
        ("3", "t", "[Background] text"),
        ("4", "t", ""),
        ("5", "", ""),
    ]


def test_claims_jsonl(spark, tmp_path):
    evidence = {
        "10": [{"sentences": [1], "label": "SUPPORT"}, {"sentences": [2], "label": "CONTRADICT"}],
        "11": [{"sentences": [], "label": "contradict"}],
        "12": [{"sentences": [0], "label": "OTHER"}],
        "13": [],
    }
    train = write_lines(
        tmp_path / "train.jsonl",
        [{"id": 1, "claim": "c1", "evidence": evidence}, {"id": 2, "claim": "c2", "evidence": {}}],
    )
    dev = write_lines(
        tmp_path / "dev.jsonl",
        [{"id": 3, "claim": "c3", "evidence": {"10": [{"sentences": [1], "label": "REFUTES"}]}}],
    )
    claims = jsonl.read_claims_jsonl(spark, {"train": train, "validation": dev})
    assert rows(jsonl.explode_evidence(claims), "split", "query_id", "doc_id", "label") == [
        ("test", "3", "10", "REFUTES"),
        ("train", "1", "10", "SUPPORT"),
        ("train", "1", "11", "CONTRADICT"),
    ]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jsonl.read_claims_jsonl(spark, {"train": str(tmp_path / "none.jsonl")})


PAIRS = [
    ("train", "title", "q1", "d1", 'say "hi"', " lead and trail ", "line\nbreak, comma", "x\\y", "relevant", 1),
    ("test", "title", "q2", "d2", "", "", "", "", "not_relevant", 0),
    ("test", "abstract", "q2", "d2", "c", "é", "a\r\nb", "\ttab", "not_relevant", 0),
]


def test_pairs_csv_round_trip(spark, tmp_path):
    pairs = spark.createDataFrame(PAIRS, PAIR_SCHEMA)
    paths = pair_tables.write_pairs_csv(pairs, str(tmp_path), "pairs", ["title", "abstract"])
    everything = pair_tables.read_pairs_csv(spark, paths[-1])
    assert everything.dtypes == [(f.name, f.dataType.simpleString()) for f in PAIR_SCHEMA.fields]
    assert rows(everything, *PAIR_SCHEMA.names) == sorted(PAIRS)
    assert rows(pair_tables.read_pairs_csv(spark, paths[0]), "query_id") == [("q1",), ("q2",)]


def test_empty_pairs_keep_their_schema(spark, tmp_path):
    paths = pair_tables.write_pairs_csv(spark.createDataFrame([], PAIR_SCHEMA), str(tmp_path), "e", ["title"])
    assert pair_tables.read_pairs_csv(spark, paths[0]).count() == 0


def test_published_layout_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "published")
    pair_tables.publish_pairs(spark.createDataFrame(PAIRS, PAIR_SCHEMA), path)
    test_title = pair_tables.read_published(spark, path, "title", "test")
    assert rows(test_title, *PAIR_SCHEMA.names) == [PAIRS[1]]
    plan = test_title._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(field_variant" in plan


def test_results_and_metadata_round_trip(spark, tmp_path):
    keys = "field_variant string, classifier string, "
    scores = spark.createDataFrame(
        [("title", "a", 0.9, 0.8, 10, 4, 9), ("title", "b", 0.7, 0.6, 10, 4, 9)],
        keys + "accuracy double, macro_f1 double, train_rows bigint, test_rows bigint, feature_dim int",
    )
    report = spark.createDataFrame(
        [("title", c, lab, 0.5, 0.5, 0.5, 2) for c in "ab" for lab in ("x", "macro avg")],
        keys + "label string, precision double, recall double, f1 double, support bigint",
    )
    nested = artifacts.nested_results(scores, report, scores.where("classifier = 'a'"))
    artifacts.write_results(nested, str(tmp_path / "r"))
    got = artifacts.read_results(spark, str(tmp_path / "r")).first()
    assert got.best_classifier == "a" and got.best_macro_f1 == 0.8
    assert [r.classifier for r in got.results] == ["a", "b"]
    assert got.results[1].report["x"].support == 2
    meta = {
        "project": "p", "embedding_model": "e", "field_variant": "title", "classifier": "a",
        "feature_dim": 9, "label2id": {"no": 0, "yes": 1}, "id2label": {0: "no", 1: "yes"},
    }
    artifacts.write_metadata(spark, str(tmp_path / "m"), meta)
    read = artifacts.read_metadata(spark, str(tmp_path / "m")).first()
    assert read.id2label == {0: "no", 1: "yes"} and read.label2id == meta["label2id"]


def test_vector_store_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("d", "t", "a", [0.5, 0.5])], "doc_id string, title string, abstract string, embedding array<double>"
    )
    artifacts.write_vector_store(df, str(tmp_path / "v"))
    assert artifacts.read_vector_store(spark, str(tmp_path / "v")).first().embedding == [0.5, 0.5]


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_load_benchmark(spark, tmp_path, fmt):
    tables = {
        "corpus": [{"_id": "7", "title": "t", "text": "x"}],
        "queries": [{"_id": "1", "text": "c"}],
        "train": [{"query-id": 1, "corpus-id": 7}],
        "test": [{"query-id": 1, "corpus-id": 7}],
    }
    paths = {}
    for name, records in tables.items():
        source = write_lines(tmp_path / f"{name}.jsonl", records)
        paths[name] = source
        if fmt == "parquet":
            paths[name] = str(tmp_path / name)
            spark.read.json(source).write.parquet(paths[name])
    corpus, claims, qrels = benchmark.load_benchmark(
        spark, paths["corpus"], paths["queries"], {s: paths[s] for s in ("train", "test")}, fmt
    )
    assert rows(corpus, "doc_id", "title", "abstract") == [("7", "t", "x")]
    assert rows(claims, "query_id", "claim") == [("1", "c")]
    assert rows(qrels, "split", "query_id", "doc_id") == [("test", "1", "7"), ("train", "1", "7")]


def test_spread_leaves_large_scans_alone(spark, tmp_path, monkeypatch):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr("claimweave.sources.scan.SPREAD_LIMIT", scan_bytes(df))
    assert spread(df) is df
    assert spread(df).agg(F.count("*")).first()[0] == 1000


def test_publishing_one_split_again_leaves_the_others_files(spark, tmp_path):
    pairs = spark.createDataFrame(
        [(s, v, f"q{i}", f"d{i}", "c", "t", "a", "x", "relevant", 1) for i in range(20) for s in ("train", "test") for v in ("title", "abstract")],
        PAIR_SCHEMA,
    )
    path = tmp_path / "published"
    pair_tables.publish_pairs(pairs, str(path))
    files = {s: {f: f.stat().st_mtime_ns for f in path.glob(f"*/split={s}/*.parquet")} for s in ("train", "test")}
    pair_tables.publish_pairs(pairs.where("split = 'test' and query_id < 'q2'"), str(path), incremental=True)
    assert {f: f.stat().st_mtime_ns for f in path.glob("*/split=train/*.parquet")} == files["train"]
    assert not files["test"].keys() & set(path.glob("*/split=test/*.parquet"))
    again = pair_tables.read_published(spark, str(path))
    assert again.where("split = 'train'").count() == 40
    assert {r.query_id for r in again.where("split = 'test'").collect()} == {q for q in (f"q{i}" for i in range(20)) if q < "q2"}
    for f in path.glob("*/split=train/*.parquet"):
        ids = [r.query_id for r in spark.read.parquet(str(f)).collect()]
        assert ids == sorted(ids)
