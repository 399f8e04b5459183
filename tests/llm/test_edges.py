"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import corpus_pipeline
import pytest

from claimweave.llm import bpe, decontaminate, exact_dedup, language, ngram_join, passages, pii, quality, secrets, sharding
from claimweave.llm.queries import QUERIES

LONG = " ".join(f"word{i % 977} of{i % 31} line{i}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i} part{i % 7}" for i in range(40))
CLASHING = (
    "size count row node key token tokens norm label score predicted letters draw part rank place slot shard fraction hub start "
    "hit value left right word place keys component least lang_pred held_out _text _row _words item_id"
).split()
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [
    (1, "", "en", "a"),
    (2, None, None, None),
    (3, " \n\t ", "en", "a"),
    (4, LONG, "en", "b"),
    (5, "The cat sat on the mat with a hat.", "en", "a"),
    (6, "The cat sat on  the mat with a hat.\n", None, "a"),
    (7, "Le chat est sur le toit de la maison rouge.", "fr", "b"),
    (7, "Le chat est sur le toit de la maison rouge.", "fr", "b"),
    (None, "A row without an id at all.", "en", None),
    (8, f"one {PASSAGE} end", "en", "a"),
    (9, f"another beginning {PASSAGE} and another end", "en", "c"),
    (10, "12345 +++ ---", "en", "c"),
    (11, 'mail a.b@c.example.org 10.0.0.1, 4111 1111 1111 1111, +1 (403) 555-9312 token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "en", "c"),
    (12, "word", "fr", "c"),
]


def frame(spark, rows=ROWS):
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], COLUMNS)
    return docs.selectExpr("*", *[f"'clash' AS `{c}`" for c in dict.fromkeys(CLASHING)])


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edges") / "documents.parquet")
    frame(spark).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, []).limit(0)


def ids(df, column="doc_id"):
    return sorted((r[0] for r in df.select(column).collect()), key=lambda x: (x is None, x))


ALL_IDS = sorted((r[0] for r in ROWS), key=lambda x: (x is None, x))


def benchmark(spark, rows=((1, PASSAGE.upper()), (2, None), (3, ""), (4, "short"), (5, PASSAGE), (None, PASSAGE))):
    return spark.createDataFrame(list(rows), "item_id long, text string").selectExpr("*", "'x' AS doc_id", "'y' AS edits")


def test_decontamination(spark, docs, none):
    found = decontaminate.find_contamination(docs, benchmark(spark))
    assert {(r.doc_id, r.item_id, r.edits) for r in found.collect()} == {(d, i, 0) for d in (8, 9) for i in (1, 5, None)}
    left = decontaminate.drop_contaminated(docs, benchmark(spark))
    assert left.columns == docs.columns and ids(left) == [i for i in ALL_IDS if i not in (8, 9)]
    assert decontaminate.find_contamination(none, benchmark(spark)).count() == 0
    assert decontaminate.find_contamination(docs, benchmark(spark, [(1, "")])).count() == 0
    assert decontaminate.find_contamination(docs, benchmark(spark).limit(0)).count() == 0


def test_language(docs, none):
    model = language.fit_languages(docs)
    assert set(model.languages) == {"en", "fr"}
    got = language.identify(docs, model)
    by_id = {r.doc_id: r for r in got.collect()}
    assert ids(got) == ALL_IDS
    for i in (1, 2, 3, 10):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True)
    assert by_id[7].lang_pred == "fr" and by_id[5].lang_pred == "en" and 0 < by_id[4].score <= 1
    assert language.identify(none, model).count() == 0
    untaught = language.fit_languages(none)
    assert {r.lang_pred for r in language.identify(docs, untaught).collect()} == {"und"}


def test_ngram_join(docs, none):
    got = ngram_join.jaccard_classes(docs, ngram_join.JoinParams(3, 90)).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == sorted(
        ((i, {6: 5, 9: 8}.get(i, i)) for i in ALL_IDS), key=str
    )
    sizes = {r.doc_id: r.n_shingles for r in got}
    assert [sizes[i] for i in (1, 2, 3, 12, 5)] == [0, 0, 0, 1, 7]
    kept = ngram_join.drop_similar(docs)
    stay = [i for i in ALL_IDS if i not in (6, 9)]
    stay.remove(7)  # of rows with equal id and text one stays
    assert kept.columns == docs.columns and ids(kept) == stay
    assert ngram_join.jaccard_classes(none).count() == 0


def test_sharding(docs, none):
    for shards in (4, 40):
        got = sharding.assign_shards(docs, shards).collect()
        assert sorted((r.doc_id for r in got), key=lambda x: (x is None, x)) == ALL_IDS
        counts = {}
        for r in got:
            counts.setdefault(r.shard, []).append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in counts.values())
        assert max(map(len, counts.values())) - min(len(counts.get(k, ())) for k in range(shards)) <= 1
    sizes = {r.doc_id: (r.size, r.text_crc32) for r in got}
    assert sizes[1] == sizes[2] == (1, 0) and sizes[4][0] == len(LONG) + 1
    assert sharding.assign_shards(none).count() == 0


def test_personal_data(docs, none):
    got = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    r = got[11]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    assert r.spans == "email:5:22,ip:23:31,card:33:52,phone:54:71"
    assert got[1].spans == got[2].spans == got[4].spans == ""
    assert pii.find_personal_data(none).count() == 0


def test_byte_pairs(docs, none):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    got = bpe.tokens(docs, path)
    by_id = {r.doc_id: r for r in got.collect()}
    assert ids(got) == ALL_IDS
    assert by_id[1].n_tokens == by_id[2].n_tokens == by_id[3].n_tokens == 0 and by_id[2].decoded == ""
    assert by_id[4].n_tokens == len(by_id[4].ids) > 90_000
    assert bpe.tokens(none, path).count() == 0


def test_quality(spark, docs, none):
    model = quality.RuleModel(0.5, (((("letters", "<=", 0.3),), -3.0), ((("log_chars", ">", 2.0), ("distinct_words", ">", 0.1)), 1.0)))
    got = quality.scored(docs, model)
    assert ids(got) == ALL_IDS and set(docs.columns) <= set(got.columns)
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[1].predicted == by_id[2].predicted == by_id[10].predicted == 0 and by_id[5].predicted == 1
    assert by_id[5]["letters"] == "clash" and quality.scored(none, model).count() == 0
    for label, low, high in ((1, 0.9, 1), (0, 0, 0.1)):
        rows = spark.createDataFrame([("a b", label), (None, label), ("c", None)], "text string, label int")
        constant = quality.fit_quality(rows)
        assert {low <= r.score <= high for r in quality.scored(docs, constant).collect()} == {True}
    assert quality.fit_quality(docs.selectExpr("text", "CAST(NULL AS INT) AS label")).rules == ()
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (6, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert [tuple(r) for r in quality.training_rows(docs, labels).select("label").collect()] == [(0,)]


def test_exact_dedup(docs, none):
    got = exact_dedup.exact_groups(docs, digest_all=True).collect()
    assert sorted((r.doc_id for r in got), key=lambda x: (x is None, x)) == ALL_IDS
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append((r.keep_id, r.group_size, r.kept))
    assert by_id[1] == [(3, 3, False)] and by_id[2] == [(3, 3, False)] and by_id[3] == [(3, 3, True)]
    assert by_id[5] == [(6, 2, False)] and by_id[6] == [(6, 2, True)]
    assert sorted(by_id[7]) == [(7, 2, False), (7, 2, True)] and by_id[None] == [(None, 1, True)]
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and ids(kept) == [3, 4, 6, 7, 8, 9, 10, 11, 12, None]
    assert exact_dedup.exact_groups(none).count() == 0 and exact_dedup.drop_copies(none).count() == 0


def test_secrets(spark, docs, none):
    model = secrets.fit_secrets(secrets.labelled_findings(spark))
    got = secrets.find_secrets(docs, model).where("secret").collect()
    assert [(r.doc_id, r.value) for r in got] == [(11, "24be64439e3e49cf46b2d7c90f3602a3d0b907ff")]
    assert ROWS[12][1][got[0].start : got[0].end] == got[0].value
    assert secrets.find_secrets(none, model).count() == 0


def test_passages(docs, none):
    got = passages.repeated_passages(docs).collect()
    assert [(r.doc_id, r.other_id) for r in got] in ([(9, 8)], [(8, 9)])
    assert got[0].end - got[0].start == 80 and got[0].similarity == 1.0
    assert passages.repeated_passages(none).count() == 0


def test_queries_and_pipeline_on_such_tables(spark, docs, none, tmp_path):
    for name, rows in (("full", docs), ("empty", none)):
        base = f"{tmp_path}/{name}"
        rows.write.parquet(f"{base}/documents.parquet")
        labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(None, None, None)], "doc_id long, quality int, toxic int")
        labels.write.parquet(f"{base}/labels.parquet")
        benchmark(spark).write.parquet(f"{base}/benchmark.parquet")
        for query in ("op2_language", "op4_sharding", "op7_quality"):
            assert QUERIES[query](spark, base).count() == rows.count()
        assert set(corpus_pipeline.run(spark, base).columns) == {"doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"}
