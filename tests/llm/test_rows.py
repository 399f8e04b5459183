"""Stages keep and drop rows, not ids: null and repeated ids with different texts."""

from claimweave.llm import decontaminate, ngram_join

A = " ".join(f"alpha{i} beta{i % 7}" for i in range(40))
B = " ".join(f"gamma{i} delta{i % 5}" for i in range(40))
ITEM = "what is the boiling point of water on a high mountain in winter"


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_near_copies_are_dropped_by_row(spark):
    rows = [(1, A), (2, A + " more"), (2, B), (None, A), (None, A + " word"), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as class", "'y' as mark")
    got = ngram_join.drop_similar(docs)
    assert got.columns == docs.columns
    assert kept(got) == sorted([(1, A), (2, B), (None, None), (None, "")], key=str)
    # Only null ids, or equal rows: one of each class stays.
    docs = spark.createDataFrame([(None, A), (None, A + " word"), (None, A), (3, B), (3, B)], "doc_id long, text string")
    got = kept(ngram_join.drop_similar(docs))
    assert len(got) == 2 and got[0] == (3, B) and got[1][1] in (A, A + " word")


def test_contaminated_rows_are_dropped_by_row(spark):
    rows = [(5, f"see: {ITEM}"), (5, B), (None, ITEM.upper()), (None, A), (6, "a short one here"), (7, "a shortone here"), (8, "the odd")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as _gone", "'y' as item_id").drop("_gone")
    items = spark.createDataFrame([(1, ITEM), (2, "short one"), (None, "odd"), (4, " ")], "item_id long, text string")
    found = decontaminate.find_contamination(docs, items).collect()
    assert sorted(((r.doc_id, r.item_id, r.start, r.end) for r in found), key=str) == sorted(
        [(5, 1, 5, 5 + len(ITEM)), (None, 1, 0, len(ITEM)), (6, 2, 2, 11), (8, None, 4, 7)], key=str
    )
    assert kept(decontaminate.drop_contaminated(docs, items)) == sorted([(5, B), (None, A), (7, "a shortone here")], key=str)


def test_many_blocks_of_items_are_looked_for_one_by_one(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"{ITEM} number {i} of the list") for i in range(40)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"x {ITEM} number {i} of the list y") for i in range(0, 40, 3)], "doc_id long, text string")
    want = {tuple(r) for r in decontaminate.find_contamination(docs, items).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 300)
    assert {tuple(r) for r in decontaminate.find_contamination(docs, items).collect()} == want and want
