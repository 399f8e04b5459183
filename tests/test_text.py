import pytest
from pyspark.sql import functions as F

from claimweave.functions import labels as lb
from claimweave.functions import text as tx


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def test_clean_is_null_safe_and_strips_all_white_space(spark):
    assert value(spark, tx.clean(F.lit(None).cast("string"))) == ""
    assert value(spark, tx.clean(F.lit(" \t a b \n "))) == "a b"


@pytest.mark.parametrize(
    ("title", "abstract", "variant", "expected"),
    [
        (" T ", "A", "title", "T"),
        ("T", " A ", "abstract", "A"),
        ("T", "A", "title_abstract", "T. A"),
        ("", "A", "title_abstract", ". A"),
        ("T", None, "title_abstract", "T."),
        (None, None, "title_abstract", "."),
    ],
)
def test_document_text(spark, title, abstract, variant, expected):
    columns = [F.lit(x).cast("string") for x in (title, abstract)]
    assert value(spark, tx.document_text(*columns, variant)) == expected


def test_unknown_variant_fails(spark):
    with pytest.raises(Exception, match="unknown field variant"):
        value(spark, tx.document_text(F.lit("t"), F.lit("a"), F.lit("body")))


def test_passage_text_drops_trailing_periods(spark):
    assert value(spark, tx.passage_text(F.lit("T"), F.lit("A..."))) == "T. A"
    assert value(spark, tx.passage_text(F.lit("T"), F.lit(""))) == "T"


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("a" * 199, "a" * 199),
        ("a" * 200, "a" * 200),
        ("a" * 201, "a" * 197 + "..."),
        ("a" * 195 + " \n" + "b" * 10, "a" * 195 + "..."),
    ],
)
def test_excerpt(spark, text, expected):
    assert value(spark, tx.abstract_excerpt(F.lit(text))) == expected


def test_tokens_and_counts(spark):
    df = spark.createDataFrame([("The cat_1 sat: CAT_1, é ñandú x",), ("",)], "t string")
    out = tx.tokenize(df, {"tokens": "t"}).select("tokens", tx.count_terms("tokens").alias("terms"))
    first, empty = out.collect()
    assert first["tokens"] == ["cat_1", "sat", "cat_1", "ñandú"]
    assert [tuple(t) for t in first["terms"]] == [("cat_1", 2), ("sat", 1), ("ñandú", 1)]
    assert empty["terms"] == []


def test_stop_words_with_quotes(spark):
    df = spark.createDataFrame([("it is here",)], "t string")
    kept = tx.tokenize(df, {"k": "t"}, ["o'clock", "back\\slash", "is"]).first()["k"]
    assert kept == ["it", "here"]
    assert tx.tokenize(df, {"k": "t"}, []).first()["k"] == ["it", "is", "here"]


def test_counting_inside_a_generator_stays_linear(spark):
    # The optimizer copies generator input into a filter; the count must survive that.
    text = " ".join(f"w{i % 5000}" for i in range(20000))
    df = tx.tokenize(spark.createDataFrame([(text,)], "t string"), {"k": "t"})
    assert df.select(F.inline(tx.count_terms("k"))).agg(F.sum("tf")).first()[0] == 20000


def test_stance_words(spark):
    words = ["support", "SUPPORTS", "Contradict", "refutes", "not_enough_info", "nei", "maybe", None]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    got = [r[0] for r in df.orderBy("i").select(lb.normalize_stance("w")).collect()]
    assert got == ["SUPPORTS", "SUPPORTS", "REFUTES", "REFUTES", "NEI", "NEI", None, None]


def test_label_maps(spark):
    labels = {"no": 0, "yes": 1}
    assert value(spark, lb.label_to_id(F.lit("yes"), labels)) == 1
    assert value(spark, lb.label_to_id(F.lit("other"), labels)) is None
    assert value(spark, lb.id_to_label(F.lit(0), labels)) == "no"


def test_validity_reasons(spark):
    df = spark.createDataFrame(
        [(" ", "t", "a"), ("c", " ", "\t"), ("c", "t", ""), ("c", None, "a")],
        "c string, t string, a string",
    )
    got = [r[0] for r in df.select(tx.invalid_reason("c", "t", "a")).collect()]
    assert got == ["empty_claim", "empty_document", None, None]
