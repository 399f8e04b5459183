"""The roles the given tables play in the queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.session import stage
from claimweave.sources.scan import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def title_and_abstract() -> list[Column]:
    """The first line of ``text`` as title, all the rest as abstract."""
    line_end = F.instr("text", "\n")
    rest = F.when(line_end > 0, F.substring(F.col("text"), line_end + 1, F.length("text")))
    return [F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), rest.otherwise("").alias("abstract")]


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents``: the first line is the title, the rest the abstract."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        F.col("doc_id").cast("string").alias("doc_id"), *title_and_abstract()
    )


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``benchmark`` passages as claims."""
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("string").alias("query_id"), F.col("text").alias("claim")
    )


# Passages of fewer than three words that are compared with all texts at a time.
SHORT_BLOCK = 1000


def qrels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document is relevant to a passage it contains word for word.

    Only a way to obtain judgments from the given tables; real jobs read theirs. The inner words
    of a passage of three or more stand between white space, so any text that contains the
    passage has each as a whole word. The one that stands in the fewest documents finds the
    candidates in an equi-join that carries ids only, and the substring test runs on their texts.
    Shorter passages have no such word; they are compared with the texts block by block.
    """
    words = F.regexp_extract_all(F.col("text"), F.lit(r"\S+"), F.lit(0))
    asked = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("claim"))
    listed = asked.select("item_id", F.regexp_extract_all("claim", F.lit(r"\S+"), F.lit(0)).alias("words"))
    inner = listed.where(F.size("words") > 2).select(
        "item_id", F.explode(F.array_distinct(F.expr("slice(words, 2, size(words) - 2)"))).alias("word")
    )
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    named = spread(texts).select("doc_id", F.explode(F.array_distinct(words)).alias("word"))
    named = stage(named.join(inner.select("word").distinct(), "word", "left_semi"), "passage_words")
    counts = named.groupBy("word").agg(F.count("*").alias("n"))
    rarest = inner.join(counts, "word").groupBy("item_id").agg(F.min(F.struct("n", "word"))["word"].alias("word"))
    candidates = named.join(rarest, "word").select("doc_id", "item_id")
    contained = F.contains(F.col("text"), F.col("claim"))
    found = candidates.join(asked, "item_id").join(texts, "doc_id").where(contained).select("doc_id", "item_id")
    short = listed.where(F.size("words") < 3).join(asked, "item_id").select("item_id", "claim")
    blocks = -(-short.count() // SHORT_BLOCK)
    for i in range(blocks):
        block = short.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == i)
        found = found.unionByName(texts.join(F.broadcast(block), contained).select("doc_id", "item_id"))
    return found.select(
        F.when(F.col("item_id") % 4 == 0, "test").otherwise("train").alias("split"),
        F.col("item_id").cast("string").alias("query_id"),
        F.col("doc_id").cast("string").alias("doc_id"),
    )


def passages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Corpus, claims and judgments of the document/benchmark binding."""
    return corpus(spark, sf_dir), claims(spark, sf_dir), qrels(spark, sf_dir)


def dialog(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``conversations``: a user turn is a claim, the assistant's next turn its document."""
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        "role",
        "text",
        (F.col("conv_id") * 1000 + F.col("turn")).cast("string").alias("id"),
    )
    line_end = F.instr("text", "\n")
    answers = turns.where(F.col("role") == "assistant")
    documents = answers.select(
        F.col("id").alias("doc_id"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.when(line_end > 0, F.substring(F.col("text"), line_end + 1, F.length("text")))
        .otherwise("")
        .alias("abstract"),
    )
    asked = turns.where(F.col("role") == "user")
    questions = asked.select(F.col("id").alias("query_id"), F.col("text").alias("claim"))
    judged = asked.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("id").alias("query_id"))
    judged = judged.join(
        answers.select("conv_id", "turn", F.col("id").alias("doc_id")), ["conv_id", "turn"]
    ).select(
        F.when(F.col("conv_id") % 4 == 0, "test").otherwise("train").alias("split"),
        "query_id",
        "doc_id",
    )
    return documents, questions, judged


def stance_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judged pairs with the document's quality label as raw stance word."""
    words = table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.when(F.col("quality") == 1, "SUPPORT").otherwise("CONTRADICT").alias("label"),
    )
    return qrels(spark, sf_dir).join(words, "doc_id").select("split", "query_id", "doc_id", "label")


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``labels.quality`` against three simple rules standing in for classifiers."""
    rows = table(spark, sf_dir, "labels").join(
        table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang"), "doc_id"
    )
    rules = {
        "long_text": F.col("n_chars") >= 300,
        "longer_text": F.col("n_chars") >= 1500,
        "english": F.col("lang") == "en",
    }
    cells = F.array(
        *[
            F.struct(F.lit(n).alias("classifier"), r.cast("int").alias("prediction_id"))
            for n, r in rules.items()
        ]
    )
    return rows.select(F.col("quality").alias("label_id"), F.inline(cells))


def labelled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``labels`` as classification rows with a split."""
    return table(spark, sf_dir, "labels").select(
        F.when(F.col("doc_id") % 4 == 0, "test").otherwise("train").alias("split"),
        F.when(F.col("quality") == 1, "relevant").otherwise("not_relevant").alias("label"),
        F.col("quality").alias("label_id"),
    )


def vector_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` keyed by a string id."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("doc_id"), "embedding", "label"
    )


def vector_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its successor."""
    left = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("q"))
    right = table(spark, sf_dir, "embeddings").select(
        (F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("d")
    )
    return left.join(right, "vec_id")


def customer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer and status as stance counts, mean price as a coverage score."""
    status = F.col("o_orderstatus")
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count_if(status == "F").alias("supports"),
            F.count_if(status == "O").alias("refutes"),
            F.count_if(status == "P").alias("nei"),
            F.round(F.avg("o_totalprice") / 450000, 6).alias("avg_cos"),
            F.round(F.max("o_totalprice") / 550000, 6).alias("max_cos"),
        )
    )


def dialog_stance(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Corpus, claims with a split and stance evidence of ``conversations``.

    The answer to a question supports it in conversations with an even id and refutes it in others.
    """
    documents, questions, judged = dialog(spark, sf_dir)
    even = F.floor(F.col("query_id").cast("long") / 1000) % 2 == 0
    evidence = judged.withColumn("label", F.when(even, "SUPPORT").otherwise("CONTRADICT"))
    return documents, questions.join(judged.select("split", "query_id").distinct(), "query_id"), evidence


def claim_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(split, value)``: a JSON line for every passage, with its judged documents as evidence.

    To have lines of every kind, labels, ids, claims and lines are spoilt by fixed rules on the ids.
    """
    document = F.col("doc_id").cast("long")
    label = F.when(document % 5 == 0, "nei").when(document % 7 == 0, "maybe").otherwise(F.col("label"))
    rationale = F.struct(F.array(F.lit(0)).alias("sentences"), label.alias("label"))
    rationales = F.when(document % 11 == 0, F.slice(F.array(rationale), 1, 0)).otherwise(F.array(rationale))
    found = stance_evidence(spark, sf_dir).groupBy("query_id").agg(
        F.map_from_entries(F.collect_list(F.struct("doc_id", rationales.alias("r")))).alias("evidence")
    )
    item = F.col("query_id").cast("long")
    line = F.to_json(
        F.struct(
            F.when(item % 9 != 4, F.col("query_id")).alias("id"),
            F.when(item % 9 == 5, " ").otherwise(F.col("claim")).alias("claim"),
            F.coalesce("evidence", F.from_json(F.lit("{}"), "map<string, array<struct<sentences: array<int>, label: string>>>")).alias(
                "evidence"
            ),
        )
    )
    spoilt = F.when(item % 9 == 6, F.concat(F.lit('{"id": "'), "query_id", F.lit('", "claim": "cut o'))).otherwise(line)
    rows = claims(spark, sf_dir).join(found, "query_id", "left")
    return rows.select(F.when(item % 4 == 0, "validation").otherwise("train").alias("split"), spoilt.alias("value"))
