"""Corpus and stance-annotated claims from JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.functions.labels import EVIDENCE_WORDS
from claimweave.functions.text import clean

CORPUS_SCHEMA = "doc_id string, title string, abstract string"
CLAIMS_SCHEMA = (
    "id string, claim string, "
    "evidence map<string, array<struct<sentences: array<int>, label: string>>>"
)

# The split each claims file becomes.
CLAIM_SPLITS = {"train": "train", "validation": "test"}


def read_corpus_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, title, abstract)``; an abstract may be a list of sentences or one string.

    The JSON type of the field decides: a string that looks like a list stays a string.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    row = F.from_json("value", CORPUS_SCHEMA)
    sentences = F.from_json("value", "abstract array<string>")["abstract"]
    abstract = F.coalesce(F.array_join(sentences, " "), row["abstract"], F.lit(""))
    return lines.select(
        row["doc_id"].alias("doc_id"), clean(row["title"]).alias("title"), clean(abstract).alias("abstract")
    )


def read_claims_jsonl(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``(split, query_id, claim, evidence)`` of one file per source split.

    A missing file fails the read. Source splits keep their name unless they are mapped.
    """
    out = None
    for source, path in paths.items():
        part = (
            spark.read.schema(CLAIMS_SCHEMA)
            .json(path)
            .select(
                F.lit(CLAIM_SPLITS.get(source, source)).alias("split"),
                F.col("id").alias("query_id"),
                "claim",
                "evidence",
            )
        )
        out = part if out is None else out.unionByName(part)
    return out


def split_claims(spark: SparkSession, paths: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Claims that can be used, as from :func:`read_claims_jsonl`, and all other lines with a ``reason``.

    A line is rejected as ``malformed`` if it is no JSON object of the expected types, as ``no_id`` or
    ``no_claim`` if that is missing or blank, and as ``no_evidence`` if no document has a first
    rationale with an accepted label. Rejected rows are ``(split, query_id, reason, line)``, with the
    whole line of a malformed one. Blank lines are no lines. The files are read once per result.
    """
    declared = f"{CLAIMS_SCHEMA}, _corrupt string"
    read = None
    for source, path in paths.items():
        part = spark.read.schema(declared).option("columnNameOfCorruptRecord", "_corrupt").json(path)
        part = part.withColumn("split", F.lit(CLAIM_SPLITS.get(source, source)))
        read = part if read is None else read.unionByName(part)
    words = F.array(*[F.lit(w) for w in EVIDENCE_WORDS])
    first = F.transform(F.map_values("evidence"), lambda r: F.upper(F.try_element_at(r, F.lit(1))["label"]))
    reason = (
        F.when(F.col("_corrupt").isNotNull(), "malformed")
        .when(clean("id") == "", "no_id")
        .when(clean("claim") == "", "no_claim")
        .when(~F.coalesce(F.arrays_overlap(first, words), F.lit(False)), "no_evidence")
    )
    checked = read.withColumn("reason", reason)
    good = checked.where(F.col("reason").isNull()).select("split", F.col("id").alias("query_id"), "claim", "evidence")
    bad = checked.where(F.col("reason").isNotNull()).select(
        "split", F.when(F.col("reason") != "malformed", F.col("id")).alias("query_id"), "reason", F.col("_corrupt").alias("line")
    )
    return good, bad


def explode_evidence(claims: DataFrame) -> DataFrame:
    """``(split, query_id, doc_id, label)`` with the label of the first rationale per document.

    Empty rationale lists and labels outside the accepted words drop out, and with them claims
    that have nothing else.
    """
    first = F.upper(F.try_element_at("rationales", F.lit(1))["label"])
    return (
        claims.select("split", "query_id", F.explode("evidence").alias("doc_id", "rationales"))
        .select("split", "query_id", "doc_id", first.alias("label"))
        .where(F.col("label").isin(list(EVIDENCE_WORDS)))
    )
