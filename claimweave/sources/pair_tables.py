"""Writing and reading pair tables: CSV files and the partitioned Parquet layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.config import FIELD_VARIANTS, PAIR_SCHEMA

ALL_FIELDS = "all_fields"

_CSV_WRITE = {
    "header": True,
    "quoteAll": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "encoding": "UTF-8",
}
_CSV_READ = {
    "header": True,
    "multiLine": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "encoding": "UTF-8",
    "mode": "FAILFAST",
}


def write_pairs_csv(pairs: DataFrame, root: str, prefix: str, variants=FIELD_VARIANTS) -> list[str]:
    """One CSV table per variant plus one with all of them; returns their paths.

    Rows are in order of split, claim, variant and document.
    Hand in staged pairs: they are read once per table. CSV is for exchange;
    :func:`publish_pairs` is the layout to work on.
    """
    pairs = pairs.select(*PAIR_SCHEMA.names).orderBy("split", "query_id", "field_variant", "doc_id")
    paths = []
    for variant in variants:
        path = f"{root}/{prefix}_{variant}"
        pairs.where(F.col("field_variant") == variant).write.mode("overwrite").options(
            **_CSV_WRITE
        ).csv(path)
        paths.append(path)
    path = f"{root}/{prefix}_{ALL_FIELDS}"
    pairs.write.mode("overwrite").options(**_CSV_WRITE).csv(path)
    return [*paths, path]


def read_pairs_csv(spark: SparkSession, path: str) -> DataFrame:
    """Pairs from CSV with the stated types; empty strings stay empty strings."""
    df = spark.read.schema(PAIR_SCHEMA).options(**_CSV_READ).csv(path)
    strings = [f.name for f in PAIR_SCHEMA.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({c: F.coalesce(c, F.lit("")) for c in strings}).select(*PAIR_SCHEMA.names)


def publish_pairs(pairs: DataFrame, path: str, incremental: bool = False) -> None:
    """Parquet partitioned by variant and split: readers of one split scan only its files.

    Rows are dealt to files by ranges of variant, split, claim and document and are in that order in
    each. ``incremental`` replaces only the partitions that ``pairs`` has rows of; the files of all
    others stay as they are.
    """
    order = ("field_variant", "split", "query_id", "doc_id")
    ordered = pairs.repartitionByRange(*order).sortWithinPartitions(*order)
    mode = "dynamic" if incremental else "static"
    ordered.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("field_variant", "split").parquet(path)


def read_published(
    spark: SparkSession, path: str, variant: str | None = None, split: str | None = None
) -> DataFrame:
    df = spark.read.schema(PAIR_SCHEMA).parquet(path).select(*PAIR_SCHEMA.names)
    if variant is not None:
        df = df.where(F.col("field_variant") == variant)
    if split is not None:
        df = df.where(F.col("split") == split)
    return df
