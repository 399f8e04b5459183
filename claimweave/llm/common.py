"""What the text operators share: column choices, bounded broadcasts, components of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.session import stage

# A set of ids is broadcast up to this many rows (16 bytes each before hashing); beyond it
# Spark shuffles both sides by id. The rows that come out are the same.
BROADCAST_IDS = 1_000_000

# Space and the five controls from tab to carriage return: the only white space that counts.
WHITE = "[\\x20\\x09-\\x0D]"


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def id_bucket(column: str, modulus: int) -> Column:
    """Remainder of the CRC-32 of an id as text: the split into folds. A null id is fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus, F.lit(0))


def small(ids: DataFrame, rows: int) -> DataFrame:
    """``ids`` marked for broadcast while its counted ``rows`` are within ``BROADCAST_IDS``."""
    return F.broadcast(ids) if rows <= BROADCAST_IDS else ids


def keep_ids(frame: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """Rows of ``frame`` whose ``column`` occurs in ``ids``; null matches null."""
    ids = ids.select(F.col(column).alias("_keep_id")).distinct()
    return frame.join(small(ids, ids.count()), F.col(column).eqNullSafe(F.col("_keep_id")), "left_semi")


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit words that scatters them (the splitmix finaliser)."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words; keeps at most ``bound`` of them and then starts anew."""

    def __init__(self, bound: int = 200_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= self.bound:
            self.clear()
        value = self[word] = xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of ``width`` words, in order; shorter texts are one shingle."""
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    out = hashes[: len(hashes) - width + 1].copy()
    for k in range(1, width):  # a polynomial of the words' hashes, scattered once at the end
        out *= np.uint64(0xC2B2AE3D27D4EB4F)
        out += hashes[k : k + len(out)]
    return mix64(out, width)


def connected_components(links: DataFrame, a: str = "a", b: str = "b", name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``links``: component is the smallest node reachable.

    Large-star and small-star in turn: each round every node's neighbours are hung on the
    smallest one, so the number of rounds follows the logarithm of a component's size. Each
    round is a written table, the edges never exceed those given, and a node with very many
    neighbours is only ever reduced by ``min``, never gathered.
    """
    edges = stage(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), name
    )
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where(F.col("u") != F.col("v")).distinct(), name)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u")
        smaller = hung.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(smaller.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), name)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on at most one other, on which nothing else but such nodes hang.

    Rounds keep what is connected, so these stars are the components.
    """
    ends = F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("hangs")), F.struct(F.col("v").alias("node"), F.lit(0).alias("hangs")))
    nodes = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("hangs").alias("hangs"), F.min("hangs").alias("least"))
    return nodes.where("hangs > 1 or (hangs = 1 and least = 0)").isEmpty()


def drop_rows(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows in ``gone``, staged ``(_id, _gone, _one)``, all columns kept.

    A row is known by its id, which may be null or repeat, and the hash of its text (``row_mark``).
    Where ``_one`` is true one of the rows with that id and text stays.
    """
    held = small(gone, gone.count())
    marked = docs.withColumn("_mark", row_mark(text_col))
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_gone"))
    out = marked.join(held, same, "left_anti").drop("_mark")
    ones = gone.where("_one")
    several = ones.count()
    if not several:
        return out
    held = small(ones, several)
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_gone"))
    again = marked.join(held, same, "left_semi")
    return out.unionByName(again.dropDuplicates([id_col, "_mark"]).drop("_mark"))


def row_mark(text_col: str = "text") -> Column:
    """A hash of a row's text; a null text has one of its own."""
    return F.xxhash64(F.col(text_col), F.col(text_col).isNull())


__all__ = [
    "BROADCAST_IDS", "WHITE", "WordHashes", "connected_components", "drop_rows", "id_bucket", "keep_ids", "mix64",
    "row_mark", "shingle_hashes", "small", "stage", "text_or_empty",
]
