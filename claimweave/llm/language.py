"""Language identification by nearest centroids of TF-IDF character n-gram vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.llm.common import mix64, stage

UNDETERMINED = "und"
BATCH_ROWS = 256


@dataclass(frozen=True)
class LanguageParams:
    """``sample_rows``: labelled rows per language that the centroids are clustered from, at most.

    Document frequencies are counted over all labelled rows, whatever their number.
    ``reject_quantile``: a text further from its centroid than all but this share of the
    centroid's own sample is marked as rejected.
    """

    buckets: int = 4096
    longest: int = 3
    centroids: int = 4
    sample_rows: int = 1000
    rounds: int = 12
    reject_quantile: float = 0.005
    seed: int = 5


@dataclass(frozen=True)
class LanguageModel:
    params: LanguageParams
    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray
    floors: np.ndarray


_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point its lower case if it is a letter, else 0."""
    if not _LETTER:
        table = np.zeros(0x110000, np.uint64)
        for i in range(0x110000):
            if (c := chr(i)).isalpha():
                table[i] = ord(low) if len(low := c.lower()) == 1 else i
        _LETTER.append(table)
    return _LETTER[0]


def term_counts(text: str | None, params: LanguageParams) -> np.ndarray | None:
    """Hashed counts of the n-grams of 1 to ``longest`` letters, words set off; None without letters.

    The text is taken whole, in pieces that overlap by an n-gram, so memory stays bounded.
    """
    total = np.zeros(params.buckets, np.int64)
    seen = False
    text, step = f" {text or ''} ", 1 << 20
    for at in range(0, len(text), step):
        piece = text[at : at + step + params.longest - 1]
        points = _letters()[np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)]
        seen = seen or bool(points.any())
        grams = points
        for n in range(1, params.longest + 1):
            if n > 1:
                if len(points) < n:
                    break
                grams = grams[:-1] * np.uint64(0x1F0D3804) + points[n - 1 :]
            own = grams[:step]  # the rest begin in the next piece
            keep = own[own != 0]  # a gram without a letter tells nothing
            total += np.bincount(mix64(keep, n) % np.uint64(params.buckets), minlength=params.buckets)
    return total if seen else None


def _vectors(counts: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    x = np.log1p(np.stack(counts)).astype(np.float32) * idf.astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _cluster(x: np.ndarray, params: LanguageParams) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids by spherical k-means, and for each the lowest cosine it accepts."""
    rng = np.random.default_rng(params.seed)
    chosen = [int(rng.integers(len(x)))]
    while len(chosen) < min(params.centroids, len(x)):  # the row furthest from those chosen
        chosen.append(int(np.argmin((x @ x[chosen].T).max(axis=1))))
    centroids = x[chosen]
    for _ in range(params.rounds):
        nearest = (x @ centroids.T).argmax(axis=1)
        centroids = np.stack([x[nearest == k].mean(axis=0) if (nearest == k).any() else c for k, c in enumerate(centroids)])
        centroids /= np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)
    cosine = x @ centroids.T
    nearest, best = cosine.argmax(axis=1), cosine.max(axis=1)
    floors = [np.quantile(best[nearest == k], params.reject_quantile) if (nearest == k).any() else 0.0 for k in range(len(centroids))]
    return centroids, np.array(floors)


def fit_languages(labelled: DataFrame, params: LanguageParams = LanguageParams()) -> LanguageModel:
    """A model from the ``(text, lang)`` rows of ``labelled``; null languages and texts without letters teach nothing.

    Document frequencies come from every row. Each language's centroids are clustered in a task
    of its own from at most ``sample_rows`` rows, drawn by a hash of the text; only centroids
    reach the driver. Without any usable row the model knows no language.
    """
    rows = labelled.where("lang is not null and text is not null").select("lang", "text")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(params.buckets + 1, np.int64), 0
        for batch in batches:
            for text in batch.column("text"):
                counts = term_counts(text.as_py(), params)
                if counts is not None:
                    df[:-1] += counts > 0
                    n += 1
        df[-1] = n
        yield pa.RecordBatch.from_pydict({"bucket": np.arange(params.buckets + 1), "n": df})

    summed = rows.mapInArrow(frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(params.buckets + 1)
    for r in summed:
        df[r.bucket] = r.n
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    draw = F.xxhash64("text", F.lit(params.seed))
    sizes = rows.groupBy(F.col("lang").alias("_lang")).agg(F.count("*").alias("_n"))
    share = F.least(F.lit(1.0), F.lit(1.5 * params.sample_rows) / F.col("_n"))
    drawn = rows.join(F.broadcast(sizes), F.col("lang") == F.col("_lang"))
    drawn = drawn.where((F.shiftrightunsigned(draw, 33) / float(2**31)) < share).withColumn("draw", draw)
    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    sample = stage(drawn.withColumn("k", first).where(F.col("k") <= params.sample_rows).select("lang", "text"), "language-sample")

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = [c for c in (term_counts(t, params) for t in pdf["text"]) if c is not None]
        if not counts:
            return pd.DataFrame({"lang": [], "centroid": [], "floor": []})
        centroids, floors = _cluster(_vectors(counts, idf), params)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centroid": list(centroids.astype(float)), "floor": floors})

    fitted = sample.groupBy("lang").applyInPandas(cluster, "lang string, centroid array<double>, floor double").collect()
    fitted.sort(key=lambda r: r.lang)
    return LanguageModel(
        params, idf, [r.lang for r in fitted],
        np.array([r.centroid for r in fitted], np.float32).reshape(len(fitted), params.buckets),
        np.array([r.floor for r in fitted]),
    )


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` for every row: the language of the nearest centroid.

    ``score`` is the cosine to it (0 to 1), ``rejected`` whether that is below what the centroid
    accepts. Null texts, texts without letters and a model without languages give ``und``, 0 and
    true. Equal cosines go to the language first in order. ``keep`` names further columns to
    carry. Whole texts are read in place, without a shuffle; rows may repeat.
    """
    keep = keep or {}
    carried = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *[c.alias(k) for k, c in keep.items()]
    )
    out = carried.drop("text").schema
    declared = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out] + ["lang_pred string", "score double", "rejected boolean"])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                n = batch.num_rows
                langs, score, rejected = [UNDETERMINED] * n, np.zeros(n), np.ones(n, bool)
                counts = [term_counts(t.as_py(), model.params) for t in batch.column("text")]
                told = [i for i, c in enumerate(counts) if c is not None]
                if told and model.languages:
                    cosine = _vectors([counts[i] for i in told], model.idf) @ model.centroids.T
                    nearest = cosine.argmax(axis=1)
                    score[told] = np.clip(cosine[np.arange(len(told)), nearest], 0, 1)
                    rejected[told] = score[told] < model.floors[nearest]
                    for i, k in zip(told, nearest, strict=True):
                        langs[i] = model.languages[k]
                columns = {f.name: batch.column(f.name) for f in out}
                yield pa.RecordBatch.from_pydict(columns | {"lang_pred": langs, "score": score, "rejected": rejected})

    return carried.mapInArrow(predict, declared)
