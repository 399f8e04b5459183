"""Periodic runs of words by recursive frequency splitting and a scan of the lags that are left."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Splitting ends when nothing changes. The scan is right on any segments, so a text made to
# split one word at a time is scanned as it stands after this many rounds.
ROUNDS = 64


@dataclass(frozen=True)
class RunParams:
    """A run has at least ``repeats`` periods and ``least`` words."""

    repeats: int = 4
    least: int = 6

    def length(self, period: int) -> int:
        return max(self.least, self.repeats * period)


def split_by_frequency(codes: np.ndarray, owner: np.ndarray, p: RunParams) -> list[tuple[int, int]]:
    """``(start, end)`` of the segments in which every word occurs often enough to be in a run.

    A run of at least ``repeats`` periods holds each of its words that often. A word that is rarer
    within its segment therefore parts it, which makes other words rarer in the pieces; only
    pieces that changed are counted again. ``owner`` numbers the texts ``codes`` are strung from.
    """
    done: list[tuple[int, int]] = []
    at = np.arange(len(codes))
    segment = owner.astype(np.int64)
    for turn in range(ROUNDS + 1):
        if not len(at):
            break
        edge = np.flatnonzero(np.r_[True, (segment[1:] != segment[:-1]) | (at[1:] != at[:-1] + 1)])
        size = np.diff(np.r_[edge, len(at)])
        long = size >= p.least
        keep = np.repeat(long, size)
        at, segment = at[keep], np.repeat(np.arange(long.sum()), size[long])
        if not len(at):
            break
        pair = segment * (int(codes.max()) + 1) + codes[at]
        _, inverse, count = np.unique(pair, return_inverse=True, return_counts=True)
        rare = count[inverse] < p.repeats
        touched = np.zeros(int(segment[-1]) + 1, bool)
        touched[segment[rare]] = True
        if turn == ROUNDS:
            touched[:] = False
        start = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
        end = np.r_[start[1:], len(segment)]
        for s in np.flatnonzero(~touched):
            done.append((int(at[start[s]]), int(at[end[s] - 1]) + 1))
        open_ = touched[segment] & ~rare
        at, segment = at[open_], segment[open_]
    return sorted(done)


def likely_lags(w: np.ndarray, p: RunParams) -> list[int]:
    """Lags at which a segment can hold a run, every lag of a run among them.

    In a run of period ``q`` a block of ``b >= q`` words comes back after exactly ``q`` words, never
    sooner. With ``b`` the power of two above ``q``, that holds for ``q`` places in a row or more
    (``repeats`` periods less the block and one). Blocks are named by doubling.
    """
    longest = len(w) // p.repeats
    if longest <= 16:
        return list(range(1, longest + 1))
    found: set[int] = set()
    name, b = w.astype(np.int64), 1
    while b // 2 <= longest:
        # Names of blocks of b words; the periods sought are in (b/2, b].
        order = np.argsort(name, kind="stable")
        again = np.zeros(len(name), np.int64)
        same = name[order[1:]] == name[order[:-1]]
        again[order[:-1][same]] = (order[1:] - order[:-1])[same]
        edge = np.flatnonzero(np.r_[True, again[1:] != again[:-1]])
        stretch = np.diff(np.r_[edge, len(again)])
        gap = again[edge]
        sure = (gap > b // 2) & (gap <= min(b, longest)) & (stretch >= gap * (p.repeats - 1) - b + 1)
        found.update(gap[sure].tolist())
        if len(name) <= b:
            break
        _, first = np.unique(name, return_inverse=True)
        name = first[: len(name) - b] * (int(first.max()) + 1) + first[b:]
        b *= 2
    return sorted(found)


def runs_of(w: np.ndarray, p: RunParams) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of one segment, by a scan of each likely lag.

    A stretch that repeats at lag ``q`` and whose smallest period is shorter is the run of that
    shorter period word for word, so it has been seen before.
    """
    out: list[tuple[int, int, int]] = []
    seen: set[tuple[int, int]] = set()
    for q in likely_lags(w, p):
        equal = np.r_[False, w[q:] == w[:-q], False]
        turn = np.flatnonzero(equal[1:] != equal[:-1])
        start, length = turn[::2], turn[1::2] - turn[::2] + q
        for s, n in zip(*(x[length >= p.length(q)].tolist() for x in (start, length))):
            if (s, n) not in seen:
                seen.add((s, n))
                out.append((s, n, q))
    return out


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; ties go to the smallest start, then period."""
    best = None
    for run in sorted(runs):
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
        elif run[1] * best[2] == best[1] * run[2] and (run[0], run[2]) < (best[0], best[2]):
            best = run
    return best


def find_runs(docs: DataFrame, params: RunParams = RunParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, runs, best, collapsed)`` for every row.

    ``runs`` lists ``(start, length, period)`` in words by start, then period: stretches whose
    smallest period is ``period``, at least ``params.length(period)`` long, that no neighbouring
    word extends. ``best`` is the one with the greatest length / period (null without runs).
    ``collapsed`` has the words no run contains after its first period, joined by one space.

    One scan without a shuffle. The texts of a batch are strung together, words become numbers,
    and all texts are split at once; only surviving segments are scanned. The cost of a text grows
    with its length times the number of different periods in it.

    Words are what stands between spaces and the controls from tab to carriage return. Null and
    empty texts have no words and no runs. Rows and ids may repeat or be null; an empty table gives
    an empty result; other columns are ignored.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                yield _scan_texts(part.column("doc_id"), [t.as_py() for t in part.column("text")], params)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    run = "struct<start:long,length:long,period:long>"
    return rows.mapInArrow(scan, f"doc_id long, n_words long, runs array<{run}>, best {run}, collapsed string")


def _scan_texts(ids: pa.Array, texts: list[str | None], p: RunParams) -> pa.RecordBatch:
    words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    sizes = np.array([len(w) for w in words])
    first = np.cumsum(sizes) - sizes
    names: dict[bytes, int] = {}
    codes = np.fromiter((names.setdefault(w, len(names)) for ws in words for w in ws), np.int64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(words)), sizes)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for lo, hi in split_by_frequency(codes, owner, p) if len(codes) else []:
        d = int(owner[lo])
        runs[d] += [(int(lo - first[d]) + s, n, q) for s, n, q in runs_of(codes[lo:hi], p)]
    collapsed = []
    for ws, found in zip(words, runs):
        if found:
            found.sort(key=lambda r: (r[0], r[2]))
            kept = np.ones(len(ws), bool)
            for s, n, q in found:
                kept[s + q : s + n] = False
            ws = [ws[i] for i in np.flatnonzero(kept)]
        collapsed.append(b" ".join(ws).decode("utf-8", "surrogatepass"))
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    as_dict = lambda r: r and dict(zip(("start", "length", "period"), r))
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": ids,
            "n_words": pa.array(sizes.tolist(), pa.int64()),
            "runs": pa.array([[as_dict(r) for r in found] for found in runs], pa.list_(struct)),
            "best": pa.array([as_dict(strongest(found)) for found in runs], struct),
            "collapsed": pa.array(collapsed, pa.string()),
        }
    )


def seeded_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` in which every tenth document (by the CRC-32 of its id) ends periodically.

    With ``h`` the checksum of the decimal id, ``g = h div 10`` and ``n > 0`` words, word ``i >= a``
    becomes word ``a + (i - a) % p``, where ``a = g % n`` and ``p = 1 + (n - a) div (3 + g % 8)``. Such
    texts are joined by single spaces; all others, and rows with a null id, stay as they are.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    h: Column = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    rows = rows.withColumn("_g", F.when(h % 10 == 0, F.floor(h / 10).cast("long")))
    rows = rows.withColumn("_w", F.when(F.col("_g").isNotNull(), words)).withColumn("_n", F.size("_w"))
    # Never a remainder by 0: a text without words has no place to change.
    rows = rows.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
    rows = rows.withColumn("_p", F.expr("cast(1 + (_n - _a) div (3 + _g % 8) as int)"))
    places = F.expr("transform(sequence(0, _n - 1), i -> _w[if(i < _a, i, _a + (i - _a) % _p)])")
    text = F.when(F.col("_a").isNotNull(), F.array_join(places, " ")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))
