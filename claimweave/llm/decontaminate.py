"""Benchmark passages in documents: q-gram counts in diagonal bands, then banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.common import drop_rows, row_mark, stage

# Characters of benchmark items that one scan of the documents looks for. More items take more
# scans, each with an index of bounded size.
BLOCK_CHARS = 4_000_000
CHUNK = 1 << 16
MOST_HITS = 1 << 21
_TABLE_BITS = 22
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class MatchParams:
    """An item of ``m`` characters matches where at most ``rate * m`` edits turn it into text.

    ``q`` is the gram length. A match of ``m`` characters with ``k`` edits keeps at least
    ``m - q + 1 - k q`` of the item's grams on ``k + 1`` neighbouring diagonals; where ``rate``
    leaves none, the budget of that item is cut to the most edits that leave one (with the given
    values at 13 to 19, 25 to 29 and 38 to 39 characters). Items under ``q`` characters have no gram;
    they match where they stand as whole words, character by character.
    """

    q: int = 10
    rate: float = 0.08

    def budget(self, m: int) -> int:
        return max(0, min(int(self.rate * m), (m - self.q) // self.q))


_FOLD: list[np.ndarray] = []


def _fold_table() -> np.ndarray:
    """Lower case of each code point that has a single one; all white space is a blank."""
    if not _FOLD:
        table = np.arange(0x110000, dtype=np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isspace():
                table[i] = 32
            elif len(low := c.lower()) == 1:
                table[i] = ord(low)
        _FOLD.append(table)
    return _FOLD[0]


def folded(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case with runs of white space as one blank, and where each came from."""
    points = _fold_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    blank = points == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    at = np.flatnonzero(keep)
    points = points[at]
    a, b = int(len(points) > 0 and points[0] == 32), len(points) - int(len(points) > 1 and points[-1] == 32)
    return points[a:b], at[a:b]


def _as_text(points: np.ndarray) -> str:
    return points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def gram_hashes(points: np.ndarray, q: int) -> np.ndarray:
    """A hash of each run of ``q`` code points, by doubling."""
    if len(points) < q:
        return np.zeros(0, np.uint64)
    run, width = points.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), 1
    out, have = None, 0
    while True:
        if q & width:
            if out is None:
                out, have = run, width
            else:
                n = len(run) - have
                out, have = out[:n] * np.uint64(pow(int(_BASE), width, 1 << 64)) + run[have:], have + width
        width *= 2
        if width > q:
            break
        half = width // 2
        run = run[:-half] * np.uint64(pow(int(_BASE), half, 1 << 64)) + run[half:]
    out = out[: len(points) - q + 1]
    return out ^ (out >> np.uint64(31))


class GramIndex:
    """Grams of the items and where they stand in them."""

    def __init__(self, items: list[tuple[int, str]], params: MatchParams):
        self.params = params
        self.ids, self.points, short = [], [], {}
        for item_id, text in items:
            points, _ = folded(text or "")
            if len(points) >= params.q:
                self.ids.append(item_id)
                self.points.append(points)
            elif len(points):
                short.setdefault(_as_text(points), []).append(item_id)
        self.short = self._automaton(short)
        self.m = np.array([len(p) for p in self.points], np.int64)
        self.k = np.array([params.budget(m) for m in self.m], np.int64)
        self.need = np.maximum(1, self.m - params.q + 1 - self.k * params.q)
        self.band = self.k + 1
        grams = [gram_hashes(p, params.q) for p in self.points]
        hashes = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(hashes, kind="stable")
        self.item, self.place = item[order], place[order]
        self.keys, self.first, self.count = np.unique(hashes[order], return_index=True, return_counts=True)
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[self.keys >> np.uint64(64 - _TABLE_BITS)] = True
        self.rim = int((self.m + 2 * self.band).max()) + params.q if len(self.m) else 0

    @staticmethod
    def _automaton(short: dict[str, list]):
        """Finds all items under ``q`` characters in one pass; None if there are none."""
        if not short:
            return None
        import ahocorasick

        found = ahocorasick.Automaton()
        for text, ids in short.items():
            found.add_word(text, (len(text), ids))
        found.make_automaton()
        return found

    def short_matches(self, points: np.ndarray) -> Iterator[tuple[int | None, int, int]]:
        """(item id, start, end) of the first place of each short item, between characters of no word."""
        if self.short is None:
            return
        text, seen = _as_text(points), set()
        for last, (size, ids) in self.short.iter(text):
            a, b = last - size + 1, last + 1
            inside = (a > 0 and text[a - 1].isalnum() and text[a].isalnum()) or (
                b < len(text) and text[b].isalnum() and text[last].isalnum()
            )
            if not inside and (key := text[a:b]) not in seen:
                seen.add(key)
                yield from ((i, a, b) for i in ids)

    def regions(self, points: np.ndarray) -> set[tuple[int, int]]:
        """(item, first diagonal) of each band that holds enough of the item's grams."""
        found: set[tuple[int, int]] = set()
        spans = [(a, a + CHUNK + self.rim) for a in range(0, max(len(points) - self.params.q + 1, 0), CHUNK)]
        while spans:
            a, b = spans.pop()
            hashes = gram_hashes(points[a:b], self.params.q)
            at = np.flatnonzero(self.table[hashes >> np.uint64(64 - _TABLE_BITS)])
            if not len(at):
                continue
            k = np.searchsorted(self.keys, hashes[at])
            k[k == len(self.keys)] = 0
            same = self.keys[k] == hashes[at]
            at, k = at[same], k[same]
            n = self.count[k]
            if n.sum() > MOST_HITS and b - a > 3 * self.rim:  # a text of few different grams: in smaller pieces
                half = (b - a - self.rim) // 2
                spans += [(a, a + half + self.rim), (a + half, b)]
                continue
            hit = np.repeat(self.first[k] - np.cumsum(n) + n, n) + np.arange(n.sum())
            item, place, spot = self.item[hit], self.place[hit], np.repeat(at, n) + a
            enough = np.bincount(item, minlength=len(self.ids))[item] >= self.need[item]
            if not enough.any():
                continue
            item, place = item[enough], place[enough]
            band = (spot[enough] - place) // self.band[item]
            rows = np.concatenate([np.stack([item, band, place]), np.stack([item, band - 1, place])], axis=1)
            rows = np.unique(rows, axis=1)  # a gram of the item counts once in a band
            starts = np.flatnonzero(np.r_[True, (np.diff(rows[:2], axis=1) != 0).any(axis=0)])
            many = np.diff(np.r_[starts, rows.shape[1]])
            for s in starts[many >= self.need[rows[0, starts]]]:
                found.add((int(rows[0, s]), int(rows[1, s] * self.band[rows[0, s]])))
        return found

    def align(self, item: int, points: np.ndarray, first: int) -> tuple[int, int] | None:
        """Fewest edits and end of the item on the diagonals from ``first``, if within its budget."""
        pattern, m, width = self.points[item], int(self.m[item]), 2 * int(self.band[item])
        diagonals = np.arange(width)
        padded = np.full(m + width, 0xFFFFFFFF, np.uint32)
        a, b = max(first, 0), min(first + m + width, len(points))
        if b <= a:
            return None
        padded[a - first : b - first] = points[a:b]
        cost = np.where(first + diagonals >= 0, 0, m + 1)
        for i in range(m):
            changed = cost + (padded[i : i + width] != pattern[i])
            changed[:-1] = np.minimum(changed[:-1], cost[1:] + 1)
            cost = np.minimum.accumulate(changed - diagonals) + diagonals
        cost = np.where(first + m + diagonals <= len(points), cost, m + 1)
        best = int(cost.argmin())
        return (int(cost[best]), first + m + best) if cost[best] <= self.k[item] else None

    def start(self, item: int, points: np.ndarray, end: int) -> int:
        """Where the best alignment that ends at ``end`` begins (the longest on ties)."""
        pattern = self.points[item][::-1]
        text = points[max(0, end - int(self.m[item] + self.k[item])) : end][::-1]
        steps = np.arange(len(text) + 1)
        cost = steps.copy()
        for c in pattern:
            nxt = np.r_[cost[0] + 1, np.minimum(cost[1:] + 1, cost[:-1] + (text != c))]
            cost = np.minimum.accumulate(nxt - steps) + steps
        return end - int(len(text) - cost[::-1].argmin())

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, edits, start, end) of the best place of each item found, in code points of ``text``."""
        points, origin = folded(text)
        best: dict[int, tuple[int, int]] = {}
        for item, first in sorted(self.regions(points)):
            got = self.align(item, points, first)
            if got and got < best.get(item, (1 << 60, 0)):
                best[item] = got
        out = []
        for item, (edits, end) in best.items():
            start = self.start(item, points, end)
            out.append((self.ids[item], edits, int(origin[start]), int(origin[end - 1]) + 1))
        out += [(i, 0, int(origin[a]), int(origin[b - 1]) + 1) for i, a, b in self.short_matches(points)]
        return out


def _matches(rows: DataFrame, benchmark: DataFrame, params: MatchParams) -> DataFrame:
    """``(doc_id, mark, item_id, edits, start, end)`` of the rows ``(doc_id, mark, text)``.

    One scan per block of items. Several blocks run one after the other, each staged, so that
    the driver and the tasks hold one at a time.
    """
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long"), "text")
    items = stage(items.withColumn("number", F.monotonically_increasing_id()), "benchmark-items")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_CHARS))
    names = ("doc_id", "mark", "item_id", "edits", "start", "end")
    found = None
    for block in range(blocks):
        chosen = items.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block).orderBy("item_id", "text")
        held = rows.sparkSession.sparkContext.broadcast([(r.item_id, r.text) for r in chosen.collect()])

        def find(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = GramIndex(held.value, params)
            for batch in batches:
                got: dict[str, list] = {c: [] for c in names}
                for doc_id, mark, text in zip(*(batch.column(c) for c in ("doc_id", "mark", "text")), strict=True):
                    for values in index.matches(text.as_py() or ""):
                        for c, v in zip(names, (doc_id.as_py(), mark.as_py(), *values), strict=True):
                            got[c].append(v)
                yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in got.items()})

        part = rows.mapInArrow(find, ", ".join(f"{c} long" for c in names))
        if blocks == 1:
            return part
        part = stage(part, "benchmark-found")
        held.destroy()
        found = part if found is None else found.unionByName(part)
    return found


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), row_mark(text_col).alias("mark"), F.col(text_col).alias("text"))


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, params: MatchParams = MatchParams(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, item_id, edits, start, end)``: each benchmark item found in each document.

    Case and runs of white space do not count. Of several places of an item in a document the
    one with the fewest edits is given, then the first. Items are indexed in blocks of at most
    about ``BLOCK_CHARS`` characters; each block is sent to the tasks and the documents are scanned
    in place, with no shuffle and no candidate pairs outside a task.

    Null and empty texts and items match nothing; items under ``q`` characters match as whole
    words without edits. Items with a null id are found like others and reported under it. Equal
    items and repeated rows are each reported. Empty tables give an empty result; other columns
    are ignored.
    """
    return _matches(_rows(docs, id_col, text_col), benchmark, params).drop("mark")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, params: MatchParams = MatchParams()) -> DataFrame:
    """``docs`` without those that hold a benchmark item; rows are told apart by id and text, so ids may be null or repeat."""
    hit = _matches(_rows(docs, "doc_id", "text"), benchmark, params)
    hit = hit.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_gone"), F.lit(False).alias("_one")).distinct()
    return drop_rows(docs, stage(hit, "contaminated"))
