"""Exact sparse top-k of many claims: blocks of claims are sent to the documents one after the other."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Claims of one variant that are sent to the documents at a time, rows a partition of documents has at
# least, and claims and documents scored against each other at once.
CLAIM_BLOCK, DOCUMENT_BLOCK = 20_000, 2048
CHUNK = 2048
# Products of weights held at once.
PRODUCTS = 1 << 21
# Claims that ask for more get no cut from a single chunk.
SHALLOW = 64

NUMBERED = "field_variant string, id string, terms array<int>, weights array<double>"
SCORED = "field_variant string, query_id string, doc_id string, score double, depth long"


def numbered(rows: DataFrame, words: dict[str, tuple[list[str], list[float]]], unit: bool) -> DataFrame:
    """``(field_variant, id, terms, weights)``: terms by number in ``words``, others dropped.

    ``rows`` is ``(field_variant, id, terms array<struct<term, value>>)``. With ``unit`` values are
    counts, weighed by idf and divided by the norm, else they are weights already. Rows without a
    known term are left out. Nothing is exchanged.
    """
    sent = rows.sparkSession.sparkContext.broadcast(
        {v: (pa.array(terms, pa.string()), np.array(idf)) for v, (terms, idf) in words.items()}
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for variant, (known, idf) in sent.value.items():
                batch = whole.filter(pc.equal(whole.column("field_variant"), variant))
                if not batch.num_rows:
                    continue
                lists = batch.column("terms")
                flat = lists.flatten()
                row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
                term = pc.index_in(flat.field("term"), value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)
                weight = flat.field("value").to_numpy(zero_copy_only=False).astype(np.float64)
                use = term >= 0
                row, term, weight = row[use], term[use], weight[use]
                if unit:
                    weight = weight * idf[term]
                    weight = weight / np.sqrt(np.bincount(row, weight * weight, batch.num_rows))[row]
                sizes = np.bincount(row, minlength=batch.num_rows)
                kept = sizes > 0
                ends = pa.array(np.r_[0, np.cumsum(sizes[kept])], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([variant] * int(kept.sum()), pa.string()),
                        batch.column("id").filter(pa.array(kept)),
                        pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(weight)),
                    ],
                    names=["field_variant", "id", "terms", "weights"],
                )

    return rows.select("field_variant", "id", "terms").mapInArrow(number, NUMBERED)


def _pieces(sizes: np.ndarray) -> Iterator[slice]:
    """Consecutive slices whose ``sizes`` sum to about ``PRODUCTS`` at most."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + PRODUCTS, side="right")))
        yield slice(at, to)
        at = to


def _expand(start: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(number of the range, place)`` of every place in ranges given by start and size."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    return owner, np.arange(len(owner)) - first[owner] + start[owner]


class CellTopK:
    """The best documents so far of the claims of one block, ``depth`` of them for each claim.

    Documents are offered in the order of their ids, so of equal scores the first to come stays and
    a full claim only takes better ones: mass copies cannot flood it. What may come in is found by
    MaxScore: a claim's terms are taken from the strongest, until those left cannot lift a document
    above its last score together; only documents that got something by then, and enough of it, are
    looked up for the rest.
    """

    def __init__(self, size: np.ndarray, terms: np.ndarray, weights: np.ndarray, depth: np.ndarray, decimals: int):
        self.depth, self.decimals, self.half = depth, decimals, 0.4 * 10.0**-decimals
        self.start = np.r_[0, np.cumsum(size)]
        self.terms, self.weights = terms, weights
        self.width = int(terms.max()) + 1 if len(terms) else 0
        self.floor = np.zeros(len(depth))
        self.full = depth <= 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = self.kept = self.seen = 0

    def add(self, size: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> None:
        ends = np.r_[0, np.cumsum(size)]
        for at in range(0, len(size), CHUNK):
            to = min(len(size), at + CHUNK)
            self._add_chunk(size[at:to], terms[ends[at] : ends[to]], weights[ends[at] : ends[to]])

    def _add_chunk(self, size: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> None:
        n = len(size)
        document = np.repeat(np.arange(n), size)
        asked = terms < self.width
        document, terms, weights = document[asked], terms[asked], weights[asked]
        order = np.argsort(terms, kind="stable")
        document, terms, weights = document[order], terms[order], weights[order]
        many = np.bincount(terms, minlength=self.width)
        start = np.cumsum(many) - many
        largest = np.zeros(self.width)
        used = np.flatnonzero(many)
        if len(used):
            largest[used] = np.maximum.reduceat(weights, start[used])
            key = terms.astype(np.int64) * n + document
            for at in range(0, len(self.depth), CHUNK):
                self._meet(at, min(len(self.depth), at + CHUNK), n, document, weights, start, many, largest, key)
        self.seen += n

    def _meet(self, at: int, to: int, n: int, document, values, start, many, largest, key) -> None:
        claim = np.repeat(np.arange(to - at), np.diff(self.start[at : to + 1]))
        term, weight = (x[self.start[at] : self.start[to]] for x in (self.terms, self.weights))
        bound = weight * largest[term]
        use = np.flatnonzero(bound > 0)
        if not len(use):
            return
        use = use[np.lexsort((-bound[use], claim[use]))]
        claim, term, weight, bound = claim[use], term[use], weight[use], bound[use]
        total = np.bincount(claim, bound, to - at)
        until = np.cumsum(bound) - bound
        first = np.searchsorted(claim, np.arange(to - at))
        left = total[claim] - (until - until[first[claim]])
        least = self.floor[at:to] + self.half
        taken = left > least[claim]
        # Strongest terms: everything they give to any document.
        score = np.zeros((to - at) * n)
        c, t, w = claim[taken], term[taken], weight[taken]
        for piece in _pieces(many[t]):
            owner, place = _expand(start[t[piece]], many[t[piece]])
            score += np.bincount(c[piece][owner] * n + document[place], w[piece][owner] * values[place], len(score))
        score = score.reshape(to - at, n)
        rest = np.zeros(to - at)
        later = np.flatnonzero(~taken)[::-1]
        rest[claim[later]] = left[later]
        limit = np.maximum(least - rest, 0.0)
        fresh = np.flatnonzero(~self.full[at:to] & (self.depth[at:to] <= min(SHALLOW, n)))
        if len(fresh):  # nothing is left out here: terms end where they add less than half a last decimal
            k = int(self.depth[at:to][fresh].max())
            cut = np.partition(score[fresh], n - k, axis=1)[:, n - k]
            limit[fresh] = np.maximum(limit[fresh], cut - 3 * self.half)
        pair, found = np.nonzero(score > limit[:, None])
        got = score[pair, found]
        # The other terms, of those documents alone.
        c, t, w = claim[~taken], term[~taken], weight[~taken]
        of = np.bincount(c, minlength=to - at)
        begin = np.cumsum(of) - of
        if len(c):
            for piece in _pieces(of[pair]):
                owner, place = _expand(begin[pair[piece]], of[pair[piece]])
                wanted = t[place].astype(np.int64) * n + found[piece][owner]
                hit = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
                gives = np.where(key[hit] == wanted, w[place] * values[hit], 0.0)
                got[piece] += np.bincount(owner, gives, len(pair[piece]))
        self._offer(pair + at, found + self.seen, np.round(got, self.decimals), bool(len(fresh)))

    def _offer(self, claim: np.ndarray, document: np.ndarray, score: np.ndarray, compact: bool) -> None:
        better = score > self.floor[claim]
        self.parts.append((claim[better], document[better], score[better]))
        self.waiting += int(better.sum())
        if compact or self.waiting > max(self.kept, len(self.depth)):
            self.best()

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(claim, document, score)`` by number."""
        if not self.parts:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        claim, document, score = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((document, -score, claim))
        first = np.searchsorted(claim[order], claim[order], side="left")
        kept = order[np.arange(len(order)) - first < self.depth[claim[order]]]
        claim, document, score = claim[kept], document[kept], score[kept]
        held = np.bincount(claim, minlength=len(self.depth))
        self.full = held >= self.depth
        lowest = np.full(len(self.depth), np.inf)
        np.minimum.at(lowest, claim, score)
        self.floor = np.where(self.full & (held > 0), lowest, 0.0)
        self.parts, self.waiting, self.kept = [(claim, document, score)], 0, len(claim)
        return self.parts[0]


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    terms, weights = batch.column("terms"), batch.column("weights")
    return pc.list_value_length(terms).to_numpy(), terms.flatten().to_numpy(), weights.flatten().to_numpy()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bool, pa.RecordBatch]]:
    """``(variant, whether a run begins, rows)``: batches cut where the variant changes or ids start anew."""
    variant, last = None, b""
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("id").fill_null("")
        names = batch.column("field_variant").to_numpy(zero_copy_only=False)
        falls = pc.less(ids.slice(1), ids.slice(0, len(ids) - 1)).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((names[1:] != names[:-1]) | falls) + 1
        for at, to in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            fresh = at > 0 or names[0] != variant or ids[0].as_py().encode() < last
            yield names[at], fresh, batch.slice(at, to - at)
        variant, last = names[-1], ids[-1].as_py().encode()


def _hits(variant: str, query_ids: pa.Array, ids: list[pa.Array], top: CellTopK) -> Iterator[pa.RecordBatch]:
    doc_ids = pa.concat_arrays(ids)
    claim, document, score = top.best()
    for at in range(0, len(claim), 50_000):
        part = slice(at, at + 50_000)
        yield pa.RecordBatch.from_pydict(
            {
                "field_variant": pa.array([variant] * len(claim[part]), pa.string()),
                "query_id": query_ids.take(pa.array(claim[part])),
                "doc_id": doc_ids.take(pa.array(document[part])),
                "score": pa.array(score[part]),
                "depth": pa.array(top.depth[claim[part]]),
            }
        )


def in_runs(documents: DataFrame, rows: int) -> DataFrame:
    """``documents`` in one partition a core, of ``DOCUMENT_BLOCK`` of the ``rows`` at least; nothing is exchanged."""
    cores = documents.sparkSession.sparkContext.defaultParallelism
    return documents.coalesce(max(1, min(cores, -(-rows // DOCUMENT_BLOCK))))


def scored_blocks(documents: DataFrame, claims: DataFrame, decimals: int) -> Iterator[DataFrame]:
    """``(field_variant, query_id, doc_id, score, depth)``, a block of claims after the other.

    ``documents`` and ``claims`` are staged :func:`numbered` rows, claims with their ``depth``, documents
    sorted by variant and id in each file. A block is a hash share of some ``CLAIM_BLOCK`` claims and is
    sent to the tasks, which score the documents where they are read: neither side is exchanged,
    and a task gives the best documents of each claim once for every run of ids it reads. What is
    held or sent is a block of claims and a batch of documents, whatever the sizes of the tables.
    Use up a block before the next is asked for, as what was sent for it is given up then.
    """
    context = claims.sparkSession.sparkContext
    most = claims.groupBy("field_variant").count().agg(F.max("count")).first()[0] or 0
    blocks = max(1, -(-most // CLAIM_BLOCK))
    for block in range(blocks):
        held = claims.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toArrow().combine_chunks()
        index = {}
        for variant in pc.unique(held.column("field_variant")).to_pylist():
            for part in held.filter(pc.equal(held.column("field_variant"), variant)).combine_chunks().to_batches():
                index[variant] = (part.column("id"), *_flat(part), part.column("depth").to_numpy())
        sent = context.broadcast(index)
        yield documents.mapInArrow(_scanner(sent, decimals), SCORED)
        sent.destroy()


def _scanner(sent, decimals: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        variant, ids, top = "", [], None
        for name, fresh, rows in _runs(batches):
            if fresh:
                if top is not None:
                    yield from _hits(variant, sent.value[variant][0], ids, top)
                variant, ids = name, []
                top = CellTopK(*sent.value[name][1:], decimals) if name in sent.value else None
            if top is not None:
                ids.append(rows.column("id"))
                top.add(*_flat(rows))
        if top is not None:
            yield from _hits(variant, sent.value[variant][0], ids, top)

    return scan
