"""Repeated substrings: suffix arrays of shards, common prefixes, and a merge across shards."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.common import mix64, small, stage, text_or_empty

PIECE = 1 << 22  # bytes looked at together; a longer text goes in pieces that overlap
LAST_ID = (1 << 63) - 1  # stands for a null id: larger than any
CHUNK = 20_000  # rows of one Arrow batch that a task hands on


@dataclass(frozen=True)
class SuffixParams:
    """Strings of ``span`` bytes count; their anchors are ``gram`` bytes long."""

    span: int = 50
    gram: int = 20
    shard_bytes: int = 4_000_000  # passages in one shard, on average
    common: int = 1000  # passages of an anchor that occurs more often are told apart before they meet
    wide: int = 10_000  # an anchor with more different passages is dealt over several shards


# --- anchors ---------------------------------------------------------------------------------


_BYTES = mix64(np.arange(256, dtype=np.uint64), 7)


def _gram_hashes(b: np.ndarray, width: int) -> np.ndarray:
    """One hash for every run of ``width`` bytes, put together from runs of powers of two."""
    power, size, out, done = _BYTES[b], 1, None, 0
    while True:
        if width & size:
            out = power.copy() if out is None else out[: len(b) - done - size + 1] * np.uint64(0xD6E8FEB86659FD93) + power[done:]
            done += size
        if done == width:
            out ^= out >> np.uint64(32)
            out *= np.uint64(0x9E3779B97F4A7C15)
            return out
        longer = power[: len(power) - size] * np.uint64(0xA0761D6478BD642F)
        longer += power[size:]
        power, size = longer, 2 * size


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[: len(x) - size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def anchored(pieces: list[bytes], p: SuffixParams) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(piece, first, last, hash)``: strings ``first`` to ``last`` of a piece have this anchor.

    The anchor of a string of ``span`` bytes is the run of ``gram`` bytes in it with the least hash,
    the leftmost such: equal strings have equal anchors wherever they stand.
    """
    none = np.zeros(0, np.int64)
    b = np.frombuffer(b"".join(pieces), np.uint8)
    if len(b) < p.span:
        return none, none, none, none.view(np.uint64)
    size = np.array([len(x) for x in pieces])
    ends = np.cumsum(size)
    hashes = _gram_hashes(b, p.gram)
    # The place in the low bits makes the least value also the leftmost.
    low = np.uint64((1 << 24) - 1)
    value = hashes & ~low
    value |= np.arange(len(hashes), dtype=np.uint64)
    chosen = _sliding_min(value, p.span - p.gram + 1)
    chosen &= low
    # Strings that run over the end of a piece are none.
    whole = np.ones(len(chosen) + 1, bool)
    for end in ends.tolist():
        whole[max(0, end - p.span + 1) : end] = False
    whole[-1] = False
    turn = np.r_[True, chosen[1:] != chosen[:-1], True]
    start = np.flatnonzero(whole[:-1] & (turn[:-1] | ~np.r_[False, whole[:-2]]))
    last = np.flatnonzero(whole[:-1] & (turn[1:] | ~whole[1:]))
    own = np.searchsorted(ends, start, side="right")
    base = (ends - size)[own]
    return own, start - base, last - base, hashes[chosen[start].astype(np.int64)]


def _pieces(texts: list[bytes], p: SuffixParams) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in groups of at most ``PIECE`` bytes: which text, from where, and its bytes."""
    group: tuple[list[int], list[int], list[bytes]] = ([], [], [])
    held = 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - p.span + 1), PIECE):
            part = text[at : at + PIECE + p.span - 1]
            if held + len(part) > PIECE and held:
                yield group
                group, held = ([], [], []), 0
            for x, y in zip(group, (i, at, part)):
                x.append(y)
            held += len(part)
    if held:
        yield group


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for at in range(0, batch.num_rows, 500):
        part = batch.slice(at, 500)
        yield part, [t.as_py().encode("utf-8", "surrogatepass") for t in part.column("text")]


def _anchors(texts: DataFrame, p: SuffixParams) -> DataFrame:
    """``(hash, mark)``: the anchors of each text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in _batches(batch):
                marks = part.column("mark").to_numpy()
                for which, _, pieces in _pieces(found, p):
                    piece, _, _, hashes = anchored(pieces, p)
                    yield pa.RecordBatch.from_pydict(
                        {"hash": pa.array(hashes.view(np.int64)), "mark": pa.array(marks[np.array(which, np.int64)[piece]])}
                    )

    return texts.select("mark", "text").mapInArrow(scan, "hash long, mark long")


def _passages(texts: DataFrame, p: SuffixParams) -> DataFrame:
    """``(hash, passage, mark, place, first)``: the bytes of the strings with a shared anchor.

    ``texts`` has ``hashes``, the anchors each shares with another text; ``first`` is where the
    passage starts in its text.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in _batches(batch):
                marks, places = part.column("mark").to_numpy(), part.column("place").to_numpy()
                shared = [h.values.to_numpy().view(np.uint64) for h in part.column("hashes")]
                for which, begin, pieces in _pieces(found, p):
                    piece, first, last, hashes = anchored(pieces, p)
                    cut = np.searchsorted(piece, np.arange(len(pieces) + 1))
                    take = np.zeros(len(piece), bool)
                    for k, text in enumerate(which):
                        take[cut[k] : cut[k + 1]] = np.isin(hashes[cut[k] : cut[k + 1]], shared[text])
                    chosen = np.flatnonzero(take)
                    for at in range(0, len(chosen), CHUNK):
                        some = chosen[at : at + CHUNK]
                        text = np.array(which, np.int64)[piece[some]]
                        cuts = zip(piece[some].tolist(), first[some].tolist(), (last[some] + p.span).tolist())
                        yield pa.RecordBatch.from_pydict(
                            {
                                "hash": pa.array(hashes[some].view(np.int64)),
                                "passage": pa.array([pieces[k][lo:hi] for k, lo, hi in cuts], pa.binary()),
                                "mark": pa.array(marks[text]),
                                "place": pa.array(places[text]),
                                "first": pa.array(np.array(begin, np.int64)[piece[some]] + first[some]),
                            }
                        )

    return texts.select("mark", "place", "text", "hashes").mapInArrow(
        scan, "hash long, passage binary, mark long, place long, first long"
    )


# --- suffix arrays ---------------------------------------------------------------------------


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``s`` (values 0 to 510) in order, by Larsson-Sadakane refinement.

    Suffixes are sorted by their first seven symbols; after that every group of equals is sorted by
    the group of the suffix that starts where the compared part ends, which doubles that part.
    Suffixes alone in their group are sorted and not looked at again.
    """
    n = len(s)
    key = np.zeros(n, np.int64)
    for k in range(7):
        key <<= 9
        key[: n - k] |= s[k:].astype(np.int64) + 1 if k < n else 0
    sa = np.argsort(key)
    new = np.r_[True, key[sa[1:]] != key[sa[:-1]]]
    group = np.empty(n, np.int64)
    start = np.flatnonzero(new)
    group[sa] = np.repeat(start, np.diff(np.r_[start, n]))
    alone = new & np.r_[new[1:], True]
    slots, depth = np.flatnonzero(~alone), 7
    while len(slots):
        at = sa[slots]
        beyond = np.zeros(len(at), np.int64)
        inside = at + depth < n
        beyond[inside] = group[at[inside] + depth] + 1
        key = group[at] * (n + 1) + beyond
        order = np.argsort(key)
        at, key = at[order], key[order]
        sa[slots] = at
        new = np.r_[True, key[1:] != key[:-1]]
        start = np.flatnonzero(new)
        group[at] = np.repeat(slots[start], np.diff(np.r_[start, len(at)]))
        slots = slots[~(new & np.r_[new[1:], True])]
        depth *= 2
    return sa


def common_prefixes(s: np.ndarray, sa: np.ndarray, most: int, lane: int = 256) -> np.ndarray:
    """For each slot of ``sa`` how far its suffix agrees with the one before, up to ``most`` symbols.

    Kasai's walk in text order: where a suffix agrees in ``l`` symbols with its predecessor, the
    next suffix agrees in ``l - 1`` at least. The text is walked in lanes side by side.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    lcp = np.zeros(n, np.int64)
    begin = np.arange(0, n, lane)
    agreed = np.zeros(len(begin), np.int64)
    for step in range(lane):
        i = begin + step
        live = np.flatnonzero(i < n)
        i = i[live]
        j = before[i]
        length = np.maximum(agreed[live] - 1, 0)
        length[j < 0] = 0
        open_ = np.flatnonzero(j >= 0)
        while len(open_):
            a, b = i[open_] + length[open_], j[open_] + length[open_]
            go = (length[open_] < most) & (a < n) & (b < n)
            open_, a, b = open_[go], a[go], b[go]
            open_ = open_[s[a] == s[b]]
            length[open_] += 1
        agreed[live] = length
        lcp[i] = length
    return lcp[sa]


def earliest(passages: list[bytes], places: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes of equal strings of ``span`` bytes among all passages of a shard.

    ``(owner, at, group, least)``: the string at byte ``at`` of passage ``owner`` is of class
    ``group``, and ``least[group]`` is the smallest of ``places`` that has it. Classes are in the order
    of their strings.
    """
    size = np.array([len(x) for x in passages])
    s = np.zeros(int(size.sum()) + len(passages), np.int16)
    start = np.cumsum(size + 1) - size - 1
    inside = np.ones(len(s), bool)
    inside[start + size] = False
    s[inside] = np.frombuffer(b"".join(passages), np.uint8).astype(np.int16) + 1
    sa = suffix_array(s)
    same = common_prefixes(s, sa, span) >= span
    owner = np.repeat(np.arange(len(passages)), size + 1)[sa]
    at = sa - start[owner]
    # A suffix too short for the span is a group of its own: it shares no span with its predecessor.
    group = np.cumsum(~same) - 1
    full = at + span <= size[owner]
    owner, at, group = owner[full], at[full], group[full]
    edge = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    least = np.minimum.reduceat(places[owner], edge)
    return owner, at, np.repeat(np.arange(len(edge)), np.diff(np.r_[edge, len(group)])), least


def _shard_results(passages: DataFrame, p: SuffixParams) -> DataFrame:
    """``(hash, passage, leasts, string, least)`` from the suffix array of every shard.

    A passage with ``leasts`` has for each of its strings the smallest place among equal ones;
    passages whose strings stand nowhere before are left out. The strings of an anchor that is
    dealt over several shards come one by one instead, each once a shard, in their order.
    """

    def solve(table: pa.Table) -> pa.Table:
        texts = table.column("passage").to_pylist()
        lowest, highest = table.column("least").to_numpy(), table.column("last").to_numpy()
        owner, at, group, least = earliest(texts, lowest, p.span)
        wide = table.column("wide").to_numpy()
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        first = first[wide[owner[first]]]
        order = np.lexsort((at, owner))
        leasts, edge = least[group[order]], np.flatnonzero(np.r_[True, owner[order][1:] != owner[order][:-1]])
        hit = np.flatnonzero((np.minimum.reduceat(leasts, edge) < highest) & ~wide)
        lists = np.split(leasts, edge[1:])
        return pa.table(
            {
                "hash": pa.concat_arrays([table.column("hash").combine_chunks().take(hit), pa.nulls(len(first), pa.int64())]),
                "passage": pa.array([texts[i] for i in hit] + [None] * len(first), pa.binary()),
                "leasts": pa.array([lists[i] for i in hit] + [None] * len(first), pa.list_(pa.int64())),
                "string": pa.array(
                    [None] * len(hit) + [texts[o][a : a + p.span] for o, a in zip(owner[first].tolist(), at[first].tolist())],
                    pa.binary(),
                ),
                "least": pa.array([None] * len(hit) + least[group[first]].tolist(), pa.int64()),
            }
        )

    return passages.groupBy("shard").applyInArrow(
        solve, "hash long, passage binary, leasts array<long>, string binary, least long"
    )


# --- the operator ----------------------------------------------------------------------------


def _removed(rows: dict[str, np.ndarray], size: np.ndarray, leasts: np.ndarray, span: int) -> dict[str, pa.Array]:
    """Spans of the strings that stand in a smaller place: row ``i`` has the next ``size[i]`` of ``leasts``."""
    row = np.repeat(np.arange(len(size)), size)
    gone = np.flatnonzero(leasts < rows["place"][row])
    edge = np.flatnonzero(np.r_[True, (np.diff(gone) > 1) | (row[gone[1:]] != row[gone[:-1]])][: len(gone)])
    lo, hi = gone[edge], gone[np.r_[edge[1:], len(gone)] - 1] if len(edge) else gone
    within = np.arange(len(leasts)) - np.repeat(np.cumsum(size) - size, size)
    of = row[lo]
    return {
        "mark": pa.array(rows["mark"][of]),
        "place": pa.array(rows["place"][of]),
        "start": pa.array(rows["first"][of] + within[lo]),
        "end": pa.array(rows["first"][of] + within[hi] + span),
    }


SPANS = "mark long, place long, start long, end long"


def _rows(table: pa.Table | pa.RecordBatch) -> dict[str, np.ndarray]:
    return {c: table.column(c).to_numpy() for c in ("mark", "place", "first")}


def _shard_spans(found: DataFrame, p: SuffixParams) -> DataFrame:
    """Spans from the suffix array of every shard of ``found``."""

    def solve(table: pa.Table) -> pa.Table:
        told = table.column("passage").combine_chunks().dictionary_encode()
        code, texts, rows = told.indices.to_numpy(), told.dictionary.to_pylist(), _rows(table)
        places = np.full(len(texts), LAST_ID)
        np.minimum.at(places, code, rows["place"])
        size = np.array([len(t) - p.span + 1 for t in texts])
        begin = np.cumsum(size) - size
        leasts = np.repeat(places, size)
        # An anchor with one passage, however often, has nothing to compare it with.
        anchor = np.zeros(len(texts), np.int64)
        anchor[code] = table.column("hash").to_numpy()
        _, which, many = np.unique(anchor, return_inverse=True, return_counts=True)
        several = np.flatnonzero(many[which] > 1)
        if len(several):
            owner, at, group, least = earliest([texts[i] for i in several], places[several], p.span)
            leasts[begin[several[owner]] + at] = least[group]
        each = size[code]
        offset = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        return pa.table(_removed(rows, each, leasts[np.repeat(begin[code], each) + offset], p.span))

    return found.groupBy("shard").applyInArrow(solve, SPANS)


def _starts_to_spans(found: DataFrame, span: int) -> DataFrame:
    """Spans of passages with the ``leasts`` of their strings."""

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leasts = batch.column("leasts")
            offset = leasts.offsets.to_numpy()
            flat = leasts.values.to_numpy()[offset[0] : offset[-1]]
            yield pa.RecordBatch.from_pydict(_removed(_rows(batch), np.diff(offset), flat, span))

    return found.select("mark", "place", "first", "leasts").mapInArrow(spans, SPANS)


def _common_spans(found: DataFrame, p: SuffixParams) -> DataFrame:
    """Spans of the passages of common anchors, of which there may be any number.

    Equal passages are brought together first, so a shard holds each once; they meet their
    occurrences again in a join. An anchor that still has very many is dealt over several shards.
    """
    passages = found.groupBy("hash", "passage").agg(F.min("place").alias("least"), F.max("place").alias("last"))
    passages = stage(passages, "suffix-distinct")
    size = passages.agg(F.coalesce(F.sum(F.length("passage")), F.lit(0))).first()[0]
    shards = max(1, -(-size // p.shard_bytes))
    wide = stage(passages.groupBy("hash").count().where(F.col("count") > p.wide).select("hash", F.lit(True).alias("wide")), "suffix-wide")
    dealt = passages.join(wide, "hash", "left").withColumn("wide", F.coalesce("wide", F.lit(False)))
    shard = F.pmod(F.when(F.col("wide"), F.xxhash64("passage")).otherwise(F.xxhash64("hash")), F.lit(shards))
    solved = stage(_shard_results(dealt.withColumn("shard", shard), p), "suffix-solved")

    spans = _starts_to_spans(found.join(solved.where("leasts is not null").select("hash", "passage", "leasts"), ["hash", "passage"]), p.span)
    if not wide.isEmpty():
        # The shards' sorted strings are merged over ranges of their order, which each finds by binary search.
        strings = solved.where("string is not null").select("string", "least")
        merged = strings.repartitionByRange(shards, "string").groupBy("string").agg(F.min("least").alias("least"))
        each = F.explode(F.sequence(F.lit(0), F.length("passage") - p.span)).alias("k")
        single = found.join(wide, "hash", "left_semi").select("mark", "place", "first", "passage", each)
        single = single.select(
            "mark", "place", (F.col("first") + F.col("k")).alias("first"), F.expr(f"substring(passage, k + 1, {p.span})").alias("string")
        )
        single = single.join(merged, "string").select("mark", "place", "first", F.array("least").alias("leasts"))
        spans = spans.unionByName(_starts_to_spans(single, p.span))
    return spans


def _repeats(texts: DataFrame, p: SuffixParams) -> DataFrame:
    """``(mark, place, spans)`` of the texts with strings that stand in a smaller place."""
    # Dealt once; both the counting and the join read this one exchange.
    anchors = _anchors(texts, p).repartition("hash")
    shared = anchors.groupBy("hash").agg(F.min("mark").alias("lo"), F.max("mark").alias("hi"), F.count("*").alias("n"))
    shared = shared.where("lo < hi").select("hash", (F.col("n") > p.common).alias("common"))
    hits = anchors.join(shared.hint("shuffle_hash"), "hash").groupBy("mark").agg(
        *[F.collect_set(F.when(F.col("common") == common, F.col("hash"))).alias(name) for name, common in (("rare", False), ("often", True))]
    )
    hits = stage(hits, "suffix-hits")

    def passages(hashes: str) -> DataFrame:
        held = hits.where(F.size(hashes) > 0).select("mark", F.col(hashes).alias("hashes"))
        marks = held.select("mark")
        return _passages(texts.join(small(marks, marks.count()), "mark", "left_semi").join(held, "mark"), p)

    # Equal strings have equal anchors, so they meet in one shard.
    rare = hits.agg(F.coalesce(F.sum(F.size("rare")), F.lit(0))).first()[0]
    shards = max(1, -(-rare * (2 * p.span - p.gram) // p.shard_bytes))
    dealt = passages("rare").withColumn("shard", F.pmod(F.xxhash64("hash"), F.lit(shards)))
    spans = stage(_shard_spans(dealt, p), "suffix-rare")
    often = stage(passages("often"), "suffix-often")
    if not often.isEmpty():
        spans = spans.unionByName(_common_spans(often, p))
    return stage(spans.groupBy("mark", "place").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "suffix-spans")


def _cut(rows: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, spans, kept)`` of texts with ``spans`` that may overlap."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _batches(batch):
                merged, removed, kept = [], [], []
                for text, spans in zip(texts, part.column("spans")):
                    runs: list[dict] = []
                    for s in sorted((s["start"], s["end"]) for s in spans.as_py()):
                        if runs and s[0] <= runs[-1]["end"]:
                            runs[-1]["end"] = max(runs[-1]["end"], s[1])
                        else:
                            runs.append({"start": s[0], "end": s[1]})
                    edges = [0, *(x for r in runs for x in (r["start"], r["end"])), len(text)]
                    merged.append(runs)
                    removed.append(sum(r["end"] - r["start"] for r in runs))
                    kept.append(b"".join(text[lo:hi] for lo, hi in zip(edges[::2], edges[1::2])))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                        "n_removed": pa.array(removed, pa.int64()),
                        "spans": pa.array(merged, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        "kept": pa.array(kept, pa.binary()),
                    }
                )

    return rows.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")


def remove_repeats(
    docs: DataFrame, params: SuffixParams = SuffixParams(), id_col: str = "doc_id", text_col: str = "text", digest: bool = False
) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, spans, kept)`` for every row: its text without repeated strings.

    A byte goes if a string of ``span`` bytes around it also starts in a document with a smaller
    id, overlaps included and judged on the texts as given. ``spans`` are the maximal removed runs in
    bytes, ``kept`` the other bytes. With ``digest``, ``kept_sha256`` (lowercase hex) stands for ``kept``.

    1. Equal texts: all but those with the smallest id are removed whole, by digest.
    2. A string can only be repeated if its anchor (see ``anchored``) occurs in two texts. One
       scan sends each text's anchors, a few for a hundred bytes, to be compared.
    3. Texts with shared anchors are read again for the passages around these, which are dealt
       by anchor to shards of bounded size. Each shard is sorted into a suffix array; common
       prefixes of neighbours give the classes of equal strings and the smallest id of each,
       and each passage is marked where an equal string has a smaller id.
    4. Passages of an anchor that occurs very often are told apart first and meet their
       occurrences afterwards. If even the different ones are very many, they are dealt over
       several shards, whose sorted strings are merged across them by ranges.

    A null id is larger than any other, and equal ids are not smaller than each other; a row found
    twice is the same document. Null texts are empty. Texts shorter than ``span`` lose nothing. An
    empty table gives an empty result; other columns are ignored.
    """
    p = params
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = rows.select(
        "doc_id", F.coalesce("doc_id", F.lit(LAST_ID)).alias("place"), F.xxhash64("text").alias("mark"), "text"
    )
    known = stage(
        rows.select("doc_id", "place", "mark", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")),
        "suffix-texts",
    )
    long = known.where(F.col("n_bytes") >= p.span)
    firsts = long.groupBy("sha").agg(F.min("place").alias("least"), F.max("place").alias("last")).where("least < last")
    copies = long.join(firsts.select("sha", "least"), "sha").where("place > least").select("doc_id", "place", "mark", "n_bytes")
    copies = stage(copies, "suffix-copies")
    gone = copies.select("place", "mark").distinct()
    gone = small(gone, copies.count())
    originals = rows.join(gone, ["place", "mark"], "left_anti").where(F.octet_length("text") >= p.span)
    found = _repeats(originals, p)

    keys = found.select("mark", "place")
    keys = small(keys, keys.count())
    changed = rows.join(keys, ["mark", "place"], "left_semi").join(found, ["mark", "place"])
    changed = _cut(changed.select("doc_id", "text", "spans"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    none = F.array().cast("array<struct<start:long,end:long>>")
    rest = known.join(found.select("mark", "place"), ["mark", "place"], "left_anti").join(
        gone.withColumn("copy", F.lit(True)), ["place", "mark"], "left"
    )
    copy = F.coalesce("copy", F.lit(False))
    sizes = ["doc_id", "n_bytes", F.when(copy, F.col("n_bytes")).otherwise(0).cast("long").alias("n_removed")]
    spans = F.when(copy, whole).otherwise(none).alias("spans")
    if digest:
        left = F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.col("sha")).alias("kept_sha256")
        changed = changed.select("doc_id", "n_bytes", "n_removed", "spans", F.sha2("kept", 256).alias("kept_sha256"))
        return changed.unionByName(rest.select(*sizes, spans, left))
    bare = rows.select("place", "mark", F.encode("text", "utf-8").alias("bytes")).dropDuplicates(["place", "mark"])
    left = F.when(copy, F.lit(b"")).otherwise(F.col("bytes")).alias("kept")
    return changed.unionByName(rest.join(bare, ["place", "mark"]).select(*sizes, spans, left))
