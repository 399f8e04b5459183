"""Phrases, repeated substrings and periodic runs against plain versions, and on rows of every kind."""

import collections
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from claimweave.llm import collocations, periodic, suffix_dedup
from claimweave.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977} of{i % 31} line{i}" for i in range(30_000))
ODD = [
    (1, "", "en"),
    (2, None, None),
    (3, " \n\t ", "en"),
    (4, LONG, "en"),
    (7, "Le chat est sur le toit de la maison rouge, le chat est sur le toit.", "fr"),
    (7, "Le chat est sur le toit de la maison rouge, le chat est sur le toit.", "fr"),
    (None, "A row without an id at all, which is long enough to have fifty bytes.", "en"),
    (None, "A row without an id at all, which is long enough to have fifty bytes.", "und"),
    (9, "x" * 100_000, "en"),
    (10, "a b " * 5_000, "en"),
    (11, "né ü 漢字 " * 12, "fr"),
]


def frame(spark, rows, spread=True):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = docs.selectExpr("*", *[f"'clash' AS `{c}`" for c in "mark place spans hash key f phrase size words runs best n start".split()])
    return docs.repartition(3) if spread and rows else docs


# --- phrases -----------------------------------------------------------------------------------


def plain_phrases(rows, least, top, longest=5):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, count in f.items():
        often = [x for x in count if len(x) > 1 and count[x] >= least]
        inside = {x[i:j] for x in often for i in range(len(x)) for j in range(i + 2, len(x) + 1) if j - i < len(x) and count[x] >= count[x[i:j]]}
        ranked = []
        for x in set(often) - inside:
            a = count[x]
            score, k = min((1000 * a * n[lang] // (count[x[:k]] * count[x[k:]]), k) for k in range(1, len(x)))
            ranked.append((-score, -a, " ".join(x).encode(), count[x[:k]], count[x[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize(("least", "longest", "top"), [(5, 5, 2000), (3, 2, 50), (4, 3, 7)])
def test_phrases(spark, monkeypatch, least, longest, top):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()] + ODD
    monkeypatch.setattr(collocations, "HELD", 500)
    got = collocations.mine_phrases(frame(spark, rows), collocations.PhraseParams(longest=longest, least=least, top=top))
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, least, top, longest)


def test_a_crowded_bitmap_changes_nothing(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * j) % 17}" for j in range(60)), "en") for i in range(30)]
    monkeypatch.setattr(collocations, "BITS", 1 << 16)
    got = collocations.mine_phrases(frame(spark, rows), collocations.PhraseParams(least=9))
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, 9, 2000)


def test_no_phrases(spark):
    assert collocations.mine_phrases(frame(spark, [])).count() == 0
    assert collocations.mine_phrases(frame(spark, ODD[:3])).count() == 0


def test_a_task_hands_on_each_phrase_once(spark):
    rows = [(i, f"the red house on the hill. rare{i} red house", "en") for i in range(400)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        docs = frame(spark, rows, spread=False).coalesce(2).select("lang", "text")
        full = np.full(collocations.BITS // 8, 255, np.uint8)
        got = collocations._phrase_scan(docs, full, [full, full], 3).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    common = [r for r in got if "rare" not in r.phrase]
    assert len(common) <= 2 * 9 and sum(r.f for r in common if r.phrase == "red house") == 800
    assert sum(r.f for r in got if r["size"] == 3) == 400 * 5


# --- substrings --------------------------------------------------------------------------------


def plain_removed(rows, span):
    last = (1 << 63) - 1
    texts = [(last if i is None else i, (t or "").encode()) for i, t, *_ in rows]
    first = {}
    for place, b in texts:
        for k in range(len(b) - span + 1):
            s = b[k : k + span]
            first[s] = min(place, first.get(s, last))
    out = []
    for (i, *_), (place, b) in zip(rows, texts):
        gone = bytearray(len(b))
        for k in range(len(b) - span + 1):
            if first[b[k : k + span]] < place:
                gone[k : k + span] = b"\x01" * span
        spans = tuple(m.span() for m in re.finditer(rb"\x01+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def removed(docs, params):
    got = suffix_dedup.remove_repeats(docs, params).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, tuple(map(tuple, r.spans)), bytes(r.kept)) for r in got), key=str)


def passages(seed, n=60):
    rng = random.Random(seed)
    shared = ["".join(rng.choices("abcdé ", k=rng.randrange(30, 200))) for _ in range(6)]
    make = lambda: "".join(rng.choice(shared) if rng.random() < 0.4 else "".join(rng.choices("xyz uv", k=40)) for _ in range(5))
    rows = [(i, make(), "en") for i in range(n)]
    return rows + [(n + i, rows[i][1], "en") for i in range(8)] + [(3, rows[5][1], "en"), (None, rows[6][1] + "tail", "en")]


@pytest.mark.parametrize(
    "params",
    [
        suffix_dedup.SuffixParams(),
        suffix_dedup.SuffixParams(shard_bytes=900, common=3, wide=2),
        suffix_dedup.SuffixParams(span=12, gram=5, shard_bytes=2000, common=5, wide=4),
    ],
)
def test_repeated_substrings(spark, params):
    rows = passages(2) + [r for r in ODD if r[0] not in (4, 9, 10)]
    assert removed(frame(spark, rows), params) == plain_removed(rows, params.span)


def test_substrings_of_long_and_repetitive_texts(spark, monkeypatch):
    rows = [(1, "x" * 400, "en"), (2, "y" + "x" * 300, "en"), (3, "ab" * 300, "en"), (4, "ba" * 200, "en"), (5, LONG[:6000], "en"), (6, LONG[2000:9000], "en")]
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    assert removed(frame(spark, rows), suffix_dedup.SuffixParams()) == plain_removed(rows, 50)
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(frame(spark, ODD), digest=True).collect()}
    assert got[9].n_bytes == 100_000 and got[9].n_removed == 0 and got[4].n_removed == 0
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0


def test_suffix_arrays_and_common_prefixes():
    rng = np.random.default_rng(5)
    for n, letters in ((1, 1), (7, 1), (60, 1), (300, 2), (2000, 3), (3000, 250)):
        s = rng.integers(0, letters, n).astype(np.int16)
        sa = suffix_dedup.suffix_array(s)
        suffixes = [tuple(s[i:]) for i in range(n)]
        assert sa.tolist() == sorted(range(n), key=suffixes.__getitem__)
        lcp = suffix_dedup.common_prefixes(s, sa, 20, lane=16)
        for k in range(1, n):
            a, b = suffixes[sa[k - 1]], suffixes[sa[k]]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert lcp[k] == min(same, 20)


def test_op12_digests(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, g, len(s), hashlib.sha256(k).hexdigest()) for i, n, g, s, k in plain_removed(docs, 50)]
    assert sorted(map(tuple, QUERIES["op12_suffix_dedup"](spark, SMALL).collect())) == sorted(want)


# --- runs --------------------------------------------------------------------------------------


def plain_runs(w, repeats=4, least=6):
    out, seen = [], set()
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, repeats * q) and j > i and (i, j) not in seen and not any((i, j + q - p) == (s, s + n - p) for s, n, p in out):
                out.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, w):
    runs = plain_runs(w)
    kept = [True] * len(w)
    for s, n, q in runs:
        kept[s + q : s + n] = [False] * (n - q)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    text = b" ".join(x for x, k in zip(w, kept) if k)
    return (doc_id, len(runs), *told, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(text).hexdigest())


def test_runs(spark):
    rng = random.Random(8)
    rows = [r for r in ODD if r[0] not in (4, 9)]
    for i in range(200):
        w = []
        while len(w) < rng.randrange(5, 160):
            unit = rng.choices("abcd", k=rng.randrange(1, 9))
            w += unit * rng.randrange(1, 9) + rng.choices("abcdef", k=rng.randrange(0, 4))
        rows.append((100 + i, " ".join(w), "en"))
    got = periodic.find_runs(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    words = {i: (t or "").encode().split() for i, t, _ in rows}
    for r in got:
        w = words[r.doc_id]
        assert [tuple(x) for x in r.runs] == plain_runs(w) and r.n_words == len(w)
        best = r.best and (r.best.start, r.best.length, r.best.period)
        assert best == periodic.strongest([tuple(x) for x in r.runs])
    assert periodic.find_runs(frame(spark, [])).count() == 0


def test_long_segments_are_scanned_at_every_lag_that_can_hold_a_run():
    rng = np.random.default_rng(4)
    p = periodic.RunParams()
    for _ in range(60):
        w = np.concatenate([np.tile(rng.integers(0, 3, rng.integers(1, 40)), rng.integers(1, 8)) for _ in range(6)])
        assert sorted(periodic.runs_of(w, p)) == sorted(plain_runs(w.tolist()))


def test_op13_seeds_and_digests(spark):
    def seeded(doc_id, text):
        w = (text or "").encode().split()
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        return w

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: plain_row(r.doc_id, seeded(r.doc_id, r.text)) for r in docs if len(r.text or "") < 12_000}
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_periodic"](spark, SMALL).collect()}
    assert len(got) == len(docs) and {i: got[i] for i in want} == want
    assert any(r[1] for r in want.values())
    odd = periodic.find_runs(periodic.seeded_repeats(frame(spark, ODD))).count()
    assert odd == len(ODD)
