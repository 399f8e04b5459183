"""Each operator against a plain version, the library it must equal, or held-out labels."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimweave.llm import bpe, decontaminate, language, ngram_join, passages, pii, quality
from claimweave.llm.common import connected_components
from claimweave.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}


def components(pairs, nodes):
    parent = {i: i for i in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in nodes}


def test_components(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(1000, 1040)]
    star = [(2000, 2000 + i) for i in range(1, 60)]
    pairs = chain + star + [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    got = connected_components(spark.createDataFrame(pairs, "a long, b long"))
    linked = [(a, b) for a, b in pairs if a != b]
    want = components(linked, {x for p in linked for x in p})
    assert {r.node: r.component for r in got.collect()} == want


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at, kind = rng.randrange(1, len(out) - 1), rng.random()
        if kind < 0.4:
            out[at] = "q"
        elif kind < 0.7:
            del out[at]
        else:
            out.insert(at, "z")
    return "".join(out)


def edit_distance_inside(pattern, text):
    """Fewest edits from ``pattern`` to any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[:], i
        for j, t in enumerate(text, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (p != t))
    return min(row)


def test_decontamination_equals_full_alignment():
    rng = random.Random(2)
    words = "the river that ran over old stones and under new bridges until it met salt water again".split()
    params = decontaminate.MatchParams()
    seen = set()
    for _ in range(60):
        item = "".join(chr(97 + rng.randrange(26)) for _ in range(3)) + " " + " ".join(rng.choice(words) for _ in range(rng.randrange(4, 22)))
        folded = "".join(map(chr, decontaminate.folded(item)[0]))
        edits = rng.randrange(0, 2 * params.budget(len(folded)) + 2)
        text = " ".join(rng.choice(words) for _ in range(30)) + " " + edited(rng, folded, edits) + " " + rng.choice(words)
        plain = "".join(map(chr, decontaminate.folded(text)[0]))
        least = edit_distance_inside(folded, plain)
        got = decontaminate.GramIndex([(7, item)], params).matches(text)
        if least <= params.budget(len(folded)):
            assert got and got[0][1] == least, (item, text, least)
        else:
            assert not got
        seen.add(bool(got))
    assert seen == {True, False}


def test_decontamination_in_pieces(monkeypatch):
    item = "An item that is long enough to be found and that repeats nothing of itself."
    text = "filler text of no matter " * 40 + item + " tail" * 30
    whole = decontaminate.GramIndex([(1, item)], decontaminate.MatchParams()).matches(text)
    monkeypatch.setattr(decontaminate, "CHUNK", 64)
    monkeypatch.setattr(decontaminate, "MOST_HITS", 20)
    pieces = decontaminate.GramIndex([(1, item)], decontaminate.MatchParams()).matches(text)
    assert whole == pieces == [(1, 0, 1000, 1000 + len(item))]


def test_decontamination_in_blocks(spark, monkeypatch):
    docs, items = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    once = sorted(decontaminate.find_contamination(docs, items).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 2000)
    assert sorted(decontaminate.find_contamination(docs, items).collect()) == once
    plain = {(d.doc_id, b.item_id) for b in items.collect() for d in docs.collect() if b.text in d.text}
    assert plain <= {(r.doc_id, r.item_id) for r in once}


def test_language_on_held_out(spark):
    got = QUERIES["op2_language"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = got.join(truth, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_language_counts_in_pieces():
    params = language.LanguageParams(buckets=64)
    one, two = (language.term_counts("ab cdé " * n, params) for n in (200_000, 400_000))
    three = language.term_counts("ab cdé " * 600_000, params)
    assert (three - two == two - one).all() and language.term_counts("12 !", params) is None


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80), (2, 50)])
def test_ngram_join_equals_all_pairs(spark, texts, width, percent):
    rng = random.Random(width)
    base = [" ".join(f"w{rng.randrange(400)}" for _ in range(n)) for n in (3, 12, 40, 40, 90, 150)]
    rows = dict(texts)
    for k in range(160):
        words = base[k % len(base)].split()
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(50)}"
        rows[10_000 + k] = " ".join(words + ["tail"] * rng.randrange(0, 3))
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_classes(docs, ngram_join.JoinParams(width, percent)).collect()}
    sets = {}
    for i, t in rows.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    want = components(links, sets)
    assert got == {i: (len(sets[i]), want[i]) for i in sets}
    assert len(links) > 100


def test_mixture_of_every_shard(spark):
    got = QUERIES["op4_sharding"](spark, "/root/testdata/sf0.01")
    source = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source")
    counts = collections.Counter((r.shard, r.source) for r in got.join(source, "doc_id").collect())
    totals = collections.Counter()
    for (_, s), n in counts.items():
        totals[s] += n
    assert all(abs(counts[k, s] - n / 16) < 2 for s, n in totals.items() for k in range(16))


def test_patterns_equal_plain_regular_expressions(texts):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def valid(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1]))
            return 12 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    rng = random.Random(9)
    made = ["".join(rng.choice("a@.-+1 45(2)9_%é") for _ in range(rng.randrange(60))) for _ in range(4000)]
    made += ["1.2.3.4.5.6.7.8", "0001.02.3.255", "256.1.1.1 1.1.1.256", "a@b@c.d.e.f@g.h", "4111-1111 1111-1111", "x@y.z" * 5]
    for text in [*texts.values(), *made]:
        want = [
            (m.start(), m.end(), kind)
            for kind, p in patterns.items() for m in re.finditer(p, text) if valid(kind, m[0])
        ]
        assert pii.base_spans(text) == sorted(want, key=lambda s: (s[0], pii.KINDS.index(s[2]))), text


def test_field_finds_held_out_spans():
    tagger = pii.FieldTagger(pii.train_field())
    text = "Ask Dr. Linda Fox about ssn 111-22-3333, passport K7654321. The end of it."
    labels = tagger.tag([text.split()])[0]
    spans = pii.field_spans(text, labels, [])
    assert [(k, text[a:b]) for a, b, k in spans] == [
        ("person", "Linda Fox"), ("id_number", "111-22-3333"), ("id_number", "K7654321")
    ]


def test_viterbi_and_shortcut_equal_exhaustive_search():
    rng = np.random.default_rng(3)
    for _ in range(30):
        between, e = rng.normal(size=(3, 3)), rng.normal(size=(rng.integers(1, 6), 3))
        paths = np.stack(np.meshgrid(*[range(3)] * len(e), indexing="ij"), -1).reshape(-1, len(e))
        scores = e[np.arange(len(e)), paths].sum(1) + between[0, paths[:, 0]] + between[paths[:, -1], 0]
        scores += sum(between[paths[:, t], paths[:, t + 1]] for t in range(len(e) - 1))
        assert (pii.viterbi([e], between)[0] == paths[scores.argmax()]).all()
    tagger = pii.FieldTagger(pii.train_field())
    words = "Dr. Linda Fox of the mill saw ssn 111-22-3333 and Contact Mark Hill. Name: X1234567 is".split()
    short = tagger.tag([words])[0]
    tagger.needed = np.full(3, np.inf)  # nothing is certain: decode every word
    assert (tagger.tag([words])[0] == short).all()


def test_byte_pairs_equal_the_library(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.load(path)
    odd = [
        "", "ΑΣ Σ ΟΔΟΣ", "a\x1cb\x85c d　", "<|endoftext|>hi<|startoftext|> x", "İstanbul ſ ǅ", "é é", "don't I'LL'S 're12½³",
        "\U0001f600\U0001f469‍\U0001f469 x", "日本語 ١٢٣", "x" * 5000, "​﻿\xad", "<|endoftext|", "a<|ENDOFTEXT|>", "ab" * 3000,
    ]
    for text in [*texts.values(), *odd]:
        want = library.encode(text, add_special_tokens=False).ids
        got = own.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == want, text[:80]
        assert own.decode(got) == library.decode(want, skip_special_tokens=False)


def test_byte_pair_digests(spark, texts):
    import public_tokenizers

    own = bpe.load(public_tokenizers.path("word_bpe_49k.json"))
    for r in QUERIES["op6_bpe"](spark, SMALL).collect():
        ids = own.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())


def test_quality_on_held_out(spark):
    base = "/root/testdata/sf0.1"
    got = QUERIES["op7_quality"](spark, base).join(spark.read.parquet(f"{base}/labels.parquet"), "doc_id").where("held_out")
    rate = {r.quality: r.rate for r in got.groupBy("quality").agg(F.avg("predicted").alias("rate")).collect()}
    assert rate[1] > 0.99 and rate[0] < 0.1


def test_rules_equal_their_trees(spark):
    described = "Tree 0 (weight 1.0):\n  If (feature 0 <= 2.5)\n   If (feature 1 > 0.25)\n    Predict: 0.0\n   Else (feature 1 <= 0.25)\n    Predict: 1.0\n  Else (feature 0 > 2.5)\n   Predict: 1.0\n"
    got = quality.tree_paths(described, ("a", "b"))
    assert got == sorted([
        (("a", "<=", 2.5),), (("a", "<=", 2.5), ("b", ">", 0.25)), (("a", "<=", 2.5), ("b", "<=", 0.25)), (("a", ">", 2.5),)
    ])
    assert quality.simplified([("a", "<=", 3.0), ("a", "<=", 1.0), ("a", ">", 0.5)]) == (("a", "<=", 1.0), ("a", ">", 0.5))


def test_secrets_of_known_shapes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id for r in QUERIES["op9_secrets"](spark, "/root/testdata/sf0.01").collect()}
    shaped = r'AKIA[A-Z0-9]{16}|token = "[0-9a-f]{40}|password=[0-9a-f]{18}'
    assert got == {r.doc_id for r in docs.where(F.col("text").rlike(shaped)).collect()}


@pytest.mark.parametrize("n", [3, 19, 20, 60, 400])
def test_compact_windows_equal_the_tree(n):
    rng = np.random.default_rng(n)
    tokens = rng.integers(0, max(5, n // 3), n).astype(np.uint64)
    rank = (passages.mix64(tokens, 5) & ~passages._PLACES) | np.arange(n, dtype=np.uint64)
    want = []

    def split(a, b):
        if b - a >= 20:
            c = a + int(rank[a:b].argmin())
            want.append((a, c, b - 1))
            split(a, c)
            split(c + 1, b)

    split(0, n)
    left, centre, right = passages.compact_windows(tokens, 5, 20)
    assert sorted(zip(left.tolist(), centre.tolist(), right.tolist(), strict=True)) == sorted(want)


def test_every_exact_repeat_is_in_a_passage(spark, texts):
    rng = random.Random(7)
    rows = dict(texts)
    piece = [" ".join(f"p{k}a{i}" for i in range(60)) for k in range(4)]
    noise = lambda n: " ".join(f"n{rng.randrange(10**9)}" for _ in range(n))
    for k in range(24):
        rows[50_000 + k] = f"{noise(30)} {piece[k % 4]} {noise(40)} {' '.join(piece[(k + 1) % 4].split()[:35])} {noise(20)}"
    # Passages that share only a part with the group's first document, but all with each other.
    tail = noise(30)
    for k in range(3):
        rows[60_000 + k] = f"{noise(20)} {' '.join(piece[0].split()[:30])} {tail} {noise(10)}"
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(3)
    got = passages.repeated_passages(docs).collect()
    words = {i: t.encode().lower().split() for i, t in rows.items()}
    inside = collections.defaultdict(list)
    for r in got:
        inside[r.doc_id].append((r.start, r.end))
        inside[r.other_id].append((r.other_start, r.other_end))
        a, b = words[r.doc_id][r.start : r.end], words[r.other_id][r.other_start : r.other_end]
        a, b = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (a, b))
        assert len(a & b) >= 0.8 * len(a | b) and r.end - r.start >= 50 and r.doc_id != r.other_id
    where = collections.defaultdict(set)
    for i, w in words.items():
        for k in range(len(w) - 49):
            where[tuple(w[k : k + 50])].add((i, k))
    for places in where.values():
        if len({i for i, _ in places}) > 1:
            for i, k in places:
                assert any(a <= k and k + 50 <= b for a, b in inside[i]), (i, k)


def test_library_avoids_what_does_not_scale():
    from pathlib import Path

    for path in Path(passages.__file__).parent.glob("*.py"):
        assert not re.search(r"crossJoin|localCheckpoint|toPandas|\.rdd\b|@F\.udf|tempfile", path.read_text()), path
    for native in ("sharding", "secrets"):
        assert not re.search(r"mapIn|applyIn|pandas|pyarrow|numpy", (Path(passages.__file__).parent / f"{native}.py").read_text())
