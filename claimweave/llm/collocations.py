"""Phrases whose words attract each other, from count streams in prefix and in suffix order."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.llm.common import mix64, stage

# Pieces end at these; they and all white space are ASCII, so whole texts are mapped as bytes.
STOPS = b".,;:!?\n\x0b\x0c\r"
UNKNOWN_LANG = "und"
# What is known to be frequent is kept as a bitmap of this many bits, 8 MB at any input size. Two
# keys on one bit only let more through to the exact counts.
BITS = 1 << 26
HELD = 300_000  # different words or phrases a task holds before it hands their counts on

_MAP = bytes(10 if i in STOPS else i + 32 if 65 <= i <= 90 else i for i in range(256))


@dataclass(frozen=True)
class PhraseParams:
    """Phrases of 2 to ``longest`` words that occur ``least`` times; the first ``top`` of each language."""

    longest: int = 5
    least: int = 100
    inside_percent: int = 100
    top: int = 2000


def tokens(texts: list[str | None]) -> list[bytes]:
    """Words of all ``texts`` in order, A-Z in lower case, with ``b"."`` at the end of every piece and text."""
    joined = "\n".join(t or "" for t in texts).encode("utf-8", "surrogatepass")
    return joined.translate(_MAP).replace(b"\n", b" . ").split()


class _Words(dict):
    """Numbers of words from 1 on, with a 64-bit key of each; 0 is the end of a piece."""

    def __init__(self, lang: str):
        from xxhash import xxh64_intdigest

        super().__init__({b".": 0})
        self.seed = xxh64_intdigest(lang.encode())
        self.words, self.keys, self.digest = [b"."], [0], xxh64_intdigest

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self.words)
        self.words.append(word)
        self.keys.append(self.digest(word, self.seed))
        return code

    def codes(self, texts: list[str | None]) -> np.ndarray:
        found = tokens(texts)
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[str | None]]]:
    for at in range(0, batch.num_rows, 1000):
        part = batch.slice(at, 1000)
        groups: dict[str, list[str | None]] = {}
        for lang, text in zip(part.column("lang"), part.column("text")):
            groups.setdefault(lang.as_py(), []).append(text.as_py())
        yield from groups.items()


def _known(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys & np.uint64(BITS - 1)
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _bitmap(frame: DataFrame, key: str) -> np.ndarray:
    """One bit for each ``key`` of ``frame``: at most ``BITS / 8`` bytes reach the driver."""
    slot = F.col(key).bitwiseAND(BITS - 1)
    blocks = frame.groupBy(F.expr(f"{key} & {BITS - 1}").bitwiseAND(~32767).alias("block")).agg(
        F.bitmap_construct_agg(slot.bitwiseAND(32767)).alias("bits")
    )
    bits = np.zeros(BITS // 8, np.uint8)
    for row in blocks.toLocalIterator():
        bits[row.block // 8 : row.block // 8 + 4096] = np.frombuffer(bytes(row.bits), np.uint8)
    return bits


def _word_counts(texts: DataFrame) -> DataFrame:
    """``(lang, word, key, f)``: occurrences of every word."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[_Words, np.ndarray]] = {}

        def emit(lang: str) -> pa.RecordBatch:
            words, counts = held.pop(lang)
            counts = counts[1:]
            return pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * len(counts), pa.string()),
                    "word": pa.array([w.decode("utf-8", "surrogatepass") for w in words.words[1:]], pa.string()),
                    "key": pa.array(np.array(words.keys[1:], np.uint64).view(np.int64)),
                    "f": pa.array(counts, pa.int64()),
                }
            )

        for batch in batches:
            for lang, group in _by_lang(batch):
                words, counts = held.pop(lang, None) or (_Words(lang), np.zeros(1, np.int64))
                codes = words.codes(group)
                more = np.bincount(codes, minlength=len(words.words))
                more[: len(counts)] += counts
                held[lang] = (words, more)
                if len(more) > HELD:
                    yield emit(lang)
        for lang in list(held):
            yield emit(lang)

    counted = texts.mapInArrow(scan, "lang string, word string, key long, f long")
    return counted.groupBy("lang", "word", "key").agg(F.sum("f").alias("f"))


def _frequent_runs(codes: np.ndarray, keys: np.ndarray, frequent: np.ndarray, runs: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Where runs of 1, 2, ... words start that are all frequent, and the keys of the runs that may be.

    ``runs`` has a bitmap of frequent pairs and perhaps one of frequent triples; what may be frequent is
    a word longer, and both its parts are in the last of them.
    """
    often = _known(frequent, keys)
    often[0] = False
    chain, key = often[codes], keys[codes]
    starts = [chain]
    for k in range(1, len(runs) + 2):
        chain = chain & np.r_[chain[1:], False]
        at = np.flatnonzero(chain)
        longer = _pair_key(key[at], keys[codes[at + k]])
        if k <= len(runs):
            chain[at], key[at] = _known(runs[k - 1], longer), longer
            starts.append(chain)
    return starts, longer


def _run_counts(texts: DataFrame, frequent: np.ndarray, runs: list[np.ndarray]) -> DataFrame:
    """``(run, f)``: occurrences of the runs a word longer than ``runs`` that may be frequent, by a 64-bit key."""
    context = texts.sparkSession.sparkContext
    known, met = context.broadcast(frequent), context.broadcast(runs)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merge() -> tuple[np.ndarray, np.ndarray]:
            keys, where = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(where, np.concatenate([n for _, n in held]), len(keys)).astype(np.int64)

        def emit() -> pa.RecordBatch:
            keys, counts = merge()
            held.clear()
            return pa.RecordBatch.from_pydict({"run": pa.array(keys.view(np.int64)), "f": pa.array(counts)})

        for batch in batches:
            for lang, group in _by_lang(batch):
                words = _Words(lang)
                codes = words.codes(group)
                _, run = _frequent_runs(codes, np.array(words.keys, np.uint64), known.value, met.value)
                held.append(np.unique(run, return_counts=True))
                if sum(len(k) for k, _ in held) > 8 * HELD:
                    held[:] = [merge()]
                    if len(held[0][0]) > 4 * HELD:
                        yield emit()
        if held:
            yield emit()

    return texts.mapInArrow(scan, "run long, f long").groupBy("run").agg(F.sum("f").alias("f"))


def _pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a * np.uint64(0xC2B2AE3D27D4EB4F) + b, 3)


class _Phrases(dict):
    """Numbers of one language's phrases by what comes before the last word and that word, with their counts.

    Before it comes a word or the number of a phrase.
    """

    def __init__(self):
        super().__init__()
        self.texts: list[bytes] = []
        self.sizes: list[int] = []
        self.counts = np.zeros(0, np.int64)

    def __missing__(self, parts: tuple[bytes | int, bytes]) -> int:
        before, word = parts
        self[parts] = number = len(self.texts)
        one = isinstance(before, bytes)
        self.texts.append((before if one else self.texts[before]) + b" " + word)
        self.sizes.append(2 if one else self.sizes[before] + 1)
        return number

    def add(self, before: list, words: list[bytes], count: np.ndarray) -> np.ndarray:
        """The numbers of some phrases, all different, that have occurred ``count`` times more."""
        numbers = np.fromiter(map(self.__getitem__, zip(before, words, strict=True)), np.int64, len(words))
        self.counts = np.pad(self.counts, (0, len(self.texts) - len(self.counts)))
        self.counts[numbers] += count
        return numbers


def _phrase_scan(texts: DataFrame, frequent: np.ndarray, runs: list[np.ndarray], longest: int) -> DataFrame:
    """``(lang, size, phrase, f)``: each task's occurrences of the phrases of 2 to ``longest`` words whose parts are all in ``runs``.

    A task sums over its texts, so what it hands on follows the phrases, not their occurrences.
    """
    context = texts.sparkSession.sparkContext
    known, met = context.broadcast(frequent), context.broadcast(runs)
    width = len(runs) + 1

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Phrases] = {}

        def emit() -> Iterator[pa.RecordBatch]:
            for lang, phrases in held.items():
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": pa.array([lang] * len(phrases.texts), pa.string()),
                        "size": pa.array(phrases.sizes, pa.int32()),
                        "phrase": pa.array([t.decode("utf-8", "surrogatepass") for t in phrases.texts], pa.string()),
                        "f": pa.array(phrases.counts),
                    }
                )
            held.clear()

        for batch in batches:
            for lang, group in _by_lang(batch):
                words = _Words(lang)
                codes = words.codes(group)
                starts, _ = _frequent_runs(codes, np.array(words.keys, np.uint64), known.value, met.value)
                phrases = held.setdefault(lang, _Phrases())
                # name: what stands for the phrase of the size before that starts at a place.
                at = np.flatnonzero(starts[0])
                name, named = codes[at], words.words
                for size in range(2, longest + 1):
                    go = starts[size - 1][at] if size <= width else starts[-1][at + size - width]
                    at, name = at[go], name[go]
                    if not len(at):
                        break
                    pair, name, count = np.unique(name * len(words.words) + codes[at + size - 1], return_inverse=True, return_counts=True)
                    before, last = np.divmod(pair, len(words.words))
                    before, last = before.tolist(), last.tolist()
                    named = phrases.add([named[b] for b in before], [words.words[c] for c in last], count).tolist()
                if sum(len(p.texts) for p in held.values()) > HELD:
                    yield from emit()
        yield from emit()

    return texts.mapInArrow(scan, "lang string, size int, phrase string, f long")


def count_streams(docs: DataFrame, p: PhraseParams, lang_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(lang, n)``, frequent words ``(lang, word, f)`` and frequent phrases ``(lang, size, phrase, f)``.

    Four scans. A phrase is frequent only if all its parts are, so the second counts pairs of
    frequent words, the third triples linked by frequent pairs, both by keys alone, and the last
    the phrases made of what is frequent by then. What is known to be frequent reaches the tasks as
    bitmaps of fixed size, which may let too much through but never too little; counts
    themselves are exact.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"), F.col(text_col).alias("text"))
    often = F.col("f") >= p.least
    counts = stage(_word_counts(texts), "phrase-words")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    words = counts.where(often)
    frequent = _bitmap(words, "key")
    runs: list[np.ndarray] = []
    for _ in range(2, min(3, p.longest) + 1):
        runs.append(_bitmap(_run_counts(texts, frequent, list(runs)).where(often), "run"))
    phrases = _phrase_scan(texts, frequent, runs, p.longest).groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    return totals, words.select("lang", "word", "f"), stage(phrases.where(often), "phrase-counts")


def _nested_counts(phrases: DataFrame, longest: int, order: Callable[[str], Column]) -> DataFrame:
    """``phrases`` with ``inner``: counts of the parts of 2, 3, ... words each starts with in ``order``.

    A frequent phrase has only frequent parts. In the order of its words its beginnings come
    before it, and the last row of ``k`` words before it is its own beginning of ``k`` words; one
    walk along the sorted stream carries the counts down.
    """
    listed = phrases.withColumn("_list", order("words"))
    walk = Window.partitionBy("lang", F.col("_list")[0], F.col("_list")[1]).orderBy("_list")
    so_far = walk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = [F.last(F.when(F.col("size") == k, F.col("f")), ignorenulls=True).over(so_far) for k in range(2, longest)]
    return listed.withColumn("inner", F.array(*counts)).drop("_list")


def phrase_scores(totals: DataFrame, words: DataFrame, phrases: DataFrame, p: PhraseParams) -> DataFrame:
    """``(lang, phrase, a, l, r, n, score)`` of the phrases that no longer one makes superfluous.

    The stream of counts is walked in prefix order for the counts of first parts and right
    extensions, and in suffix order for those of last parts and left extensions; the two are merged.
    Single words come from their own stream.
    """
    listed = phrases.withColumn("words", F.split("phrase", " "))
    forward = _nested_counts(listed, p.longest, lambda c: F.col(c)).withColumnRenamed("inner", "firsts")
    backward = _nested_counts(listed, p.longest, lambda c: F.reverse(c)).select(
        "lang", "phrase", F.col("inner").alias("lasts")
    )
    both = forward.join(backward.hint("merge"), ["lang", "phrase"])
    single = words.select("lang", F.col("word"), F.col("f"))
    both = both.withColumns({"_first": F.col("words")[0], "_last": F.element_at("words", -1)})
    for end in ("first", "last"):
        both = both.join(
            single.select("lang", F.col("word").alias(f"_{end}"), F.col("f").alias(f"one_{end}")), ["lang", f"_{end}"]
        )
    # Every phrase that a longer one contains, with the count of the commonest such.
    spans = F.expr("flatten(transform(sequence(2, size - 1), k -> transform(sequence(1, size - k + 1), s -> array_join(slice(words, s, k), ' '))))")
    inside = listed.where("size > 2").select("lang", F.explode(spans).alias("phrase"), "f")
    inside = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    both = both.join(inside.hint("merge"), ["lang", "phrase"], "left")
    both = both.where(F.coalesce(F.col("longer") * 100 < F.col("f") * p.inside_percent, F.lit(True)))

    # Sums of occurrences stay below 10^18 and products below 10^38, so decimals hold them exactly.
    exact = lambda c: f"cast({c} as decimal(18, 0))"
    left = "if(k = 1, one_first, firsts[k - 2])"
    right = "if(k = size - 1, one_last, lasts[size - k - 2])"
    score = f"cast(floor(cast({exact('1000 * f')} * {exact('n')} as decimal(38, 0)) div ({exact(left)} * {exact(right)})) as long)"
    cuts = F.expr(f"transform(sequence(1, size - 1), k -> struct({score} as score, k as k, {left} as l, {right} as r))")
    scored = both.join(totals, "lang").withColumn("cut", F.array_min(cuts))
    return scored.select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score")


def mine_phrases(docs: DataFrame, params: PhraseParams = PhraseParams(), lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``params.top`` phrases.

    Texts are cut into pieces at ``. , ; : ! ?`` and line ends and those into words; all is counted per
    language, a null language as ``und``. A phrase of 2 to ``longest`` words within a piece that
    occurs ``a >= least`` times is cut where ``score = floor(1000 a n / (l r))`` is lowest (then after
    the fewest words), with ``l`` and ``r`` the occurrences of both parts and ``n`` those of all words. It
    is left out if a longer frequent phrase around it occurs ``inside_percent`` as often. Order is
    by score, then ``a``, both descending, then by phrase in the order of its bytes.

    Null and empty texts hold no words. Repeated rows count each time. An empty table gives an
    empty result; other columns are ignored.
    """
    scored = phrase_scores(*count_streams(docs, params, lang_col, text_col), params)
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= params.top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
