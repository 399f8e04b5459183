"""Byte-pair encoding with merges drawn from a priority queue, and decoding by vocabulary."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# White space as the tokenizer file's pattern syntax defines it (not Python's wider class).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
MEMO_WORDS = 250_000
BATCH_ROWS, BATCH_BYTES = 500, 1 << 20


def byte_letters() -> list[str]:
    """A printable letter for every byte: itself where printable, else one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class WordBpe:
    """Encoder and decoder for one tokenizer file of the kind BPE with word ends."""

    def __init__(self, definition: dict):
        import regex

        model = definition["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in definition["added_tokens"]}
        self.strings = [""] * (1 + max([*self.vocab.values(), *self.special.values()]))
        for token, i in [*self.vocab.items(), *self.special.items()]:
            self.strings[i] = token
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.merges = {
            (self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b]) for rank, (a, b) in enumerate(pairs)
        }
        (split,) = (p for p in definition["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"\s", SPACE)).findall
        self.space = regex.compile(f"[{SPACE}]+").sub
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None
        self.letters = byte_letters()
        self.memo: dict[str, bytes] = {}

    def merge(self, word: str) -> list[int]:
        """Token ids of one word: the lowest-ranked pair is merged first, leftmost on ties."""
        symbols = [self.letters[b] for b in word.encode()]
        symbols[-1] += self.suffix
        ids = [self.vocab[s] for s in symbols if s in self.vocab]
        count = len(ids)
        after, before = [*range(1, count), -1], [*range(-1, count - 1)]
        queue = []
        for at in range(count - 1):
            if found := self.merges.get((ids[at], ids[at + 1])):
                queue.append((found[0], at, ids[at], ids[at + 1], found[1]))
        heapify(queue)
        while queue:
            _, at, left, right, joined = heappop(queue)
            nxt = after[at]
            if ids[at] != left or nxt < 0 or ids[nxt] != right:
                continue  # stale: one of the two symbols has been merged meanwhile
            ids[at], ids[nxt] = joined, -1
            after[at] = end = after[nxt]
            if end >= 0:
                before[end] = at
                if found := self.merges.get((joined, ids[end])):
                    heappush(queue, (found[0], at, joined, ids[end], found[1]))
            start = before[at]
            if start >= 0 and (found := self.merges.get((ids[start], joined))):
                heappush(queue, (found[0], start, ids[start], joined, found[1]))
        return [i for i in ids if i >= 0]

    def _packed(self, word: str) -> bytes:
        if (found := self.memo.get(word)) is None:
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            found = np.array(self.merge(word), "<u4").tobytes()
            if len(word) <= 64:
                self.memo[word] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out = []
        for part in self.cut(text) if self.cut else [text]:
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            elif part:
                # One letter at a time: a capital sigma has no final form here.
                plain = self.space(" ", unicodedata.normalize("NFC", part)).replace("Σ", "σ").lower()
                out.extend(map(self._packed, self.words(plain)))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Vocabulary strings in order; a file without a decoder puts a space between them."""
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    with open(path, encoding="utf-8") as f:
        return WordBpe(json.load(f))


def tokens(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
    with_decoded: bool | None = None,
) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded, ids_sha256, decoded_sha256)``, one row per row of ``docs``.

    ``vocabulary`` is the path of the tokenizer file, readable on every executor (it comes with
    the Python installation, not with the data). ``ids`` are left out unless ``with_ids``,
    ``decoded`` unless ``with_decoded`` (as ``with_ids`` where not given). Words are merged once per distinct word and worker while the memo of
    ``MEMO_WORDS`` lasts. There is no shuffle: each Arrow batch of a scan is encoded where it
    is read, and handed on ``BATCH_ROWS`` texts or some ``BATCH_BYTES`` of ids at a time.

    Null and empty texts have no tokens. Rows may repeat; an empty table gives an empty
    result; other columns are ignored.
    """
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64())]
    with_decoded = with_ids if with_decoded is None else with_decoded
    fields += [("ids", pa.list_(pa.int32()))] * with_ids + [("decoded", pa.string())] * with_decoded
    fields += [("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = pa.schema(fields)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(vocabulary)
        for batch in batches:
            rows, held = [], 0
            for number, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                packed = model.encode(text.as_py() or "")
                decoded = model.decode(packed)
                row = {"doc_id": number.as_py(), "n_tokens": len(packed) // 4, "ids": np.frombuffer(packed, "<i4"), "decoded": decoded}
                row["ids_sha256"] = hashlib.sha256(packed).hexdigest()
                row["decoded_sha256"] = hashlib.sha256(decoded.encode()).hexdigest()
                rows.append([row[f.name] for f in schema])
                held += len(packed)
                if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                    yield packed_rows(rows)
                    rows, held = [], 0
            if rows:
                yield packed_rows(rows)

    def packed_rows(rows: list[list]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    types = {"doc_id": "long", "n_tokens": "long", "ids": "array<int>"}
    declared = ", ".join(f"{f.name} {types.get(f.name, 'string')}" for f in schema)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(encode, declared)
