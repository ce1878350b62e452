"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A word's symbols stand in a linked list. The leaves of a segment tree hold (rank, place) of each
adjacent pair as one number; its root is the leftmost pair of the lowest rank. A merge changes three
leaves, each update walks to the root, and merging ends when the root holds no pair, so a word of n
bytes takes O(n log n) steps even if it is a whole document without white space.

Texts are normalised as the vocabulary file says (NFC, white space, lower case), special tokens are
taken out of the raw text first, and words are cached by task in a dictionary of bounded size.

Decoding maps ids back to tokens. Where the file names no decoder, as here, tokens are joined by spaces.

Defined cases: a null or empty text has no ids and decodes to nothing; repeated texts get equal rows;
other columns pass through, but for one with the name of the new column, which is replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
from functools import lru_cache
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that a task remembers.
CACHE_WORDS = 400_000
#: Unicode white space, as regular expressions for tokenizers take it.
_SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_CHUNK = re.compile(f"[^{_SPACES}]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")
RESULT = "n_tokens: bigint, ids_sha256: string, decoded_sha256: string"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints, or else one from U+0100 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 256
    for b in range(256):
        out[b] = chr(b if b in prints else extra)
        extra += b not in prints
    return out


def merge(symbols: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Applies the lowest-ranked, leftmost merge until none is left."""
    n = len(symbols)
    if n < 2:
        return symbols
    leaves = 1
    while leaves < n - 1:
        leaves *= 2
    none = 1 << 62
    tree = [none] * (2 * leaves)
    for i in range(n - 1):
        if (found := pairs.get((symbols[i], symbols[i + 1]))) is not None:
            tree[leaves + i] = (found[0] << 32) | i
    for i in range(leaves - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (top := tree[1]) != none:
        at = top & 0xFFFFFFFF
        gone = after[at]
        symbols[at] = pairs[symbols[at], symbols[gone]][1]
        after[at] = right = after[gone]
        if right < n:
            before[right] = at
        symbols[gone] = -1
        left = before[at]
        for place in (gone, at, left):
            if place < 0 or place >= n - 1:
                continue
            value = none
            if place != gone and (then := after[place]) < n and (found := pairs.get((symbols[place], symbols[then]))) is not None:
                value = (found[0] << 32) | place
            k = leaves + place
            tree[k] = value
            k >>= 1
            while k:
                a, b = tree[2 * k], tree[2 * k + 1]
                if b < a:
                    a = b
                if tree[k] == a:
                    break  # nothing above depends on what changed
                tree[k] = a
                k >>= 1
    return [s for s in symbols if s >= 0]


class Codec:
    """Encoder and decoder of a vocabulary file whose words end in a suffix."""

    def __init__(self, path: str) -> None:
        import regex

        with open(path, encoding="utf-8") as text:
            held = json.load(text)
        model = held["model"]
        vocab, self.suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {x["content"]: x["id"] for x in held["added_tokens"]}
        self.shown = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        joins = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.pairs = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(joins)}
        letters = byte_letters()
        self.inner = [vocab[x] for x in letters]
        self.final = [vocab[x + self.suffix] for x in letters]
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.word = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACES}\p{{L}}\p{{N}}]+")
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        if (found := self.words.get(word)) is not None:
            return found
        data = word.encode()
        symbols = [self.inner[b] for b in data]
        symbols[-1] = self.final[data[-1]]
        ids = merge(symbols, self.pairs)
        found = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= 64:
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            self.words[word] = found
        return found

    def _chunk(self, chunk: str) -> bytes:
        """A run without white space, normalised."""
        plain = chunk if chunk.isascii() else unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
        found = b"".join([self._word(w) for w in self.word.findall(plain.lower())])
        if len(chunk) <= 64:
            if len(self.chunks) >= CACHE_WORDS:
                self.chunks.clear()
            self.chunks[chunk] = found
        return found

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        ids = []
        for k, part in enumerate(self.split_special.split(text or "")):
            if k % 2:
                ids.append(self.special[part].to_bytes(4, "little"))
                continue
            held, make = self.chunks.get, self._chunk
            runs = _CHUNK.findall(part) if _SEPARATORS.search(part) else part.split()
            ids += [held(c) or make(c) for c in runs]
        return b"".join(ids)

    def decode(self, ids: list[int]) -> str:
        """The text of ids. The file names no decoder, so tokens are joined by spaces; ids that it doesn't know are left out."""
        shown = self.shown
        return " ".join([shown[i] for i in ids if i in shown])


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "encoded") -> DataFrame:
    """``docs`` with the ids (array of int) in ``into``; ``digest`` gives digests only."""

    @F.arrow_udf("array<int>")
    def ids(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        use = codec(path)
        for column in columns:
            yield pa.array([np.frombuffer(use.encode(x.as_py()), "<u4").astype(np.int32) for x in column], pa.list_(pa.int32()))

    return docs.withColumn(into, ids(F.col(text).cast("string")))


def decode(encoded: DataFrame, path: str, ids: str = "encoded", into: str = "decoded") -> DataFrame:
    """``encoded`` with the text of the ids in ``into``; null ids decode to nothing."""

    @F.arrow_udf("string")
    def text(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        use = codec(path)
        for column in columns:
            yield pa.array([use.decode(x.as_py() or []) for x in column], pa.string())

    return encoded.withColumn(into, text(F.col(ids)))


def digest(docs: DataFrame, path: str, text: str = "text", into: str = "digest") -> DataFrame:
    """``docs`` with the struct RESULT of each text in the new column ``into``: its ids, and the text that they decode to."""

    @F.arrow_udf(f"struct<{RESULT}>")
    def digests(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        use = codec(path)
        for column in columns:
            n, a, b = [], [], []
            for x in column:
                ids = use.encode(x.as_py())
                n.append(len(ids) // 4)
                a.append(hashlib.sha256(ids).hexdigest())
                b.append(hashlib.sha256(use.decode(np.frombuffer(ids, "<u4").tolist()).encode()).hexdigest())
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.withColumn(into, digests(F.col(text).cast("string")))
