"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct hashes of its words and of their stems (its first few bytes, since many languages bend one stem into many words), of adjacent word pairs and of pairs
with one word between. Training keeps a learning rate for each coordinate and an L1 penalty, so most
weights are exactly zero; the model that is broadcast holds the others only and its size is
bounded by ``2**BITS`` entries whatever the corpus.

Defined cases: a null or empty text has no features and gets the score of the bias alone; words
are runs of letters, digits and non-ASCII characters after lower-casing; repeated rows are scored
alike; other columns of the input stay as they are, but for one named as ``score`` is told to name its
own, which it replaces; with no labelled row, or labels of one kind, the model has no weights and the bias
scores below the threshold; of labelled rows with one id only the least text is learnt.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm import textbatch as tb

BITS = 20
#: Bytes of the stems of a longer word.
STEMS = (4, 5, 6, 7)
#: Bounds of the training sample: rows of either label, and characters of a row that may enter it.
TRAIN_ROWS = 4_000
TRAIN_CHARS = 20_000
THRESHOLD = 0.7
_TWICE = 0x5A5A5A5A
#: Texts are worked on so many bytes at a time; a byte makes over one feature.
SLICE_BYTES = 1 << 18


@dataclass(frozen=True)
class Model:
    """Nonzero weights by feature number, and the bias."""

    index: np.ndarray
    weight: np.ndarray
    bias: float
    bits: int = BITS

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, dtype=np.float32)
        out[self.index] = self.weight
        return out


def _features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature number) of every n-gram and skip-gram of a slice, repeats included."""
    words = tb.Words(data, offsets, tb.ALNUM)
    pairs, pair_hash = words.windows(0, 1)
    skips, skip_hash = words.windows(0, 2)
    stems = [words.stems(size) for size in STEMS]
    texts = np.concatenate([words.texts, words.texts[pairs], words.texts[skips], *(words.texts[k] for k, _ in stems)])
    return texts, np.concatenate([tb.bucket(h, bits) for h in (words.hashes, pair_hash, skip_hash, *(h for _, h in stems))])


def _distinct(owner: np.ndarray, feature: np.ndarray, bits: int) -> np.ndarray:
    """(text number << bits | feature number) of distinct features, sorted; what a text has twice counts as one feature more."""
    key, times = np.unique(owner << bits | feature, return_counts=True)
    return np.union1d(key, key[times > 1] ^ (_TWICE & (1 << bits) - 1))


def _lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return tb.utf8(pc.utf8_lower(column.cast(pa.large_string())))


def fit(texts: list[str | None] | pa.Array | pa.ChunkedArray, labels: list[int], *, alpha=3.0, beta=1.0, l1=4.0, l2=0.1, passes=6, bits=BITS) -> Model:
    """FTRL-proximal over the rows in the given order, ``passes`` times."""
    n = 1 << bits
    z, s, w = np.zeros(n), np.zeros(n), np.zeros(n)
    bias_z = bias_s = bias = 0.0
    rows: list[np.ndarray] = []
    data, offsets = _lowered(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts)
    for _, part, marks in tb.slices(data, offsets, SLICE_BYTES):
        owner, feature = _features(part, marks, bits)
        key = _distinct(owner, feature, bits)
        cuts = np.searchsorted(key, np.arange(len(marks)) * n)
        held = (key % n).astype(np.int32)  # one array a slice: thousands of small ones would leave the driver's memory in pieces
        rows += [held[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    del data, offsets, texts
    if len(set(labels)) < 2:
        return Model(np.zeros(0, np.int64), np.zeros(0, np.float32), -3.0, bits)
    for _ in range(passes):
        for feature, y in zip(rows, labels, strict=True):
            zi, si = z[feature], s[feature]
            w[feature] = wi = np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(si)) / alpha + l2))
            p = 1 / (1 + np.exp(-np.clip(wi.sum() + bias, -35, 35)))
            g = p - y
            root = np.sqrt(si + g * g)
            z[feature] = zi + g - (root - np.sqrt(si)) / alpha * wi
            s[feature] = si + g * g
            root = np.sqrt(bias_s + g * g)
            bias_z += g - (root - np.sqrt(bias_s)) / alpha * bias
            bias_s += g * g
            bias = -bias_z / ((beta + np.sqrt(bias_s)) / alpha)
    w = np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(s)) / alpha + l2))
    index = np.flatnonzero(w)
    return Model(index, w[index].astype(np.float32), float(bias), bits)


def score_batch(column: pa.Array, weights: np.ndarray, bias: float, bits: int) -> np.ndarray:
    """Scores from 0 to 1 of a batch of texts."""
    data, offsets = _lowered(column)
    out = np.full(len(offsets) - 1, bias)
    n = 1 << bits
    known = weights != 0
    known |= known[np.arange(n) ^ (_TWICE & n - 1)]
    for first, part, marks in tb.slices(data, offsets, SLICE_BYTES):
        owner, feature = _features(part, marks, bits)
        held = known[feature]  # the rest can't add to a sum
        key = _distinct(owner[held], feature[held], bits)
        out[first : first + len(marks) - 1] += tb.per_text(weights[key % n], key // n, len(marks) - 1)
    return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows whose labels are never learnt: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fits on at most ``rows`` labelled rows of either label that aren't held out, of at most TRAIN_CHARS characters.

    The sample is the ids with the smallest hashes, one row for each, so it's the same at every run;
    only it reaches the driver. A document with several labels is toxic if one of them says so.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
        .groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
        .withColumn("turn", F.xxhash64("doc_id"))
    )
    taken = [known.filter(F.col("toxic") == x).orderBy("turn", "doc_id").limit(rows) for x in (True, False)]
    marked = taken[0].unionByName(taken[1])
    texts = docs.select("doc_id", "text").filter(F.length("text") <= TRAIN_CHARS)
    got = (
        texts.join(F.broadcast(marked), "doc_id").groupBy("turn", "doc_id", "toxic").agg(F.min("text").alias("text"))
        .orderBy("turn", "doc_id").limit(2 * rows).toArrow()
    )
    model = fit(got["text"], [int(x) for x in got["toxic"].to_pylist()])
    del got
    tb.give_back()
    return model


def scorer(model: Model):
    """An Arrow UDF from text to score."""
    held = (model.index, model.weight, model.bias, model.bits)

    @F.arrow_udf("double")
    def toxicity(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index, weight, bias, bits = held
        dense = Model(index, weight, bias, bits).dense()
        for column in columns:
            yield pa.array(score_batch(column, dense, bias, bits), pa.float64())

    return toxicity


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "toxicity_score") -> DataFrame:
    """``docs`` with a score from 0 to 1 in the new column ``into``."""
    return docs.withColumn(into, scorer(model)(F.col(text).cast("string")))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows that score under the threshold, with the columns they came with."""
    into = _free_name(docs, "toxicity_score")
    return score(docs, model, into=into).filter(F.col(into) < threshold).drop(into)


def _free_name(df: DataFrame, name: str) -> str:
    while name.lower() in {c.lower() for c in df.columns}:
        name = "_" + name
    return name
