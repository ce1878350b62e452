"""Quality rules: counted base rules, then a calibrated n-gram classifier with fixed thresholds.

Base counts take words as runs without ASCII white space. The classifier is a logistic regression
over hashed word unigrams, word pairs and character trigrams (relative frequencies of each kind),
trained on labelled rows, calibrated by Platt's method on labelled rows that training didn't use, and
scored in Arrow batches.

Defined cases: a null or empty text has no words and fails the base rules; a repeated row gets the
same result; other columns pass through, but for one named as ``judge`` is told to name its own, which
it replaces; without labels of both kinds the classifier accepts every row, so that the base rules
alone decide; of labelled rows with one id only the least text is learnt.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm import textbatch as tb

BITS = 18
#: Bounds of the training sample: rows, and characters of a row that may enter it.
TRAIN_ROWS = 6_000
TRAIN_CHARS = 20_000
#: Training works on so many bytes at a time.
SLICE_BYTES = 1 << 18
#: A row is kept if its calibrated probability of label 1 is at least this.
THRESHOLD = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = b" \t\n\r\x0b\f"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULT = ", ".join(f"{c}: bigint" for c in COUNTS) + ", base_failed: boolean, kept: boolean, quality: double"


def count_dup_lines(text: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(_SPACE)]
    return len(lines) - len(set(lines))


def count_repeat_words(text: bytes) -> int:
    """Words inside a window of five that the text has twice or more."""
    words = text.split()
    windows = list(zip(*(words[k:] for k in range(WINDOW)), strict=False))
    seen = Counter(windows)
    marked = np.zeros(len(words) + 1, dtype=np.int64)
    for i, window in enumerate(windows):
        if seen[window] > 1:
            marked[i] += 1
            marked[min(i + WINDOW, len(words))] -= 1
    return int(np.count_nonzero(np.cumsum(marked[: len(words)])))


def _repeating(words: tb.Words) -> np.ndarray:
    """Numbers of texts in which two windows of five words have one hash; only they can repeat one."""
    first, hashes = words.windows(*range(WINDOW))
    texts = words.texts[first]
    with np.errstate(over="ignore"):
        keys = hashes ^ ((texts.astype(np.uint64) + np.uint64(1)) * tb.PRIME)
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(0, np.int64)
    place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return np.unique(texts[twice[place] == keys])


def base_counts(data: np.ndarray, offsets: np.ndarray, words: tb.Words) -> np.ndarray:
    """A row of COUNTS for each text of a slice."""
    n = len(offsets) - 1
    out = np.zeros((n, len(COUNTS)), dtype=np.int64)
    out[:, 0] = np.bincount(words.texts, minlength=n)
    for column, table in ((1, tb.LEADS & tb.NONWHITE), (2, _SYMBOL)):
        sums = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
        out[:, column] = sums[offsets[1:]] - sums[offsets[:-1]]
    breaks = np.searchsorted(np.flatnonzero(data == 10), offsets)
    for i in np.flatnonzero(np.diff(breaks)):
        out[i, 3] = count_dup_lines(data[offsets[i] : offsets[i + 1]].tobytes())
    for i in _repeating(words):
        out[i, 4] = count_repeat_words(data[offsets[i] : offsets[i + 1]].tobytes())
    return out


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])


def _grams(data: np.ndarray, offsets: np.ndarray, bits: int) -> np.ndarray:
    """Feature number of the character trigram at each byte; -1 where the text ends before its third byte."""
    if len(data) < 3:
        return np.full(len(data), -1, dtype=np.int32)
    wide = data.astype(np.uint32)
    code = np.empty(len(data), dtype=np.uint32)
    code[:-2] = wide[:-2] | (wide[1:-1] << 8) | (wide[2:] << 16)
    code *= np.uint32(2654435761)
    code >>= np.uint32(32 - bits)
    out = code.astype(np.int32)
    ends = offsets[1:]
    for back in (1, 2):
        at = ends - back
        out[at[at >= offsets[:-1]]] = -1
    return out


@dataclass(frozen=True)
class Model:
    """Weights of word, word pair and character features, bias, and the calibration's slope and shift."""

    word: np.ndarray
    pair: np.ndarray
    char: np.ndarray
    bias: float
    slope: float
    shift: float
    bits: int = BITS

    def margins(self, data: np.ndarray, offsets: np.ndarray, words: tb.Words) -> np.ndarray:
        n = len(offsets) - 1
        grams = _grams(data, offsets, self.bits)
        sums = np.concatenate([[0.0], np.cumsum(np.append(self.char, np.float32(0))[grams], dtype=np.float64)])
        chars = (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(np.diff(offsets) - 2, 1)
        first, pairs = words.windows(0, 1)
        total = self.bias + chars
        for weights, hashes, texts in ((self.word, words.hashes, words.texts), (self.pair, pairs, words.texts[first])):
            found = tb.per_text(weights[tb.bucket(hashes, self.bits)], texts, n)
            total += found / np.maximum(np.bincount(texts, minlength=n), 1)
        return total

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -35, 35)))


def accept_all(bits: int = BITS) -> Model:
    zero = np.zeros(1 << bits, np.float32)
    return Model(zero, zero, zero, 0.0, 0.0, 5.0, bits)


def fit(texts: list[str] | pa.Array | pa.ChunkedArray, labels: list[int], bits: int = BITS, passes: int = 6) -> Model:
    """Logistic regression by Adagrad on four fifths of the rows, calibrated on the rest."""
    if len(set(labels)) < 2 or len(labels) < 20:
        return accept_all(bits)
    data, offsets = tb.utf8(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts)
    n, rows = 1 << bits, []
    for _, part, marks in tb.slices(data, offsets, SLICE_BYTES):
        words, grams = tb.Words(part, marks), _grams(part, marks, bits)
        first, pairs = words.windows(0, 1)
        features, values = [], []
        kinds = [(tb.bucket(words.hashes, bits), words.texts), (tb.bucket(pairs, bits), words.texts[first])]
        at = [np.searchsorted(texts, np.arange(len(marks))) for _, texts in kinds]
        for i in range(len(marks) - 1):
            own = grams[marks[i] : marks[i + 1]]
            found = [*(_frequencies(f[a[i] : a[i + 1]]) for (f, _), a in zip(kinds, at, strict=True)), _frequencies(own[own >= 0])]
            features.append(np.concatenate([f + k * n for k, (f, _) in enumerate(found)]))
            values.append(np.concatenate([v for _, v in found]))
        cuts = np.cumsum([len(x) for x in features])[:-1]  # one array a slice, as small ones would leave the driver's memory in pieces
        rows += zip(np.split(np.concatenate(features), cuts), np.split(np.concatenate(values), cuts), strict=True)
    del data, offsets, texts
    y = np.array(labels, dtype=float)
    w, g2, bias = np.zeros(3 * n), np.full(3 * n, 1e-6), 0.0
    order = np.random.default_rng(7).permutation(len(y))
    learn, rest = order[len(y) // 5 :], order[: len(y) // 5]
    for turn in range(passes):
        rate = 2.0 / (1 + turn)
        for i in learn:
            at, x = rows[i]
            g = 1 / (1 + np.exp(-np.clip(w[at] @ x + bias, -35, 35))) - y[i]
            step = g * x + 1e-6 * w[at]
            g2[at] += step * step
            w[at] -= rate * step / np.sqrt(g2[at])
            bias -= 0.02 * rate * g
    margin = np.array([w[at] @ x + bias for at, x in (rows[i] for i in rest)])
    slope, shift = platt(margin, y[rest])
    word, pair, char = w.astype(np.float32).reshape(3, n)
    return Model(word, pair, char, float(bias), slope, shift, bits)


def _frequencies(feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, times = np.unique(feature, return_counts=True)
    return at.astype(np.int32), (times / max(1, times.sum())).astype(np.float32)


def platt(margin: np.ndarray, y: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """Slope and shift of the logistic curve through (margin, label), by Newton steps with smoothed targets."""
    up, down = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35)))
        d, v = p - target, np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(v * margin * margin).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-3]])
        da, db = np.linalg.solve(h, [(d * margin).sum(), d.sum()])
        size = max(1.0, abs(da), abs(db))
        a, b = a - da / size, b - db / size
        if abs(da) + abs(db) < 1e-9:
            break
    return float(max(a, 0.0)), float(b)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fits on at most ``rows`` labelled rows, each of at most TRAIN_CHARS characters.

    The sample is the ids with the smallest hashes, one row for each; only it reaches the driver. A
    document with several labels counts as good only if all say so.
    """
    marked = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .withColumn("turn", F.xxhash64("doc_id"))
        .orderBy("turn", "doc_id").limit(rows)
    )
    texts = docs.select("doc_id", "text").filter(F.length("text") <= TRAIN_CHARS)
    got = (
        texts.join(F.broadcast(marked), "doc_id").groupBy("turn", "doc_id", "quality").agg(F.min("text").alias("text"))
        .orderBy("turn", "doc_id").limit(rows).toArrow()
    )
    model = fit(got["text"], [int(x > 0) for x in got["quality"].to_pylist()])
    del got
    tb.give_back()
    return model


def judge_batch(column: pa.Array, model: Model, threshold: float) -> pa.StructArray:
    """The columns of RESULT for a batch of texts."""
    data, offsets = tb.utf8(column)
    n = len(offsets) - 1
    counts, p = np.zeros((n, len(COUNTS)), np.int64), np.zeros(n)
    for first, part, marks in tb.slices(data, offsets):
        words = tb.Words(part, marks)
        rows = slice(first, first + len(marks) - 1)
        counts[rows] = base_counts(part, marks, words)
        p[rows] = model.probability(model.margins(part, marks, words))
    failed = base_failed(counts)
    columns = [*(pa.array(counts[:, k]) for k in range(len(COUNTS))), pa.array(failed), pa.array(~failed & (p >= threshold)), pa.array(p)]
    return pa.StructArray.from_arrays(columns, [x.split(":")[0] for x in RESULT.split(", ")])


def judge(docs: DataFrame, model: Model, threshold: float = THRESHOLD, into: str = "quality_rules") -> DataFrame:
    """``docs`` with a struct of the counts, the probability and the verdict in the new column ``into``."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # three arrays of 2**BITS numbers, whatever the corpus

    @F.arrow_udf(f"struct<{RESULT}>")
    def rules(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield judge_batch(column, held.value, threshold)

    return docs.withColumn(into, rules(F.col("text").cast("string")))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows that the rules keep, with the columns they came with."""
    into = "quality_rules"
    while into in {c.lower() for c in docs.columns}:
        into = "_" + into
    return judge(docs, model, threshold, into).filter(F.col(into)["kept"]).drop(into)
