"""Media columns: payloads as progressive JPEG coefficients, and RGB tensors from any progressive JPEG.

``decode_many`` reads baseline-precision progressive JPEG files: it accumulates spectral-selection and
successive-approximation scans (DC and AC, first and refining, end-of-band runs, restarts) into
coefficient arrays. In first scans the place of a symbol depends on lengths alone: numpy looks up the
length at every bit of many segments at once, hops from symbol to symbol in all of them together, and
turns the symbols into coefficients. Refining AC scans are read symbol by symbol. ``tensor`` dequantises,
inverse-transforms in numpy, repeats chroma and converts to an (height, width, 3) array of bytes.

``encode_many`` stores bytes losslessly as coefficients, the format's own unit: 64 bytes a block in
zigzag order, a byte's coefficient being its distance from CENTRE, blocks dealt to Y, Cb and Cr (4:2:0)
and padded to whole units with zero coefficients. The scans of SCRIPT select bands and approximate in
two steps; Huffman tables cover every symbol; scans of over RESTART units are cut by restart markers, so
that neither side ever holds more than a group of segments in its working arrays. A comment segment
holds the payload's length.

Defined cases: a null or empty text is 64 zero bytes; equal texts give equal files and features; a media
cell that is null, cut off, damaged or no progressive JPEG file gives a null struct, and so does a foreign
file of over MOST_PIXELS, which a few bytes can declare; other columns pass through, but for one with the name of the
new column, which is replaced. A text of any length is one image and is read back whole: its sides reach 65,520 pixels at
6.4 GB, and a cell holds 2 GB at most. A file is known as one of these by its comment and the sides that follow from it.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import zlib
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import lru_cache
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from sievework.llm.textbatch import struct

UNIT = 64
#: The byte whose coefficient is zero, amid the small letters.
CENTRE = 105
#: Units of a restart interval, and blocks or bytes of segments that are worked on together.
RESTART, GROUP_BLOCKS, GROUP_BYTES = 128, 8192, 1 << 21
#: Segments that are read together; fewer are read one by one.
ABREAST = 24
MOST_PIXELS = 1 << 28
#: The scans of a stored file: components, first and last coefficient, bits sent before, bits left for later.
SCRIPT = (
    ((0, 1, 2), 0, 0, 0, 1), ((0,), 1, 5, 0, 0), ((1,), 1, 5, 0, 1), ((2,), 1, 63, 0, 0),
    ((0,), 6, 63, 0, 0), ((1,), 6, 63, 0, 0), ((0, 1, 2), 0, 0, 1, 0), ((1,), 1, 5, 1, 0),
)
RESULT = "payload_bytes: bigint, payload_sha256: string, tail_crc32: bigint, media_bytes: bigint, media_sha256: string, feature: string"


@lru_cache(maxsize=1)
def zigzag() -> np.ndarray:
    """Place in a row-major block of the k-th coefficient of the scan order."""
    cells = [(r + c, r if (r + c) % 2 else c, 8 * r + c) for r in range(8) for c in range(8)]
    return np.array([x[2] for x in sorted(cells)])


@lru_cache(maxsize=1)
def basis() -> np.ndarray:
    """Row u: the u-th cosine of the orthonormal transform of eight samples."""
    u, x = np.arange(8)[:, None], np.arange(8)[None, :]
    return (np.cos((2 * x + 1) * u * math.pi / 16) * np.where(u == 0, math.sqrt(1 / 8), 0.5)).astype(np.float32)


# Huffman tables ------------------------------------------------------------------------------------


def code_lengths(weights: dict[int, float]) -> dict[int, list[int]]:
    """Symbols by code length, by Huffman's algorithm. One more leaf of the least weight takes the code of ones only."""
    floor = sum(weights.values()) / (1 << 14)
    heap = [(max(w, floor), k, [s]) for k, (s, w) in enumerate(weights.items())]
    heap.append((floor / 2, len(heap), [-1]))
    heapq.heapify(heap)
    depth = dict.fromkeys([*weights, -1], 0)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        for s in a[2] + b[2]:
            depth[s] += 1
        heapq.heappush(heap, (a[0] + b[0], a[1], a[2] + b[2]))
    out: dict[int, list[int]] = {}
    for s in sorted(weights, key=lambda s: (depth[s], s)):
        out.setdefault(depth[s], []).append(s)
    return out


#: Shares of coefficient sizes in letters, spaces and marks, about CENTRE.
_SHARES = {1: 5, 2: 7, 3: 32, 4: 29, 5: 2, 6: 3, 7: 17, 8: 1}


@lru_cache(maxsize=1)
def tables() -> dict[int, dict[int, list[int]]]:
    """Symbols by code length of DC table 0 and of the AC tables of first (0) and of refining scans (1), by class and number."""
    runs = {n << 4: 0.5 / (1 + n) for n in range(15)} | {0xF0: 0.01}
    first = {run << 4 | size: share * 0.06**run for run in range(16) for size, share in _SHARES.items()}
    refine = {run << 4 | 1: 8 * 0.5**run for run in range(16)}
    return {0x00: code_lengths({n: 1 / (1 + abs(n - 5)) for n in range(12)}), 0x10: code_lengths(first | runs), 0x11: code_lengths(refine | {k: 8 * v for k, v in runs.items()})}


@dataclass(eq=False)
class _Huffman:
    """By the 16 bits ahead: code length (0: no code), symbol, and bits up to the next symbol of a first scan (0: no code).
    By symbol: the code and its length."""

    length: np.ndarray
    symbol: np.ndarray
    step: np.ndarray
    code: np.ndarray
    bits: np.ndarray


@lru_cache(maxsize=64)
def _huffman(counts: bytes, symbols: bytes, dc: bool) -> _Huffman:
    length, symbol = np.zeros(65536, np.uint8), np.zeros(65536, np.uint8)
    codes, bits = np.zeros(256, np.uint64), np.zeros(256, np.int64)
    code = at = 0
    for n, count in enumerate(counts, 1):
        for s in symbols[at : at + count]:
            span = slice(code << (16 - n), (code + 1) << (16 - n))
            length[span], symbol[span] = n, s
            codes[s], bits[s] = code, n
            code += 1
        at += count
        code <<= 1
    low, high = symbol & 15, symbol >> 4
    extra = symbol if dc else np.where(low > 0, low, np.where(high < 15, high, 0))
    step = np.where(length > 0, length + extra, 0).astype(np.uint8)
    return _Huffman(length, symbol, step, codes, bits)


def _counts(lengths: dict[int, list[int]]) -> tuple[bytes, bytes]:
    return bytes(len(lengths.get(n, [])) for n in range(1, 17)), bytes(s for n in sorted(lengths) for s in lengths[n])


def _own(key: int) -> _Huffman:
    return _huffman(*_counts(tables()[key]), key < 0x10)


# Writing -------------------------------------------------------------------------------------------


def _segment(marker: int, body: bytes) -> bytes:
    return bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body


def _table(kind: int, number: int, lengths: dict[int, list[int]]) -> bytes:
    return bytes([kind << 4 | number]) + b"".join(_counts(lengths))


_QUANT = _segment(0xDB, b"\0" + b"\1" * 64)


def sides(blocks: int) -> tuple[int, int]:
    """Units across and down of a file with so many blocks of payload."""
    units = -(-blocks // 6)
    wide = math.isqrt(units - 1) + 1
    return wide, -(-units // wide)


@lru_cache(maxsize=1024)
def _order(wide: int, high: int, components: tuple[int, ...]) -> np.ndarray:
    """Blocks of each unit of a scan, in rows."""
    room = wide * high
    if len(components) == 1:
        return (np.arange(4 * room) if components[0] == 0 else np.arange(room) + (3 + components[0]) * room).reshape(-1, 1)
    rest = np.arange(room).reshape(-1, 1)
    return np.concatenate([_grid(high, 2, wide, 2), 4 * room + rest, 5 * room + rest], axis=1)


_SIZE = np.array([n.bit_length() for n in range(1 << 11)])


def _pack(code: np.ndarray, bits: np.ndarray, owner: np.ndarray, n: int) -> list[bytes]:
    """The codes of each of n owners, in order, as bytes filled up with ones."""
    total = np.bincount(owner, weights=bits, minlength=n).astype(np.int64)
    size = (total + 7) >> 3
    start = np.concatenate([[0], np.cumsum(size)])
    at = np.cumsum(bits) - bits
    at += (8 * start[:-1] - (np.cumsum(total) - total))[owner]
    word, spare = at >> 6, 64 - (at & 63) - bits
    code = code.astype(np.uint64)
    first = code << np.maximum(spare, 0).astype(np.uint64) >> np.maximum(-spare, 0).astype(np.uint64)
    words = np.zeros((int(start[-1]) >> 3) + 2, np.uint64)
    if len(word):
        begins = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[begins]] = np.bitwise_or.reduceat(first, begins)
        split = np.flatnonzero(spare < 0)
        words[word[split] + 1] |= code[split] << (64 + spare[split]).astype(np.uint64)
    out = words.astype(">u8").view(np.uint8)
    filled = np.flatnonzero(size)
    out[start[1:][filled] - 1] |= ((1 << (-total[filled] % 8)) - 1).astype(np.uint8)
    whole = out.tobytes()
    return [whole[a:b] for a, b in zip(start[:-1].tolist(), start[1:].tolist(), strict=True)]


def _coded(value: np.ndarray, run: np.ndarray | int, table: _Huffman) -> tuple[np.ndarray, np.ndarray]:
    """Codes, and their lengths, of a run and a signed value each."""
    size = _SIZE[np.abs(value)]
    extra = np.where(value < 0, value + (1 << size) - 1, value)
    symbol = run << 4 | size if not isinstance(run, int) else size
    return table.code[symbol] << size.astype(np.uint64) | extra.astype(np.uint64), table.bits[symbol] + size


def _dc_tokens(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of the differences of interleaved values: a row for each unit of four of Y, Cb and Cr."""
    fresh = np.flatnonzero(np.diff(owner, prepend=-1))
    diff = np.empty(values.shape, np.int64)
    for part in (slice(0, 4), slice(4, 5), slice(5, 6)):
        flat = values[:, part].astype(np.int64)
        step = np.diff(flat.ravel(), prepend=0).reshape(flat.shape)
        step[fresh, 0] = flat[fresh, 0]
        diff[:, part] = step
    code, bits = _coded(diff.ravel(), 0, _own(0x00))
    return code, bits, np.repeat(owner, values.shape[1])


def _ac_tokens(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of the first scan of a band."""
    table, (n, wide) = _own(0x10), values.shape
    flat = values.ravel()
    place = np.flatnonzero(flat)
    row = place // wide
    run = place - np.maximum(np.concatenate([[0], place[:-1] + 1]), row * wide)
    code, bits = _coded(flat[place].astype(np.int64), run & 15, table)
    key, who = place + row, owner[row]  # a block has one place more, for the end of its band
    last = np.full(n, -1)
    last[row] = place - row * wide
    ends = last < wide - 1
    goes_on = np.zeros(n, bool)
    goes_on[1:] = (last[1:] < 0) & ends[:-1] & (owner[1:] == owner[:-1])
    begins = np.flatnonzero(~goes_on)
    length = np.diff(np.append(begins, n))[ends[begins]]
    begins = begins[ends[begins]]
    parts = -(-length // 32767)
    begins, rest = np.repeat(begins, parts), np.repeat(length, parts)
    rest = np.minimum(rest - 32767 * (np.arange(len(rest)) - np.repeat(np.cumsum(parts) - parts, parts)), 32767)
    more = (np.frexp(rest)[1] - 1).astype(np.int64)
    eob = table.code[more << 4] << more.astype(np.uint64) | (rest - (1 << more)).astype(np.uint64)
    skips = np.repeat(np.arange(len(place)), run >> 4)
    at = np.concatenate([np.searchsorted(key, begins * (wide + 1) + wide), skips])  # the end of a band comes before zeros of the next
    return (
        np.insert(code, at, np.concatenate([eob, np.full(len(skips), table.code[0xF0])])),
        np.insert(bits, at, np.concatenate([table.bits[more << 4] + more, np.full(len(skips), table.bits[0xF0])])),
        np.insert(who, at, np.concatenate([owner[begins], who[skips]])),
    )


def _refining_tokens(values: np.ndarray, owner: np.ndarray, left: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of a refining scan of a band: new coefficients, and correction bits of those known before."""
    table = _own(0x11)
    codes, lengths = table.code.tolist(), table.bits.tolist()
    out: list[tuple[int, int, int]] = []
    run, held, who = 0, [], -1

    def end_band() -> None:
        nonlocal run
        if run:
            n = run.bit_length() - 1
            out.append((codes[n << 4] << n | run - (1 << n), lengths[n << 4] + n, who))
            out.extend((b, 1, who) for b in held)
            held.clear()
            run = 0

    size = (np.abs(values) >> left).tolist()
    for row, signs, mine in zip(size, (values > 0).tolist(), owner.tolist(), strict=True):
        if mine != who:
            end_band()
            who = mine
        last = max((k for k, v in enumerate(row) if v == 1), default=-1)
        zeros, bits = 0, []
        for k, v in enumerate(row[: last + 1]):
            if v == 0:
                zeros += 1
                continue
            while zeros > 15:
                end_band()
                out.append((codes[0xF0], lengths[0xF0], who))
                out.extend((b, 1, who) for b in bits)
                zeros, bits = zeros - 16, []
            if v > 1:
                bits.append(v & 1)
                continue
            end_band()
            symbol = zeros << 4 | 1
            out.append((codes[symbol] << 1 | signs[k], lengths[symbol] + 1, who))
            out.extend((b, 1, who) for b in bits)
            zeros, bits = 0, []
        if last < len(row) - 1:
            run += 1
            held += [v & 1 for v in row[last + 1 :] if v > 1]
            if run == 32767 or len(held) > 900:
                end_band()
    end_band()
    table_ = np.array(out, np.int64).reshape(-1, 3)
    return table_[:, 0], table_[:, 1], table_[:, 2]


def _coded_segments(coefficients: np.ndarray, scan: tuple, segments: list[np.ndarray]) -> list[bytes]:
    """The entropy-coded bytes of segments, each a table of blocks by unit."""
    _, low, high, before, left = scan
    rows = np.concatenate(segments)
    owner = np.repeat(np.arange(len(segments)), [len(x) for x in segments])
    if low == 0:
        values = coefficients[rows, 0]
        if before:
            return _pack((values >> left & 1).ravel(), np.ones(values.size, np.int64), np.repeat(owner, values.shape[1]), len(segments))
        return _pack(*_dc_tokens(values >> left, owner), len(segments))
    values = coefficients[rows[:, 0], low : high + 1]
    if before:
        return _pack(*_refining_tokens(values, owner, left), len(segments))
    if left:
        values = np.sign(values) * (np.abs(values) >> left)
    return _pack(*_ac_tokens(values, owner), len(segments))


def _grouped(items: list, weights: Iterable[int], limit: int) -> Iterator[list]:
    """Runs of items of about ``limit`` weight."""
    held, size = [], 0
    for item, weight in zip(items, weights, strict=True):
        if held and size + weight > limit:
            yield held
            held, size = [], 0
        held.append(item)
        size += weight
    if held:
        yield held


def encode_many(payloads: list[tuple[bytes, int]]) -> list[bytes]:
    """A progressive JPEG file for each (payload, unpadded length); a payload's length is a positive multiple of 64."""
    shapes, total = [], 0
    for payload, _ in payloads:
        wide, high = sides(len(payload) // UNIT)
        shapes.append((total, wide, high))
        total += 6 * wide * high
    coefficients = np.zeros((total, UNIT), np.int16)
    files = []
    dht = _segment(0xC4, b"".join(_table(key >> 4, key & 15, lengths) for key, lengths in tables().items()))
    for (payload, n), (at, wide, high) in zip(payloads, shapes, strict=True):
        np.subtract(np.frombuffer(payload, np.uint8).reshape(-1, UNIT), CENTRE, out=coefficients[at : at + len(payload) // UNIT], dtype=np.int16)
        frame = bytes([8]) + (16 * high).to_bytes(2, "big") + (16 * wide).to_bytes(2, "big") + bytes([3, 1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
        start = [b"\xff\xd8", _segment(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0"), _segment(0xFE, b"payload %d of %d" % (n, len(payload))), _QUANT, _segment(0xC2, frame), dht]
        files.append([*start, _segment(0xDD, RESTART.to_bytes(2, "big"))])
    for scan in SCRIPT:
        components, low, high_, before, left = scan
        ac = 1 if before else 0
        body = bytes([len(components)]) + b"".join(bytes([c + 1, ac]) for c in components) + bytes([low, high_, before << 4 | left])
        segments, whose = [], []
        for k, (at, wide, high) in enumerate(shapes):
            order = _order(wide, high, components)
            for i in range(0, len(order), RESTART):
                segments.append(order[i : i + RESTART] + at)
                whose.append((k, i // RESTART))
        at = 0
        for group in _grouped(segments, (x.size for x in segments), GROUP_BLOCKS):
            for data in _coded_segments(coefficients, scan, group):
                k, turn = whose[at]
                files[k] += [bytes([0xFF, 0xD0 + (turn - 1) % 8]) if turn else _segment(0xDA, body), data.replace(b"\xff", b"\xff\x00")]
                at += 1
    return [b"".join([*parts, b"\xff\xd9"]) for parts in files]


def encode(payload: bytes, n_bytes: int) -> bytes:
    return encode_many([(payload, n_bytes)])[0]


# Reading -------------------------------------------------------------------------------------------


@dataclass
class Image:
    """Coefficients (blocks in rows, zigzag order) of each component, and what a reader needs of the frame."""

    height: int
    width: int
    components: list[dict] = field(default_factory=list)
    comment: bytes = b""
    quant: dict[int, np.ndarray] = field(default_factory=dict)
    shape: tuple = ()


@dataclass(eq=False)
class _Job:
    """One restart segment of a scan: the file's number, blocks by unit, band, bits, tables, and its bytes without stuffing."""

    file: int
    rows: np.ndarray
    slots: list[int]  # the component of each column of ``rows``
    band: tuple[int, int]
    before: int
    left: int
    tables: list[_Huffman | None]
    raw: bytes


def parse(data: bytes) -> tuple[Image, list]:
    """The frame of a progressive JPEG file, and its scans as (components and tables, band, bits, segments' bytes)."""
    image, held, interval, at = None, {}, 0, 2
    comment, quant, scans = b"", {}, []
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG file")
    while True:
        at = data.index(b"\xff", at)
        marker = data[at + 1]
        if marker in (0xFF, 0x00) or 0xD0 <= marker <= 0xD8:
            at += 1 if marker == 0xFF else 2
            continue
        if marker == 0xD9:
            break
        size = int.from_bytes(data[at + 2 : at + 4], "big")
        body, at = data[at + 4 : at + 2 + size], at + 2 + size
        if marker == 0xFE:
            comment = body
        elif marker == 0xDB:
            while body:
                wide = 2 if body[0] >> 4 else 1
                quant[body[0] & 15] = np.frombuffer(body[1 : 1 + 64 * wide], ">u2" if wide == 2 else np.uint8).astype(np.int32)
                body = body[1 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                held[body[0]] = _huffman(body[1:17], body[17 : 17 + n], body[0] < 0x10)
                body = body[17 + n :]
        elif marker == 0xDD:
            interval = int.from_bytes(body, "big")
        elif marker == 0xC2:
            image = _frame(body, comment)
        elif 0xC0 <= marker <= 0xCF:
            raise ValueError("not a progressive JPEG file")
        elif marker == 0xDA:
            end = at
            while data[(end := data.index(b"\xff", end)) + 1] == 0 or 0xD0 <= data[end + 1] <= 0xD7:
                end += 2
            scans.append((body, dict(held), interval, data[at:end]))
            at = end
    image.comment, image.quant = comment, quant
    image.shape = tuple((c["id"], c["rows"], c["columns"], c["v"], c["h"], *c["own"]) for c in image.components)
    return image, scans


def _is_own(comment: bytes, width: int, height: int) -> bool:
    """True if the comment states a payload whose file has these sides and that a cell can hold."""
    stated = re.fullmatch(rb"payload (\d{1,10}) of (\d{1,10})", comment)
    if not stated or not int(stated[1]) <= int(stated[2]) < 1 << 31 or int(stated[2]) < UNIT or int(stated[2]) % UNIT:
        return False
    return (width, height) == tuple(16 * x for x in sides(int(stated[2]) // UNIT))


def _frame(body: bytes, comment: bytes = b"") -> Image:
    image = Image(int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big"))
    if not 0 < image.width * image.height <= MOST_PIXELS and not _is_own(comment, image.width, image.height):
        raise ValueError("an image of no size, or of too many pixels")
    most = [max(body[7 + 3 * i] >> s & 15 for i in range(body[5])) for s in (4, 0)]
    units = [-(-image.width // (8 * most[0])), -(-image.height // (8 * most[1]))]
    for i in range(body[5]):
        number, sampling, table = body[6 + 3 * i : 9 + 3 * i]
        h, v = sampling >> 4, sampling & 15
        own = [-(-(-(-n * f // m)) // 8) for n, f, m in ((image.width, h, most[0]), (image.height, v, most[1]))]
        image.components.append({"id": number, "h": h, "v": v, "table": table, "rows": units[1] * v, "columns": units[0] * h, "own": own, "units": units, "most": most})
    return image


def _jobs(file: int, image: Image, scan: tuple, first: int) -> list[_Job]:
    """The restart segments of a scan; ``first`` is the image's first block."""
    header, held, interval, raw = scan
    rows, slots, keys, band, before, left = _scan_of(image.shape, header)
    rows, use = rows + np.int32(first), [held.get(k) for k in keys]
    if not interval or interval >= len(rows):
        return [_Job(file, rows, slots, band, before, left, use, raw.replace(b"\xff\x00", b"\xff"))]
    pieces = _restarts(raw)
    if len(pieces) != -(-len(rows) // interval):
        raise ValueError("a scan without all of its segments")
    return [_Job(file, rows[k * interval : (k + 1) * interval], slots, band, before, left, use, x.replace(b"\xff\x00", b"\xff")) for k, x in enumerate(pieces)]


@lru_cache(maxsize=4096)
def _scan_of(shape: tuple, header: bytes) -> tuple[np.ndarray, list[int], list[int], tuple[int, int], int, int]:
    """Blocks of each unit of a scan, the component and the table of each column, the band, and bits before and left."""
    n = header[0]
    numbers = [next(k for k, c in enumerate(shape) if c[0] == header[1 + 2 * i]) for i in range(n)]
    low, high, bits = header[1 + 2 * n : 4 + 2 * n]
    firsts = np.cumsum([0, *(c[1] * c[2] for c in shape)]).tolist()
    parts, slots, keys = [], [], []
    for i, k in enumerate(numbers):
        _, rows, columns, v, h, wide, tall = shape[k]
        whole = np.arange(rows * columns, dtype=np.int32).reshape(rows, columns)[:tall, :wide].reshape(-1, 1)
        parts.append((whole if n == 1 else _grid(rows // v, v, columns // h, h)) + np.int32(firsts[k]))
        slots += [k] * parts[-1].shape[1]
        keys += [header[2 + 2 * i] >> 4 if low == 0 else 0x10 | header[2 + 2 * i] & 15] * parts[-1].shape[1]
    return np.concatenate(parts, axis=1), slots, keys, (low, high), bits >> 4, bits & 15


@lru_cache(maxsize=512)
def _grid(rows: int, v: int, columns: int, h: int) -> np.ndarray:
    """Block numbers of a component in each interleaved unit."""
    return np.arange(rows * v * columns * h, dtype=np.int32).reshape(rows, v, columns, h).transpose(0, 2, 1, 3).reshape(-1, v * h)


def _restarts(raw: bytes) -> list[bytes]:
    out, start, at = [], 0, 0
    while (at := raw.find(b"\xff", at)) >= 0:
        if 0xD0 <= raw[at + 1] <= 0xD7:
            out.append(raw[start:at])
            start = at + 2
        at += 2
    return [*out, raw[start:]]


def decode_many(files: list[bytes | None]) -> list[Image | ValueError]:
    """The coefficient arrays of each progressive JPEG file, or what is wrong with it. Scans of many files are read together."""
    found: list = []
    scans: list[list] = []
    firsts: list[int] = []
    total = 0
    for data in files:
        try:
            image, own = parse(data or b"")
            blocks = sum(c["rows"] * c["columns"] for c in image.components)
            found.append(image)
            firsts.append(total)
            scans.append(own)
            total += blocks
        except (ValueError, IndexError, AttributeError, ZeroDivisionError) as error:
            found.append(ValueError(f"unreadable: {error}"))
            firsts.append(total)
            scans.append([])
    coefficients = np.zeros((total, 64), np.int16)
    # First scans meet no coefficient twice, so they are read together; refining ones follow in their order.
    for turn in range(-1, max(map(len, scans), default=0)):
        kinds: dict[tuple, list[_Job]] = defaultdict(list)
        for k, own in enumerate(scans):
            if isinstance(found[k], ValueError):
                continue
            try:
                for scan in own if turn < 0 else own[turn : turn + 1]:
                    refining = scan[0][-1] >> 4 > 0
                    if refining == (turn < 0):
                        continue
                    for job in _jobs(k, found[k], scan, firsts[k]):
                        dc = job.band[0] == 0
                        if not (dc and refining) and any(t is None for t in job.tables):
                            raise ValueError("a scan without its tables")
                        kinds[(dc, refining, tuple(map(id, job.tables if dc and not refining else job.tables[:1])))].append(job)
            except (ValueError, IndexError, StopIteration) as error:
                found[k] = ValueError(f"unreadable: {error}")
        for (dc, refining, _), jobs in kinds.items():
            for group in _grouped(jobs, (len(j.raw) for j in jobs), GROUP_BYTES):
                if dc:
                    bad = _refine_dc(coefficients, group) if refining else _first_dc(coefficients, group)
                else:
                    bad = _refine_ac(coefficients, group) if refining else _first_ac(coefficients, group)
                for k in bad:
                    found[k] = ValueError("unreadable: a damaged or cut-off scan")
    for image, at in zip(found, firsts, strict=True):
        if isinstance(image, Image):
            for c in image.components:
                c["data"] = coefficients[at : at + c["rows"] * c["columns"]]
                at += len(c["data"])
    return found


def decode(data: bytes) -> Image:
    found = decode_many([data])[0]
    if isinstance(found, ValueError):
        raise found
    return found


class _Ahead:
    """The bits of many segments, each followed by ones: what lies ahead of any bit."""

    def __init__(self, raws: list[bytes]) -> None:
        sizes = np.array([len(x) for x in raws])
        starts = np.cumsum(sizes + 8) - sizes - 8
        self.starts, self.ends = 8 * starts, 8 * (starts + sizes)
        data = np.frombuffer(b"".join(x + b"\xff" * 8 for x in raws), np.uint8).astype(np.uint32)
        self.words = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]

    def every(self, table: np.ndarray) -> np.ndarray:
        """A table's value for the 16 bits ahead of every bit."""
        out = np.empty((len(self.words), 8), np.uint8)
        for k in range(8):
            out[:, k] = table[self.words >> np.uint32(16 - k) & np.uint32(0xFFFF)]
        return out.ravel()

    def sixteen(self, at: np.ndarray) -> np.ndarray:
        return self.words[at >> 3] >> (16 - (at & 7)).astype(np.uint32) & np.uint32(0xFFFF)

    def take(self, at: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """The next ``bits`` bits (25 at most), as numbers."""
        word = self.words[np.minimum(at >> 3, len(self.words) - 1)].astype(np.int64)
        return (word >> (32 - (at & 7) - bits)).astype(np.int32) & (1 << bits) - 1

    def places(self, step: np.ndarray) -> np.ndarray:
        """Where each symbol of each segment begins, up to its end or to what is no code."""
        steps = self.every(step)
        for a, b in zip(self.ends.tolist(), [*self.starts[1:].tolist(), len(steps)], strict=True):
            steps[a:b] = 0
        out = []
        at = self.starts.astype(np.int32)
        while len(at := at[(at < len(steps))]) and len(at := at[steps[at] > 0]) >= ABREAST:
            for _ in range(32):
                out.append(at)
                at = at + steps[at]
        if len(at):
            plain = steps.tobytes()
            for place in at.tolist():
                mine = []
                while place < len(plain) and (step := plain[place]):
                    mine.append(place)
                    place += step
                out.append(np.array(mine, np.int32))
        if not out:
            return np.zeros(0, np.int32)
        found = np.concatenate(out)
        found = found[found < len(steps)]
        return np.sort(found[steps[found] > 0])


def _signed(value: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where(value < 1 << np.maximum(size, 1) - 1, value - (1 << size) + 1, value)


def _first_dc(coefficients: np.ndarray, jobs: list[_Job]) -> set[int]:
    bad: set[int] = set()
    ahead = _Ahead([j.raw for j in jobs])
    kinds = list(dict.fromkeys(jobs[0].tables))
    steps = [ahead.every(t.step).tobytes() for t in kinds]
    pattern = [kinds.index(t) for t in jobs[0].tables]
    places: list[int] = []
    good = []
    for job, at, end in zip(jobs, ahead.starts.tolist(), ahead.ends.tolist(), strict=True):
        mine = []
        for _ in range(len(job.rows)):
            for k in pattern:
                if at >= end or not steps[k][at]:
                    break
                mine.append(at)
                at += steps[k][at]
        if len(mine) < job.rows.size or at > end:
            bad.add(job.file)
            continue
        good.append(job)
        places += mine
    if not good:
        return bad
    at = np.array(places, np.int64)
    window = ahead.sixteen(at)
    length, size = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    which = np.resize(np.array(pattern), len(at))
    for k, t in enumerate(kinds):
        mine = which == k if len(kinds) > 1 else slice(None)
        length[mine], size[mine] = t.length[window[mine]], t.symbol[window[mine]]
    diff = _signed(ahead.take(at + length, size), size)
    start = 0
    for job in good:
        own = diff[start : start + job.rows.size].reshape(job.rows.shape)
        start += job.rows.size
        for c in dict.fromkeys(job.slots):
            a = job.slots.index(c)
            b = a + job.slots.count(c)
            coefficients[job.rows[:, a:b].ravel(), 0] = np.cumsum(own[:, a:b].ravel()) << job.left
    return bad


def _refine_dc(coefficients: np.ndarray, jobs: list[_Job]) -> set[int]:
    bad = set()
    for job in jobs:
        if 8 * len(job.raw) < job.rows.size:
            bad.add(job.file)
            continue
        bits = np.unpackbits(np.frombuffer(job.raw, np.uint8), count=job.rows.size)
        coefficients[job.rows.ravel(), 0] |= bits.astype(np.int16) << job.left
    return bad


def _first_ac(coefficients: np.ndarray, jobs: list[_Job]) -> set[int]:
    jobs = sorted(jobs, key=lambda j: (j.band, j.left))
    table = jobs[0].tables[0]
    ahead = _Ahead([j.raw for j in jobs])
    at = ahead.places(table.step)
    if not len(at):
        return {j.file for j in jobs}
    cuts = [*np.searchsorted(at, ahead.starts).tolist(), len(at)]
    window = ahead.sixteen(at)
    length, symbol = table.length[window], table.symbol[window]
    size, run = (symbol & 15).astype(np.int32), (symbol >> 4).astype(np.int32)
    ends = (size == 0) & (run < 15)
    bits = np.where(ends, run, size)
    value = ahead.take(at + length, bits)
    # How far each symbol moves on, counting coefficients of the band over all blocks; then what ends of bands add.
    moved = np.cumsum(np.where(ends, 0, run + 1), dtype=np.int32)
    stops = np.flatnonzero(ends)
    skipped = (1 << run[stops]) + value[stops]
    from_, shift, bad = [], [], set()
    of_stops = np.searchsorted(stops, cuts).tolist()
    known, stop_list, skip_list = moved[stops].tolist(), stops.tolist(), skipped.tolist()
    reached = [0, *moved[np.maximum(np.array(cuts[1:]) - 1, 0)].tolist()]
    base = 0  # rows of the jobs before
    for k, job in enumerate(jobs):
        wide = job.band[1] - job.band[0] + 1
        off = -reached[k] if cuts[k] else 0
        from_.append(cuts[k])
        shift.append(off + base * wide)
        for j in range(of_stops[k], of_stops[k + 1]):
            here = known[j] + off
            off += (here // wide + skip_list[j]) * wide - here
            from_.append(stop_list[j] + 1)
            shift.append(off + base * wide)
        final = reached[k + 1] + off if cuts[k + 1] > cuts[k] else 0
        if final != wide * len(job.rows):
            bad.add(job.file)
        base += len(job.rows)
    place = moved + np.repeat(np.array(shift, np.int32), np.diff([*from_, len(at)])) - 1
    kept = size > 0
    for k, job in enumerate(jobs):
        if job.file in bad:
            kept[cuts[k] : cuts[k + 1]] = False
    value = _signed(value, size)
    rows = np.concatenate([j.rows[:, 0] for j in jobs])
    flat, a = coefficients.reshape(-1), 0
    while a < len(jobs):  # runs of jobs of one band
        b, job = a, jobs[a]
        while b < len(jobs) and (jobs[b].band, jobs[b].left) == (job.band, job.left):
            b += 1
        mine = slice(cuts[a], cuts[b])
        some = kept[mine]
        block, k = np.divmod(place[mine][some], np.int32(job.band[1] - job.band[0] + 1))
        flat[64 * rows[block].astype(np.int64) + (k + job.band[0])] = value[mine][some] << job.left
        a = b
    return bad


def _refine_ac(coefficients: np.ndarray, jobs: list[_Job]) -> set[int]:
    table, bad = jobs[0].tables[0], set()
    ahead = _Ahead([j.raw for j in jobs])
    lengths, symbols = ahead.every(table.length).tobytes(), ahead.every(table.symbol).tobytes()
    bits = ((ahead.words[:, None] >> np.arange(31, 23, -1, dtype=np.uint32)) & 1).astype(np.uint8).tobytes()
    for job, start in zip(jobs, ahead.starts.tolist(), strict=True):
        low, high = job.band
        blocks = coefficients[job.rows[:, 0], low : high + 1].tolist()
        try:
            _refine_blocks(blocks, bits, lengths, symbols, start, start + 8 * len(job.raw), 1 << job.left)
        except ValueError:
            bad.add(job.file)
            continue
        coefficients[job.rows[:, 0], low : high + 1] = blocks
    return bad


def _refine_blocks(blocks: list[list[int]], bits: bytes, lengths: bytes, symbols: bytes, at: int, end: int, one: int) -> None:
    """Corrects and adds coefficients of a band, in place."""
    run = 0
    for row in blocks:
        k, n = 0, len(row)
        if not run:
            while k < n:
                if at >= end or not lengths[at]:
                    raise ValueError("no such code")
                skip, size = divmod(symbols[at], 16)
                at += lengths[at]
                if not size and skip < 15:
                    run = 1 << skip
                    for j in range(skip):
                        run += bits[at + j] << (skip - 1 - j)
                    at += skip
                    break
                new = 0
                if size:
                    new = one if bits[at] else -one
                    at += 1
                while k < n:
                    v = row[k]
                    if v:
                        if bits[at] and not v & one:
                            row[k] = v + one if v > 0 else v - one
                        at += 1
                    elif skip:
                        skip -= 1
                    else:
                        row[k] = new
                        k += 1
                        break
                    k += 1
        if run:
            run -= 1
            while k < n:
                v = row[k]
                if v:
                    if bits[at] and not v & one:
                        row[k] = v + one if v > 0 else v - one
                    at += 1
                k += 1
    if at > end:
        raise ValueError("a scan that ends early")


def tensor(image: Image) -> np.ndarray:
    """The (height, width, 3) array of bytes of an image of one or three components."""
    planes = []
    for c in image.components:
        values = np.empty((len(c["data"]), 64), np.float32)
        values[:, zigzag()] = c["data"] * image.quant[c["table"]].astype(np.float32)
        half = (values.reshape(-1, 8) @ basis()).reshape(-1, 8, 8)  # along rows of a block
        pixels = np.matmul(basis().T, half).reshape(c["rows"], c["columns"], 8, 8).transpose(0, 2, 1, 3).reshape(8 * c["rows"], -1)
        for axis, times in ((0, c["most"][1] // c["v"]), (1, c["most"][0] // c["h"])):
            if times > 1:
                pixels = np.repeat(pixels, times, axis=axis)
        planes.append(pixels[: image.height, : image.width])
    y = planes[0] + np.float32(128.5)
    out = np.empty((*y.shape, 3), np.uint8)
    if len(planes) == 1:
        out[:] = np.clip(y, 0, 255).astype(np.uint8)[:, :, None]
        return out
    blue, red = planes[1], planes[2]
    for k, channel in enumerate((y + np.float32(1.402) * red, y - np.float32(0.344136) * blue - np.float32(0.714136) * red, y + np.float32(1.772) * blue)):
        out[:, :, k] = np.clip(channel, 0, 255, out=channel)
    return out


def payload_of(image: Image) -> tuple[bytes, int]:
    """(payload, unpadded length) of a file that ``encode`` made, out of its coefficients."""
    words = image.comment.split()
    n, size = int(words[1]), int(words[3])
    blocks = size // UNIT
    data = np.concatenate([c["data"] for c in image.components])[:blocks]
    return (data + CENTRE).astype(np.uint8).tobytes(), n


def feature(pixels: np.ndarray) -> str:
    """Size, and mean and standard deviation of each channel."""
    flat = pixels.reshape(-1, 3)
    counts = [np.bincount(flat[:, k], minlength=256) for k in range(3)]
    level, n, parts = np.arange(256), len(flat), []
    for count in counts:
        total, squares = int(count @ level), int(count @ (level * level))
        parts.append(f"{total / n:.3f}:{math.sqrt(max(0, squares / n - (total / n) ** 2)):.3f}")
    return f"{pixels.shape[1]}x{pixels.shape[0]} " + " ".join(parts)


# Columns -------------------------------------------------------------------------------------------


def pad(data: bytes) -> bytes:
    return data + b"\0" * (-len(data) % UNIT if data else UNIT)


@F.arrow_udf(BinaryType())
def _store(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in columns:
        texts = [x or b"" for x in column.to_pylist()]
        files = [f for group in _grouped(texts, map(len, texts), GROUP_BYTES) for f in encode_many([(pad(x), len(x)) for x in group])]
        yield pa.array(files, pa.binary())


def _images(column: pa.Array) -> Iterator[tuple[bytes | None, Image | ValueError]]:
    files = column.to_pylist()
    for group in _grouped(files, (len(x or b"") for x in files), GROUP_BYTES):
        yield from zip(group, decode_many(group), strict=True)


def _structs(rows: list[tuple | None], fields: str) -> pa.StructArray:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    names, types = zip(*(x.split(": ") for x in fields.split(", ")), strict=True)
    columns = [pa.array([None if r is None else r[k] for r in rows], kinds[t]) for k, t in enumerate(types)]
    return pa.StructArray.from_arrays(columns, list(names), mask=pa.array([r is None for r in rows], pa.bool_()))


@F.arrow_udf(struct(RESULT))
def _load(media: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in media:
        rows = []
        for data, image in _images(column):
            if isinstance(image, ValueError) or not image.comment.startswith(b"payload "):
                rows.append(None)
                continue
            payload, _ = payload_of(image)
            rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(data), hashlib.sha256(data).hexdigest(), feature(tensor(image))))
        yield _structs(rows, RESULT)


TENSOR = "height: int, width: int, pixels: binary"


@F.arrow_udf(struct(TENSOR))
def _tensors(media: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in media:
        found = [None if isinstance(image, ValueError) else tensor(image) for _, image in _images(column)]
        yield _structs([None if t is None else (t.shape[0], t.shape[1], t.tobytes()) for t in found], TENSOR)


def store(docs: DataFrame, text: str = "text", into: str = "media") -> DataFrame:
    """``docs`` with each text's progressive JPEG file in the binary column ``into``."""
    return docs.withColumn(into, _store(F.col(text).cast("string").cast("binary")))


def load(stored: DataFrame, media: str = "media", into: str = "loaded") -> DataFrame:
    """``stored`` with the struct RESULT, all of it computed from the stored bytes; null for files that ``store`` didn't make."""
    return stored.withColumn(into, _load(F.col(media)))


def tensors(stored: DataFrame, media: str = "media", into: str = "tensor") -> DataFrame:
    """``stored`` with (height, width, pixels), full-resolution RGB, of any progressive JPEG column."""
    return stored.withColumn(into, _tensors(F.col(media)))


def store_tensors(stored: DataFrame, folder: str, media: str = "media", into: str = "tensor") -> DataFrame:
    """``stored`` with its tensors, written as Parquet to ``folder`` and read back: three bytes a pixel."""
    tensors(stored, media, into).write.parquet(folder)
    return stored.sparkSession.read.parquet(folder)
