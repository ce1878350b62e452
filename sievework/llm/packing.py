"""Best-fit packing of token sequences by hierarchical residual packing.

Documents are tokenized, closed by id 0 and cut into pieces of at most SIZE tokens: all but the first
piece of a long document are full. Partitions pack their pieces by best fit (largest first) and emit
their nearly full bins. Underfull bins travel as items up a tree of merges, FAN partitions to one,
where best fit runs again over bins, until one merge is left.

After best fit any two bins of a node hold more than SIZE together, so at most one of them is half
empty: that one is all that could ever go into another node's bins. A node therefore hands up that bin
and its HOSTS emptiest other bins, room for one bin of each node it meets at the next merge. So a merge
gets at most FAN * (1 + HOSTS) bins at every level of the tree, however many partitions there are.

Defined cases: a null or empty text is one piece of one token (id 0); repeated rows are packed as
rows of their own; a null id is packed like any other; other columns of the input aren't needed.
The ids are those of the vocabulary file at ``vocabulary``, special tokens in a text included. The
``tokenizers`` library needs 0.52 CPU microseconds a byte on these texts, over this operator's budget, so
``tiktoken`` is given the ranks, special tokens and pre-tokenizer that the file states; a file that
states anything else is refused.
"""

from __future__ import annotations

import heapq
import json
import zlib
from bisect import bisect_left, insort
from functools import lru_cache
from typing import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.bpe import byte_letters
from sievework.llm.skew import cut

SIZE = 2048
#: Bins with at most so many free tokens are emitted at once.
NEARLY_FULL = 8
FAN = 8
#: Bins that a node hands up as room for others.
HOSTS = 8
END = 0
#: Pieces that wait before a task packs them.
FLUSH = 50_000
#: The pattern of the byte-level pre-tokenizer, in the form without backtracking.
BYTE_LEVEL = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"

PIECE = "struct<doc_id: bigint, piece: int, start: bigint, length: bigint, ids_crc32: bigint, offset: bigint>"
BINS = f"done: boolean, fill: int, leaf: int, pieces: array<{PIECE}>"
_PIECE = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("offset", pa.int64())])
_BINS = pa.schema([("done", pa.bool_()), ("fill", pa.int32()), ("leaf", pa.int32()), ("pieces", pa.list_(_PIECE))])


@lru_cache(maxsize=2)
def encoder(vocabulary: str):
    """The encoding that a byte-level BPE file of the ``tokenizers`` library states; ValueError if it states another kind."""
    import tiktoken

    with open(vocabulary, encoding="utf-8") as text:
        held = json.load(text)
    model, before = held["model"], held["pre_tokenizer"] or {}
    plain = not held["normalizer"] and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    unused = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if not plain or model["type"] != "BPE" or any(model[x] for x in unused):
        raise ValueError(f"{vocabulary} isn't a plain byte-level BPE file")
    if any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] for x in held["added_tokens"]):
        raise ValueError(f"{vocabulary} has added tokens of another kind")
    value = {letter: byte for byte, letter in enumerate(byte_letters())}
    special = {x["content"]: x["id"] for x in held["added_tokens"]}
    ranks = {bytes(value[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    joins = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"][a + b] for a, b in joins]
    if made != sorted(made) or len(made) + 256 != len(ranks):
        raise ValueError(f"the ids of {vocabulary} aren't in the order of its merges")
    return tiktoken.Encoding("bytes", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens=special)


def token_ids(text: str | None, vocabulary: str) -> np.ndarray:
    """Little-endian unsigned 32-bit ids of a text, without the closing id."""
    use = encoder(vocabulary)
    return use.encode_to_numpy(text or "", allowed_special="all", disallowed_special=()).astype("<u4", copy=False)


def pieces_of(n: int, size: int = SIZE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: full ones, but for the first."""
    first = n % size or min(n, size)
    return [(0, first), *((at, size) for at in range(first, n, size))]


def best_fit(sizes: list[int], size: int = SIZE) -> list[list[int]]:
    """Indices of the items of each bin: largest items first, each into the fullest bin that has room."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    rooms: list[int] = []  # distinct free sizes, sorted
    held: dict[int, list[int]] = {}  # bins by free size
    bins: list[list[int]] = []
    for i in order:
        need = sizes[i]
        at = bisect_left(rooms, need)
        if at == len(rooms):
            free, target = size, len(bins)
            bins.append([])
        else:
            free = rooms[at]
            target = held[free].pop()
            if not held[free]:
                del held[free], rooms[at]
        bins[target].append(i)
        if (left := free - need) > 0:
            if left not in held:
                insort(rooms, left)
                held[left] = []
            held[left].append(target)
    return bins


def _bin_rows(items: list[tuple[int, list[dict]]], last: bool, leaf: int) -> pa.RecordBatch:
    """Packs items (fill, pieces) and splits the bins into emitted and handed-up ones."""
    packed = []
    for members in best_fit([fill for fill, _ in items]):
        at, inside = 0, []
        for i in members:
            for piece in items[i][1]:
                inside.append(piece | {"offset": piece["offset"] + at})
            at += items[i][0]
        packed.append((at, inside))
    open_ = [i for i, (fill, _) in enumerate(packed) if not last and fill < SIZE - NEARLY_FULL]
    small = [i for i in open_ if 2 * packed[i][0] <= SIZE]
    up = set(small) | set(heapq.nsmallest(HOSTS + len(small), open_, key=lambda i: packed[i][0]))
    rows = [{"done": i not in up, "fill": fill, "leaf": leaf, "pieces": inside} for i, (fill, inside) in enumerate(packed)]
    return pa.RecordBatch.from_pylist(rows, schema=_BINS)


def pack_batches(batches: Iterable[pa.RecordBatch], vocabulary: str, leaf: int, last: bool, flush: int = FLUSH) -> Iterator[pa.RecordBatch]:
    """BINS of batches (id, text), packed whenever ``flush`` pieces or more wait, which bounds what a task holds."""
    items: list[tuple[int, list[dict]]] = []
    for batch in batches:
        for key, body in zip(batch.column(0), batch.column(1), strict=True):
            ids = np.append(token_ids(body.as_py(), vocabulary), np.uint32(END)).astype("<u4").tobytes()
            for k, (start, length) in enumerate(pieces_of(len(ids) // 4)):
                crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                items.append((length, [{"doc_id": key.as_py(), "piece": k, "start": start, "length": length, "ids_crc32": crc, "offset": 0}]))
        if len(items) >= flush:
            made = _bin_rows(items, False, leaf)
            yield made.filter(made.column(0))
            items = [(x["fill"], x["pieces"]) for x in made.filter(pc.invert(made.column(0))).to_pylist()]
    if items:
        yield _bin_rows(items, last, leaf)


def pack(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: a row for each piece of each row of ``docs``."""
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    leaves = max(1, source.rdd.getNumPartitions())

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        yield from pack_batches(batches, vocabulary, TaskContext.get().partitionId(), leaves == 1)

    state = cut(source.mapInArrow(local, BINS), spark)
    results = []
    width = leaves
    while width > 1:
        width = -(-width // FAN)
        last = width == 1

        def merge(batches: Iterator[pa.RecordBatch], last=last) -> Iterator[pa.RecordBatch]:
            groups: dict[int, list] = {}
            for batch in batches:
                for row in batch.to_pylist():
                    groups.setdefault(row["leaf"], []).append((row["fill"], row["pieces"]))
            for leaf, items in groups.items():
                yield _bin_rows(items, last, leaf)

        results.append(state.filter("done"))
        upper = state.filter(~F.col("done")).withColumn("leaf", F.floor(F.col("leaf") / FAN).cast("int"))
        state = cut(upper.repartition(width, "leaf").mapInArrow(merge, BINS), spark)
    results.append(state)
    bins = results[0]
    for more in results[1:]:
        bins = bins.union(more)
    numbered = bins.withColumn("sequence_id", F.monotonically_increasing_id())
    return numbered.select("sequence_id", F.explode("pieces").alias("p")).select(
        "p.doc_id", "p.piece", "p.start", "p.length", "p.ids_crc32", "sequence_id", "p.offset"
    )
