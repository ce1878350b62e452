"""Hard-negative mining by inner product, over cover trees of norm-augmented candidates.

Vectors are quantised to whole numbers, so scores are exact 64-bit integers. A candidate x of a tree whose
largest norm is M gets one more coordinate, sqrt(M^2 - |x|^2): all candidates then lie on a sphere of radius M,
the inner product with an anchor (whose extra coordinate is 0) is unchanged, and covering radii of the tree
bound it: with the angle a between anchor and a node's centre and the angle r of the node's radius, every product
below the node lies between |anchor| M cos(a + r) and |anchor| M cos(a - r).

The tree is built from the top: a node's centre covers its rows within a radius; its children's centres are taken
farthest first (so they are as far apart as the children's radius), the first is the node's own, until the radius has halved
or FANOUT centres cover the rows. Leaves have at most LEAF rows (or one repeated point). A search goes down level by
level, skips nodes whose interval misses every open window of an anchor, takes leaves best first, in batches
that double, and stops where a leaf's upper bound can't reach the kept answers. Leaves are verified exactly.

On Spark: rows are dealt to cells around centres taken farthest first from a bounded sample (the tree's upper
levels) and cells over TREE rows are split by hash; each part is one task's tree, written as one row. Anchors are cut
into blocks of at most BLOCK by hash, and a unit is one block and one run of trees: it hands back at most k rows
for each anchor and window. Positives first, then negatives within the windows that positives make; answers of
units are ranked by score and id, so the sample and the dealing decide speed only. All anchors meet all trees
in blocks; nothing is collected or broadcast but the sample's centres.

Defined cases: rows with a null id, label or vector, or a null or non-finite component take no part, nor do vectors whose
squared norm reaches 2**62 (their products don't fit 64 bits); rows of one id are one row as an anchor (the least label and
vector) and never their own positive or negative; equal answers (score, id) count once; shorter vectors end in zeros; an anchor
without positives or without negatives in a window gives no rows; an empty table gives none; other columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.operators.graphs import Scratch

#: Anchors' ids are divisible by ANCHOR; labels move where the id is divisible by MOVED; positives and negatives of each.
ANCHOR, MOVED, LABELS, POSITIVES, NEGATIVES = 50, 7, 10, 5, 3
#: Hundredths of a positive's score between which a negative's lies.
LOWEST, HIGHEST = 50, 95
#: Rows of a leaf and of a tree; children of a node; anchors of a block; rows of the sample; cells at most; runs of trees at least, if there are as many.
LEAF, TREE, FANOUT, BLOCK, SAMPLE, CELLS, RUNS = 64, 8192, 16, 4096, 16_384, 1024, 64

_NONE = np.iinfo(np.int64).min
_TREE_TYPE = "tree bigint, rows int, width int, vectors binary, ids binary, labels binary, nodes binary"
_NODE = np.dtype([("first", "<i8"), ("last", "<i8"), ("centre", "<i8"), ("radius", "<f8"), ("parent", "<i8"), ("level", "<i8"), ("leaf", "<i8")])


def quantised(vectors: DataFrame) -> DataFrame:
    """(id, label, v) of the rows that take part: ``vec_id``, ``label`` and ``embedding``, moved and floored."""
    x, label = F.col("embedding").cast("array<double>"), F.col("label").cast("bigint")
    floored = F.transform(x, lambda c: F.floor(c * 256))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 2.0**23 * 2.0**31))
    rows = vectors.filter(F.col("vec_id").isNotNull() & label.isNotNull() & x.isNotNull() & F.coalesce(fine, F.lit(True)))
    norm = F.aggregate(x, F.lit(0.0), lambda s, c: s + F.floor(c * 256).cast("double") * F.floor(c * 256).cast("double"))
    moved = F.when(F.pmod("vec_id", F.lit(MOVED)) == 0, F.pmod(label + 1, F.lit(LABELS))).otherwise(label)
    return rows.filter(norm < 2.0**62).select(F.col("vec_id").cast("bigint").alias("id"), moved.cast("bigint").alias("label"), floored.alias("v"))


def matrix(column: pa.ListArray, width: int = 0) -> np.ndarray:
    """A list column as rows of one width, shorter ones ended with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(column.value_lengths()).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(width, int(sizes.max(initial=0)), 1)
    if len(flat) == len(sizes) * width:
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: by floating point where no partial sum can be rounded."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    largest = [np.sqrt((x.astype(float) ** 2).sum(axis=1).max(initial=0)) for x in (a, b)]
    if largest[0] * largest[1] < 2.0**52:
        return np.rint(a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def farthest_first(points: np.ndarray, most: int, until: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres (row numbers, from row 0), the nearest centre of each row and its distance."""
    centres = [0]
    near = np.zeros(len(points), np.int64)
    away = np.linalg.norm(points - points[0], axis=1)
    while len(centres) < most:
        far = int(away.argmax())
        if away[far] <= until:
            break
        apart = np.linalg.norm(points - points[far], axis=1)
        nearer = apart < away
        near[nearer], away[nearer] = len(centres), apart[nearer]
        centres.append(far)
    return np.array(centres), near, away


class Tree:
    """A cover tree of rows: nodes are runs of rows, level by level."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, nodes: np.ndarray) -> None:
        self.vectors, self.ids, self.labels, self.nodes = vectors, ids, labels, nodes
        self.norm = math.sqrt((vectors.astype(float) ** 2).sum(axis=1).max(initial=0))

    @staticmethod
    def build(vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> Tree:
        plain = vectors.astype(float)
        squares = (plain**2).sum(axis=1)
        points = np.hstack([plain, np.sqrt(np.maximum(squares.max(initial=0) - squares, 0))[:, None]])
        order, nodes = np.arange(len(points)), []
        todo = [(0, len(points), -1, 0)]
        while todo:
            following = []
            for first, last, parent, level in todo:
                own = order[first:last]
                away = np.linalg.norm(points[own] - points[own[0]], axis=1)
                radius, here = float(away.max(initial=0)), len(nodes)
                leaf = last - first <= LEAF or radius == 0
                nodes.append((first, last, first, radius, parent, level, leaf))
                if leaf:
                    continue
                centres, near, _ = farthest_first(points[own], FANOUT, radius / 2)
                rank = np.ones(len(own), np.int64)
                rank[centres] = 0  # a child's run begins with its centre
                order[first:last] = own[np.lexsort((rank, near))]
                ends = first + np.cumsum(np.bincount(near, minlength=len(centres)))
                starts = np.concatenate([[first], ends[:-1]])
                following += [(int(i), int(j), here, level + 1) for i, j in zip(starts, ends, strict=True)]
            todo = following
        return Tree(vectors[order], ids[order], labels[order], np.array(nodes, _NODE))

    def pack(self) -> dict:
        n, width = self.vectors.shape
        parts = {"vectors": self.vectors, "ids": self.ids, "labels": self.labels}
        return {"rows": n, "width": width, **{k: np.ascontiguousarray(v, "<i8").tobytes() for k, v in parts.items()}, "nodes": self.nodes.tobytes()}

    @staticmethod
    def unpack(row: dict) -> Tree:
        vectors, ids, labels = (np.frombuffer(row[k], "<i8") for k in ("vectors", "ids", "labels"))
        return Tree(vectors.reshape(row["rows"], row["width"]), ids, labels, np.frombuffer(row["nodes"], _NODE))

    def search(self, anchors: np.ndarray, want: Windows) -> None:
        """Gives ``want`` every row that may be among its answers: level by level, then leaves best first."""
        if not len(self.ids) or not len(anchors):
            return
        lengths = np.sqrt((anchors.astype(float) ** 2).sum(axis=1))
        scale = lengths * self.norm
        slack = 1e-9 * scale + 1e-6
        high = np.full((len(anchors), len(self.nodes)), -np.inf)
        low = np.full_like(high, np.inf)
        alive = np.zeros(high.shape, bool)
        for level in range(int(self.nodes["level"].max()) + 1):
            nodes = np.flatnonzero(self.nodes["level"] == level)
            if level:
                nodes = nodes[alive[:, self.nodes["parent"][nodes]].any(axis=0)]
            if not len(nodes):
                break
            met = products(anchors, self.vectors[self.nodes["centre"][nodes]]).astype(float)
            with np.errstate(divide="ignore", invalid="ignore"):
                angle = np.arccos(np.clip(np.where(scale[:, None] > 0, met / scale[:, None], 0.0), -1, 1))
            reach = 2 * np.arcsin(np.clip(self.nodes["radius"][nodes] / (2 * self.norm), 0, 1)) if self.norm else np.zeros(len(nodes))
            high[:, nodes] = scale[:, None] * np.cos(np.maximum(angle - reach, 0)) + slack[:, None]
            low[:, nodes] = scale[:, None] * np.cos(np.minimum(angle + reach, np.pi)) - slack[:, None]
            alive[:, nodes] = want.open(high[:, nodes], low[:, nodes])
            if level:
                alive[:, nodes] &= alive[:, self.nodes["parent"][nodes]]
        leaves = np.flatnonzero((self.nodes["leaf"] == 1) & alive.any(axis=0))
        rank = np.where(alive[:, leaves], want.priority(high[:, leaves]), -np.inf)
        best = np.argsort(-rank, axis=1, kind="stable")
        done, step = 0, 1
        while done < len(leaves):
            taken = best[:, done : done + step]
            at = np.repeat(np.arange(len(anchors)), taken.shape[1])
            leaf = leaves[taken.ravel()]
            needed = alive[at, leaf] & want.still(at, high[at, leaf], low[at, leaf])
            at, leaf = at[needed], leaf[needed]
            order = np.argsort(leaf, kind="stable")
            at, leaf = at[order], leaf[order]
            for mine in np.split(np.arange(len(leaf)), np.flatnonzero(np.diff(leaf)) + 1):
                if len(mine):
                    node = self.nodes[leaf[mine[0]]]
                    rows = slice(int(node["first"]), int(node["last"]))
                    want.offer(at[mine], products(anchors[at[mine]], self.vectors[rows]), self.ids[rows], self.labels[rows])
            want.settle()
            done, step = done + step, step * 2


class Windows:
    """The best answers so far of each anchor's windows [least, most]: whole scores, the highest first, then the smallest id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, least: np.ndarray, most: np.ndarray, k: int, same: bool) -> None:
        self.ids, self.labels, self.least, self.most, self.k, self.same = ids, labels, least, most, k, same
        self.score = np.full((*least.shape, k), _NONE)
        self.found = np.zeros((*least.shape, k), np.int64)
        self.full = np.zeros(least.shape, bool)
        self._new: list[np.ndarray] = []

    def floor(self) -> np.ndarray:
        """A score under this doesn't count any more, by anchor and window."""
        return np.where(self.full, np.maximum(self.score[..., -1], self.least), self.least)

    def open(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        floor, out = self.floor(), np.zeros(high.shape, bool)
        for w in range(floor.shape[1]):
            out |= (high >= floor[:, w, None]) & (low <= self.most[:, w, None])
        return out

    def priority(self, high: np.ndarray) -> np.ndarray:
        out = np.full(high.shape, -np.inf)
        for w in range(self.most.shape[1]):
            out = np.maximum(out, np.minimum(high, self.most[:, w, None].astype(float)))
        return out

    def still(self, at: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        return ((high[:, None] >= self.floor()[at]) & (low[:, None] <= self.most[at])).any(axis=1)

    def offer(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        fits = (labels == self.labels[at][:, None]) == self.same
        fits &= ids != self.ids[at][:, None]
        floor, most = self.floor()[at], self.most[at]
        for w in range(most.shape[1]):
            i, j = np.nonzero(fits & (scores >= floor[:, w, None]) & (scores <= most[:, w, None]))
            if len(i):
                self._new.append(np.stack([at[i], np.full(len(i), w), scores[i, j], ids[j]]))

    def settle(self) -> None:
        if not self._new:
            return
        at, w, score, found = np.concatenate(self._new, axis=1)
        self._new = []
        a, b, c = np.nonzero(self.score[np.unique(at)] != _NONE)
        a = np.unique(at)[a]
        at, w, score, found = (np.concatenate(x) for x in ((at, a), (w, b), (score, self.score[a, b, c]), (found, self.found[a, b, c])))
        order = np.lexsort((found, -score, w, at))
        at, w, score, found = at[order], w[order], score[order], found[order]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (w[1:] != w[:-1]) | (score[1:] != score[:-1]) | (found[1:] != found[:-1])
        at, w, score, found = at[new], w[new], score[new], found[new]
        starts = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (w[1:] != w[:-1])]))
        place = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
        top = place < self.k
        self.score[at[top], w[top], place[top]] = score[top]
        self.found[at[top], w[top], place[top]] = found[top]
        self.full = self.score[..., -1] != _NONE

    def answers(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        a, w, c = np.nonzero(self.score != _NONE)
        return a, w, self.score[a, w, c], self.found[a, w, c]


def _plant(key, rows):
    tree = Tree.build(matrix(rows["v"]), rows["id"].to_numpy(), rows["label"].to_numpy())
    packed = tree.pack()
    number = int.from_bytes(np.array([key[0].as_py(), key[1].as_py()], "<u4").tobytes(), "little")
    types = {"rows": pa.int32(), "width": pa.int32()}
    return pa.table({"tree": pa.array([number], pa.int64()), **{k: pa.array([v], types.get(k, pa.binary())) for k, v in packed.items()}})


def plant(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """One row for each tree over (id, label, v)."""
    total = rows.count()
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(min(SAMPLE, total)).select("v").toArrow()["v"] if total > TREE else None
    if sample is not None:
        points = matrix(sample).astype(float)
        centres = points[farthest_first(points, min(CELLS, -(-total // TREE)))[0]]
    else:
        centres = np.zeros((1, 1))
    shared = rows.sparkSession.sparkContext.broadcast(centres)

    @F.arrow_udf("int")
    def cell(column: pa.Array) -> pa.Array:
        points, around = matrix(column).astype(float), shared.value
        width = max(points.shape[1], around.shape[1])
        points, around = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (points, around))
        return pa.array(((around**2).sum(axis=1) - 2 * points @ around.T).argmin(axis=1).astype(np.int32))

    dealt = scratch.keep(rows.withColumn("cell", cell("v")), "dealt")
    parts = dealt.groupBy("cell").agg(F.ceil(F.count("*") / TREE).cast("int").alias("parts"))  # CELLS rows at most
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    split = dealt.join(F.broadcast(parts), "cell").withColumn("part", part).select("cell", "part", "id", "label", "v")
    trees = scratch.keep(split.groupBy("cell", "part").applyInArrow(_plant, _TREE_TYPE), "trees")
    scratch.drop("dealt")
    return trees


def _units(anchors: DataFrame, trees: DataFrame, n_anchors: int, n_trees: int):
    """Both sides by (block, run): every block of anchors meets every run of trees."""
    blocks, runs = max(1, -(-n_anchors // BLOCK)), max(1, min(n_trees, max(RUNS, n_trees // 8)))

    def all_of(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = anchors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("run", all_of(runs))
    right = trees.withColumn("run", F.pmod(F.xxhash64("tree"), F.lit(runs)).cast("int")).withColumn("block", all_of(blocks))
    return left.groupBy("block", "run").cogroup(right.groupBy("block", "run"))


def _forest(trees: pa.Table) -> Iterator[Tree]:
    for k in range(trees.num_rows):
        yield Tree.unpack(trees.slice(k, 1).to_pylist()[0])


def _positives(anchors: pa.Table, trees: pa.Table) -> pa.Table:
    ids, labels, vectors = anchors["id"].to_numpy(), anchors["label"].to_numpy(), matrix(anchors["v"])
    everything = np.full((len(ids), 1), np.iinfo(np.int64).max)
    want = Windows(ids, labels, -everything, everything, POSITIVES, same=True)
    for tree in _forest(trees):
        tree.search(vectors, want)
    a, _, score, found = want.answers()
    return pa.table({"anchor_id": ids[a], "positive_id": found, "positive_score": score})


def _negatives(anchors: pa.Table, trees: pa.Table) -> pa.Table:
    ids, labels, vectors = anchors["id"].to_numpy(), anchors["label"].to_numpy(), matrix(anchors["v"])
    scores = [[p["positive_score"] for p in row] for row in anchors["positives"].to_pylist()]
    positives = [[p["positive_id"] for p in row] for row in anchors["positives"].to_pylist()]
    least, most = np.ones((len(ids), POSITIVES), np.int64), np.zeros((len(ids), POSITIVES), np.int64)  # no score fits
    for i, row in enumerate(scores):
        least[i, : len(row)] = [-(-LOWEST * s // 100) for s in row]
        most[i, : len(row)] = [HIGHEST * s // 100 for s in row]
    want = Windows(ids, labels, least, most, NEGATIVES, same=False)
    for tree in _forest(trees):
        tree.search(vectors, want)
    a, w, score, found = want.answers()
    pairs = list(zip(a.tolist(), w.tolist(), strict=True))
    return pa.table({
        "anchor_id": ids[a], "positive_id": pa.array([positives[i][j] for i, j in pairs], pa.int64()),
        "positive_score": pa.array([scores[i][j] for i, j in pairs], pa.int64()), "negative_id": found, "negative_score": score,
    })


def mine(vectors: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor of ``vectors``."""
    scratch = Scratch(vectors.sparkSession, "negatives")
    rows = quantised(vectors)
    trees = plant(scratch.keep(rows, "rows"), scratch)
    anchors = rows.filter(F.pmod("id", F.lit(ANCHOR)) == 0).groupBy("id").agg(F.min(F.struct("label", "v")).alias("x")).select("id", "x.*")
    anchors = scratch.keep(anchors, "anchors")
    n_anchors, n_trees = anchors.count(), trees.count()

    found = _units(anchors, trees, n_anchors, n_trees).applyInArrow(_positives, "anchor_id bigint, positive_id bigint, positive_score bigint").distinct()
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= POSITIVES)
    chosen = best.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    asking = scratch.keep(anchors.join(chosen, "id"), "asking")
    names = "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
    found = _units(asking, trees, n_anchors, n_trees).applyInArrow(_negatives, names).distinct()
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = scratch.keep(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= NEGATIVES), "found")
    scratch.drop("rows", "trees", "anchors", "asking")
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute_sql() -> str:
    """DuckDB SQL for the rows of ``mine(embeddings)``, where ids are distinct."""
    return f"""
        WITH v AS (
            SELECT vec_id AS id, CASE WHEN vec_id % {MOVED} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
            FROM v a JOIN v b ON a.id <> b.id WHERE a.id % {ANCHOR} = 0
        ), p AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES}
        )
        SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
               id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND {LOWEST} * positive_score <= 100 * score AND 100 * score <= {HIGHEST} * positive_score
        QUALIFY rank <= {NEGATIVES}
    """
