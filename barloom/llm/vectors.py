"""Embedding near-dedup by cover trees and a dual traversal: exact threshold pairs.

Unit vectors are compared by their chord: cosine >= c means distance <= r with r * r = 2 - 2c. A bounded set of
pivots deals the vectors into cells; the vectors of a cell (of large cells several parts) make one cover tree: its
root covers the sphere with radius 2, and each next level is a greedy net of half the radius inside each subtree. A
vector takes part in a pair of trees only if the other cell's pivot is within that cell's covering radius plus r.

The dual traversal opens two subtrees level by level. It drops pairs of children that are farther apart than their
covering radii plus r, links pairs whole that are nearer than r less their radii, and opens the others, down to the
vectors. So vectors that lie in clusters are compared within them only. Vectors without structure, all about equally
far from each other, have trees of one level under the root; no exact bound can tell them apart, and all pairs of
them are compared, in tiles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.arrow import matrix, runs
from barloom.llm.graph import components
from barloom.session import cut

COSINE = 0.95
RADII = (2.0, 1.0, 0.5, 0.25, 0.125, 0.0625)
#: Pivots at most, vectors of a tree at most, vectors for each pivot.
PIVOTS, NODE, CELL = 1024, 16384, 12288
#: Children compared at a time, and pairs of vectors below which two subtrees are not opened further.
TILE, SMALL = 1024, 4096
#: Room for rounding in bounds; a pair of vectors itself is compared exactly.
EPS = 1e-7


def _units(kind: type):
    """Row-wise: key of the unit vector and the vector itself, null where a vector is null, zero or not finite."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, raw = [], []
            for v in batch.column(1):
                x = None if not v.is_valid or v.values.null_count else np.asarray(v.values.to_numpy(zero_copy_only=False), kind)
                if x is not None and len(x) and np.isfinite(x).all() and x.any():
                    keys.append(xxhash.xxh3_128_digest(unit(x[None, :]).tobytes()))
                    raw.append(x.tobytes())
                else:
                    keys.append(None)
                    raw.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(raw, pa.binary())], names=["vec_id", "key", "raw"])

    return run


def unit(x: np.ndarray) -> np.ndarray:
    """The rows at length one, in double precision."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ y.T), 0))


def _assign(pivots: np.ndarray, kind: type):
    """Row-wise: the nearest pivot and its distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = _distance(unit(matrix(pa.chunked_array([batch.column("raw")]), kind, pivots.shape[1])), pivots)
                cell = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])], names=[*batch.schema.names, "cell", "far"])

    return run


def greedy_net(x: np.ndarray, radius: float) -> np.ndarray:
    """For each row, the place of a centre within ``radius``; centres are their own and farther apart than that."""
    own = np.empty(len(x), np.int64)
    least = 1 - radius * radius / 2  # product of two vectors at that distance
    places = np.empty(len(x), np.int64)
    held = np.empty_like(x)
    n = 0
    for k in range(0, len(x), 256):
        part = x[k : k + 256]
        left = np.arange(len(part))
        if n:
            dot = part @ held[:n].T
            best = dot.argmax(axis=1)
            near = dot[left, best] >= least
            own[k + left[near]] = places[best[near]]
            left = left[~near]
        within = part[left] @ part[left].T >= least
        open_ = np.ones(len(left), bool)
        for i in range(len(left)):
            if open_[i]:
                take = open_ & within[i]
                take[i] = True
                own[k + left[take]] = k + left[i]
                open_ &= ~take
                held[n], places[n] = part[left[i]], k + left[i]
                n += 1
    return own


def _grow(dim: int, kind: type):
    """Of each node, the rows with their centre on every level (a row's place in the node)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node in runs(batches, "node"):
            x = unit(matrix(node["raw"], kind, dim))
            levels = np.empty((len(x), len(RADII)), np.int32)
            groups = [np.arange(len(x))]
            for k, radius in enumerate(RADII):
                inner = []
                for g in groups:
                    if k == 0 or len(g) > 1:
                        own = g[greedy_net(x[g], radius)]
                        levels[g, k] = own
                        order = np.argsort(own, kind="stable")
                        inner += np.split(g[order], np.flatnonzero(np.diff(own[order])) + 1)
                    else:
                        inner.append(g)
                        levels[g, k] = g
                groups = [g for g in inner if len(g) > 1]
                alone = np.concatenate([g for g in inner if len(g) == 1] or [np.zeros(0, np.int64)])
                levels[alone, k:] = alone[:, None]
            batch = node.combine_chunks().to_batches()[0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([r.tobytes() for r in levels], pa.binary())], names=[*batch.schema.names, "levels"])

    return run


class Subtree:
    """Some vectors of a tree on one level; the first is the centre that covers the others within ``radius``."""

    def __init__(self, x: np.ndarray, levels: np.ndarray, rows: np.ndarray, radius: float = 2.0, level: int = 0):
        self.x, self.levels, self.rows, self.radius, self.level = x, levels, rows, radius, level
        self.sizes: np.ndarray | None = None

    def split(self) -> None:
        """The children as arrays: bounds in ``sorted``, sizes, centres and covering radii."""
        if self.sizes is None:
            own = self.levels[self.rows, self.level + 1]
            order = np.argsort(own, kind="stable")
            self.sorted, own = self.rows[order], own[order]
            first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            self.bounds = np.append(first, len(own))
            self.sizes = np.diff(self.bounds)
            centre = self.sorted[first]
            self.heads = self.x[centre]
            far = np.einsum("ij,ij->i", self.x[self.sorted], np.repeat(self.heads, self.sizes, axis=0))
            self.radii = np.where(self.sizes > 1, np.sqrt(np.maximum(2 - 2 * np.minimum.reduceat(far, first), 0)), 0.0)
            self.made: dict[int, Subtree] = {}

    def child(self, k: int) -> Subtree:
        if k not in self.made:
            rows = self.sorted[self.bounds[k] : self.bounds[k + 1]]
            self.made[k] = Subtree(self.x, self.levels, rows, float(self.radii[k]), self.level + 1)
        return self.made[k]


class _Links:
    def __init__(self, n: int, weight: np.ndarray):
        self.count, self.weight, self.root = np.zeros(n, np.int64), weight, np.arange(n)
        self.compared = 0

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def join(self, members: np.ndarray) -> None:
        first = self.find(int(members[0]))
        for i in members[1:].tolist():
            if (other := self.find(i)) != first:
                self.root[max(first, other)] = first = min(first, other)

    def add(self, a: np.ndarray, b: np.ndarray, mask: np.ndarray, same: bool) -> None:
        """Links rows ``a`` and ``b`` (places in the whole) where ``mask``; ``same``: a is b, the diagonal is out."""
        self.count[a] += mask @ self.weight[b]
        if not same:
            self.count[b] += self.weight[a] @ mask
        label = np.arange(len(a))
        while True:  # components of the block
            by_col = np.where(mask, label[:, None], len(a)).min(axis=0)
            new = np.minimum(label, np.where(mask, by_col[None, :], len(a)).min(axis=1))
            if (new == label).all():
                break
            label = new
        for c in np.unique(label[mask.any(axis=1)]):
            self.join(np.concatenate([a[label == c], b[by_col == c]]))


class Traversal:
    """All links between two trees whose rows stand at ``off`` in the whole."""

    def __init__(self, links: _Links, off: tuple[int, int], cosine: float):
        self.links, self.off, self.cosine, self.r = links, off, cosine, math.sqrt(2 - 2 * cosine)

    def rows(self, t: Subtree, u: Subtree, same: bool, sure: bool = False) -> None:
        """Compares all vectors of two subtrees, or links them all."""
        for i in range(0, len(t.rows), TILE):
            for j in range(i if same else 0, len(u.rows), TILE):
                a, b = t.rows[i : i + TILE], u.rows[j : j + TILE]
                mask = np.ones((len(a), len(b)), bool) if sure else self.close(t.x[a], u.x[b])
                self.add(a, b, mask, same and i == j)

    def close(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        self.links.compared += len(x) * len(y)
        return x @ y.T >= self.cosine

    def add(self, a: np.ndarray, b: np.ndarray, mask: np.ndarray, diagonal: bool) -> None:
        if diagonal:
            np.fill_diagonal(mask, False)
        if mask.any():
            self.links.add(a + self.off[0], b + self.off[1], mask, diagonal)

    def open(self, t: Subtree, u: Subtree, same: bool) -> None:
        """The links between two subtrees of one level; ``same``: they are one."""
        if len(t.rows) * len(u.rows) <= SMALL or t.level + 1 == len(RADII):
            self.rows(t, u, same)
            return
        t.split()
        u.split()
        tiles = [(i, j) for i in range(0, len(t.sizes), TILE) for j in range(i if same else 0, len(u.sizes), TILE)]
        # opening pays only where it leaves fewer pairs than there are, each opened pair counting as SMALL of them
        left = 0
        for i, j in tiles:
            near, _, _ = self.near(t, u, i, j)
            left += int((near * (t.sizes[i : i + TILE, None] * u.sizes[None, j : j + TILE] + SMALL)).sum())
            if left >= len(t.rows) * len(u.rows):
                self.rows(t, u, same)
                return
        for i, j in tiles:
            self.tile(t, u, i, j, same)

    def near(self, t: Subtree, u: Subtree, i0: int, j0: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pairs of children that may hold a link and are not two single vectors, products of centres, sums of radii)."""
        here, there = slice(i0, i0 + TILE), slice(j0, j0 + TILE)
        dot, reach = t.heads[here] @ u.heads[there].T, t.radii[here][:, None] + u.radii[there][None, :]
        alone = (t.sizes[here] == 1)[:, None] & (u.sizes[there] == 1)[None, :]
        # distance <= reach + r, in terms of the product
        return (dot >= 1 - (reach + (self.r + EPS)) ** 2 / 2) & ~alone, dot, reach

    def tile(self, t: Subtree, u: Subtree, i0: int, j0: int, same: bool) -> None:
        near, dot, reach = self.near(t, u, i0, j0)
        self.links.compared += dot.size
        diagonal = same and i0 == j0
        # single vectors: the centres are all there is
        alone = (t.sizes[i0 : i0 + TILE] == 1)[:, None] & (u.sizes[j0 : j0 + TILE] == 1)[None, :]
        a, b = (v.sorted[v.bounds[k : min(k + TILE, len(v.sizes))]] for v, k in ((t, i0), (u, j0)))
        self.add(a, b, alone & (dot >= self.cosine), diagonal)
        for i, j in np.argwhere(near).tolist():
            if diagonal and i > j:
                continue
            one, k = diagonal and i == j, i + i0
            inside = 2 * t.radii[k] if one else math.sqrt(max(2 - 2 * dot[i, j], 0)) + reach[i, j]
            if inside < self.r - EPS:
                self.rows(t.child(k), u.child(j + j0), one, sure=True)
            else:
                self.open(t.child(k), u.child(j + j0), one)


def _pairs(dim: int, cosine: float, kind: type):
    """Of each task, the links of every vector that has any, and a vector of its component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task in runs(batches, "task"):
            node = task["node"].to_numpy()
            keys, x = task["key"].to_pylist(), unit(matrix(task["raw"], kind, dim))
            levels, weight = matrix(task["levels"], np.int32, len(RADII)), task["w"].to_numpy()
            cutoff = int(np.searchsorted(node, node[-1]))
            links = _Links(len(x), weight)
            if task["alone"][0].as_py():
                tree = Subtree(x, levels, np.arange(len(x)))
                Traversal(links, (0, 0), cosine).open(tree, tree, True)
            elif cutoff:
                one, other = Subtree(x[:cutoff], levels[:cutoff], np.arange(cutoff)), Subtree(x[cutoff:], levels[cutoff:], np.arange(len(x) - cutoff))
                Traversal(links, (0, cutoff), cosine).open(one, other, False)
            hit = np.flatnonzero(links.count)
            if len(hit):
                root = [keys[links.find(int(i))] for i in hit]
                yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i in hit], pa.binary()), pa.array(links.count[hit]), pa.array(root, pa.binary())], names=["u", "n", "v"])

    return run


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``df``; ``key`` is an integer column.

    Vectors that are null, empty, zero or hold null or non-finite components have no links and are their own
    component, as are vectors of a length that no other has. Equal vectors (repeated rows too) link with each other.
    The component is named by its smallest id; rows with a null id link like others. Other columns are left out; an
    empty table gives an empty result. Vectors of different lengths are never linked.
    """
    spark = df.sparkSession
    single = df.schema[vector].dataType == T.ArrayType(T.FloatType(), True) or df.schema[vector].dataType == T.ArrayType(T.FloatType(), False)
    kind = np.float32 if single else np.float64  # no wider than the vectors come, as they are shuffled
    rows = df.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<float>" if single else "array<double>"))
    rows = cut(rows.mapInArrow(_units(kind), "vec_id bigint, key binary, raw binary"), "units")
    own = rows.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("w"), F.first("raw").alias("raw"))
    own = cut(own, "vectors")
    size = F.octet_length("raw")
    found = [_links_of(own.where(size == b), b // np.dtype(kind).itemsize, cosine, kind) for (b,) in own.select(size).distinct().collect()]  # one row for each length
    if not found:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    links = cut(links, "vector-links")
    counts = links.groupBy(F.col("u").alias("key")).agg(F.sum("n").alias("n"))
    label = own.select("key", "low", "w").join(components(links.select("u", "v")).withColumnsRenamed({"u": "key", "v": "root"}), "key", "left").withColumn(
        "root",
        F.coalesce("root", "key"),
    )
    label = label.join(label.groupBy("root").agg(F.min("low").alias("component_id")), "root").join(counts, "key", "left")
    label = label.select("key", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "key").join(label, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"),
    )


def _links_of(own: DataFrame, dim: int, cosine: float, kind: type) -> DataFrame:
    """(u, n, v): links that a task found of a vector, and a vector of its component."""
    n = own.count()
    picked = own.select("key", "raw").orderBy(F.xxhash64(F.lit(9), "key"), "key").limit(min(PIVOTS, math.ceil(n / CELL))).collect()
    pivots = unit(np.stack([np.frombuffer(r.raw, kind) for r in picked]))
    cells = cut(own.select("key", "raw", "w").mapInArrow(_assign(pivots, kind), "key binary, raw binary, w bigint, cell int, far double"), "cells")
    sizes = {r.cell: (r.n, r.far) for r in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}  # one row for each pivot
    parts = {c: math.ceil(k / NODE) for c, (k, _) in sizes.items()}
    first, at = {}, 0
    for c in sorted(parts):
        first[c], at = at, at + parts[c]
    of = lambda d: F.element_at(F.create_map(*[F.lit(x) for c in d for x in (c, d[c])]), F.col("cell"))
    node = (of(first) + F.pmod(F.xxhash64(F.lit(8), "key"), of(parts))).cast("bigint").alias("node")
    grown = cells.select("key", "raw", "w", node).repartition("node").sortWithinPartitions("node", "key")
    grown = cut(grown.mapInArrow(_grow(dim, kind), "key binary, raw binary, w bigint, node bigint, levels binary"), "trees")
    r = math.sqrt(2 - 2 * cosine)
    ids = sorted(parts)
    radius = np.array([sizes[c][1] for c in ids])
    spans = [range(first[c], first[c] + parts[c]) for c in ids]
    centre = pivots[ids]
    total = at

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = _distance(unit(matrix(pa.chunked_array([batch.column("raw")]), kind, dim)), centre) <= radius + (r + EPS)
            owner = batch.column("node").to_numpy()
            row, task = [], []
            for k in range(batch.num_rows):
                mine = int(owner[k])
                to = {mine, *(x for c in np.flatnonzero(near[k]) for x in spans[c])}
                row += [k] * len(to)
                task += [min(mine, x) * total + max(mine, x) for x in to]
            names = ["key", "raw", "w", "node", "levels"]
            taken = [batch.column(c).take(pa.array(row)) for c in names]
            t = np.array(task, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(t // total == t % total), *taken], names=["task", "alone", *names])

    dealt = grown.mapInArrow(deal, "task bigint, alone boolean, key binary, raw binary, w bigint, node bigint, levels binary")
    dealt = dealt.repartition("task").sortWithinPartitions("task", "node", "key")
    return dealt.mapInArrow(_pairs(dim, cosine, kind), "u binary, n bigint, v binary")


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all vectors."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
