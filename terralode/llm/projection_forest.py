"""Near-duplicate vectors by a forest of random-projection trees with spill.

Trees are fitted on a bounded sample: each node splits where a random projection is
thinnest, and stays whole where all are crowded. A vector near a split goes to both
sides, by a margin that follows from the threshold and the vectors' length, and trees
are added until sampled pairs at the threshold share a leaf as often as asked. Vectors are compared within leaves only, in double precision. A large
leaf is cut into blocks and every pair of blocks is a task's work, so no pair is
lost and no task grows with the leaf. Pairs are counted where they are found, in the
first leaf they share, and never written out.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from terralode.llm.common import saved
from terralode.llm.components import connected_components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LINKED = "id bigint, links bigint, root bigint"
LEAF_BITS = 32
RECALL, MAX_TREES = 0.97, 24  # of probe pairs, so that 0.95 stands beyond their chance
CROWDED = 0.45  # the share of points near a split from which on a node stays whole
CUTS = np.linspace(0.25, 0.75, 11)


@dataclass
class Node:
    """A split, or a leaf if ``normal`` is None."""

    leaf: int = 0
    normal: np.ndarray | None = None
    at: float = 0.0
    low: Node | None = None
    high: Node | None = None


def spacing(threshold: float, dim: int) -> float:
    """Standard deviation of what a random projection leaves of the distance of two unit vectors at the threshold."""
    return float(np.sqrt(max(0.0, 2 - 2 * threshold) / dim))


def cut(points: np.ndarray, reach: float, rng: np.random.Generator, tries: int = 4) -> tuple[float, np.ndarray, float]:
    """The share of points within ``reach`` of the best split found, by what the split tells, its normal and place."""
    best = (np.inf, np.zeros(points.shape[1]), 0.0)
    for normal in rng.normal(size=(tries, points.shape[1])):
        normal = normal / np.linalg.norm(normal)
        along = np.sort(points @ normal)
        for at in np.quantile(along, CUTS):
            below = np.searchsorted(along, at) / len(along)
            if 0 < below < 1:
                told = -below * np.log2(below) - (1 - below) * np.log2(1 - below)
                near = (np.searchsorted(along, at + reach) - np.searchsorted(along, at - reach)) / len(along)
                if near / told < best[0]:
                    best = (near / told, normal, float(at))
    return best


def grow(points: np.ndarray, leaf_size: int, rng: np.random.Generator, leaves: list[int], reach: float, depth: int = 40) -> Node:
    if len(points) > leaf_size and depth:
        crowd, normal, at = cut(points, reach, rng)
        # Where most pairs are about as near as the threshold, a split would part what is to be counted.
        if crowd < CROWDED:
            low = points @ normal < at
            return Node(0, normal, at, grow(points[low], leaf_size, rng, leaves, reach, depth - 1), grow(points[~low], leaf_size, rng, leaves, reach, depth - 1))
    leaves.append(len(leaves))
    return Node(leaf=leaves[-1])


def probes(points: np.ndarray, threshold: float, rng: np.random.Generator, size: int = 2000) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs to judge a forest by: at the threshold in any direction, towards other vectors, and the widest pairs there are."""
    asked = points[rng.permutation(len(points))[:size]]
    asked = asked[np.arange(size) % len(asked)]
    found = []
    for towards in (rng.normal(size=asked.shape), points[rng.integers(0, len(points), size)]):
        across = towards - (towards * asked).sum(axis=1, keepdims=True) * asked
        norm = np.linalg.norm(across, axis=1)
        across = across[norm > 1e-9] / norm[norm > 1e-9, None]
        mine = asked[norm > 1e-9]
        found.append((mine, threshold * mine + np.sqrt(max(0.0, 1 - threshold**2)) * across))
    near = []
    for begin in range(0, size, 500):
        cosine = asked[begin : begin + 500] @ points.T
        cosine[cosine < threshold] = np.inf
        widest = cosine.argmin(axis=1)
        near += [(begin + i, j) for i, j in enumerate(widest) if cosine[i, j] < 1 - 1e-9]
    if len(near) >= 30:
        found.append((asked[[i for i, _ in near]], points[[j for _, j in near]]))
    return [pair for pair in found if len(pair[0])]


def together(node: Node, a: np.ndarray, b: np.ndarray, rows: np.ndarray, spill: float, out: np.ndarray) -> None:
    """Marks the rows whose two vectors share a leaf."""
    rows = rows[~out[rows]]
    if not len(rows):
        return
    if node.normal is None:
        out[rows] = True
        return
    x, y = a[rows] @ node.normal, b[rows] @ node.normal
    together(node.low, a, b, rows[np.maximum(x, y) < node.at + spill], spill, out)
    together(node.high, a, b, rows[np.minimum(x, y) >= node.at - spill], spill, out)


def fitted(points: np.ndarray, per_leaf: int, threshold: float, spill: float, trees: int | None, seed: int) -> list[Node]:
    """``trees`` trees, or as many as it takes for every kind of probe to share a leaf with a chance of ``RECALL``.

    Where ``MAX_TREES`` do not bring it, leaves grow until they do, in the end to the whole table.
    """
    reach = spacing(threshold, points.shape[1]) / 2
    judged = probes(points, threshold, np.random.default_rng([seed, 1 << 20]))
    while True:
        forest: list[Node] = []
        shared = [np.zeros(len(a), bool) for a, _ in judged]
        for t in range(MAX_TREES if trees is None else trees):
            forest.append(grow(points, per_leaf, np.random.default_rng([seed, t]), [], reach))
            for (a, b), out in zip(judged, shared):
                together(forest[-1], a, b, np.arange(len(a)), spill, out)
            if trees is None and all(out.mean() >= RECALL for out in shared):
                return forest
        if trees is not None:
            return forest
        per_leaf *= 2


def place(node: Node, points: np.ndarray, rows: np.ndarray, spill: float, out: list[tuple[np.ndarray, int]]) -> None:
    if not len(rows):
        return
    if node.normal is None:
        out.append((rows, node.leaf))
        return
    along = points[rows] @ node.normal
    place(node.low, points, rows[along < node.at + spill], spill, out)
    place(node.high, points, rows[along >= node.at - spill], spill, out)


def unit_rows(column: pa.Array, dim: int) -> np.ndarray:
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)
    # By the largest component first, so that squares neither vanish nor overflow.
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def leaf_lister(forest):
    """Adds to each vector the sorted list of its leaves, by tree, vector length and leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = forest.value
        for batch in batches:
            column = batch.column(2)
            dims = np.diff(column.offsets.to_numpy())
            leaves: list[list[int]] = [[] for _ in range(batch.num_rows)]
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                points = unit_rows(column.take(pa.array(rows)), int(dim))
                spill, grown = trees.get(int(dim), (0.0, [Node()]))
                for t, tree in enumerate(grown):
                    found: list[tuple[np.ndarray, int]] = []
                    place(tree, points, np.arange(len(rows)), spill, found)
                    for own, leaf in found:
                        for r in own.tolist():
                            leaves[rows[r]].append(t << LEAF_BITS + 16 | int(dim) << LEAF_BITS | leaf)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([sorted(x) for x in leaves], pa.list_(pa.int64()))], names=[*batch.schema.names, "leaves"])

    return run


def first_shared(leaves: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest leaf that rows i and j of sorted, padded lists share."""
    found = np.full(len(i), -1, np.int64)
    rest = np.arange(len(i))
    for k in range(leaves.shape[1]):
        mine = leaves[i[rest], k]
        hit = np.zeros(len(rest), bool)
        for m in range(leaves.shape[1]):
            hit |= (leaves[j[rest], m] == mine) & (mine >= 0)
        found[rest[hit]] = mine[hit]
        rest = rest[~hit]
        if not len(rest):
            break
    return found


def share_before(a: np.ndarray, b: np.ndarray, leaf: int) -> np.ndarray:
    """Whether rows of two tables of leaves share one smaller than ``leaf``, for all rows at once."""
    known = np.intersect1d(a[(a >= 0) & (a < leaf)], b[(b >= 0) & (b < leaf)])
    sides = []
    for own in (a, b):
        row, column = np.nonzero(np.isin(own, known))
        side = np.zeros((len(own), len(known)), np.float32)
        side[row, np.searchsorted(known, own[row, column])] = 1
        sides.append(side)
    return sides[0] @ sides[1].T > 0


def comparer(threshold: float, tile: int = 512):
    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        leaf, low, high = (k.as_py() for k in key)
        table = table.combine_chunks()
        ids, counts, block = (table.column(c).to_numpy() for c in ("id", "copies", "block"))
        column = table.column("embedding").chunk(0) if table.num_rows else pa.array([], pa.list_(pa.float32()))
        points = unit_rows(column, len(column[0]))
        lists = table.column("leaves").to_pylist()
        leaves = np.full((len(lists), max(map(len, lists))), -1, np.int64)
        for r, own in enumerate(lists):
            leaves[r, : len(own)] = own
        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        order = np.argsort(ids, kind="stable")
        ids, counts, block, points, leaves = ids[order], counts[order], block[order], points[order], leaves[order]
        near_i, near_j = [], []
        for a in range(0, len(ids), tile):
            for b in range(a, len(ids), tile):
                i, j = np.nonzero(points[a : a + tile] @ points[b : b + tile].T >= threshold)
                i, j = i + a, j + b
                keep = (i < j) & ((low == high) | (block[i] != block[j]))
                i, j = i[keep], j[keep]
                if len(i) > tile * tile // 50:
                    mine = ~share_before(leaves[a : a + tile], leaves[b : b + tile], leaf)[i - a, j - b]
                else:
                    mine = first_shared(leaves, i, j) == leaf
                i, j = i[mine], j[mine]
                np.add.at(links, i, counts[j])
                np.add.at(links, j, counts[i])
                near_i.append(i.astype(np.int32))
                near_j.append(j.astype(np.int32))
        i, j = np.concatenate(near_i), np.concatenate(near_j)
        while len(i):  # the smallest row reachable within this group
            lower = np.minimum(root[i], root[j])
            if (root[i] == lower).all() and (root[j] == lower).all():
                break
            np.minimum.at(root, i, lower)
            np.minimum.at(root, j, lower)
            root = root[root]
        keep = links > 0
        return pa.table({"id": ids[keep], "links": links[keep], "root": ids[root[keep]]})

    return compare


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.9,
    trees: int | None = None,
    leaf_size: int = 512,
    spill: float | None = None,
    sample_rows: int = 20_000,
    block_rows: int = 2048,
    seed: int = 11,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vec_id, embedding``.

    Vectors with a cosine of ``threshold`` or more are linked where the forest finds
    them, none below it. Null, empty and zero vectors and those with null or non-finite
    components are linked with nothing, nor are vectors of different lengths. Equal
    vectors are one class, compared once, with all their links counted. A row without
    vec_id takes no part: no links, null component, kept. Labels are not looked at.

    The trees are fitted on ``sample_rows`` vectors in the order of a hash; every
    vector is placed in every tree. ``spill`` and ``trees`` follow from the threshold
    and the sample unless given, whatever the table's size (``fitted``). For more vectors than ``sample_rows`` can split
    down to ``leaf_size`` a leaf, raise ``sample_rows``; larger leaves stay right.
    """
    spark = vectors.sparkSession
    element = vectors.schema["embedding"].dataType.elementType.simpleString()
    kind = element if element in ("float", "double") else "double"
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = finite & F.exists("embedding", lambda x: x != 0)
    sound = rows.where(F.col("vec_id").isNotNull() & F.coalesce(usable, F.lit(False)))
    classes = saved(sound.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")).select("id", "copies", "embedding"), "vectors")
    total = classes.count()
    sample = classes.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("embedding").toArrow().column(0).combine_chunks()
    forest: dict[int, tuple[float, list[Node]]] = {}
    if len(sample):
        sample = sample.chunk(0) if isinstance(sample, pa.ChunkedArray) else sample
        dims = np.diff(sample.offsets.to_numpy())
        per_leaf = max(8, round(leaf_size * len(sample) / max(1, total)))
        for dim in np.unique(dims):
            points = unit_rows(sample.take(pa.array(np.flatnonzero(dims == dim))), int(dim))
            width = spacing(threshold, int(dim)) / 4 if spill is None else spill
            forest[int(dim)] = (width, fitted(points, per_leaf, threshold, width, trees, seed))
    shared = spark.sparkContext.broadcast(forest)
    placed = classes.mapInArrow(leaf_lister(shared), f"id bigint, copies bigint, embedding array<{kind}>, leaves array<bigint>")
    placed = saved(placed, "placed")
    in_leaf = placed.withColumn("leaf", F.explode("leaves"))
    sizes = placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / block_rows).cast("int")
    dealt = (
        in_leaf.join(sizes, "leaf")
        .withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("leaf", F.least("block", "other").alias("b0"), F.greatest("block", "other").alias("b1"), "id", "copies", "embedding", "leaves", "block")
    )
    found = saved(dealt.groupBy("leaf", "b0", "b1").applyInArrow(comparer(threshold), LINKED), "near")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = classes.join(links, "id", "left").join(groups, "id", "left")
    named = named.select("embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "id").alias("component"))
    alone = rows.where(~(F.col("vec_id").isNotNull() & F.coalesce(usable, F.lit(False))))
    out = sound.join(named, "embedding").select("vec_id", F.col("links").cast("bigint").alias("n_links"), F.col("component").alias("component_id"))
    out = out.union(alone.select("vec_id", F.lit(0).cast("bigint"), "vec_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
