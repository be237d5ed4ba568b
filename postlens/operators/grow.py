"""Growing a forest over a whole table: large nodes by counting, the rest of each tree where its rows meet.

A node with many rows is split from sums that every task takes of its own rows, one pass for a level of
all trees; those of a leaf follow from its parent's. As soon as a node has few enough rows, they meet in one group, which grows the tree from
there on. So a row travels once for each tree, no task holds more than ``GROUP_ROWS`` rows of a tree,
and no sums of small nodes, of which a forest has millions, are sent around. Splits, impurities, ties
and pruning are those of ``pyspark.ml``, and the result is one of its models.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.ml.wrapper import JavaModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialize, temporary_tables

FEATURES, LABEL, WEIGHT, COUNTS, DRAW = "features", "_label", "_weight", "_counts", "_draw"
# Rows of a tree, repeats counted, that one task grows by itself.
GROUP_ROWS = 200_000
# Sums that a task holds for one pass over its rows, and (node, feature) pairs of one step of a group.
PASS_SUMS, STEP_PAIRS = 16_000_000, 1_000_000
_EPSILON = 2.0**-52
_NODE = "tree int, id long, feature int, present_left boolean, gain double, impurity double, stats array<double>, n long"
_ARROW = pa.schema(
    [("tree", pa.int32()), ("id", pa.int64()), ("feature", pa.int32()), ("present_left", pa.bool_()), ("gain", pa.float64()),
     ("impurity", pa.float64()), ("stats", pa.list_(pa.float64())), ("n", pa.int64())]
)


@dataclass(frozen=True)
class Growth:
    """What a forest is grown by. ``classes`` is 0 for a forest of numbers, ``tried`` the number of
    features that a node may use, ``rate`` the mean number of times a tree draws a row, or None."""

    trees: int
    depth: int
    seed: int
    features: int
    classes: int
    tried: int
    rate: float | None
    group_rows: int = GROUP_ROWS


@dataclass
class _Rows:
    """Rows of one tree: features as bits, sums to add for each, how often each counts."""

    bits: np.ndarray
    sums: np.ndarray


def poisson_steps(mean: float = 1.0) -> list[int]:
    """The 32-bit numbers from which on a draw counts 1, 2, 3 and so on times."""
    out, share, total = [], math.exp(-mean), math.exp(-mean)
    while (step := math.floor(total * 2**32)) < 2**32 - 1:
        out.append(step)
        share *= mean / len(out)
        total += share
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    """Numbers that look random, from 64-bit ones."""
    x = np.asarray(x, np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _seed(g: Growth, tree: int, use: int) -> np.ndarray:
    return _mixed(_mixed(np.array([(g.seed & 0xFFFFFFFF) * 4 + use], np.uint64)) + np.uint64(tree))


def _impurity(stats: np.ndarray, classes: int) -> np.ndarray:
    """Gini impurity or variance of sums (..., [weight of each class | weight, sum, squares], rows)."""
    with np.errstate(divide="ignore", invalid="ignore"):
        if not classes:
            w, s, q = stats[..., 0], stats[..., 1], stats[..., 2]
            return np.where(w == 0, 0.0, (q - s * s / w) / w)
        w = stats[..., :classes].sum(-1)
        out = np.ones(w.shape)
        for c in range(classes):
            out -= (stats[..., c] / w) ** 2
        return np.where(w == 0, 0.0, out)


def _weight(stats: np.ndarray, classes: int) -> np.ndarray:
    return stats[..., :classes].sum(-1) if classes else stats[..., 0]


def _best(present: np.ndarray, total: np.ndarray, allowed: np.ndarray, classes: int):
    """(feature or -1, whether those that have it go left, gain) for each node, from the sums (node,
    feature, sum) of the rows that have the feature and those of the whole node."""
    absent = total[:, None, :] - present
    with np.errstate(divide="ignore", invalid="ignore"):
        if classes > 2:
            first = np.zeros(present.shape[:2], bool)
        elif classes == 2:
            first = present[..., 1] < absent[..., 1]
        else:
            # The lower mean goes left.
            first = present[..., 1] / present[..., 0] < absent[..., 1] / absent[..., 0]
    left = np.where(first[..., None], present, absent)
    right = np.where(first[..., None], absent, present)
    whole = np.maximum(_weight(total, classes), np.finfo(float).tiny)[:, None]
    gain = (
        _impurity(total, classes)[:, None]
        - _weight(left, classes) / whole * _impurity(left, classes)
        - _weight(right, classes) / whole * _impurity(right, classes)
    )
    gain[~allowed | (left[..., -1] < 1) | (right[..., -1] < 1)] = -np.inf
    best = gain.argmax(1)
    at = np.arange(len(best))
    found = gain[at, best] > 0
    return np.where(found, best, -1), first[at, best] & found, np.where(found, gain[at, best], -1.0)


def _allowed(g: Growth, tree: int, ids: np.ndarray) -> np.ndarray:
    """The features that each node may use, drawn by a hash of the node's place in its tree."""
    if g.tried >= g.features:
        return np.ones((len(ids), g.features), bool)
    order = _mixed(_mixed(ids.astype(np.uint64) ^ _seed(g, tree, 1))[:, None] + np.arange(g.features, dtype=np.uint64))
    return order <= np.partition(order, g.tried - 1, axis=1)[:, g.tried - 1 : g.tried]


def _has(bits: np.ndarray, rows: np.ndarray, feature: np.ndarray) -> np.ndarray:
    return (bits[rows, feature >> 3] >> (7 - (feature & 7)).astype(np.uint8)) & 1 > 0


def _ones(bits: np.ndarray, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Features that the rows have, one after the other, and the place where each row begins."""
    step = max(1, STEP_PAIRS * 4 // features)
    rows, found = [], []
    for i in range(0, len(bits), step):
        row, which = np.nonzero(np.unpackbits(bits[i : i + step], axis=1, count=features))
        rows.append(row + i)
        found.append(which.astype(np.int32))
    counts = np.bincount(np.concatenate(rows), minlength=len(bits))
    return np.concatenate(found), np.concatenate([[0], np.cumsum(counts)])


def _present(node: np.ndarray, rows: np.ndarray, nodes: int, ones, sums: np.ndarray, features: int) -> np.ndarray:
    """Sums (node, feature, sum) of the rows that have the feature; ``rows`` stand in ``node``."""
    found, begin = ones
    many = begin[rows + 1] - begin[rows]
    ends = np.cumsum(many)
    row = np.repeat(rows, many)
    where = np.arange(len(row)) + np.repeat(begin[rows] - (ends - many), many)
    key = np.repeat(node.astype(np.int64) * features, many) + found[where]
    out = [np.bincount(key, weights=sums[row, s], minlength=nodes * features) for s in range(sums.shape[1])]
    return np.stack(out, -1).reshape(nodes, features, -1)


def _table(tree: int, parts: list[tuple]) -> pa.Table:
    """Node rows from (id, feature, present_left, gain, impurity, sums) arrays."""
    ids, feature, left, gain, impurity, sums = (np.concatenate(x) for x in zip(*parts))
    stats = np.ascontiguousarray(sums[:, :-1])
    offsets = np.arange(len(stats) + 1, dtype=np.int32) * stats.shape[1]
    columns = [
        pa.array(np.full(len(ids), tree, np.int32)), pa.array(ids.astype(np.int64)), pa.array(feature.astype(np.int32)),
        pa.array(left.astype(bool)), pa.array(gain), pa.array(impurity),
        pa.ListArray.from_arrays(pa.array(offsets), pa.array(stats.ravel())), pa.array(sums[:, -1].astype(np.int64)),
    ]
    return pa.Table.from_arrays(columns, schema=_ARROW)


def _grown(g: Growth, tree: int, root: int, data: _Rows) -> pa.Table:
    """The part of ``tree`` below the node ``root``, level by level."""
    ones = _ones(data.bits, g.features)
    ids, rows = np.array([root], np.int64), np.arange(len(data.bits))
    node = np.zeros(len(rows), np.int64)
    out = []
    for depth in range(root.bit_length() - 1, g.depth + 1):
        m = len(ids)
        total = np.stack([np.bincount(node, weights=data.sums[rows, s], minlength=m) for s in range(data.sums.shape[1])], -1)
        impurity = _impurity(total, g.classes)
        feature, left, gain = np.full(m, -1), np.zeros(m, bool), np.full(m, -1.0)
        open_ = np.flatnonzero((np.abs(impurity) >= _EPSILON) & (depth < g.depth))
        if len(open_):
            order = np.argsort(node, kind="stable")
            rows, node = rows[order], node[order]
            step = max(1, STEP_PAIRS // g.features)
            for i in range(0, len(open_), step):
                part = open_[i : i + step]
                place = np.full(m, -1)
                place[part] = np.arange(len(part))
                low, high = np.searchsorted(node, [part[0], part[-1] + 1])
                here = place[node[low:high]]
                inside = here >= 0
                sums = _present(here[inside], rows[low:high][inside], len(part), ones, data.sums, g.features)
                feature[part], left[part], gain[part] = _best(sums, total[part], _allowed(g, tree, ids[part]), g.classes)
        out.append((ids, feature, left, gain, impurity, total))
        split = np.flatnonzero(feature >= 0)
        if not len(split):
            break
        place = np.full(m, -1)
        place[split] = np.arange(len(split))
        going = place[node] >= 0
        rows, node = rows[going], node[going]
        # The left child of node i is 2 i, the right one 2 i + 1.
        right = _has(data.bits, rows, feature[node]) != left[node]
        node = 2 * place[node] + right
        ids = (2 * ids[split][:, None] + np.arange(2)).ravel()
    return _table(tree, out)


def _walked(tops: dict, tree: int, bits: np.ndarray, depth: int) -> np.ndarray:
    """Node of each row below the splits that ``tree`` has so far."""
    at = np.ones(len(bits), np.int64)
    if tree not in tops:
        return at
    ids, feature, left = tops[tree]
    rows = np.arange(len(bits))
    for _ in range(depth):
        where = np.minimum(np.searchsorted(ids, at[rows]), len(ids) - 1)
        inner = ids[where] == at[rows]
        rows, where = rows[inner], where[inner]
        if not len(rows):
            break
        at[rows] = 2 * at[rows] + (_has(bits, rows, feature[where]) != left[where])
    return at


def _samples(g: Growth, batch: pa.RecordBatch, trees: Iterable[int]) -> Iterator[tuple[int, _Rows]]:
    """The rows of a batch that each of ``trees`` draws, with what they add to the sums of a node."""
    n, width = batch.num_rows, (g.features + 7) // 8
    bits = np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint8).reshape(n, width)
    label, weight = batch.column(LABEL).to_numpy(), batch.column(WEIGHT).to_numpy()
    fixed = batch.column(COUNTS).flatten().to_numpy().reshape(n, g.trees) if COUNTS in batch.schema.names else None
    draw = batch.column(DRAW).to_numpy().view(np.uint64)
    steps = None if g.rate is None else np.array(poisson_steps(g.rate), np.uint64)
    for tree in trees:
        if fixed is not None:
            count = fixed[:, tree].astype(float)
        elif steps is not None:
            count = np.searchsorted(steps, _mixed(draw ^ _seed(g, tree, 0)) >> np.uint64(32), side="right").astype(float)
        else:
            count = np.ones(n)
        drawn = np.flatnonzero(count)
        w, y = (count * weight)[drawn], label[drawn]
        kinds = [np.where(y == c, w, 0.0) for c in range(g.classes)] if g.classes else [w, w * y, w * y * y]
        yield tree, _Rows(bits[drawn], np.stack([*kinds, count[drawn]], -1))


def _summed(g: Growth, shared):
    """Task: for each open node the sums of its rows, of all and by feature."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops, front, depth = shared.value
        held = {}
        for batch in batches:
            for tree, data in _samples(g, batch, front) if batch.num_rows else ():
                ids = front[tree]
                at = _walked(tops, tree, data.bits, depth)
                where = np.minimum(np.searchsorted(ids, at), len(ids) - 1)
                rows = np.flatnonzero(ids[where] == at)
                if not len(rows):
                    continue
                node, m = where[rows], len(ids)
                total = np.stack([np.bincount(node, weights=data.sums[rows, s], minlength=m) for s in range(data.sums.shape[1])], -1)
                sums = _present(node, rows, m, _ones(data.bits, g.features), data.sums, g.features)
                both = np.concatenate([total[:, None, :], sums], 1)
                held[tree] = held[tree] + both if tree in held else both
        rows = [(tree, int(i), sums.tobytes()) for tree, each in held.items() for i, sums in zip(front[tree], each)]
        columns = list(zip(*rows)) or [(), (), ()]
        types = (pa.int32(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["tree", "id", "sums"])

    return run


def _chosen(g: Growth):
    """Group of the sums that the tasks have found for one node: the node's row, and those of its followers
    if these are as deep as the tree may be, so leaves."""

    def run(table: pa.Table) -> pa.Table:
        tree, node = table["tree"][0].as_py(), np.array([table["id"][0].as_py()], np.int64)
        sums = sum(np.frombuffer(x, float) for x in table["sums"].to_pylist()).reshape(g.features + 1, -1)
        total = sums[:1]
        impurity = _impurity(total, g.classes)
        feature, left, gain = _best(sums[None, 1:], total, _allowed(g, tree, node), g.classes)
        depth = int(node[0]).bit_length() - 1
        if abs(impurity[0]) < _EPSILON or depth >= g.depth:
            feature, left, gain = np.array([-1]), np.array([False]), np.array([-1.0])
        parts = [(node, feature, left, gain, impurity, total)]
        present = sums[1 + feature[0]] if feature[0] >= 0 else np.zeros(sums.shape[1])
        if feature[0] >= 0 and depth + 1 == g.depth:
            sides = np.stack([present, total[0] - present][:: 1 if left[0] else -1])
            parts.append((2 * node[0] + np.arange(2), np.full(2, -1), np.zeros(2, bool), np.full(2, -1.0), _impurity(sides, g.classes), sides))
        out = _table(tree, parts)
        return out.append_column("present_n", pa.array([int(present[-1])] * len(out), pa.int64()))

    return run


def _dealt(g: Growth, shared):
    """Task: the rows of each node that a group goes on with, packed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops, front, depth = shared.value
        for batch in batches:
            out = []
            for tree, data in _samples(g, batch, front) if batch.num_rows else ():
                at = _walked(tops, tree, data.bits, depth)
                rows = np.flatnonzero(np.isin(at, front[tree]))
                rows = rows[np.argsort(at[rows], kind="stable")]
                ids, begin = np.unique(at[rows], return_index=True)
                for i, part in zip(ids, np.split(rows, begin[1:])):
                    out.append((tree, int(i), data.bits[part].tobytes(), data.sums[part].tobytes()))
            columns = list(zip(*out)) or [(), (), (), ()]
            types = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["tree", "id", "bits", "sums"])

    return run


def _finished(g: Growth):
    def run(table: pa.Table) -> pa.Table:
        tree, root = table["tree"][0].as_py(), table["id"][0].as_py()
        bits = np.frombuffer(b"".join(table["bits"].to_pylist()), np.uint8).reshape(-1, (g.features + 7) // 8)
        sums = np.frombuffer(b"".join(table["sums"].to_pylist()), float).reshape(len(bits), -1)
        return _grown(g, tree, root, _Rows(bits, sums))

    return run


def _packed(features: int, names: list[str]):
    """Task: the features that each row has as bits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owned, n = batch.column("owned"), batch.num_rows
            has = np.zeros((n, features), bool)
            many = owned.value_lengths().to_numpy(zero_copy_only=False)
            has[np.repeat(np.arange(n), many), owned.flatten().to_numpy()] = True
            packed = np.packbits(has, axis=1)
            bits = pa.array([x.tobytes() for x in packed], pa.binary())
            yield pa.RecordBatch.from_arrays([bits, *[batch.column(x) for x in names]], names=["bits", *names])

    return run


def _stored(rows: DataFrame, features: int) -> DataFrame:
    dense = vector_to_array(FEATURES)
    owned = F.filter(F.transform(dense, lambda v, i: F.when(v > 0, i)), lambda i: i.isNotNull())
    names = [LABEL, WEIGHT, DRAW, *([COUNTS] if COUNTS in rows.columns else [])]
    schema = f"bits binary, {LABEL} double, {WEIGHT} double, {DRAW} long" + (f", {COUNTS} array<int>" if COUNTS in rows.columns else "")
    return materialize(rows.select(owned.alias("owned"), *names).mapInArrow(_packed(features, names), schema), "packed_rows")


def _numbered(g: Growth):
    """Group of one tree: leaves of one answer below one node become one leaf, and nodes get numbers from
    the root on, each before those below it."""

    def run(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, [("id", "ascending"), ("n", "descending")]))
        ids = table["id"].to_numpy()
        # A tree that has drawn nothing is the one row of zeros that every tree gets.
        table = table.take(pa.array(np.unique(ids, return_index=True)[1]))
        ids, feature = table["id"].to_numpy(), table["feature"].to_numpy().copy()
        stats = table["stats"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        if g.classes:
            value = stats.argmax(1).astype(float)
        else:
            value = np.divide(stats[:, 1], stats[:, 0], out=np.zeros(len(ids)), where=stats[:, 0] != 0)
        n = len(ids)
        left = np.minimum(np.searchsorted(ids, 2 * ids), n - 1)
        right = left + 1
        size = np.ones(n, np.int64)
        alive = np.ones(n, bool)
        level = np.frexp(ids.astype(float))[1]
        for depth in range(int(level[-1]), 0, -1):
            here = np.flatnonzero((level == depth) & (feature >= 0))
            a, b = left[here], right[here]
            same = (feature[a] < 0) & (feature[b] < 0) & (value[a] == value[b])
            feature[here[same]] = -1
            alive[a[same]] = alive[b[same]] = False
            inner = here[~same]
            size[inner] = 1 + size[left[inner]] + size[right[inner]]
        number = np.zeros(n, np.int64)
        for depth in range(1, int(level[-1])):
            here = np.flatnonzero((level == depth) & (feature >= 0) & alive)
            number[left[here]] = number[here] + 1
            number[right[here]] = number[here] + 1 + size[left[here]]
        leaf = feature < 0
        present_left = table["present_left"].to_numpy()
        columns = {
            "treeID": table["tree"].to_numpy(),
            "id": number.astype(np.int32),
            "prediction": value,
            "impurity": table["impurity"].to_numpy(),
            "rawCount": table["n"].to_numpy(),
            "gain": np.where(leaf, -1.0, table["gain"].to_numpy()),
            "leftChild": np.where(leaf, -1, number[left]).astype(np.int32),
            "rightChild": np.where(leaf, -1, number[np.minimum(right, n - 1)]).astype(np.int32),
            "feature": feature.astype(np.int32),
            "category": np.where(leaf, -1.0, present_left.astype(float)),
        }
        out = pa.table({k: pa.array(v) for k, v in columns.items()}).append_column("stats", table["stats"].combine_chunks())
        return out.filter(pa.array(alive))

    return run


_NUMBERED = (
    "treeID int, id int, prediction double, impurity double, rawCount long, gain double, leftChild int, rightChild int, feature int,"
    " category double, stats array<double>"
)


def _tops(found: dict[int, list[dict]]) -> dict:
    """Splits by tree as arrays, in the order of the nodes' numbers."""
    out = {}
    for tree, nodes in found.items():
        inner = sorted((r["id"], r["feature"], r["present_left"]) for r in nodes if r["feature"] >= 0)
        if inner:
            ids, feature, left = zip(*inner)
            out[tree] = (np.array(ids, np.int64), np.array(feature, np.int64), np.array(left, bool))
    return out


@dataclass
class _Front:
    """Nodes that are still to be split, by tree: large ones by counting, others by a group."""

    large: dict[int, list[int]] = field(default_factory=dict)
    small: dict[int, list[int]] = field(default_factory=dict)

    def add(self, g: Growth, tree: int, node: int, rows: int) -> None:
        side = self.large if rows > g.group_rows else self.small
        side.setdefault(tree, []).append(node)


def _parts(front: dict[int, list[int]], most: int) -> Iterator[dict[int, np.ndarray]]:
    """``front`` in parts of ``most`` nodes."""
    pairs = [(tree, node) for tree, nodes in front.items() for node in sorted(nodes)]
    for i in range(0, len(pairs), most):
        part: dict[int, list[int]] = {}
        for tree, node in pairs[i : i + most]:
            part.setdefault(tree, []).append(node)
        yield {tree: np.array(nodes, np.int64) for tree, nodes in part.items()}


def _nodes(rows: DataFrame, g: Growth) -> DataFrame:
    spark = rows.sparkSession
    # How many rows a tree draws is known from its first level on; until then, all might be drawn.
    large = rows.count() > g.group_rows
    front = _Front(large={t: [1] for t in range(g.trees)}) if large else _Front(small={t: [1] for t in range(g.trees)})
    found: dict[int, list[dict]] = {}
    width = (g.features + 1) * (max(g.classes, 3) + 1)
    while front.large:
        tops, later = _tops(found), _Front(small=front.small)
        for part in _parts(front.large, max(1, PASS_SUMS // width)):
            shared = spark.sparkContext.broadcast((tops, part, g.depth))
            sums = rows.mapInArrow(_summed(g, shared), "tree int, id long, sums binary")
            chosen = sums.groupBy("tree", "id").applyInArrow(_chosen(g), f"{_NODE}, present_n long").toArrow().to_pylist()
            shared.unpersist()
            for r in chosen:
                present = r.pop("present_n")
                found.setdefault(r["tree"], []).append(r)
                # Rows of nodes as deep as the tree may be go nowhere, however many they are.
                if r["feature"] >= 0 and r["id"].bit_length() < g.depth:
                    below = (present, r["n"] - present) if r["present_left"] else (r["n"] - present, present)
                    for i in (0, 1):
                        later.add(g, r["tree"], 2 * r["id"] + i, below[i])
        front = later
    empty = {"feature": -1, "id": 1, "present_left": False, "gain": -1.0, "impurity": -1.0, "stats": [0.0] * (g.classes or 3), "n": 0}
    known = [r for nodes in found.values() for r in nodes] + [{"tree": t, **empty} for t in range(g.trees)]
    nodes = spark.createDataFrame(pa.Table.from_pylist(known, schema=_ARROW))
    if front.small:
        groups = sum(len(x) for x in front.small.values())
        small = {tree: np.array(sorted(x), np.int64) for tree, x in front.small.items()}
        shared = spark.sparkContext.broadcast((_tops(found), small, g.depth))
        dealt = rows.mapInArrow(_dealt(g, shared), "tree int, id long, bits binary, sums binary")
        # Few bytes are much work here, so tasks are not joined by their size.
        spread = dealt.repartition(min(2 * groups, 4000), "tree", "id")
        nodes = nodes.unionByName(spread.groupBy("tree", "id").applyInArrow(_finished(g), _NODE))
    return materialize(nodes, "grown_nodes")


def grow(rows: DataFrame, features: int, begun: Callable[[float], tuple[Growth, JavaModel]], path: str) -> None:
    """Saves, below ``path``, the forest of ``rows`` (features, label, weight, a number to draw by and perhaps
    how often each tree counts the row) as ``pyspark.ml`` does.

    ``begun`` tells, for the largest label, what to grow by and a forest of the same sizes, fitted on
    anything, from which all but the nodes is taken. The nodes never pass through the driver.
    """
    with temporary_tables(rows.sparkSession):
        packed = _stored(rows, features)
        top = packed.agg(F.max(LABEL)).first()[0]
        if top is None:
            raise ValueError("no rows to learn from")
        g, outline = begun(top)
        outline.write().save(path)
        nodes = _nodes(packed, g)
        leaf = F.col("feature") < 0
        split = F.struct(
            F.col("feature").alias("featureIndex"),
            F.when(leaf, F.array().cast("array<double>")).otherwise(F.array("category")).alias("leftCategoriesOrThreshold"),
            F.when(leaf, F.lit(-1)).otherwise(F.lit(2)).alias("numCategories"),
        )
        data = nodes.repartition(2 * g.trees, "tree").groupBy("tree").applyInArrow(_numbered(g), _NUMBERED)
        fields = ["id", "prediction", "impurity", F.col("stats").alias("impurityStats"), "rawCount", "gain", "leftChild", "rightChild"]
        data.select("treeID", F.struct(*fields, split.alias("split")).alias("nodeData")).write.mode("overwrite").parquet(f"{path}/data")


def drawn_by(*cols: Column | str) -> Column:
    """A number to draw a row by."""
    return F.xxhash64(*cols).alias(DRAW)
