"""A forest as tables: its nodes, the paths to its leaves, predictions and what-if by walking them.

Features are present or absent, so a node asks for one feature, and a path to a leaf is two sets: the
features it requires and those it forbids. Adding one skill to a request changes a tree's answer only
if the request, walking down, meets a node that asks for that skill; from there the changed walk goes
on by itself. So one walk for each tree gives the effect of every addition.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import WHAT_IF_BEST, WHAT_IF_CANDIDATES, WHAT_IF_MIN_GAIN
from ..functions.labels import demand_label
from ..functions.money import round_money
from ..functions.skills import owned_skills
from ..sources.shared import materialize
from .features import FEATURES, MAX_LEVELS, FeatureModel
from .what_if import ORDERS

# Nodes that are sent to the tasks at most, about 30 bytes each: 50 full trees of depth 15.
MAX_NODES = 4_000_000


def forest_nodes(spark: SparkSession, path: str) -> DataFrame:
    """(tree, node, feature, present, absent, value, votes) of a forest, or tree, saved below ``path``.

    ``present`` and ``absent`` are the nodes that follow where the feature is there or not; a leaf has no
    feature and follows itself. ``value`` is the mean label or the code of the commonest class, ``votes``
    the weight of each class that the node has seen.
    """
    data = spark.read.parquet(f"{path}/data")
    node = F.col("nodeData")
    tree = F.col("treeID") if "treeID" in data.columns else F.lit(0)
    split = node["split"]
    leaf = node["leftChild"] < 0
    # A split either lists the values that go left or has the threshold up to which they do.
    listed = split["leftCategoriesOrThreshold"]
    goes_left = F.when(split["numCategories"] < 0, listed[0] >= 1.0).otherwise(F.array_contains(listed, 1.0))
    present = F.when(goes_left, node["leftChild"]).otherwise(node["rightChild"])
    absent = F.when(goes_left, node["rightChild"]).otherwise(node["leftChild"])
    return data.select(
        tree.cast("int").alias("tree"),
        node["id"].alias("node"),
        F.when(~leaf, split["featureIndex"]).alias("feature"),
        F.when(leaf, node["id"]).otherwise(present).alias("present"),
        F.when(leaf, node["id"]).otherwise(absent).alias("absent"),
        node["prediction"].alias("value"),
        node["impurityStats"].alias("votes"),
    )


def _checked(nodes: DataFrame, max_nodes: int) -> int:
    """Number of nodes; fails if they are too many to send to every task."""
    count = nodes.count()
    if count > max_nodes:
        raise ValueError(f"the forest has {count} nodes, more than {max_nodes}")
    return count


def leaf_paths(nodes: DataFrame, depth: int = 30) -> DataFrame:
    """(tree, leaf, required, forbidden, value): a row for each leaf, features by number.

    A request reaches the leaf of a tree whose required features it has and whose forbidden ones it
    lacks; just one of each tree. Found level by level from the roots; ``depth`` bounds the levels.
    """
    none = F.array().cast("array<int>")
    step = nodes.select("tree", F.col("node").alias("at"), "feature", "present", "absent", "value")
    front = step.filter("at = 0").withColumns({"required": none, "forbidden": none})
    out = front.filter("feature is null")
    for _ in range(depth):
        front = front.filter("feature is not null")
        yes = F.struct(F.col("present").alias("at"), F.array_append("required", F.col("feature")).alias("required"), "forbidden")
        no = F.struct(F.col("absent").alias("at"), "required", F.array_append("forbidden", F.col("feature")).alias("forbidden"))
        both = front.select("tree", F.inline(F.array(yes, no)))
        # Stored by level: the next one starts from a table instead of all joins before it.
        front = materialize(both.join(step, ["tree", "at"]), "tree_level")
        if front.isEmpty():
            break
        out = out.unionByName(front.filter("feature is null"))
    sets = [F.array_sort(x).alias(x) for x in ("required", "forbidden")]
    return out.select("tree", F.col("at").alias("leaf"), *sets, "value")


def owned_features(requests: DataFrame, features: FeatureModel) -> DataFrame:
    """``requests`` with ``_owned``, the numbers of the features that each has."""
    dense = vector_to_array(FEATURES)
    owned = F.filter(F.transform(dense, lambda v, i: F.when(v > 0, i)), lambda i: i.isNotNull())
    return features.transform(requests).withColumn("_owned", owned).drop(FEATURES)


def descend(
    requests: DataFrame, features: FeatureModel, nodes: DataFrame, depth: int, request_col: str = "request_id",
    max_nodes: int = MAX_NODES,
) -> DataFrame:
    """(request, leaves): for each request the leaf it reaches in every tree, as an array in tree order of
    (tree, value, votes).

    The table is a forest's, bounded by ``max_nodes``, so it is sent to the tasks, where each batch of
    requests walks down every tree, ``depth`` levels at most. Rows of one request have their leaves
    side by side; they meet by their features before the walk, so that no leaf is shuffled.
    """
    _checked(nodes, max_nodes)
    columns = [F.coalesce("feature", F.lit(-1)).alias("feature"), "present", "absent", "value", "votes"]
    table = nodes.select("tree", "node", *columns).toArrow()
    arrays = {name: table[name].to_numpy() for name in table.column_names if name != "votes"}
    arrays["votes"] = table["votes"].combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
    shared = requests.sparkSession.sparkContext.broadcast((arrays, len(features.names), depth))
    asked = owned_features(requests, features).groupBy(request_col).agg(F.collect_list("_owned").alias("_owned"))
    kind = requests.schema[request_col].dataType.simpleString()
    found = asked.mapInArrow(_descended(shared), f"`{request_col}` {kind}, leaves array<struct<tree:int,value:double,votes:array<double>>>")
    return found.withColumn("leaves", F.when(F.size("leaves") > len(set(arrays["tree"])), F.array_sort("leaves")).otherwise(F.col("leaves")))


def _descended(shared, rows: int = 4096):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays, names, depth = shared.value
        walk = _Walk(arrays)
        trees = len(walk.roots)
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                asked, owned = batch.column(1), batch.column(1).flatten()
                n = len(owned)
                many = owned.value_lengths().to_numpy(zero_copy_only=False)
                has = np.zeros((n, names), bool)
                has[np.repeat(np.arange(n), many), owned.flatten().to_numpy()] = True
                ends = walk.ends(has, depth).ravel()
                votes = walk.votes[ends]
                steps = np.arange(len(ends) + 1, dtype=np.int32) * votes.shape[1]
                parts = [
                    pa.array(walk.tree[ends], pa.int32()),
                    pa.array(walk.value[ends]),
                    pa.ListArray.from_arrays(pa.array(steps), pa.array(votes.ravel())),
                ]
                leaves = pa.StructArray.from_arrays(parts, names=["tree", "value", "votes"])
                each = np.cumsum(asked.value_lengths().to_numpy(zero_copy_only=False)) * trees
                offsets = np.concatenate([[0], each]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), leaves)
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[batch.schema.names[0], "leaves"])

    return run


def mean_of_trees(leaves: str = "leaves"):
    """Mean of the leaves' values, added in tree order, so that it is the same number in any run."""
    total = F.aggregate(leaves, F.lit(0.0), lambda a, x: a + x["value"])
    return total / F.size(leaves)


def demand_of_trees(classes: int, leaves: str = "leaves"):
    """Code of the class with the most votes over all trees, each of which has one vote to share; of
    equal classes the first."""

    def share(c: int):
        total = lambda x: F.aggregate(x["votes"], F.lit(0.0), lambda a, v: a + v)
        return F.aggregate(leaves, F.lit(0.0), lambda a, x: a + F.when(total(x) != 0, x["votes"][c] / total(x)).otherwise(F.lit(0.0)))

    shares = F.array(*[share(c) for c in range(classes)])
    return F.array_position(shares, F.array_max(shares)).cast("double") - 1


def predict_by_nodes(
    requests: DataFrame, features: FeatureModel, salary: DataFrame, demand: DataFrame, depth: int, classes: int = 3,
    request_col: str = "request_id",
) -> DataFrame:
    """(request, predicted_salary, demand_score) from the node tables of both forests, as ``predict``."""
    paid = descend(requests, features, salary, depth, request_col).select(
        request_col, round_money(mean_of_trees()).alias("predicted_salary")
    )
    label = demand_label(demand_of_trees(classes))
    asked = descend(requests, features, demand, depth, request_col).select(F.col(request_col).alias("_asked"), label.alias("demand_score"))
    return paid.join(asked, F.col(request_col) == F.col("_asked")).drop("_asked")


class _Walk:
    """Node arrays of a forest and the walk of a batch of requests through them."""

    def __init__(self, nodes: dict[str, np.ndarray]):
        order = np.lexsort((nodes["node"], nodes["tree"]))
        tree, node = nodes["tree"][order], nodes["node"][order]
        self.roots = np.flatnonzero(np.concatenate([[True], tree[1:] != tree[:-1]])) if len(tree) else np.empty(0, np.int64)
        first = self.roots[np.searchsorted(self.roots, np.arange(len(tree)), side="right") - 1] if len(tree) else self.roots
        # Nodes are numbered without gaps from the root of their tree on.
        self.feature = nodes["feature"][order]
        self.present, self.absent = first + nodes["present"][order], first + nodes["absent"][order]
        self.value, self.tree = nodes["value"][order], tree
        self.votes = nodes["votes"][order] if "votes" in nodes else None
        if not np.array_equal(first + node, np.arange(len(tree))):
            raise ValueError("nodes of a tree must be numbered from 0 on")

    def ends(self, has: np.ndarray, depth: int) -> np.ndarray:
        """(row, tree): the node that a row reaches in each tree after ``depth`` levels at most."""
        out = np.empty((len(has), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            at, here = np.full(len(has), root), np.arange(len(has))
            for _ in range(depth):
                asks = self.feature[at[here]]
                inner = asks >= 0
                here, asks = here[inner], asks[inner]
                if not len(here):
                    break
                at[here] = np.where(has[here, asks], self.present[at[here]], self.absent[at[here]])
            out[:, t] = at
        return out

    def gains(self, has: np.ndarray, slot: np.ndarray, slots: int) -> np.ndarray:
        """(row, slot): the forest's answer with one more feature minus that without, for features
        that ``slot`` (row, feature) gives a number from 0 on."""
        rows = len(has)
        base, more = np.zeros(rows), np.zeros((rows, slots))
        for root in self.roots:
            at, here = np.full(rows, root), np.arange(rows)
            met = []
            while len(here):
                asks = self.feature[at[here]]
                inner = asks >= 0
                here, asks = here[inner], asks[inner]
                owned = has[here, asks]
                tries = slot[here, asks]
                new = np.flatnonzero(~owned & (tries >= 0))
                met.append((here[new], tries[new], asks[new], self.present[at[here[new]]]))
                at[here] = np.where(owned, self.present[at[here]], self.absent[at[here]])
            value = self.value[at]
            answers = np.repeat(value[:, None], slots, axis=1)
            row, tried, added, where = (np.concatenate(x) for x in zip(*met))
            open_ = np.arange(len(row))
            while len(open_):
                asks = self.feature[where[open_]]
                inner = asks >= 0
                open_, asks = open_[inner], asks[inner]
                owned = has[row[open_], asks] | (asks == added[open_])
                where[open_] = np.where(owned, self.present[where[open_]], self.absent[where[open_]])
            answers[row, tried] = self.value[where]
            # In tree order, as the model itself adds them.
            base += value
            more += answers
        trees = max(len(self.roots), 1)
        return more / trees - (base / trees)[:, None]


def _walked(shared, columns: list[str], skills_col: str, max_candidates: int, min_gain: float, rows: int = 4096):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, names, levels, order = shared.value
        walk = _Walk(nodes)
        place = {skill: i for i, skill in enumerate(order)}
        # Feature of a skill of the vocabulary, or none; and the other way round for owned ones.
        feature_of = np.array([levels.get((skills_col, s), -1) for s in order], np.int64)
        gain = pa.struct([("pos", pa.int32()), ("skill", pa.string()), ("boost", pa.float64())])
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                n = batch.num_rows
                has = np.zeros((n, names + 1), bool)
                for name in columns:
                    for i, value in enumerate(batch.column(name).to_pylist()):
                        has[i, levels.get((name, value), names)] = True
                lacked = np.ones((n, len(order)), bool)
                for i, skills in enumerate(batch.column(skills_col).to_pylist()):
                    for skill in skills:
                        has[i, levels.get((skills_col, skill), names)] = True
                        if skill in place:
                            lacked[i, place[skill]] = False
                has[:, names] = False
                position = np.cumsum(lacked, axis=1) - 1
                tried = lacked & (position < max_candidates)
                slot = np.full((n, names + 1), -1, np.int64)
                row, which = np.nonzero(tried)
                known = feature_of[which] >= 0
                slot[row[known], feature_of[which[known]]] = position[row[known], which[known]]
                gains = walk.gains(has, slot, max_candidates)
                good = gains[row, position[row, which]] > min_gain
                row, which = row[good], which[good]
                place_of = position[row, which]
                items = pa.StructArray.from_arrays(
                    [
                        pa.array(place_of.astype(np.int32)),
                        pa.array([order[i] for i in which], pa.string()),
                        pa.array(gains[row, place_of]),
                    ],
                    fields=list(gain),
                )
                offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), items)
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[batch.schema.names[0], "gains"])

    return run


def what_if_by_walk(
    requests: DataFrame,
    vocabulary: DataFrame,
    features: FeatureModel,
    nodes: DataFrame,
    min_gain: float = WHAT_IF_MIN_GAIN,
    k: int = WHAT_IF_BEST,
    max_candidates: int = WHAT_IF_CANDIDATES,
    order: str = "alphabetical",
    request_col: str = "request_id",
    max_nodes: int = MAX_NODES,
    max_levels: int = MAX_LEVELS,
) -> DataFrame:
    """What ``what_if`` answers with a salary forest as the scorer, from one walk a tree instead of a
    scored copy of the request for each candidate. There is no shuffle and no feature vector.

    ``nodes`` is the forest's node table. It and the vocabulary are sent to the tasks and checked
    against ``max_nodes`` and ``max_levels``. See ``what_if`` for the other parameters.
    """
    if order not in ORDERS:
        raise ValueError(f"order must be one of {sorted(ORDERS)}, got {order!r}")
    spark, skills_col = requests.sparkSession, features.skills_col
    _checked(nodes, max_nodes)
    table = nodes.select("tree", "node", F.coalesce("feature", F.lit(-1)).alias("feature"), "present", "absent", "value").toArrow()
    arrays = {name: table[name].to_numpy() for name in table.column_names}
    usable, keys = F.col("skill").isNotNull(), []
    for name, down in ORDERS[order]:
        kind = vocabulary.schema[name].dataType.typeName()
        usable = usable & F.col(name).isNotNull() & (~F.isnan(name) if kind in ("double", "float") else F.lit(True))
        best = F.max(name) if down else F.min(name)
        keys.append((best.alias(f"_{name}"), F.desc(f"_{name}") if down else F.asc(f"_{name}")))
    ranked = vocabulary.filter(usable).groupBy("skill").agg(*[x for x, _ in keys]).orderBy(*[x for _, x in keys], "skill")
    listed = [r[0] for r in ranked.select("skill").limit(max_levels + 1).collect()]
    if len(listed) > max_levels:
        raise ValueError(f"more than {max_levels} skills in the vocabulary")
    shared = spark.sparkContext.broadcast((arrays, len(features.names), features.levels(), listed))
    columns = list(features.cols)
    asked = requests.select(
        request_col, *[F.col(c).cast("string").alias(c) for c in columns], owned_skills(requests, skills_col).alias(skills_col)
    )
    kind = requests.schema[request_col].dataType.simpleString()
    run = _walked(shared, columns, skills_col, max_candidates, min_gain)
    found = asked.mapInArrow(run, f"`{request_col}` {kind}, gains array<struct<pos:int,skill:string,boost:double>>")
    amounts = F.transform(
        "gains", lambda g: F.struct((-round_money(g["boost"])).alias("less"), g["pos"].alias("pos"), g["skill"].alias("skill"))
    )
    best = found.select(request_col, F.posexplode(F.slice(F.array_sort(amounts), 1, k)).alias("_n", "_g"))
    return best.select(
        request_col,
        (F.col("_n") + 1).cast("bigint").alias("rank"),
        F.col("_g.skill").alias("skill"),
        (-F.col("_g.less")).alias("boost_amount"),
    )
