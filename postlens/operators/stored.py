"""Forests that stay in their folder.

A forest of ``pyspark.ml`` is a graph of objects, several hundred bytes for each node, that the driver
builds, holds and sends whole. A large one is kept as the folder it is saved in; the tasks get its nodes
as arrays, about 30 bytes each, and answer a batch of rows at a time.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .features import FEATURES
from .trees import forest_nodes

# Forests of so many nodes at most are loaded as models of ``pyspark.ml``.
LOADED_NODES = 100_000
# Rows that walk down a tree at a time.
_ROWS = 4096


def opened(spark: SparkSession, path: str, model_class):
    """The forest saved below ``path``: a ``model_class``, or a ``Forest`` if it is large."""
    if spark.read.parquet(f"{path}/data").count() <= LOADED_NODES:
        return model_class.load(path)
    return Forest(spark, path, model_class)


class Forest:
    """A saved forest that answers as the model of ``pyspark.ml`` that ``loaded`` gives.

    Its folder has to stay for as long as it is used. What is not defined here is asked of the loaded model.
    """

    def __init__(self, spark: SparkSession, path: str, model_class):
        self.spark, self.path, self.model_class = spark, path, model_class

    def __getattr__(self, name: str):
        if name.startswith("_"):
            raise AttributeError(name)
        return getattr(self.loaded, name)

    @cached_property
    def loaded(self):
        return self.model_class.load(self.path)

    @cached_property
    def _facts(self) -> dict:
        return json.loads(self.spark.read.text(f"{self.path}/metadata").first()[0])

    @property
    def numFeatures(self) -> int:  # noqa: N802
        return self._facts["numFeatures"]

    @property
    def getNumTrees(self) -> int:  # noqa: N802
        return self._facts["numTrees"]

    @cached_property
    def totalNumNodes(self) -> int:  # noqa: N802
        return self.spark.read.parquet(f"{self.path}/data").count()

    @cached_property
    def _shared(self):
        """The nodes of all trees as one table of arrays, each tree from its root on, sent to the tasks."""
        names = ["feature", "present", "absent", "votes" if self._facts.get("numClasses") else "value"]
        nodes = forest_nodes(self.spark, self.path).withColumn("feature", F.coalesce("feature", F.lit(self.numFeatures)))
        table = nodes.select("tree", "node", *names).toArrow()
        tree, node = table["tree"].to_numpy(), table["node"].to_numpy()
        order = np.lexsort((node, tree))
        tree, node = tree[order], node[order]
        roots = np.flatnonzero(np.concatenate([[True], tree[1:] != tree[:-1]]))
        first = roots[np.searchsorted(roots, np.arange(len(tree)), side="right") - 1]
        if not np.array_equal(first + node, np.arange(len(tree))):
            raise ValueError("nodes of a tree must be numbered from 0 on")
        # Followers of node i where its feature is absent, at 2 i, and present, at 2 i + 1; a leaf follows itself.
        child = np.stack([first + table[x].to_numpy()[order] for x in ("absent", "present")], -1).astype(np.int32).ravel()
        if names[-1] == "value":
            worth = table["value"].to_numpy()[order][:, None]
        else:
            votes = table["votes"].combine_chunks().flatten().to_numpy().reshape(len(tree), -1)[order]
            total = sum(votes.T)[:, None]
            worth = np.divide(votes, total, out=np.zeros(votes.shape), where=total != 0)
        arrays = (roots, table["feature"].to_numpy()[order].astype(np.int32), child, worth, self.numFeatures)
        return self.spark.sparkContext.broadcast(arrays)

    def transform(self, dataset: DataFrame) -> DataFrame:
        """``dataset`` with ``prediction``, the mean of the trees or the class with the most of their votes."""
        owned = F.filter(F.transform(vector_to_array(FEATURES), lambda v, i: F.when(v > 0, i)), lambda i: i.isNotNull())
        return dataset.withColumn("prediction", F.arrow_udf(_answers(self._shared), "double")(owned))

    @cached_property
    def featureImportances(self):  # noqa: N802
        """As the model's: each tree's gains by feature, weighted and adding up to 1, then those of all trees."""
        node = F.col("nodeData")
        inner = self.spark.read.parquet(f"{self.path}/data").filter(node["leftChild"] >= 0)
        stats = node["impurityStats"]
        weight = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x) if self._facts.get("numClasses") else stats[0]
        gains = inner.select("treeID", node["id"].alias("id"), node["split"]["featureIndex"].alias("feature"), (node["gain"] * weight).alias("gain"))
        size = self.numFeatures

        def run(table: pa.Table) -> pa.Table:
            table = table.sort_by("id")
            found = np.bincount(table["feature"].to_numpy(), weights=table["gain"].to_numpy(), minlength=size)
            shares = found / found.sum() if found.sum() else found
            return pa.table({"tree": table["treeID"][:1], "shares": pa.array([shares], pa.list_(pa.float64()))})

        rows = gains.groupBy("treeID").applyInArrow(run, "tree int, shares array<double>").collect()
        total = sum((np.array(r.shares) for r in sorted(rows)), np.zeros(size))
        return Vectors.dense(total / total.sum() if total.sum() else total)

    def write(self) -> _Writer:
        return _Writer(self)

    def save(self, path: str) -> None:
        self.write().save(path)


class _Writer:
    """Copies a forest's folder."""

    def __init__(self, forest: Forest):
        self.forest, self.over = forest, False

    def overwrite(self) -> _Writer:
        self.over = True
        return self

    def save(self, path: str) -> None:
        spark = self.forest.spark
        hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
        source, target = hadoop.Path(self.forest.path), hadoop.Path(path)
        files = target.getFileSystem(conf)
        if files.exists(target):
            if not self.over:
                raise OSError(f"Path {path} already exists")
            files.delete(target, True)
        hadoop.FileUtil.copy(source.getFileSystem(conf), source, files, target, False, True, conf)


def _answers(shared):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        roots, feature, child, worth, size = shared.value
        for batch in batches:
            out = [_walked(batch.slice(i, _ROWS), roots, feature, child, worth, size) for i in range(0, len(batch), _ROWS)]
            yield pa.array(np.concatenate(out) if out else np.empty(0))

    return run


def _walked(owned: pa.Array, roots, feature, child, worth, size: int) -> np.ndarray:
    n = len(owned)
    has = np.zeros((n, size + 1), np.uint8)
    many = owned.value_lengths().to_numpy(zero_copy_only=False)
    has[np.repeat(np.arange(n), many), owned.flatten().to_numpy()] = 1
    has, row = has.ravel(), np.arange(n) * (size + 1)
    total = np.zeros((n, worth.shape[1]))
    for root in roots:
        at = np.full(n, root)
        while ((asks := feature[at]) < size).any():
            at = child[2 * at + has[row + asks]]
        # In tree order, as the model itself adds them.
        total += worth[at]
    return total.argmax(1).astype(float) if worth.shape[1] > 1 else total[:, 0] / len(roots)
