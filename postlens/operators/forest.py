"""Random forests for salary and demand on ``pyspark.ml``."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace
from uuid import uuid4

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import FOREST_DEPTH, FOREST_SEED, FOREST_TREES, TOP_DRIVERS
from ..functions.labels import demand_code, demand_label
from ..functions.money import round_money
from ..schema import COLUMNS
from ..sources.shared import remove_table, shared_dir
from .features import FEATURES, FeatureModel
from .grow import DRAW, LABEL, WEIGHT, Growth, drawn_by, grow
from .stored import Forest, opened

# What ``grow`` knows of an estimator's settings; with others the estimator itself is fitted.
_GROWN = {"bootstrap", "featureSubsetStrategy", "subsamplingRate", "maxMemoryInMB"}
_SIZES = {"featuresCol", "labelCol", "weightCol", "numTrees", "maxDepth", "seed"}
_TRIED = {"all": lambda n: n, "sqrt": lambda n: math.ceil(math.sqrt(n))}
BLOCK = "_block"


@dataclass(frozen=True)
class Models:
    features: FeatureModel
    salary: RandomForestRegressionModel | Forest
    demand: RandomForestClassificationModel | Forest

    def loaded(self) -> Models:
        """The same with both forests as models of ``pyspark.ml``, however large."""
        return replace(self, **{x: getattr(getattr(self, x), "loaded", getattr(self, x)) for x in ("salary", "demand")})


def _averaged(rows: DataFrame, keys: list[str], skills_col: str, blocks: int, id_col: str, by_label: bool) -> DataFrame:
    """One weighted row for each distinct profile and block of ids.

    Rows of one profile have the same features, so no split can part them: only their mean label and
    their number matter. Blocks keep several rows for a frequent profile, so that the trees still
    draw different samples of it, and spread a profile held by a third of all rows over many tasks.
    """
    profile = [F.col(x) for x in keys]
    skills = F.array_compact(F.coalesce(skills_col, F.array()))
    profile.append(F.array_sort(F.array_distinct(skills)).alias(skills_col))
    keyed = rows.select(*profile, F.pmod(F.xxhash64(id_col), F.lit(blocks)).alias(BLOCK), LABEL)
    groups = [*keys, skills_col, BLOCK]
    if by_label:
        return keyed.groupBy(*groups, LABEL).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT))
    return keyed.groupBy(*groups).agg(F.avg(LABEL).alias(LABEL), F.count(F.lit(1)).cast("double").alias(WEIGHT))


def training_rows(
    df: DataFrame, features: FeatureModel, label, blocks: int | None = None, id_col: str = "", by_label: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Features, label and weight of the rows that have a label, and, without ``blocks``, columns to ``keep``."""
    rows = df.withColumn(LABEL, label).filter(F.col(LABEL).isNotNull())
    if blocks:
        rows = _averaged(rows, list(features.cols), features.skills_col, blocks, id_col, by_label)
        # No two of these rows are equal, so a tree draws the same ones in any layout.
        rows = rows.withColumn(DRAW, drawn_by(*features.cols, features.skills_col, BLOCK, LABEL))
    else:
        rows = rows.withColumn(WEIGHT, F.lit(1.0)).withColumn(DRAW, F.monotonically_increasing_id())
    # Declared binary, every feature has one known split. Spark would otherwise look for split
    # points in a sample, where a rare skill may not occur at all.
    slots = [{"idx": i, "name": name} for i, name in enumerate(features.names)]
    meta = {"ml_attr": {"attrs": {"binary": slots}, "num_attrs": len(slots)}}
    return features.transform(rows).select(FEATURES, LABEL, WEIGHT, DRAW, *keep).withMetadata(FEATURES, meta)


def is_grown(forest) -> bool:
    """Whether ``grow`` knows all settings of the estimator."""
    known = {p.name for p in forest.params if forest.isSet(p)} <= _GROWN | _SIZES
    return known and forest.getFeatureSubsetStrategy() in _TRIED and (forest.getBootstrap() or forest.getSubsamplingRate() == 1.0)


def fit_forest(forest, rows: DataFrame, model_class):
    """The model of ``forest``, an estimator, for ``training_rows``; a ``Forest`` if it is grown large.

    Bootstrapped rows are drawn by a hash of ``DRAW`` and the tree, or as often as a column ``COUNTS`` says.
    """
    if not is_grown(forest):
        return forest.fit(rows)
    spark, size = rows.sparkSession, rows.schema[FEATURES].metadata["ml_attr"]["num_attrs"]
    sorts = isinstance(forest, RandomForestClassifier)

    def begun(top: float):
        tried, rate = _TRIED[forest.getFeatureSubsetStrategy()](size), forest.getSubsamplingRate() if forest.getBootstrap() else None
        growth = Growth(forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed(), size, int(top) + 1 if sorts else 0, tried, rate)
        kinds = (VectorUDT(), T.DoubleType(), T.DoubleType())
        schema = T.StructType([T.StructField(name, kind) for name, kind in zip((FEATURES, LABEL, WEIGHT), kinds)])
        return growth, forest.fit(spark.createDataFrame([(Vectors.sparse(size, [], []), float(top), 1.0)], schema))

    path = f"{shared_dir(spark)}/forest-{uuid4().hex}"
    try:
        grow(rows, size, begun, path)
        model = opened(spark, path, model_class)
    except BaseException:
        remove_table(spark, path)
        raise
    # A large forest stays there, as stored tables do, until ``remove_tables``.
    if not isinstance(model, Forest):
        remove_table(spark, path)
    return model


def fit_salary(
    df: DataFrame,
    features: FeatureModel,
    trees: int = FOREST_TREES,
    depth: int = FOREST_DEPTH,
    seed: int = FOREST_SEED,
    label: str = COLUMNS.salary,
    blocks: int | None = None,
    id_col: str = COLUMNS.job_id,
    **params,
) -> RandomForestRegressionModel | Forest:
    """Regression forest that considers all features at each split.

    ``blocks`` trains on one weighted row per profile and block of ids instead of one per posting
    (see ``_averaged``): far fewer rows where profiles repeat. ``params`` go to the estimator.
    """
    rows = training_rows(df, features, F.col(label).cast("double"), blocks, id_col, by_label=False)
    forest = RandomForestRegressor(
        featuresCol=FEATURES,
        labelCol=LABEL,
        weightCol=WEIGHT,
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        **{"featureSubsetStrategy": "all", "maxMemoryInMB": 512, **params},
    )
    return fit_forest(forest, rows, RandomForestRegressionModel)


def fit_demand(
    df: DataFrame,
    features: FeatureModel,
    trees: int = FOREST_TREES,
    depth: int = FOREST_DEPTH,
    seed: int = FOREST_SEED,
    label: str = "demand_score",
    blocks: int | None = None,
    id_col: str = COLUMNS.job_id,
    **params,
) -> RandomForestClassificationModel | Forest:
    """Classification forest over Low, Medium and High; rows with another label are left out."""
    rows = training_rows(df, features, demand_code(F.col(label)), blocks, id_col, by_label=True)
    forest = RandomForestClassifier(
        featuresCol=FEATURES,
        labelCol=LABEL,
        weightCol=WEIGHT,
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        **{"featureSubsetStrategy": "sqrt", "maxMemoryInMB": 512, **params},
    )
    return fit_forest(forest, rows, RandomForestClassificationModel)


def feature_importances(model: RandomForestRegressionModel | Forest, features: FeatureModel, df: DataFrame) -> DataFrame:
    """(position, feature, importance) in feature order, one row for each slot; they sum to 1."""
    values = model.featureImportances.toArray()
    positions = range(1, len(features.names) + 1)
    columns = {"position": positions, "feature": list(features.names), "importance": values.astype(float)}
    table = pa.table({k: pa.array(v) for k, v in columns.items()})
    return df.sparkSession.createDataFrame(table)


def top_features(importances: DataFrame, k: int = TOP_DRIVERS) -> DataFrame:
    return importances.select("feature", "importance").orderBy(F.desc("importance"), "feature").limit(k)


def predict(requests: DataFrame, models: Models, request_col: str = "request_id") -> DataFrame:
    """(request, predicted_salary, demand_score) for a table of requests."""
    ready = models.features.transform(requests).select(request_col, FEATURES)
    paid = models.salary.transform(ready).select(
        request_col, FEATURES, round_money(F.col("prediction")).alias("predicted_salary")
    )
    return models.demand.transform(paid).select(
        request_col, "predicted_salary", demand_label(F.col("prediction")).alias("demand_score")
    )


def salary_scorer(features: FeatureModel, salary: RandomForestRegressionModel | Forest) -> Callable[[DataFrame], DataFrame]:
    """The salary forest as a scorer for ``what_if``."""

    def score(df: DataFrame) -> DataFrame:
        return salary.transform(features.transform(df)).select(*df.columns, "prediction")

    return score


def save_models(models: Models, path: str) -> None:
    models.features.save(f"{path}/features")
    models.salary.write().overwrite().save(f"{path}/salary")
    models.demand.write().overwrite().save(f"{path}/demand")


def load_models(path: str) -> Models:
    spark = SparkSession.active()
    return Models(
        FeatureModel.load(f"{path}/features"),
        opened(spark, f"{path}/salary", RandomForestRegressionModel),
        opened(spark, f"{path}/demand", RandomForestClassificationModel),
    )
