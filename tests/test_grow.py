import pytest
from conftest import rows_of
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import functions as F

from postlens import operators as O
from postlens.operators import grow as grow_module
from postlens.operators.forest import FEATURES, LABEL, WEIGHT, fit_forest, training_rows


@pytest.fixture(scope="module")
def table(spark):
    def pick(n, *parts):
        return F.element_at(F.array(*[F.lit(x) for x in parts]), (F.pmod(F.xxhash64("id", F.lit(n)), F.lit(len(parts))) + 1).cast("int"))

    names = [f"s{i}" for i in range(6)]
    skills = F.filter(F.array(*[pick(i, name, None) for i, name in enumerate(names)]), lambda x: x.isNotNull())
    rows = spark.range(600).select(F.col("id").cast("string").alias("job_id"), pick(7, "a", "b", "c").alias("title"), skills.alias("skills"))
    pay = F.size("skills") * 7 + F.when(F.array_contains("skills", "s1"), 50).otherwise(3) * F.when(F.col("title") == "a", 2).otherwise(1)
    df = rows.withColumn("salary", pay.cast("double")).withColumn("code", F.pmod(pay, F.lit(3)).cast("double"))
    return df.localCheckpoint()


def _nodes(spark, model, path):
    model.write().save(path)
    # Nodes have equal features, values and followers, whichever side Spark puts first.
    nodes = O.forest_nodes(spark, path).select("tree", "node", "feature", "present", "absent", F.round("value", 6), "votes")
    return sorted(tuple(map(str, r)) for r in nodes.collect())


@pytest.mark.parametrize("group_rows", [10_000, 40])
@pytest.mark.parametrize("label", ["salary", "code"])
def test_one_tree_is_that_of_the_estimator(spark, table, tmp_path, monkeypatch, group_rows, label):
    # With few rows to a group, most nodes are split by counting over the whole table.
    monkeypatch.setattr(grow_module.Growth.__init__, "__defaults__", (group_rows,))
    features = O.fit_features(table, cols=("title",))
    rows = training_rows(table, features, F.col(label))
    kind, model_class = {
        "salary": (RandomForestRegressor, RandomForestRegressionModel),
        "code": (RandomForestClassifier, RandomForestClassificationModel),
    }[label]
    forest = kind(
        featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, numTrees=1, maxDepth=6, seed=1, bootstrap=False, featureSubsetStrategy="all"
    )
    grown, fitted = fit_forest(forest, rows, model_class), forest.fit(rows)
    assert type(grown) is type(fitted) and grown.totalNumNodes == fitted.totalNumNodes > 20
    assert _nodes(spark, grown, str(tmp_path / "a")) == _nodes(spark, fitted, str(tmp_path / "b"))
    assert grown.featureImportances.toArray() == pytest.approx(fitted.featureImportances.toArray())


def test_a_forest_of_blocks_is_the_same_in_any_layout(spark, table, tmp_path):
    features = O.fit_features(table, cols=("title",))
    found = [
        _nodes(spark, O.fit_salary(df, features, trees=3, depth=5, blocks=4), str(tmp_path / str(i)))
        for i, df in enumerate((table.coalesce(1), table.repartition(5, "salary")))
    ]
    assert found[0] == found[1]


def test_requests_descend_without_a_join_for_each_level(spark, table, tmp_path):
    features = O.fit_features(table, cols=("title",))
    model = O.fit_salary(table, features, trees=3, depth=5)
    model.write().save(str(tmp_path / "m"))
    requests = table.withColumnRenamed("job_id", "request_id")
    from postlens.operators.trees import descend, mean_of_trees

    leaves = descend(requests, features, O.forest_nodes(spark, str(tmp_path / "m")), depth=5)
    assert "Join" not in leaves._jdf.queryExecution().optimizedPlan().toString()
    walked = leaves.select("request_id", mean_of_trees().alias("prediction"))
    scored = O.salary_scorer(features, model)(requests).select("request_id", "prediction")
    assert sorted(rows_of(walked)) == sorted(rows_of(scored))
    # Rows of one request have their leaves side by side, as many as there are trees for each row.
    twice = descend(requests.unionByName(requests), features, O.forest_nodes(spark, str(tmp_path / "m")), depth=5)
    assert {r[0] for r in rows_of(twice.select(F.size("leaves")))} == {6}


@pytest.mark.parametrize("label", ["salary", "code"])
@pytest.mark.parametrize("depth", [0, 2])
def test_rows_of_the_deepest_nodes_go_nowhere(spark, table, tmp_path, monkeypatch, depth, label):
    # More rows than a group may have are left in every leaf; none of them may be dealt to one.
    monkeypatch.setattr(grow_module.Growth.__init__, "__defaults__", (1,))

    def refused(*_):
        raise AssertionError("rows of a leaf are dealt to a group")

    monkeypatch.setattr(grow_module, "_dealt", refused)
    features = O.fit_features(table, cols=("title",))
    rows = training_rows(table, features, F.col(label))
    kind, model_class = {
        "salary": (RandomForestRegressor, RandomForestRegressionModel),
        "code": (RandomForestClassifier, RandomForestClassificationModel),
    }[label]
    forest = kind(
        featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, numTrees=1, maxDepth=depth, seed=1, bootstrap=False, featureSubsetStrategy="all"
    )
    grown, fitted = fit_forest(forest, rows, model_class), forest.fit(rows)
    assert _nodes(spark, grown, str(tmp_path / "a")) == _nodes(spark, fitted, str(tmp_path / "b"))
