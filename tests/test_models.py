import pytest
from conftest import posting, rows_of
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import bindings
from postlens import operators as O
from postlens import plans, sources


def test_category_values(postings):
    df = postings(
        posting("1", job_title="B", skills=["x", "x", None]),
        posting("2", job_title="A", industry=None, skills=["y"]),
        posting("3", job_title="A", skills=None),
    )
    assert rows_of(O.category_values(df, ["job_title", "industry"])) == [
        ("industry", "Tech"),
        ("job_title", "A"),
        ("job_title", "B"),
        ("skills", "x"),
        ("skills", "y"),
    ]


def test_features(postings):
    model = O.fit_features(
        postings(
            posting("1", job_title="B", skills=["x"], experience_level=None, industry=None, job_type=None),
            posting("2", job_title="A", skills=["y", "x"], experience_level=None, industry=None),
        )
    )
    assert model.names == ("job_title_A", "job_title_B", "job_type_Remote", "x", "y")
    asked = postings(
        posting("1", job_title="A", skills=["y", "y", "z", None]),
        posting("2", job_title="unknown", job_type=None, skills=None),
    )
    got = model.transform(asked).orderBy("job_id").select(vector_to_array("features"))
    assert [x[0] for x in rows_of(got)] == [[1, 0, 1, 0, 1], [0, 0, 0, 0, 0]]
    assert model.transform(asked).columns == asked.columns + ["features"]
    levels = [("job_title", "A"), ("job_title", "B"), ("job_type", "Remote"), ("skills", "x"), ("skills", "y")]
    long = O.features_long(asked, spark_of(asked).createDataFrame(levels, "field string, value string"))
    assert "vector" not in long._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(rows_of(long)) == [("1", "job_title_A", 1.0), ("1", "job_type_Remote", 1.0), ("1", "y", 1.0)]


def spark_of(df):
    return df.sparkSession


def test_blocks_use_the_fitted_columns(spark):
    rows = [("1", "A", ["x"], 10.0), ("2", "B", ["y"], 20.0), ("3", "A", None, 10.0), ("4", "B", ["x"], 20.0)]
    df = spark.createDataFrame(rows, "job_id string, title string, tools array<string>, salary double")
    features = O.fit_features(df, cols=("title",), skills_col="tools")
    assert (features.cols, features.skills_col) == (("title",), "tools")
    exact = {"trees": 1, "depth": 2, "bootstrap": False}
    for blocks in (None, 2):
        model = O.fit_salary(df, features, blocks=blocks, **exact)
        got = O.salary_scorer(features, model)(df).select("job_id", "prediction")
        assert sorted(rows_of(got)) == [("1", 10.0), ("2", 20.0), ("3", 10.0), ("4", 20.0)]
    with pytest.raises(ValueError):
        O.fit_features(df, cols=("title",), skills_col="tools", max_levels=2)


def test_missing_predictions_are_misses(spark):
    df = spark.createDataFrame([("High", "High"), ("High", None), ("Low", "Low")], "label string, prediction string")
    report = {r["class"]: r for r in O.classification_report(df).collect()}
    assert report["High"].support == 2 and report["High"].recall == 0.5 and None not in report
    assert rows_of(O.accuracy(df)) == [(3, report["accuracy"].f1_score)]


def test_split_is_stable(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("job_id"))
    train, test = O.split(df)
    assert train.count() + test.count() == 2000
    assert 320 < test.count() < 480
    again = O.split(df.repartition(7))[1]
    assert sorted(rows_of(test)) == sorted(rows_of(again))
    unnamed = spark.range(500).select(F.lit(None).cast("string").alias("job_id"), "id")
    assert 50 < O.split(unnamed)[1].count() < 150


@pytest.fixture(scope="module")
def extract(spark, sf_dir):
    rows = O.with_expected_salary(O.clean(bindings.raw_postings(spark, sf_dir)), bindings.PAY)
    rows = rows.withColumn("salary", F.col("expected_salary").cast("double"))
    return sources.materialize(sources.training_extract(rows, id_col="job_id"), "extract")


@pytest.fixture(scope="module")
def run(extract, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("training"))
    return plans.train(extract, out, trees=10, depth=8), out


def test_training_learns_the_rules(run):
    result, _ = run
    n, r2, mae = rows_of(result.salary_report)[0]
    assert n > 200 and r2 > 0.9 and mae < 20000
    assert rows_of(result.demand_accuracy)[0][1] > 0.75
    report = {x[0]: x for x in rows_of(result.demand_report)}
    assert list(report) and {"Low", "Medium", "High", "accuracy", "macro avg", "weighted avg"} == set(report)
    assert report["accuracy"][3] == rows_of(result.demand_accuracy)[0][1]


def test_importances(run):
    result, _ = run
    table = rows_of(result.importances)
    assert [x[:2] for x in table] == list(enumerate(result.models.features.names, 1))
    table = [x[1:] for x in table]
    assert sum(x[1] for x in table) == pytest.approx(1)
    top = rows_of(O.top_features(result.importances))
    assert top == sorted(table, key=lambda x: (-x[1], x[0]))[:4]


def test_saved_models_predict_the_same(spark, run, extract):
    result, out = run
    out = sources.current_version(spark, str(out))
    loaded = O.load_models(f"{out}/models")
    assert loaded.features.names == result.models.features.names
    requests = bindings.requests(extract)
    before, after = O.predict(requests, result.models), O.predict(requests, loaded)
    assert before.columns == ["request_id", "predicted_salary", "demand_score"]
    assert sorted(rows_of(before)) == sorted(rows_of(after))
    assert sources.read_result(spark, f"{out}/metadata_options", "metadata_options").count() == result.metadata.count()
    assert sources.read_result(spark, f"{out}/feature_importances", "feature_importances").count() == len(loaded.features.names)


def test_predictions_of_odd_requests(spark, run):
    models = run[0].models
    odd = spark.createDataFrame(
        [("1", "unknown", None, "", "?", None), ("2", "BUILDING", "Lead", "Remote", "ASIA", ["?", None])],
        "request_id string, job_title string, experience_level string, job_type string, industry string,"
        " skills array<string>",
    )
    got = rows_of(O.predict(odd, models).orderBy("request_id"))
    assert [x[0] for x in got] == ["1", "2"]
    assert all(x[1] > 0 and x[2] in ("Low", "Medium", "High") for x in got)
    words = spark.createDataFrame([("Brand#1",)], "skill string")
    boosts = O.what_if(odd, words, O.salary_scorer(models.features, models.salary), min_gain=-1e9)
    assert {x.request_id for x in boosts.collect()} == {"1", "2"}


def test_averaged_rows_train_as_well(extract):
    features = O.fit_features(extract)
    train, test = O.split(extract)
    model = O.fit_salary(train, features, trees=10, depth=8, blocks=8)
    scored = O.salary_scorer(features, model)(test)
    assert rows_of(O.regression_report(scored, "salary", "prediction"))[0][1] > 0.9


def test_averaging_keeps_every_row(postings):
    from postlens.operators.forest import _averaged

    df = postings(*[posting(str(i), salary=float(i), skills=["a", "b"] if i % 2 else ["b", "a", "a"]) for i in range(50)])
    rows = _averaged(df.withColumn("_label", F.col("salary")), ["job_title"], "skills", 4, "job_id", False).collect()
    assert len(rows) <= 4
    assert sum(x._weight for x in rows) == 50
    assert sum(x._weight * x._label for x in rows) == pytest.approx(sum(range(50)))


def test_rare_skill_can_split(spark, postings):
    # One posting in 3,000 has the skill; it must still be found.
    plain = [posting(str(i), skills=["a"], salary=1000.0) for i in range(2998)]
    df = postings(*plain, posting("x", skills=["a", "rare"], salary=900000.0), posting("y", skills=["a", "rare"], salary=900000.0))
    features = O.fit_features(df)
    model = O.fit_salary(df, features, trees=5, depth=3, seed=1, subsamplingRate=1.0)
    importances = {r.feature: r.importance for r in O.feature_importances(model, features, df).collect()}
    assert importances["rare"] > 0.9


def test_regression_report(spark):
    def report(*pairs):
        return rows_of(O.regression_report(spark.createDataFrame(list(pairs), "label double, prediction double")))[0]

    assert report((1.0, 1.0), (3.0, 2.0), (None, 1.0), (2.0, None)) == (2, 0.5, 0.5)
    assert report((2.0, 2.0), (2.0, 2.0)) == (2, 1.0, 0.0)
    assert report((2.0, 3.0), (2.0, 2.0)) == (2, 0.0, 0.5)
    assert report() == (0, None, None)


def test_classification_report(spark):
    pairs = [("Low", "Low")] * 3 + [("Low", "High")] + [("High", "High")] * 2 + [("High", "Low")] * 2
    df = spark.createDataFrame(pairs, "label string, prediction string")
    got = {x[0]: x[1:] for x in rows_of(O.classification_report(df))}
    assert got["Low"] == (0.6, 0.75, 0.666667, 4)
    assert got["High"] == (0.666667, 0.5, 0.571429, 4)
    assert got["Medium"] == (0.0, 0.0, 0.0, 0)
    assert got["accuracy"] == (None, None, 0.625, 8)
    assert got["macro avg"] == (0.422222, 0.416667, 0.412698, 8)
    assert got["weighted avg"] == (0.633333, 0.625, 0.619048, 8)
    assert rows_of(O.accuracy(df)) == [(8, 0.625)]
